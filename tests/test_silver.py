"""Rule chains per table on small inputs with one defect each."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from cofre.plans import silver
from cofre.schemas import contract, require_columns

OLD, NEW = datetime(2026, 9, 15, 10), datetime(2026, 9, 16, 10)
SCHEMAS = {
    "agencias": "agencia_id int, nome_agencia string, cidade string",
    "clientes": "cliente_id int, nome string, cpf string, data_nascimento timestamp_ntz",
    "tipos_transacao": "tipo_transacao_id int, descricao string",
    "contas": "conta_id int, cliente_id int, agencia_id int, saldo double",
    "cartoes": "cartao_id int, conta_id int, numero_cartao string, tipo_cartao string",
    "emprestimos": "emprestimo_id int, cliente_id int, valor_contratado double, parcelas int, data_contrato timestamp_ntz",
    "transacoes": "transacao_id int, conta_origem_id int, conta_destino_id int, tipo_transacao_id int, valor double, "
    "data_hora timestamp_ntz",
}


def run(spark, table, rows, **parents):
    """(accepted rows, [(key, reason)]) of one table; rows end in the ingestion time."""
    numbered = [(*row, i) for i, row in enumerate(rows)]
    raw = spark.createDataFrame(numbered, SCHEMAS[table] + ", _ingestion_timestamp timestamp_ntz, _row_seq bigint")
    frames = {
        name: spark.createDataFrame([(k,) for k in ids], f"{contract(name).key} int") for name, ids in parents.items()
    }
    prepared = silver.prepare(raw, table)
    tagged = silver.TAGGERS[table](prepared, silver.settle_repeated({table: prepared})[table], frames)
    key = contract(table).key
    accepted = silver.trusted_rows(tagged, table).orderBy(key).collect()
    rejects = silver.reject_rows(tagged)
    assert "_reject_reason" in rejects.columns
    reasons = sorted(((r[key], r["_reject_reason"]) for r in rejects.collect()), key=repr)
    assert len(accepted) + len(reasons) == len(rows)
    return accepted, reasons, rejects


DUPLICATE = "Null or duplicated primary key."
NULL = "Required field is null."


def test_null_key_is_rejected(spark):
    rows = [(1, "A", "Recife", NEW), (None, "B", "Natal", NEW), (3, "C", "Olinda", NEW)]
    accepted, reasons, _ = run(spark, "agencias", rows)
    assert [r["agencia_id"] for r in accepted] == [1, 3]
    assert reasons == [(None, DUPLICATE)]


def test_newest_agency_stays(spark):
    rows = [(1, "Agencia Atual", "R", NEW), (1, "Agencia Antiga", "R", OLD), (2, "B", "R", OLD)]
    accepted, reasons, _ = run(spark, "agencias", rows)
    assert [(r["agencia_id"], r["nome_agencia"]) for r in accepted] == [(1, "Agencia Atual"), (2, "B")]
    assert reasons == [(1, DUPLICATE)]


def test_first_failing_rule_names_the_reason(spark):
    rows = [(1, None, "R", OLD), (1, "A", None, NEW), (2, "", "R", NEW)]
    accepted, reasons, _ = run(spark, "agencias", rows)
    assert [r["agencia_id"] for r in accepted] == [2]  # empty text is not null
    assert reasons == [(1, DUPLICATE), (1, NULL)]


def test_types_are_deduplicated(spark):
    accepted, _, _ = run(spark, "tipos_transacao", [(1, "PIX", OLD), (1, " PIX ", NEW), (2, "TED", OLD)])
    assert [tuple(r)[:2] for r in accepted] == [(1, "PIX"), (2, "TED")]


BORN = datetime(1990, 1, 1)


def test_customers(spark):
    rows = [
        (1, "  Ana   Maria ", "111.111.111-11", BORN, NEW),
        (None, "B", "22222222222", BORN, NEW),
        (3, "C", "333", BORN, NEW),
        (4, "D", "44444444444", None, NEW),
    ]
    accepted, reasons, rejects = run(spark, "clientes", rows)
    assert [(r["nome"], r["cpf"], str(r["data_nascimento"])) for r in accepted] == [
        ("Ana Maria", "11111111111", "1990-01-01")
    ]
    invalid = "Required field is null or CPF is invalid."
    assert reasons == [(3, invalid), (4, invalid), (None, DUPLICATE)]
    assert rejects.where("cliente_id = 3").first()["cpf"] == "333"  # evidence stays


def test_shared_cpf_keeps_the_newest_complete_row(spark):
    rows = [
        (1, "A", "11111111111", BORN, NEW),
        (2, "B", "111.111.111-11", BORN, OLD),
        (3, "C", "11111111111", BORN, OLD),
        (4, None, "11111111111", BORN, None),  # incomplete, does not compete
        (4, "X", "11111111111", BORN, OLD),  # superseded, does not compete
        (5, "E", "55555555555", BORN, OLD),
    ]
    accepted, reasons, _ = run(spark, "clientes", rows)
    assert [r["cliente_id"] for r in accepted] == [1, 5]
    assert reasons == [
        (2, "Duplicated CPF."),
        (3, "Duplicated CPF."),
        (4, DUPLICATE),
        (4, "Required field is null or CPF is invalid."),
    ]


def test_bad_birth_date_comes_after_shared_cpf(spark):
    rows = [(1, "A", "11111111111", "1990-01-01", 0), (2, "B", "11111111111", "soon", 1)]
    raw = spark.createDataFrame(rows, "cliente_id int, nome string, cpf string, data_nascimento string, _row_seq bigint")
    trusted = silver.Trusted({"clientes": raw}, ["clientes"])
    assert trusted.rows("clientes").isEmpty()
    got = {r["cliente_id"]: (r["_reject_reason"], r["data_nascimento"]) for r in trusted.rejects("clientes").collect()}
    assert got == {1: ("Duplicated CPF.", "1990-01-01"), 2: ("Invalid birth date.", "soon")}


def test_accounts(spark):
    rows = [
        (1, 1, 10, 5.125, NEW),
        (2, 999, 10, 5.0, NEW),
        (3, 1, 999, 5.0, NEW),
        (4, 999, 999, 5.0, NEW),
        (5, 1, 10, -7.0, NEW),
        (6, 1, 10, float("inf"), NEW),
        (7, None, 10, 1.0, NEW),
    ]
    accepted, reasons, _ = run(spark, "contas", rows, clientes=[1], agencias=[10])
    assert [(r["conta_id"], str(r["saldo"])) for r in accepted] == [(1, "5.12"), (5, "-7.00")]
    assert reasons == [
        (2, "Referenced cliente_id does not exist."),
        (3, "Referenced agencia_id does not exist."),
        (4, "Referenced cliente_id does not exist."),
        (6, "Invalid monetary value."),
        (7, NULL),
    ]


CARD = "4000 1234 5678 9012"


def test_cards(spark):
    rows = [
        (1, 100, CARD, "DEBIT", OLD),
        (1, 100, CARD, "CREDIT", NEW),
        (2, 100, CARD, "DEBIT", NEW),
        (3, 999, CARD, "DEBIT", NEW),
        (4, 100, CARD, "debit", NEW),
        (5, 100, "4000 123", "DEBIT", NEW),
    ]
    accepted, reasons, rejects = run(spark, "cartoes", rows, contas=[100])
    assert [(r["cartao_id"], r["tipo_cartao"], r["numero_cartao_mascarado"]) for r in accepted] == [
        (1, "CREDIT", "**** **** **** 9012"),
        (2, "DEBIT", "**** **** **** 9012"),
    ]
    assert reasons == [
        (1, DUPLICATE),
        (3, "Referenced conta_id does not exist."),
        (4, "Invalid card type."),
        (5, "Required field is null or card number is invalid."),
    ]
    assert "numero_cartao" not in rejects.columns
    assert not any("1234" in str(v) for row in rejects.collect() for v in row)


def test_loans(spark):
    signed = datetime(2024, 1, 2, 3)
    rows = [
        (1, 1, 1000.0, 12, signed, NEW),
        (2, 1, 1000.0, 0, signed, NEW),
        (3, 1, 1000.0, -5, signed, NEW),
        (4, 999, 1000.0, 12, signed, NEW),
        (5, 1, 0.0, 7, signed, NEW),
    ]
    accepted, reasons, _ = run(spark, "emprestimos", rows, clientes=[1])
    assert [(r["emprestimo_id"], str(r["valor_contratado"]), str(r["data_contrato"])) for r in accepted] == [
        (1, "1000.00", "2024-01-02")
    ]
    assert reasons == [
        (2, "Invalid installment count."),
        (3, "Invalid installment count."),
        (4, "Referenced cliente_id does not exist."),
        (5, "Loan amount must be greater than zero."),
    ]


def test_transactions(spark):
    at = datetime(2024, 5, 1, 10)
    gap = datetime(2018, 11, 4, 0, 30)
    rows = [
        (1, 100, 200, 1, 100.0, at, NEW),
        (2, 999, 200, 1, 100.0, at, NEW),
        (3, 100, 999, 1, 100.0, at, NEW),
        (4, 100, 200, 9, 100.0, at, NEW),
        (5, 100, 100, 1, 100.0, at, NEW),
        (6, 100, 200, 1, 0.0, at, NEW),
        (7, 100, 200, 1, -50.0, at, NEW),
        (8, 100, 200, 1, 1.0, gap, NEW),
        (9, 999, 999, 9, 0.0, gap, NEW),
        (10, 100, 200, 1, 1.0, None, NEW),
    ]
    accepted, reasons, rejects = run(spark, "transacoes", rows, contas=[100, 200], tipos_transacao=[1])
    assert [(r["transacao_id"], str(r["valor"]), r["data_hora"]) for r in accepted] == [
        (1, "100.00", datetime(2024, 5, 1, 13))
    ]
    assert dict(reasons) == {
        2: "Referenced conta_origem_id does not exist.",
        3: "Referenced conta_destino_id does not exist.",
        4: "Referenced tipo_transacao_id does not exist.",
        5: "Source and destination accounts must be different.",
        6: "Transaction amount must be greater than zero.",
        7: "Transaction amount must be greater than zero.",
        8: "Invalid transaction timestamp.",
        9: "Referenced conta_origem_id does not exist.",
        10: NULL,
    }
    assert rejects.where("transacao_id = 8").first()["data_hora"] == "2018-11-04 00:30:00"


def test_rejected_parents_reject_their_children(spark):
    raw = {
        "agencias": spark.createDataFrame([(10, "A", "R", 0)], SCHEMAS["agencias"] + ", _row_seq bigint"),
        "clientes": spark.createDataFrame(
            [(1, "A", "11111111111", BORN, 0), (2, "B", "bad", BORN, 1)], SCHEMAS["clientes"] + ", _row_seq bigint"
        ),
        "contas": spark.createDataFrame(
            [(1, 1, 10, 1.0, 0), (2, 2, 10, 1.0, 1)], SCHEMAS["contas"] + ", _row_seq bigint"
        ),
        "cartoes": spark.createDataFrame(
            [(1, 1, CARD, "DEBIT", 0), (2, 2, CARD, "DEBIT", 1)], SCHEMAS["cartoes"] + ", _row_seq bigint"
        ),
    }
    trusted = silver.Trusted(raw, ["agencias", "clientes", "contas", "cartoes"])
    assert [r["cartao_id"] for r in trusted.rows("cartoes").collect()] == [1]
    assert trusted.rejects("cartoes").first()["_reject_reason"] == "Referenced conta_id does not exist."


def test_required_columns(spark):
    full = spark.createDataFrame([(1, "A", "R")], SCHEMAS["agencias"])
    assert require_columns(full, "agencias") is full
    with pytest.raises(ValueError, match="cidade"):
        require_columns(full.drop("cidade"), "agencias")
    with pytest.raises(ValueError, match="agencias"):
        contract("bancos")


def test_columns_outside_the_contract_do_not_get_in_the_way(spark):
    raw = spark.createDataFrame([(1, "A", "R", 0)], SCHEMAS["agencias"] + ", _row_seq bigint")
    trusted = silver.Trusted({"agencias": raw.withColumn("extra", F.lit(1))}, ["agencias"])
    assert trusted.rows("agencias").columns == ["agencia_id", "nome_agencia", "cidade"]


def test_rows_that_are_equally_new_are_refused(spark):
    """Neither of two rows of a key, or of a CPF, that tie on time and position may win."""
    schema = SCHEMAS["agencias"] + ", _ingestion_timestamp timestamp_ntz, _row_seq bigint"
    tied = spark.createDataFrame([(1, "A", "X", NEW, 4), (1, "B", "X", NEW, 4), (2, "C", "Y", OLD, 0)], schema)
    prepared = {"agencias": silver.prepare(tied, "agencias")}
    with pytest.raises(ValueError, match="agencia_id 1"):
        silver.settle_repeated(prepared)
    schema = SCHEMAS["clientes"] + ", _ingestion_timestamp timestamp_ntz, _row_seq bigint"
    people = [(1, "A", "11111111111", OLD, NEW, 4), (2, "B", "111.111.111-11", OLD, NEW, 4)]
    prepared = silver.prepare(spark.createDataFrame(people, schema), "clientes")
    with pytest.raises(ValueError, match="cpf 11111111111"):
        silver.tag_clientes(prepared, silver.settle_repeated({"clientes": prepared})["clientes"], {})
