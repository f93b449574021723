"""Golden counts of FIXTURES.md section 3, sf0.01."""

import pytest

from cofre.plans.silver import Trusted
from cofre.registry.queries import queries
from cofre.schemas import TABLES
from cofre.sources.bindings import Bindings

FOLDER = "/root/testdata/sf0.01"

VALID = {
    "agencias": 23,
    "clientes": 1401,
    "tipos_transacao": 5,
    "contas": 1160,
    "cartoes": 1352,
    "emprestimos": 4886,
    "transacoes": 9269,
}

REJECTED = {
    ("agencias", "Null or duplicated primary key."): 1,
    ("agencias", "Required field is null."): 1,
    ("clientes", "Duplicated CPF."): 20,
    ("clientes", "Invalid birth date."): 21,
    ("clientes", "Null or duplicated primary key."): 14,
    ("clientes", "Required field is null or CPF is invalid."): 44,
    ("tipos_transacao", "Null or duplicated primary key."): 2,
    ("tipos_transacao", "Required field is null."): 1,
    ("contas", "Invalid monetary value."): 32,
    ("contas", "Null or duplicated primary key."): 14,
    ("contas", "Referenced agencia_id does not exist."): 143,
    ("contas", "Referenced cliente_id does not exist."): 126,
    ("contas", "Required field is null."): 25,
    ("cartoes", "Invalid card type."): 143,
    ("cartoes", "Null or duplicated primary key."): 9,
    ("cartoes", "Referenced conta_id does not exist."): 432,
    ("cartoes", "Required field is null or card number is invalid."): 64,
    ("emprestimos", "Invalid contract date."): 447,
    ("emprestimos", "Invalid installment count."): 38017,
    ("emprestimos", "Loan amount must be greater than zero."): 474,
    ("emprestimos", "Null or duplicated primary key."): 14168,
    ("emprestimos", "Referenced cliente_id does not exist."): 1767,
    ("emprestimos", "Required field is null."): 241,
    ("transacoes", "Invalid transaction timestamp."): 3,
    ("transacoes", "Referenced conta_destino_id does not exist."): 2083,
    ("transacoes", "Referenced conta_origem_id does not exist."): 3367,
    ("transacoes", "Referenced tipo_transacao_id does not exist."): 81,
    ("transacoes", "Required field is null."): 114,
    ("transacoes", "Source and destination accounts must be different."): 8,
    ("transacoes", "Transaction amount must be greater than zero."): 75,
}

ROWS = {
    "daily_transaction_volume": 2399,
    "daily_pix_transaction_volume": 1733,
    "financial_volume_by_agency": 25,
    "transactions_per_customer": 1250,
    "average_balance_by_agency": 25,
    "customers_with_loans": 1500,
    "dim_data": 2399,
    "fato_transacao": 15000,
    "fato_emprestimo": 15000,
    "duplicated_cpf": 40,
    "dst_invalid_timestamps": 4,
}


@pytest.fixture(scope="module")
def trusted(spark):
    return Trusted(Bindings(spark, FOLDER).all_raw())


@pytest.mark.parametrize("table", TABLES)
def test_valid_and_rejected_counts(trusted, table):
    counts = {r["_reject_reason"]: r["count"] for r in trusted.tagged(table).groupBy("_reject_reason").count().collect()}
    wanted = {reason: n for (t, reason), n in REJECTED.items() if t == table} | {None: VALID[table]}
    assert counts == wanted


def test_balance_total(trusted):
    assert str(trusted.rows("contas").agg({"saldo": "sum"}).first()[0]) == "5199222.43"


@pytest.mark.parametrize("name", ROWS)
def test_row_counts(spark, name):
    assert queries()[name](spark, FOLDER).count() == ROWS[name]


def test_totals(spark):
    assert str(queries()["report_01_total_volume"](spark, FOLDER).first()[0]) == "3758439620.06"
    assert str(queries()["report_05_loan_overview"](spark, FOLDER).first()["valor_total_contratado"]) == "3758439620.06"


def test_batches(spark):
    b = queries()
    assert b["complete_batches"](spark, FOLDER).count() == 6
    assert b["latest_complete_batch"](spark, FOLDER).first()["batch_id"] == "batch-018"
    assert b["latest_silver_batch"](spark, FOLDER).first()["batch_id"] == "batch-010"
