"""Analytical datasets, star schema, reports and contracts on small inputs."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from cofre.operators import contracts
from cofre.plans import gold, reports, star

MOVES = "transacao_id bigint, conta_origem_id bigint, conta_destino_id bigint, tipo_transacao_id int, " \
    "valor decimal(15,2), data_hora timestamp_ntz"
LOANS = "emprestimo_id bigint, cliente_id bigint, valor_contratado decimal(15,2), parcelas int, data_contrato date"


def moves(spark, rows):
    return spark.createDataFrame([(*r[:4], Decimal(r[4]), r[5]) for r in rows], MOVES)


def loans(spark, rows):
    return spark.createDataFrame([(i, c, Decimal(v), p, d) for i, c, v, p, d in rows], LOANS)


def plain(df):
    return [tuple(str(v) if isinstance(v, Decimal) else v for v in r) for r in df.collect()]


@pytest.fixture()
def sample(spark):
    return moves(spark, [
        (1, 1, 2, 1, "10.00", datetime(2024, 1, 1, 23, 59)),
        (2, 1, 2, 2, "0.10", datetime(2024, 1, 2)),
        (3, 2, 1, 1, "0.20", datetime(2024, 1, 2, 12)),
        (4, 9, 1, 1, "99.00", datetime(2024, 1, 3)),
    ])


@pytest.fixture()
def accounts(spark):
    rows = [(1, 11, 7, Decimal("1.00")), (2, 11, 8, Decimal("2.00")), (3, 12, 8, Decimal("2.01"))]
    return spark.createDataFrame(rows, "conta_id bigint, cliente_id bigint, agencia_id int, saldo decimal(15,2)")


@pytest.fixture()
def types(spark):
    return spark.createDataFrame([(1, "Pix"), (2, "TED")], "tipo_transacao_id int, descricao string")


def test_daily_volume(sample):
    assert plain(gold.daily_transaction_volume(sample)) == [
        (date(2024, 1, 1), 1, "10.00"), (date(2024, 1, 2), 2, "0.30"), (date(2024, 1, 3), 1, "99.00")
    ]


def test_daily_pix_ignores_case(sample, types):
    assert plain(gold.daily_pix_transaction_volume(sample, types)) == [
        (date(2024, 1, 1), 1, "10.00"), (date(2024, 1, 2), 1, "0.20"), (date(2024, 1, 3), 1, "99.00")
    ]


def test_unknown_accounts_drop_out(sample, accounts):
    assert plain(gold.financial_volume_by_agency(sample, accounts)) == [(7, 2, "10.10"), (8, 1, "0.20")]
    assert plain(gold.transactions_per_customer(sample, accounts)) == [(11, 3)]


def test_repeated_account_is_an_error(sample, accounts):
    with pytest.raises(PySparkException, match="conta_id is not unique"):
        gold.financial_volume_by_agency(sample, accounts.union(accounts)).collect()


def test_average_balance(accounts):
    assert plain(gold.average_balance_by_agency(accounts)) == [(8, 2, 2.005), (7, 1, 1.0)]


def test_customers_with_loans(spark):
    people = spark.createDataFrame([(1, "A"), (2, "B"), (3, "C")], "cliente_id bigint, nome string")
    given = loans(spark, [
        (1, 1, "10.00", 6, date(2024, 1, 1)), (2, 1, "5.50", 12, date(2024, 1, 1)), (3, 2, "20.00", 48, date(2024, 1, 1)),
        (4, None, "7.00", 6, date(2024, 1, 1)),
    ])
    assert plain(gold.customers_with_loans(people, given)) == [(2, "B", 1, "20.00", 48.0), (1, "A", 2, "15.50", 9.0)]


def test_loan_volume_of_nothing_is_one_row(spark):
    assert plain(gold.loan_volume(loans(spark, []))) == [(0, "0.00", None, None)]


def test_missing_column_is_named(sample):
    with pytest.raises(ValueError, match="valor"):
        gold.daily_transaction_volume(sample.drop("valor"))


def test_aggregates_combine_before_they_join(sample, accounts, capsys):
    gold.financial_volume_by_agency(sample, accounts).explain()
    plan = capsys.readouterr().out
    assert plan.index("Join") < plan.rindex("partial_sum")


def test_calendar(spark, sample):
    given = loans(spark, [(1, 1, "10.00", 6, date(2023, 12, 31))])
    rows = star.dim_data(sample, given).orderBy("data_sk").collect()
    assert [r["data_sk"] for r in rows] == [1, 2, 3, 4]
    assert tuple(rows[0]) == (1, date(2023, 12, 31), 31, 12, "December", 4, 2023, 7)
    assert tuple(rows[1]) == (2, date(2024, 1, 1), 1, 1, "January", 1, 2024, 1)


@pytest.fixture()
def schema(spark, sample, accounts, types):
    people = spark.createDataFrame(
        [(12, "L", "2", date(1990, 1, 1)), (11, "K", "1", date(1990, 1, 1))],
        "cliente_id bigint, nome string, cpf string, data_nascimento date",
    )
    given = loans(spark, [
        (5, 11, "100.00", 24, date(2024, 1, 1)), (4, 12, "0.05", 6, date(2024, 2, 1)), (6, 12, "0.03", 6, date(2025, 2, 1))
    ])
    return star.Star({
        "clientes": people, "contas": accounts, "tipos_transacao": types, "transacoes": sample, "emprestimos": given
    })


def test_transaction_fact(schema):
    rows = {r["transacao_id"]: r for r in schema.transactions().collect()}
    assert sorted(rows) == [1, 2, 3]  # the unknown account drops out
    assert [rows[i]["transacao_sk"] for i in (1, 2, 3)] == [1, 2, 3]
    assert (rows[3]["conta_origem_sk"], rows[3]["conta_destino_sk"], rows[3]["cliente_sk"]) == (2, 1, 1)
    assert (rows[2]["data_sk"], rows[2]["tipo_transacao_sk"]) == (2, 2)


def test_loan_fact_rounds_half_up(schema):
    rows = {r["emprestimo_id"]: r for r in schema.loans().collect()}
    assert [rows[i]["emprestimo_sk"] for i in (4, 5, 6)] == [1, 2, 3]
    assert [str(rows[i]["valor_medio_parcela"]) for i in (4, 5, 6)] == ["0.01", "4.17", "0.01"]


def test_reports(schema):
    facts, given = reports.transaction_summary(schema.transaction_rows()), reports.loan_summary(schema.loan_rows())
    assert plain(reports.operation_count(facts)) == [(3,)] and plain(reports.operation_count(facts.limit(0))) == [(0,)]
    assert plain(reports.loan_overview(given)) == [(3, "100.08", 33.36, 12.0)]
    assert plain(reports.average_installment(given)) == [(pytest.approx(4.19 / 3),)]
    assert plain(reports.total_volume(facts)) == [("10.30",)]
    assert plain(reports.by_type(facts, schema.tipo)) == [(1, "Pix", 2, "10.20"), (2, "TED", 1, "0.10")]
    assert plain(reports.monthly_transactions(facts, schema.data)) == [(2024, 1, "January", 3, "10.30")]
    assert plain(reports.loans_by_year(given, schema.data)) == [(2024, 2, "100.05", 50.025), (2025, 1, "0.03", 0.03)]
    assert plain(reports.loans_by_installments(given)) == [(6, 2, "0.08", 0.04), (24, 1, "100.00", 100.0)]
    assert plain(reports.top_customers(given, schema.cliente, k=1)) == [(11, 1, "100.00")]


def test_all_reports_read_each_fact_once(spark, schema, tmp_path):
    """The summaries are kept, so the plans of the ten reports hold no fact."""
    from cofre.operators.keysets import kept

    schema.transaction_rows().write.parquet(str(tmp_path / "moves"))
    schema.loan_rows().write.parquet(str(tmp_path / "loans"))
    moves, given = (spark.read.parquet(str(tmp_path / name)) for name in ("moves", "loans"))
    dims = {"dim_tipo_transacao": schema.tipo, "dim_data": kept(schema.data), "dim_cliente": kept(schema.cliente)}
    built = reports.build_all(kept(reports.transaction_summary(moves)), kept(reports.loan_summary(given)), dims)
    assert len(built) == 10
    assert all("parquet" not in df._jdf.queryExecution().optimizedPlan().toString().lower() for df in built.values())
    assert all(not df.isEmpty() for df in built.values())


def test_a_hot_account_is_spread(spark):
    """With a third of the transactions at one account, no task holds more than twice an even share."""
    n, parts = 60_000, 8
    for key, value in {"spark.sql.shuffle.partitions": str(parts), "spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}.items():
        spark.conf.set(key, value)
    try:
        rows = spark.range(0, n, 1, parts).select(
            F.col("id").alias("transacao_id"), F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 5000).alias("conta_origem_id"),
            F.when(F.col("id") % 3 == 1, 9).otherwise(F.col("id") * 7 % 5000).alias("conta_destino_id"), F.lit(1).alias("tipo_transacao_id"),
            F.lit(1).cast("decimal(15,2)").alias("valor"), F.lit(datetime(2024, 1, 1)).cast("timestamp_ntz").alias("data_hora"),
        )
        accounts = spark.range(5000).select(F.col("id").alias("conta_id"), F.col("id").alias("conta_sk"), F.col("id").alias("cliente_id"))
        people = spark.range(5000).select(F.col("id").alias("cliente_id"), F.col("id").alias("cliente_sk"))
        days = F.broadcast(spark.sql("select date'2024-01-01' as data, 1 as data_sk"))
        types = F.broadcast(spark.sql("select 1 as tipo_transacao_id, 1 as tipo_transacao_sk"))
        fact = star.fato_transacao_rows(rows, people, accounts, days, types)
        assert fact.count() == n and fact.where("conta_origem_sk <> cliente_sk").isEmpty()
        sizes = [r["count"] for r in fact.groupBy(F.spark_partition_id()).count().collect()]
        assert max(sizes) <= 2 * n / parts, sizes
        joined = rows.join(accounts, F.col("conta_origem_id") == F.col("conta_id"))
        assert max(r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()) > 2 * n / parts
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_unique_integers_are_counted_in_bitmaps(spark):
    """Dense keys send bitmaps, sparse and repeated ones are grouped; the counts are those of grouping."""
    n = 70_000
    models = {
        "dense": spark.range(-5, n, 1, 2).select(F.col("id").alias("a"), (F.col("id") * 10**13).alias("b"), (F.col("id") % 60_000).alias("c")),
        "text": spark.range(100).selectExpr("cast(id % 90 as string) as t", "if(id < 3, null, id) as u"),
    }
    columns = {"dense": ("a", "b", "c"), "text": ("t", "u")}
    found = contracts.unique(models, columns)
    assert {(r["model"], r["column"]): r["violations"] for r in found.collect()} == {
        ("dense", "a"): 0, ("dense", "b"): 0, ("dense", "c"): 10_000, ("text", "t"): 10, ("text", "u"): 0,
    }
    stacked = contracts._stacked(models["dense"], {0: "a", 1: "b", 2: "c"}, "bigint")
    assert sorted(contracts._dense(stacked)) == [0, 2]
    for column in ("a", "b", "c"):
        exact = models["dense"].agg(F.count(F.lit(1)), F.count_distinct(column)).first()
        assert tuple(contracts.uniqueness_counts(models["dense"], column).first()) == tuple(exact)
    counted = contracts.uniqueness_counts(models["dense"], "a")
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert "bitmap_construct_agg" in plan and "hashpartitioning(value" not in plan
    assert tuple(contracts.uniqueness_counts(models["text"], "u").first()) == (100, 97)
    assert tuple(contracts.uniqueness_counts(models["text"].where("false"), "u").first()) == (0, 0)


def test_contracts_count_violations(spark):
    models = {
        "child": spark.createDataFrame([(1, 1), (1, 2), (2, 9), (2, 9), (None, None)], "id int, ref int"),
        "parent": spark.createDataFrame([(1,), (2,), (2,)], "pk bigint"),
    }
    got = contracts.union_all([
        contracts.not_null(models, {"child": ("id", "ref")}),
        contracts.unique(models, {"child": ("id",), "parent": ("pk",)}),
        contracts.relationships(models, {"child": (("ref", "parent", "pk"), ("id", "parent", "pk"))}),
    ])
    assert sorted(map(tuple, got.collect())) == [
        ("child", "id", "not_null", 1),
        ("child", "id", "relationships", 0),
        ("child", "id", "unique", 2),
        ("child", "ref", "not_null", 1),
        ("child", "ref", "relationships", 2),
        ("parent", "pk", "unique", 1),
    ]


def test_counts(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (0, None)], "n int, v string")
    assert tuple(contracts.uniqueness_counts(df, "v").first()) == (3, 1)
    assert contracts.violation_count(df, F.col("n") <= 0, "bad").first()["bad"] == 1
    assert sorted(map(tuple, contracts.row_counts({"x": df, "y": df.limit(0)}).collect())) == [("x", 3), ("y", 0)]


def test_relationship_checks_scan_each_table_once_per_parent(spark):
    """Scans grow with children and parents that are linked, not with their product."""
    models = {f"parent{i}": spark.range(50).withColumnRenamed("id", "key") for i in range(4)}
    models |= {f"child{i}": spark.range(60 + i).selectExpr(*[f"id as c{j}" for j in range(4)]) for i in range(3)}
    links = {f"child{i}": tuple((f"c{j}", f"parent{j}", "key") for j in range(4)) for i in range(3)}
    found = contracts.relationships(models, links)
    assert {(r.model, r.column): r.violations for r in found.collect()} == {
        (f"child{i}", f"c{j}"): 10 + i for i in range(3) for j in range(4)
    }
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Range (") == 4 * (3 + 1)
