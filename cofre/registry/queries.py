"""All operators as named queries over a folder of benchmark tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cofre.functions import clean
from cofre.operators import contracts, dedupe, keys, references
from cofre.operators.keysets import kept
from cofre.operators.rules import REASON
from cofre.operators.skew import join_parent
from cofre.plans import checks, gold, reports
from cofre.plans.silver import Trusted, ancestry
from cofre.plans.star import DIMENSIONS, Star, distinct_dates, staging
from cofre.schemas import CONTRACTS, TABLES, TRANSACTION_TYPES, Reference, contract
from cofre.sources import batches
from cofre.sources.bindings import Bindings, OnDemand
from cofre.sources.extract import add_audit_columns, extract_table

Query = Callable[[SparkSession, str], DataFrame]
Build = Callable[[Bindings], DataFrame]

BATCH_ID = "batch-000"
# Bucket size that makes the benchmark tables take the numbering by buckets, over several levels.
FEW_BITS = 5
INGESTED = datetime(2024, 1, 1)


def _query(build: Build) -> Query:
    return lambda spark, folder: build(Bindings(spark, folder))


# Inputs


def _staged(b: Bindings, table: str) -> DataFrame:
    rows = b.bank(table)
    if table == "cartoes":
        rows = rows.withColumn("numero_cartao_mascarado", clean.mask_card(F.col("numero_cartao")))
    return staging(add_audit_columns(rows, BATCH_ID, INGESTED), table)


def _star(b: Bindings, **settings) -> Star:
    return Star(OnDemand(lambda table: _staged(b, table)), **settings)


def _moves(star: Star) -> DataFrame:
    return reports.transaction_summary(star.transaction_rows())


def _credits(star: Star) -> DataFrame:
    return reports.loan_summary(star.loan_rows())


@dataclass(frozen=True)
class _Views:
    """The clean views as a source to extract from."""

    bindings: Bindings

    def load(self, spark: SparkSession, table: str) -> DataFrame:
        return self.bindings.bank(table)


def _existing(b: Bindings, condition: str) -> DataFrame:
    return b.bank("clientes").where(condition)


# Scalars


def _clean_text(b: Bindings) -> DataFrame:
    raw = b.raw("agencias")
    tidy = clean.clean_text(raw.select("_row_seq", "nome_agencia", "cidade"))
    return raw.select("_row_seq", F.col("nome_agencia").alias("raw_nome_agencia")).join(tidy, "_row_seq")


def _scalar(table: str, column: str, result: Callable) -> Build:
    """Position, source value and normalised value of one column."""
    return lambda b: b.raw(table).select(
        "_row_seq", F.col(column).alias(f"raw_{column}"), result(F.col(column)).alias(column)
    )


def _utc(b: Bindings) -> DataFrame:
    raw = b.raw("transacoes")
    moment = clean.normalize_timestamp(F.col("data_hora"), raw.schema["data_hora"].dataType)
    return raw.select("transacao_id", F.col("data_hora").alias("raw_data_hora"), moment.alias("data_hora"))


# Keys, batches, deduplication


def _seed(b: Bindings) -> DataFrame:
    existing = b.bank("tipos_transacao")
    existing = existing.where("tipo_transacao_id % 2 = 1")
    seed = b.spark.createDataFrame(TRANSACTION_TYPES, "tipo_transacao_id int, descricao string")
    return keys.insert_if_absent(existing, seed, "tipo_transacao_id")


def _numbered_by_cpf(b: Bindings) -> DataFrame:
    """Customers numbered in the order of a text key."""
    return keys.add_surrogate_key(b.bank("clientes").select("cpf", "cliente_id"), "cpf", "cliente_sk")


def _numbered_sparse(b: Bindings) -> DataFrame:
    """Customers numbered in the order of a key that is spread over 63 bits."""
    spread = (F.col("cliente_id") * 7919 % 99991).cast("bigint") * 90_000_000_000_000 + F.col("cliente_id")
    return keys.add_surrogate_key(b.bank("clientes").select(spread.alias("chave"), "cliente_id"), "chave", "cliente_sk")


def _append_ids(b: Bindings) -> DataFrame:
    incoming = _existing(b, "cliente_id % 3 = 0").withColumnRenamed("cliente_id", "position")
    return keys.append_with_ids(_existing(b, "cliente_id % 3 <> 0"), incoming, "cliente_id", "position")


def _append_cpfs(b: Bindings) -> DataFrame:
    incoming = b.raw("clientes").select(
        F.col("_row_seq").alias("cliente_id"),
        clean.tidy(F.col("nome")).alias("nome"),
        clean.normalize_cpf(F.col("cpf")).alias("cpf"),
    )
    existing = _existing(b, "cliente_id % 3 = 0").select("cliente_id", "nome", "cpf")
    return keys.append_new_natural_keys(existing, incoming, "cpf", "cliente_id")


def _split_null_keys(b: Bindings) -> DataFrame:
    valid, invalid = dedupe.split_null_keys(b.raw("clientes"), "cliente_id")
    parts = {"valid": valid, "invalid": invalid}
    return contracts.union_all([
        df.select(F.lit(name).alias("part"), "cliente_id", "_row_seq") for name, df in parts.items()
    ])


def _dedupe_rejects(b: Bindings) -> DataFrame:
    return contracts.union_all([
        dedupe.dedupe_latest(b.raw(t), contract(t).key)[1].select(
            F.lit(t).alias("table_name"), F.col(contract(t).key).cast("bigint").alias("id"), "_row_seq"
        )
        for t in ("clientes", "emprestimos")
    ])


def _duplicated_cpf(b: Bindings) -> DataFrame:
    """All customers that share a CPF, among those with key and required fields."""
    df = clean.clean_text(b.raw("clientes")).withColumn("cpf", clean.normalize_cpf(F.col("cpf")))
    complete = dedupe.dedupe_latest(df, "cliente_id")[0].dropna(subset=["nome", "cpf", "data_nascimento"])
    return dedupe.members_of_repeated(complete, "cpf").select("cliente_id", "cpf")


# References


def _foreign_key(table: str, ref: Reference) -> Build:
    key = contract(table).key
    return lambda b: references.rows_without_parent(
        b.raw(table).select(key, ref.column), ref.column, b.bank(ref.parent), ref.parent_key
    )


def _foreign_key_to_trusted(table: str, ref: Reference) -> Build:
    """References to parents that the trusted layer rejects count as broken."""
    key = contract(table).key

    def build(b: Bindings) -> DataFrame:
        parents = Trusted(b.all_raw(), ancestry(ref.parent)).keys(ref.parent)
        return references.rows_without_parent(b.raw(table).select(key, ref.column), ref.column, parents, ref.parent_key)

    return build


def _orphans(table: str) -> Build:
    def build(b: Bindings) -> DataFrame:
        links = [
            references.Link(columns, b.bank(parent), key)
            for (parent, key), columns in contract(table).links().items()
        ]
        return references.orphan_count(b.raw(table), links, "orphans")

    return build


def _hot_account(b: Bindings) -> DataFrame:
    """A third of all transactions come from one account."""
    account = F.when(F.col("transacao_id") % 3 == 0, 1).otherwise(F.col("conta_origem_id"))
    moves = b.bank("transacoes").select("transacao_id", account.alias("conta_origem_id"), "valor")
    accounts = b.bank("contas").select("conta_id", "cliente_id")
    return join_parent(moves, accounts, "conta_origem_id", "conta_id").select("transacao_id", "conta_origem_id", "cliente_id", "valor")


def _many_to_one(b: Bindings) -> DataFrame:
    accounts = b.bank("contas").select("conta_id", "cliente_id", "agencia_id")
    moves = b.bank("transacoes").select("transacao_id", "conta_origem_id", "valor")
    return references.join_many_to_one(moves, accounts, "conta_origem_id", "conta_id")


# Trusted layer


def _silver(table: str) -> Build:
    return lambda b: Trusted(b.all_raw(), ancestry(table)).rows(table).select(*contract(table).trusted_columns)


def _rejects(table: str) -> Build:
    return lambda b: Trusted(b.all_raw(), ancestry(table)).rejects(table).select(contract(table).key, REASON)


def _reject_summary(b: Bindings) -> DataFrame:
    trusted = Trusted(b.all_raw(), keep=True)
    return contracts.union_all([
        trusted.rejects(t).groupBy(F.lit(t).alias("entity"), REASON).agg(F.count(F.lit(1)).alias("n")) for t in TABLES
    ])


# Contracts


def _models(b: Bindings, once: bool = False) -> Mapping[str, DataFrame]:
    """Staging, star schema and, for violations to find, the tables they come from.

    Dimensions and facts are written, like in the job, and the checks read what was written, unless they read each model ``once``.
    """
    star = _star(b)
    star.span("transacoes", "emprestimos", *DIMENSIONS)
    keep = (lambda df: df) if once else kept
    dims = {name: keep(df) for name, df in star.dimensions().items()}
    star.cliente, star.conta, star.data = (dims[name] for name in ("dim_cliente", "dim_conta", "dim_data"))

    def model(name: str) -> DataFrame:
        layer, _, table = name.partition("_")
        if layer == "stg":
            return star.staged[table]
        if layer == "dim":
            return dims[name]
        if layer == "fato":
            return keep(star.transactions() if name == "fato_transacao" else star.loans())
        return b.view(name)

    return OnDemand(model)


def _not_null(b: Bindings) -> DataFrame:
    raw = {f"raw_{t}": CONTRACTS[t].source_columns for t in TABLES}
    return contracts.not_null(_models(b, once=True), checks.NOT_NULL | raw)


def _unique(b: Bindings) -> DataFrame:
    raw = {f"raw_{t}": (CONTRACTS[t].key,) for t in TABLES}
    return contracts.unique(_models(b), checks.UNIQUE | raw)


def _relationships(b: Bindings) -> DataFrame:
    raw = {
        f"raw_{t}": tuple((r.column, f"bank_{r.parent}", r.parent_key) for r in CONTRACTS[t].references)
        for t in TABLES
    }
    return contracts.relationships(_models(b), checks.RELATIONSHIPS | raw)


def _both(b: Bindings, table: str, measure: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """A one-row measure of the clean and of the defective form of a table."""
    forms = {f"bank_{table}": b.bank(table), f"raw_{table}": b.raw(table)}
    return contracts.union_all([
        measure(df).select(F.lit(name).alias("table_name"), "*") for name, df in forms.items()
    ])


def _key_uniqueness(b: Bindings) -> DataFrame:
    """Rows and distinct primary keys of every table, clean and defective."""
    return contracts.union_all([_both(b, t, lambda df, t=t: contracts.uniqueness_counts(df, contract(t).key)) for t in TABLES])


def _build() -> dict[str, Build]:
    found: dict[str, Build] = {
        "scan_transacoes": lambda b: extract_table(b.spark, _Views(b), "transacoes"),
        "bronze_audit": lambda b: add_audit_columns(b.bank("transacoes"), BATCH_ID, INGESTED),
        "batch_ids": lambda b: batches.batch_ids(b.manifest(), "clientes"),
        "complete_batches": lambda b: batches.complete_batches(b.manifest()).select("batch_id", "ingestion_ts"),
        "latest_complete_batch": lambda b: batches.latest_batch(
            batches.complete_batches(b.manifest()).where("committed")
        ),
        "latest_silver_batch": lambda b: batches.latest_batch(
            batches.complete_batches(b.manifest()).where("committed"), "committed_at"
        ),
        "seed_insert_if_absent": _seed,
        "next_id": lambda b: keys.next_id(b.bank("clientes"), "cliente_id"),
        "append_with_ids": _append_ids,
        "append_new_natural_keys": _append_cpfs,
        "surrogate_key_text": _numbered_by_cpf,
        "surrogate_key_sparse": _numbered_sparse,
        "clean_text": _clean_text,
        "normalize_cpf": _scalar("clientes", "cpf", clean.normalize_cpf),
        "normalize_card": _scalar("cartoes", "numero_cartao", clean.normalize_card),
        "mask_card": _scalar("cartoes", "numero_cartao", lambda c: clean.mask_card(clean.normalize_card(c))),
        "normalize_money": _scalar("contas", "saldo", clean.normalize_money),
        "normalize_date": _scalar("emprestimos", "data_contrato", clean.normalize_date),
        "normalize_timestamp": _utc,
        "dst_invalid_timestamps": lambda b: _utc(b).where("data_hora is null").drop("data_hora"),
        "split_null_pk": _split_null_keys,
        "dedupe_latest": lambda b: dedupe.dedupe_latest(b.raw("emprestimos"), "emprestimo_id")[0],
        "dedupe_rejects": _dedupe_rejects,
        "duplicated_cpf": _duplicated_cpf,
        "fk_contas_cliente": _foreign_key("contas", CONTRACTS["contas"].references[0]),
        "fk_contas_agencia": _foreign_key("contas", CONTRACTS["contas"].references[1]),
        "fk_cartoes_conta": _foreign_key("cartoes", CONTRACTS["cartoes"].references[0]),
        "fk_emprestimos_cliente": _foreign_key_to_trusted("emprestimos", CONTRACTS["emprestimos"].references[0]),
        "fk_transacoes_origem": _foreign_key_to_trusted("transacoes", CONTRACTS["transacoes"].references[0]),
        "fk_transacoes_destino": _foreign_key_to_trusted("transacoes", CONTRACTS["transacoes"].references[1]),
        "fk_transacoes_tipo": _foreign_key("transacoes", CONTRACTS["transacoes"].references[2]),
        "join_many_to_one": _many_to_one,
        "join_hot_account": _hot_account,
        "reject_summary": _reject_summary,
        "daily_transaction_volume": lambda b: gold.daily_transaction_volume(b.bank("transacoes")),
        "daily_pix_transaction_volume": lambda b: gold.daily_pix_transaction_volume(
            b.bank("transacoes"), b.bank("tipos_transacao")
        ),
        "financial_volume_by_agency": lambda b: gold.financial_volume_by_agency(
            b.bank("transacoes"), b.bank("contas")
        ),
        "transactions_per_customer": lambda b: gold.transactions_per_customer(b.bank("transacoes"), b.bank("contas")),
        "average_balance_by_agency": lambda b: gold.average_balance_by_agency(b.bank("contas")),
        "customers_with_loans": lambda b: gold.customers_with_loans(b.bank("clientes"), b.bank("emprestimos")),
        "loan_volume": lambda b: gold.loan_volume(b.bank("emprestimos")),
        "dim_cliente": lambda b: _star(b).cliente,
        "dim_cliente_buckets": lambda b: _star(b, bits=FEW_BITS).cliente,
        "dim_conta": lambda b: _star(b).conta,
        "dim_tipo_transacao": lambda b: _star(b).tipo,
        "dim_data": lambda b: _star(b).data,
        "distinct_dates": lambda b: distinct_dates(b.bank("transacoes"), b.bank("emprestimos")),
        "fato_transacao": lambda b: _star(b).transactions(),
        "fato_transacao_buckets": lambda b: _star(b, bits=FEW_BITS).transactions(),
        "fato_emprestimo": lambda b: _star(b).loans(),
        "report_01_total_volume": lambda b: reports.total_volume(_moves(_star(b))),
        "report_02_operation_count": lambda b: reports.operation_count(_moves(_star(b))),
        "report_03_by_type": lambda b: (lambda s: reports.by_type(_moves(s), s.tipo))(_star(b)),
        "report_04_monthly_transactions": monthly_transactions,
        "report_05_loan_overview": lambda b: reports.loan_overview(_credits(_star(b))),
        "report_06_loans_by_year": lambda b: (lambda s: reports.loans_by_year(_credits(s), s.data))(_star(b)),
        "report_07_loans_by_installments": lambda b: reports.loans_by_installments(_credits(_star(b))),
        "report_08_top10_customers": lambda b: (lambda s: reports.top_customers(_credits(s), s.cliente))(_star(b)),
        "report_09_monthly_loans": lambda b: (lambda s: reports.monthly_loans(_credits(s), s.data))(_star(b)),
        "report_10_avg_installment": lambda b: reports.average_installment(_credits(_star(b))),
        "contract_not_null": _not_null,
        "contract_unique": _unique,
        "contract_relationships": _relationships,
        "cpf_uniqueness": lambda b: _both(b, "clientes", lambda df: contracts.uniqueness_counts(df, "cpf")),
        "key_uniqueness": _key_uniqueness,
        "row_counts": lambda b: contracts.row_counts(b.all_bank()),
        "same_account_count": lambda b: _both(
            b,
            "transacoes",
            lambda df: contracts.violation_count(df, F.col("conta_origem_id") == F.col("conta_destino_id"), "violations"),
        ),
        "non_positive_installments": lambda b: _both(
            b, "emprestimos", lambda df: contracts.violation_count(df, F.col("parcelas") <= 0, "violations")
        ),
    }
    for table in TABLES:
        found[f"stg_{table}"] = lambda b, t=table: _staged(b, t)
        found[f"silver_{table}"] = _silver(table)
        found[f"rejects_{table}"] = _rejects(table)
    for table in ("contas", "cartoes", "emprestimos", "transacoes"):
        found[f"orphans_{table}"] = _orphans(table)
    return found


def monthly_transactions(b: Bindings) -> DataFrame:
    """Flagship: staging, dimensions and transaction fact up to the monthly report."""
    star = _star(b)
    return reports.monthly_transactions(_moves(star), star.data)


def queries() -> dict[str, Query]:
    return {name: _query(build) for name, build in _build().items()}
