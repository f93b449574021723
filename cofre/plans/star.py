"""Star schema: staging projections, dimensions and facts."""

from __future__ import annotations

from collections.abc import Mapping
from functools import cached_property

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cofre.operators.keys import BUCKET_BITS, Span, add_surrogate_key, key_spans
from cofre.operators.keysets import BROADCAST_ROWS, kept
from cofre.operators.skew import hot_keys, join_parent
from cofre.schemas import AUDIT_COLUMNS, contract, require_columns


def staging(trusted: DataFrame, table: str) -> DataFrame:
    """Business and audit columns of a trusted table."""
    columns = contract(table).trusted_columns + AUDIT_COLUMNS
    return require_columns(trusted, table, columns).select(*columns)


def dim_cliente(clientes: DataFrame, span: Span | None = None, bits: int = BUCKET_BITS) -> DataFrame:
    rows = clientes.select("cliente_id", "nome", "cpf", "data_nascimento")
    return add_surrogate_key(rows, "cliente_id", "cliente_sk", span, bits=bits)


def dim_conta(contas: DataFrame, span: Span | None = None, bits: int = BUCKET_BITS) -> DataFrame:
    rows = contas.select("conta_id", "cliente_id", "agencia_id", "saldo")
    return add_surrogate_key(rows, "conta_id", "conta_sk", span, bits=bits)


def dim_tipo_transacao(tipos: DataFrame, span: Span | None = None) -> DataFrame:
    rows = tipos.select("tipo_transacao_id", "descricao")
    return add_surrogate_key(rows, "tipo_transacao_id", "tipo_transacao_sk", span)


def distinct_dates(transacoes: DataFrame, emprestimos: DataFrame) -> DataFrame:
    """Days on which anything happened."""
    moved = transacoes.select(F.to_date("data_hora").alias("data"))
    signed = emprestimos.select(F.col("data_contrato").alias("data"))
    return moved.union(signed).distinct()


def dim_data(transacoes: DataFrame, emprestimos: DataFrame) -> DataFrame:
    """Calendar of :func:`distinct_dates`. One window numbers it: dates have years of four digits,
    so a calendar has less than four million days, and some thousand in practice.
    """
    day = F.col("data")
    return distinct_dates(transacoes, emprestimos).select(
        F.row_number().over(Window.orderBy("data")).cast("bigint").alias("data_sk"),
        day,
        F.dayofmonth(day).alias("dia"),
        F.month(day).alias("mes"),
        F.date_format(day, "MMMM").alias("nome_mes"),
        F.quarter(day).alias("trimestre"),
        F.year(day).alias("ano"),
        (F.weekday(day) + 1).alias("dia_semana"),
    )


def fato_transacao_rows(
    transacoes: DataFrame, cliente: DataFrame, conta: DataFrame, data: DataFrame, tipo: DataFrame
) -> DataFrame:
    """One row per transaction with dimension keys, not yet numbered.

    Account and customer are joined first, among dimensions, so the transactions are shuffled once
    per account role and not again per customer. Rows of an account with many transactions
    meet it by broadcast. Calendar and types come marked for broadcast when their bounds allow it.
    """
    accounts = conta.select("conta_id", "conta_sk", "cliente_id")
    owners = accounts.join(cliente.select("cliente_id", "cliente_sk"), "cliente_id")
    origin = owners.select(
        F.col("conta_id").alias("conta_origem_id"), F.col("conta_sk").alias("conta_origem_sk"), "cliente_sk"
    )
    target = accounts.select(
        F.col("conta_id").alias("conta_destino_id"), F.col("conta_sk").alias("conta_destino_sk")
    )
    hot = hot_keys(transacoes, "conta_origem_id", "conta_destino_id")
    dated = (
        transacoes.withColumn("data", F.to_date("data_hora"))
        .join(data.select("data", "data_sk"), "data")
        .join(tipo.select("tipo_transacao_id", "tipo_transacao_sk"), "tipo_transacao_id")
    )
    with_origin = join_parent(dated, origin, "conta_origem_id", "conta_origem_id", hot["conta_origem_id"])
    return join_parent(with_origin, target, "conta_destino_id", "conta_destino_id", hot["conta_destino_id"]).select(
        "transacao_id",
        "cliente_sk",
        "conta_origem_sk",
        "conta_destino_sk",
        "data_sk",
        "tipo_transacao_sk",
        "valor",
        "data_hora",
    )


def fato_emprestimo_rows(emprestimos: DataFrame, cliente: DataFrame, data: DataFrame) -> DataFrame:
    """One row per loan with dimension keys, not yet numbered."""
    per_installment = F.round(F.col("valor_contratado") / F.nullif(F.col("parcelas"), F.lit(0)), 2)
    days = data.select(F.col("data").alias("data_contrato"), "data_sk")
    dated = emprestimos.join(days, "data_contrato")
    hot = hot_keys(emprestimos, "cliente_id")["cliente_id"]
    return join_parent(dated, cliente.select("cliente_id", "cliente_sk"), "cliente_id", "cliente_id", hot).select(
        "emprestimo_id",
        "cliente_sk",
        "data_sk",
        "valor_contratado",
        "parcelas",
        per_installment.cast("decimal(16,2)").alias("valor_medio_parcela"),
        "data_contrato",
    )


DIMENSIONS = ("clientes", "contas", "tipos_transacao")


class Star:
    """Dimensions over staging frames and the facts that use them, each built when first asked for."""

    def __init__(self, staged: Mapping[str, DataFrame], bits: int = BUCKET_BITS):
        self.staged, self.bits = staged, bits
        self._spans: dict[str, Span] = {}

    def span(self, table: str, *along: str) -> Span:
        """Bounds of the key of ``table``; those of ``along``, needed soon, come from the same job."""
        unknown = [t for t in (table, *along) if t not in self._spans]
        if unknown:
            self._spans |= key_spans({t: (self.staged[t], contract(t).key) for t in unknown})
        return self._spans[table]

    @cached_property
    def cliente(self) -> DataFrame:
        return dim_cliente(self.staged["clientes"], self.span("clientes"), self.bits)

    @cached_property
    def conta(self) -> DataFrame:
        return dim_conta(self.staged["contas"], self.span("contas"), self.bits)

    @cached_property
    def tipo(self) -> DataFrame:
        """Transaction types, for broadcast once the range of their unique keys or a count proves them few."""
        staged, span = self.staged["tipos_transacao"], self.span("tipos_transacao")
        types = dim_tipo_transacao(staged, span)
        few = span.high - span.low < BROADCAST_ROWS or span.rows <= BROADCAST_ROWS
        return F.broadcast(types) if few else types

    @cached_property
    def data(self) -> DataFrame:
        return dim_data(self.staged["transacoes"], self.staged["emprestimos"])

    @cached_property
    def calendar(self) -> DataFrame:
        """The calendar for joins, for broadcast when the days between its bounds are few."""
        day = {"transacoes": "cast(data_hora as date)", "emprestimos": "data_contrato"}
        numbered = {t: (self.staged[t].selectExpr(f"unix_date({expression}) as day"), "day") for t, expression in day.items()}
        spans = [s for s in key_spans(numbered).values() if s.rows]
        days = max((s.high for s in spans), default=0) - min((s.low for s in spans), default=0)
        return F.broadcast(self.data) if days < BROADCAST_ROWS else self.data

    def _numbered(self, rows: DataFrame, key: str, name: str, span: Span) -> DataFrame:
        """Buckets are counted before the rows are numbered, so the rows are kept and not joined twice."""
        wide = span.high - span.low >= 1 << self.bits
        return add_surrogate_key(kept(rows) if wide else rows, key, name, span, bits=self.bits)

    def transaction_rows(self) -> DataFrame:
        """Transaction fact without its own number."""
        self.span(*DIMENSIONS)
        return fato_transacao_rows(self.staged["transacoes"], self.cliente, self.conta, self.calendar, self.tipo)

    def transactions(self) -> DataFrame:
        """Transaction fact; the source bounds its key, so the joins need not run for that."""
        span = self.span("transacoes", *DIMENSIONS)
        return self._numbered(self.transaction_rows(), "transacao_id", "transacao_sk", span)

    def loan_rows(self) -> DataFrame:
        """Loan fact without its own number."""
        return fato_emprestimo_rows(self.staged["emprestimos"], self.cliente, self.calendar)

    def loans(self) -> DataFrame:
        """Loan fact, bounded by its source like the transactions."""
        span = self.span("emprestimos", "clientes")
        return self._numbered(self.loan_rows(), "emprestimo_id", "emprestimo_sk", span)

    def dimensions(self) -> dict[str, DataFrame]:
        self.span(*DIMENSIONS)
        return {
            "dim_cliente": self.cliente,
            "dim_conta": self.conta,
            "dim_tipo_transacao": self.tipo,
            "dim_data": self.data,
        }
