"""Business reports over facts and dimensions.

All ten derive from two summaries: transactions by day and type, loans by day, customer and number of instalments. So
each fact is read once, summed per surrogate key before it meets a dimension. Means are the exact sum divided once as double.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cofre.plans.gold import mean, total
from cofre.schemas import TOTAL


def transaction_summary(fato_transacao: DataFrame) -> DataFrame:
    """Operations and amount by day and type."""
    return fato_transacao.groupBy("data_sk", "tipo_transacao_sk").agg(F.count(F.lit(1)).alias("n"), total("valor").alias("amount"))


def loan_summary(fato_emprestimo: DataFrame) -> DataFrame:
    """Loans, amounts and instalment values by day, customer and number of instalments."""
    return fato_emprestimo.groupBy("data_sk", "cliente_sk", "parcelas").agg(
        F.count(F.lit(1)).alias("n"),
        F.count("emprestimo_id").alias("n_ids"),
        total("valor_contratado").alias("amount"),
        F.count("valor_contratado").alias("n_amounts"),
        total("valor_medio_parcela").alias("installment"),
        F.count("valor_medio_parcela").alias("n_installments"),
    )


def _count(column: str) -> Column:
    """Sum of counts: 0, not null, over nothing."""
    return F.coalesce(F.sum(column), F.lit(0))


def _amount(column: str) -> Column:
    return F.sum(column).cast(TOTAL)


def total_volume(moves: DataFrame) -> DataFrame:
    """Amount moved overall."""
    return moves.agg(_amount("amount").alias("valor_total_movimentado"))


def operation_count(moves: DataFrame) -> DataFrame:
    """Number of operations."""
    return moves.agg(_count("n").alias("quantidade_operacoes"))


def by_type(moves: DataFrame, dim_tipo: DataFrame) -> DataFrame:
    """Operations and amount per transaction type, largest amount first."""
    types = dim_tipo.select("tipo_transacao_sk", "tipo_transacao_id", F.col("descricao").alias("tipo_transacao"))
    per_type = moves.groupBy("tipo_transacao_sk").agg(F.sum("n").alias("n"), _amount("amount").alias("amount"))
    return (
        per_type.join(types, "tipo_transacao_sk")
        .groupBy("tipo_transacao_id", "tipo_transacao")
        .agg(F.sum("n").alias("quantidade_operacoes"), _amount("amount").alias("valor_total_movimentado"))
        .orderBy(F.desc("valor_total_movimentado"), "tipo_transacao_id")
    )


def _monthly(summary: DataFrame, dim_data: DataFrame, count_name: str, amount_name: str) -> DataFrame:
    per_day = summary.groupBy("data_sk").agg(F.sum("n").alias("n"), _amount("amount").alias("amount"))
    return (
        per_day.join(dim_data.select("data_sk", "ano", "mes", "nome_mes"), "data_sk")
        .groupBy("ano", "mes", "nome_mes")
        .agg(F.sum("n").alias(count_name), _amount("amount").alias(amount_name))
        .orderBy("ano", "mes")
    )


def monthly_transactions(moves: DataFrame, dim_data: DataFrame) -> DataFrame:
    """Operations and amount per month."""
    return _monthly(moves, dim_data, "quantidade_operacoes", "valor_total_movimentado")


def loan_overview(credits: DataFrame) -> DataFrame:
    """Loans, amount, mean amount and mean instalments overall."""
    parcels = F.col("parcelas").cast("bigint") * F.col("n")
    return credits.agg(
        _count("n").alias("quantidade_emprestimos"),
        _amount("amount").alias("valor_total_contratado"),
        mean(_amount("amount"), F.sum("n_amounts")).alias("valor_medio_contratado"),
        mean(F.sum(parcels), F.sum(F.when(F.col("parcelas").isNotNull(), F.col("n")))).alias("media_parcelas"),
    )


def _loans_per(credits: DataFrame, *keys: str) -> DataFrame:
    """Loans, amount and number of amounts per key."""
    return credits.groupBy(*keys).agg(
        F.sum("n").alias("quantidade_emprestimos"),
        _amount("amount").alias("valor_total_contratado"),
        F.sum("n_amounts").alias("n"),
    )


def _with_mean(summed: DataFrame) -> DataFrame:
    average = mean(F.col("valor_total_contratado"), F.col("n"))
    return summed.withColumn("valor_medio_contratado", average).drop("n")


def loans_by_year(credits: DataFrame, dim_data: DataFrame) -> DataFrame:
    """Loans, amount and mean amount per contract year."""
    per_day = _loans_per(credits, "data_sk").join(dim_data.select("data_sk", "ano"), "data_sk")
    per_year = per_day.groupBy("ano").agg(
        F.sum("quantidade_emprestimos").alias("quantidade_emprestimos"),
        _amount("valor_total_contratado").alias("valor_total_contratado"),
        F.sum("n").alias("n"),
    )
    return _with_mean(per_year).orderBy("ano")


def loans_by_installments(credits: DataFrame) -> DataFrame:
    """Loans, amount and mean amount per number of instalments."""
    return _with_mean(_loans_per(credits, "parcelas")).orderBy("parcelas")


def top_customers(credits: DataFrame, dim_cliente: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` customers with the largest loan amount."""
    per_customer = credits.groupBy("cliente_sk").agg(
        F.sum("n_ids").alias("quantidade_emprestimos"), _amount("amount").alias("valor_total_contratado")
    )
    return (
        per_customer.join(dim_cliente.select("cliente_sk", "cliente_id"), "cliente_sk")
        .select("cliente_id", "quantidade_emprestimos", "valor_total_contratado")
        .orderBy(F.desc("valor_total_contratado"), "cliente_id")
        .limit(k)
    )


def monthly_loans(credits: DataFrame, dim_data: DataFrame) -> DataFrame:
    """Loans and amount per contract month."""
    return _monthly(credits, dim_data, "quantidade_emprestimos", "valor_total_contratado")


def average_installment(credits: DataFrame) -> DataFrame:
    """Mean instalment value."""
    return credits.agg(mean(_amount("installment"), F.sum("n_installments")).alias("valor_medio_parcela"))


def build_all(moves: DataFrame, credits: DataFrame, dims: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The ten reports from the two summaries, which the caller keeps if several reports are computed."""
    return {
        "report_01_total_volume": total_volume(moves),
        "report_02_operation_count": operation_count(moves),
        "report_03_by_type": by_type(moves, dims["dim_tipo_transacao"]),
        "report_04_monthly_transactions": monthly_transactions(moves, dims["dim_data"]),
        "report_05_loan_overview": loan_overview(credits),
        "report_06_loans_by_year": loans_by_year(credits, dims["dim_data"]),
        "report_07_loans_by_installments": loans_by_installments(credits),
        "report_08_top10_customers": top_customers(credits, dims["dim_cliente"]),
        "report_09_monthly_loans": monthly_loans(credits, dims["dim_data"]),
        "report_10_avg_installment": average_installment(credits),
    }
