"""Analytical datasets over the trusted layer.

Measures are summed per join key before the join, so a popular account or type crosses the network
as one row per task. Joins assert that the lookup key is unique. Means are the exact sum divided
once as double. Rows without group key are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cofre.operators.references import unique_or_fail
from cofre.schemas import TOTAL, require_columns


def total(amount: str) -> Column:
    """Exact sum wide enough for any number of rows."""
    return F.sum(F.col(amount).cast("decimal(28,2)")).cast(TOTAL)


def mean(sum_of: Column, count_of: Column) -> Column:
    return F.try_divide(sum_of.cast("double"), count_of)


def daily_transaction_volume(transacoes: DataFrame) -> DataFrame:
    """Count and amount per UTC day."""
    require_columns(transacoes, "transacoes", ("transacao_id", "valor", "data_hora"))
    return (
        transacoes.groupBy(F.to_date("data_hora").alias("data"))
        .agg(F.count("transacao_id").alias("quantidade_transacoes"), total("valor").alias("volume_financeiro"))
        .where("data is not null")
        .orderBy("data")
    )


def daily_pix_transaction_volume(transacoes: DataFrame, tipos_transacao: DataFrame) -> DataFrame:
    """Count and amount of PIX transactions per UTC day."""
    require_columns(transacoes, "transacoes", ("transacao_id", "tipo_transacao_id", "valor", "data_hora"))
    require_columns(tipos_transacao, "tipos_transacao", ("tipo_transacao_id", "descricao"))
    types = unique_or_fail(tipos_transacao.select("tipo_transacao_id", "descricao"), "tipo_transacao_id")
    per_type = transacoes.groupBy("tipo_transacao_id", F.to_date("data_hora").alias("data")).agg(
        F.count("transacao_id").alias("n"), total("valor").alias("amount")
    )
    return (
        per_type.join(types, "tipo_transacao_id")
        .where((F.upper("descricao") == "PIX") & F.col("data").isNotNull())
        .groupBy("data")
        .agg(F.sum("n").alias("quantidade_transacoes_pix"), F.sum("amount").cast(TOTAL).alias("volume_financeiro_pix"))
        .orderBy("data")
    )


def _per_origin_account(transacoes: DataFrame, contas: DataFrame, attribute: str, *measures: Column) -> DataFrame:
    """Measures per origin account, with one attribute of the account."""
    accounts = unique_or_fail(contas.select("conta_id", attribute), "conta_id")
    per_account = transacoes.groupBy("conta_origem_id").agg(*measures)
    return per_account.join(accounts, per_account["conta_origem_id"] == accounts["conta_id"])


def financial_volume_by_agency(transacoes: DataFrame, contas: DataFrame) -> DataFrame:
    """Count and amount per agency of the origin account, largest amount first."""
    require_columns(transacoes, "transacoes", ("transacao_id", "conta_origem_id", "valor"))
    require_columns(contas, "contas", ("conta_id", "agencia_id"))
    measures = F.count("transacao_id").alias("n"), total("valor").alias("amount")
    return (
        _per_origin_account(transacoes, contas, "agencia_id", *measures)
        .where("agencia_id is not null")
        .groupBy("agencia_id")
        .agg(F.sum("n").alias("quantidade_transacoes"), F.sum("amount").cast(TOTAL).alias("volume_financeiro"))
        .orderBy(F.desc("volume_financeiro"), "agencia_id")
    )


def transactions_per_customer(transacoes: DataFrame, contas: DataFrame) -> DataFrame:
    """Count per customer of the origin account, most active first."""
    require_columns(transacoes, "transacoes", ("transacao_id", "conta_origem_id"))
    require_columns(contas, "contas", ("conta_id", "cliente_id"))
    return (
        _per_origin_account(transacoes, contas, "cliente_id", F.count("transacao_id").alias("n"))
        .where("cliente_id is not null")
        .groupBy("cliente_id")
        .agg(F.sum("n").alias("quantidade_transacoes"))
        .orderBy(F.desc("quantidade_transacoes"), "cliente_id")
    )


def average_balance_by_agency(contas: DataFrame) -> DataFrame:
    """Accounts and mean balance per agency, highest mean first."""
    require_columns(contas, "contas", ("conta_id", "agencia_id", "saldo"))
    return (
        contas.where("agencia_id is not null")
        .groupBy("agencia_id")
        .agg(F.count("conta_id").alias("quantidade_contas"), mean(total("saldo"), F.count("saldo")).alias("saldo_medio"))
        .orderBy(F.desc("saldo_medio"), "agencia_id")
    )


def customers_with_loans(clientes: DataFrame, emprestimos: DataFrame) -> DataFrame:
    """Loans, amount and mean instalments of each customer that has loans, largest amount first."""
    require_columns(clientes, "clientes", ("cliente_id", "nome"))
    require_columns(emprestimos, "emprestimos", ("emprestimo_id", "cliente_id", "valor_contratado", "parcelas"))
    loans = emprestimos.groupBy("cliente_id").agg(
        F.count("emprestimo_id").alias("quantidade_emprestimos"),
        total("valor_contratado").alias("valor_total_emprestimos"),
        mean(F.sum("parcelas"), F.count("parcelas")).alias("parcelas_media"),
    )
    return (
        unique_or_fail(clientes.select("cliente_id", "nome"), "cliente_id")
        .join(loans, "cliente_id")
        .orderBy(F.desc("valor_total_emprestimos"), "cliente_id")
    )


def loan_volume(emprestimos: DataFrame) -> DataFrame:
    """Overall loan figures, always one row."""
    require_columns(emprestimos, "emprestimos", ("emprestimo_id", "valor_contratado", "parcelas"))
    return emprestimos.agg(
        F.count(F.lit(1)).alias("quantidade_emprestimos"),
        F.coalesce(total("valor_contratado"), F.lit(0).cast(TOTAL)).alias("volume_total_emprestimos"),
        mean(total("valor_contratado"), F.count("valor_contratado")).alias("valor_medio_emprestimo"),
        mean(F.sum("parcelas"), F.count("parcelas")).alias("parcelas_media"),
    )


def build_all(trusted: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The seven datasets over the trusted tables."""
    t = trusted
    return {
        "daily_transaction_volume": daily_transaction_volume(t["transacoes"]),
        "daily_pix_transaction_volume": daily_pix_transaction_volume(t["transacoes"], t["tipos_transacao"]),
        "financial_volume_by_agency": financial_volume_by_agency(t["transacoes"], t["contas"]),
        "transactions_per_customer": transactions_per_customer(t["transacoes"], t["contas"]),
        "average_balance_by_agency": average_balance_by_agency(t["contas"]),
        "customers_with_loans": customers_with_loans(t["clientes"], t["emprestimos"]),
        "loan_volume": loan_volume(t["emprestimos"]),
    }
