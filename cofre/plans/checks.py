"""Which data contracts hold for which model. The lists are fixed values."""

from __future__ import annotations

from pyspark.sql import DataFrame

from cofre.operators import contracts

NOT_NULL: dict[str, tuple[str, ...]] = {
    "stg_agencias": ("agencia_id",),
    "stg_clientes": ("cliente_id", "cpf"),
    "stg_contas": ("conta_id", "cliente_id", "agencia_id"),
    "stg_cartoes": ("cartao_id", "conta_id"),
    "stg_emprestimos": ("emprestimo_id", "cliente_id"),
    "stg_tipos_transacao": ("tipo_transacao_id",),
    "stg_transacoes": (
        "transacao_id",
        "conta_origem_id",
        "conta_destino_id",
        "tipo_transacao_id",
        "valor",
        "data_hora",
    ),
    "dim_cliente": ("cliente_sk", "cliente_id"),
    "dim_conta": ("conta_sk", "conta_id"),
    "dim_data": ("data_sk", "data"),
    "dim_tipo_transacao": ("tipo_transacao_sk", "tipo_transacao_id"),
    "fato_transacao": (
        "transacao_sk",
        "transacao_id",
        "cliente_sk",
        "conta_origem_sk",
        "conta_destino_sk",
        "data_sk",
        "tipo_transacao_sk",
        "valor",
        "data_hora",
    ),
    "fato_emprestimo": (
        "emprestimo_sk",
        "emprestimo_id",
        "cliente_sk",
        "data_sk",
        "valor_contratado",
        "parcelas",
        "valor_medio_parcela",
        "data_contrato",
    ),
}

UNIQUE: dict[str, tuple[str, ...]] = {
    "stg_agencias": ("agencia_id",),
    "stg_clientes": ("cliente_id", "cpf"),
    "stg_contas": ("conta_id",),
    "stg_cartoes": ("cartao_id",),
    "stg_emprestimos": ("emprestimo_id",),
    "stg_tipos_transacao": ("tipo_transacao_id",),
    "stg_transacoes": ("transacao_id",),
    "dim_cliente": ("cliente_sk", "cliente_id"),
    "dim_conta": ("conta_sk", "conta_id"),
    "dim_data": ("data_sk", "data"),
    "dim_tipo_transacao": ("tipo_transacao_sk", "tipo_transacao_id"),
    "fato_transacao": ("transacao_sk", "transacao_id"),
    "fato_emprestimo": ("emprestimo_sk", "emprestimo_id"),
}

# Model: (column, parent model, parent column).
RELATIONSHIPS: dict[str, tuple[tuple[str, str, str], ...]] = {
    "stg_contas": (("cliente_id", "stg_clientes", "cliente_id"), ("agencia_id", "stg_agencias", "agencia_id")),
    "stg_cartoes": (("conta_id", "stg_contas", "conta_id"),),
    "stg_emprestimos": (("cliente_id", "stg_clientes", "cliente_id"),),
    "stg_transacoes": (
        ("conta_origem_id", "stg_contas", "conta_id"),
        ("conta_destino_id", "stg_contas", "conta_id"),
        ("tipo_transacao_id", "stg_tipos_transacao", "tipo_transacao_id"),
    ),
    "fato_transacao": (
        ("cliente_sk", "dim_cliente", "cliente_sk"),
        ("conta_origem_sk", "dim_conta", "conta_sk"),
        ("conta_destino_sk", "dim_conta", "conta_sk"),
        ("data_sk", "dim_data", "data_sk"),
        ("tipo_transacao_sk", "dim_tipo_transacao", "tipo_transacao_sk"),
    ),
    "fato_emprestimo": (("cliente_sk", "dim_cliente", "cliente_sk"), ("data_sk", "dim_data", "data_sk")),
}


def all_checks(models: dict[str, DataFrame], nulls: dict[str, dict[str, int]]) -> DataFrame:
    """Every check over staging, dimensions and facts; ``nulls`` are the null values per model and column that the writes counted."""
    return contracts.union_all([
        contracts.not_null_counted(models, NOT_NULL, nulls),
        contracts.unique(models, UNIQUE),
        contracts.relationships(models, RELATIONSHIPS),
    ])
