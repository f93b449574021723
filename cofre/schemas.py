"""Table contracts: columns, types, keys, references, value domains and reject reasons.

The names, types, domains and texts are fixed values that results must agree on.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T

MONEY = T.DecimalType(15, 2)
TOTAL = T.DecimalType(38, 2)
SOURCE_SYSTEM = "banking_oltp_postgres"
SOURCE_TIMEZONE = "America/Sao_Paulo"

# Source tables in load order: parents come before the tables that refer to them.
TABLES = ("agencias", "clientes", "tipos_transacao", "contas", "cartoes", "emprestimos", "transacoes")

AUDIT_COLUMNS = ("_source_system", "_ingestion_timestamp", "_batch_id")
INGESTED_AT = "_ingestion_timestamp"
ROW_SEQ = "_row_seq"

CARD_TYPES = ("DEBIT", "CREDIT")
INSTALLMENTS = (6, 12, 18, 24, 36, 48)

# Seed rows of the transaction types.
TRANSACTION_TYPES = ((1, "PIX"), (2, "TED"), (3, "DOC"), (4, "SAQUE"), (5, "DEPOSITO"))


@dataclass(frozen=True)
class Reference:
    """A foreign key of a table."""

    column: str
    parent: str
    parent_key: str


@dataclass(frozen=True)
class Table:
    """Contract of one source table and of its trusted form."""

    key: str
    source: tuple[tuple[str, T.DataType], ...]
    trusted: tuple[tuple[str, T.DataType], ...]
    references: tuple[Reference, ...] = ()

    def links(self) -> dict[tuple[str, str], tuple[str, ...]]:
        """Referring columns per (parent, parent key)."""
        grouped: dict[tuple[str, str], tuple[str, ...]] = {}
        for ref in self.references:
            target = (ref.parent, ref.parent_key)
            grouped[target] = grouped.get(target, ()) + (ref.column,)
        return grouped

    @property
    def source_columns(self) -> tuple[str, ...]:
        return tuple(name for name, _ in self.source)

    @property
    def trusted_columns(self) -> tuple[str, ...]:
        return tuple(name for name, _ in self.trusted)


_ID, _INT, _TEXT, _DATE, _LOCAL = T.LongType(), T.IntegerType(), T.StringType(), T.DateType(), T.TimestampNTZType()

_AGENCIAS = (("agencia_id", _ID), ("nome_agencia", _TEXT), ("cidade", _TEXT))
_CLIENTES = (("cliente_id", _ID), ("nome", _TEXT), ("cpf", _TEXT), ("data_nascimento", _DATE))
_TIPOS = (("tipo_transacao_id", _ID), ("descricao", _TEXT))
_CONTAS = (("conta_id", _ID), ("cliente_id", _ID), ("agencia_id", _ID), ("saldo", MONEY))
_EMPRESTIMOS = (
    ("emprestimo_id", _ID),
    ("cliente_id", _ID),
    ("valor_contratado", MONEY),
    ("parcelas", _INT),
    ("data_contrato", _DATE),
)
_TRANSACOES = (
    ("transacao_id", _ID),
    ("conta_origem_id", _ID),
    ("conta_destino_id", _ID),
    ("tipo_transacao_id", _ID),
    ("valor", MONEY),
    ("data_hora", _LOCAL),
)

CONTRACTS: dict[str, Table] = {
    "agencias": Table("agencia_id", _AGENCIAS, _AGENCIAS),
    "clientes": Table("cliente_id", _CLIENTES, _CLIENTES),
    "tipos_transacao": Table("tipo_transacao_id", _TIPOS, _TIPOS),
    "contas": Table(
        "conta_id",
        _CONTAS,
        _CONTAS,
        (Reference("cliente_id", "clientes", "cliente_id"), Reference("agencia_id", "agencias", "agencia_id")),
    ),
    "cartoes": Table(
        "cartao_id",
        (("cartao_id", _ID), ("conta_id", _ID), ("numero_cartao", _TEXT), ("tipo_cartao", _TEXT)),
        (("cartao_id", _ID), ("conta_id", _ID), ("tipo_cartao", _TEXT), ("numero_cartao_mascarado", _TEXT)),
        (Reference("conta_id", "contas", "conta_id"),),
    ),
    "emprestimos": Table(
        "emprestimo_id",
        _EMPRESTIMOS,
        _EMPRESTIMOS,
        (Reference("cliente_id", "clientes", "cliente_id"),),
    ),
    "transacoes": Table(
        "transacao_id",
        _TRANSACOES,
        _TRANSACOES,
        (
            Reference("conta_origem_id", "contas", "conta_id"),
            Reference("conta_destino_id", "contas", "conta_id"),
            Reference("tipo_transacao_id", "tipos_transacao", "tipo_transacao_id"),
        ),
    ),
}

# Reject reasons.
NULL_OR_DUPLICATED_PK = "Null or duplicated primary key."
REQUIRED_FIELD_NULL = "Required field is null."
REQUIRED_OR_CPF = "Required field is null or CPF is invalid."
REQUIRED_OR_CARD = "Required field is null or card number is invalid."
DUPLICATED_CPF = "Duplicated CPF."
INVALID_BIRTH_DATE = "Invalid birth date."
INVALID_MONEY = "Invalid monetary value."
INVALID_CARD_TYPE = "Invalid card type."
INVALID_LOAN_AMOUNT = "Loan amount must be greater than zero."
INVALID_INSTALLMENTS = "Invalid installment count."
INVALID_CONTRACT_DATE = "Invalid contract date."
SAME_ACCOUNT = "Source and destination accounts must be different."
INVALID_AMOUNT = "Transaction amount must be greater than zero."
INVALID_TIMESTAMP = "Invalid transaction timestamp."


def unknown_parent(column: str) -> str:
    """Reject reason of a reference that finds no parent row."""
    return f"Referenced {column} does not exist."


def contract(table: str) -> Table:
    """Contract of ``table``; an unknown name is an error that lists the known ones."""
    if table not in CONTRACTS:
        raise ValueError(f"Unknown table {table!r}, expected one of: {', '.join(TABLES)}.")
    return CONTRACTS[table]


def require_columns(df: DataFrame, table: str, columns=None) -> DataFrame:
    """Fail when ``df`` lacks expected columns; looks at the analysed schema and runs no job."""
    expected = contract(table).source_columns if columns is None else columns
    missing = sorted(set(expected) - set(df.columns))
    if missing:
        raise ValueError(f"Table '{table}' lacks column(s): {', '.join(missing)}")
    return df
