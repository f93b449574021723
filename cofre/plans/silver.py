"""Trusted layer: one rule chain per table, giving accepted rows and rejects from one tagged frame.

A tagged frame holds the typed columns of the trusted table, ``_reject_reason``, and for rejected
rows the cleaned source text of each normalised column as ``_text_<column>``.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cofre import schemas as S
from cofre.functions import clean
from cofre.operators.dedupe import older_copy, refuse_ties, repeated_keys, superseded
from cofre.operators.keysets import KeySet, kept, settle
from cofre.operators.references import Link, attach_links, missing
from cofre.operators.rules import REASON, any_null, not_positive, rejected, tag

Rules = list[tuple[str, Column]]
Parents = dict[str, DataFrame]

EVIDENCE = "_text_"


INCOMPLETE = "_incomplete"


def prepare(raw: DataFrame, table: str) -> DataFrame:
    """Check the columns, note whether a required one is null, and clean the text of all.

    Cleaning never turns a value into null or back, so the cheap test comes first.
    """
    columns = S.contract(table).source_columns
    checked = S.require_columns(raw, table)
    return clean.clean_text(checked.withColumn(INCOMPLETE, any_null(*columns)), columns)


def settle_repeated(prepared: Mapping[str, DataFrame]) -> dict[str, KeySet]:
    """Repeated primary keys of several tables, computed together. Equally new rows of a key are an error."""
    found = settle({t: repeated_keys(df, S.contract(t).key) for t, df in prepared.items()})
    return {t: refuse_ties(repeated, S.contract(t).key) for t, repeated in found.items()}


def _attach_keys(df: DataFrame, table: str, repeated: KeySet, parents: Parents) -> DataFrame:
    """Make superseded rows and references without parent known."""
    contract = S.contract(table)
    attached = repeated.attach(df, contract.key, "_newest", "_newest")
    links = [Link(columns, parents[parent], key) for (parent, key), columns in contract.links().items()]
    return attach_links(attached, links) if links else attached


def _leading_rules(
    df: DataFrame, table: str, required: str = S.REQUIRED_FIELD_NULL, invalid: Column | None = None
) -> Rules:
    """Key rule and required-field rule, which every table starts with."""
    null = F.col(INCOMPLETE)
    return [
        (S.NULL_OR_DUPLICATED_PK, superseded(df, S.contract(table).key)),
        (required, null if invalid is None else null | invalid),
    ]


def _with_money(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(_typed(column), clean.normalize_money(F.col(column), df.schema[column].dataType))


def _reference_rules(table: str) -> Rules:
    return [(S.unknown_parent(r.column), missing(r.column)) for r in S.contract(table).references]


def _typed(column: str) -> str:
    """Working column with the normalised form of ``column``."""
    return f"_typed_{column}"


def _finish(df: DataFrame, table: str, rules: Rules, hidden: tuple[str, ...] = ()) -> DataFrame:
    """Tag the rows; keep typed columns, columns outside the contract, evidence and reason.

    ``hidden`` columns are normalised for the rules but leave no trace in the result.
    """
    contract = S.contract(table)
    normalised = [c for c in contract.source_columns if _typed(c) in df.columns and c not in hidden]
    columns = [F.col(_typed(c) if c in normalised else c).alias(c) for c in contract.trusted_columns]
    extra = [c for c in S.AUDIT_COLUMNS + (S.ROW_SEQ,) if c in df.columns]
    evidence = [
        F.when(F.col(REASON).isNotNull(), F.col(c).cast("string")).alias(EVIDENCE + c) for c in normalised
    ]
    return tag(df, rules).select(*columns, *extra, *evidence, REASON)


def tag_agencias(prepared: DataFrame, repeated: KeySet, parents: Parents) -> DataFrame:
    df = _attach_keys(prepared, "agencias", repeated, parents)
    return _finish(df, "agencias", _leading_rules(df, "agencias"))


def tag_tipos_transacao(prepared: DataFrame, repeated: KeySet, parents: Parents) -> DataFrame:
    df = _attach_keys(prepared, "tipos_transacao", repeated, parents)
    return _finish(df, "tipos_transacao", _leading_rules(df, "tipos_transacao"))


def tag_clientes(prepared: DataFrame, repeated: KeySet, parents: Parents) -> DataFrame:
    """The newest row of a CPF stays, the older ones go; only rows that are otherwise complete compete."""
    df = _attach_keys(prepared, "clientes", repeated, parents).withColumns({
        _typed("cpf"): clean.normalize_cpf(F.col("cpf")),
        _typed("data_nascimento"): clean.normalize_date(F.col("data_nascimento")),
    })
    rules = _leading_rules(df, "clientes", S.REQUIRED_OR_CPF, invalid=F.col(_typed("cpf")).isNull())
    complete = ~reduce(Column.__or__, [condition for _, condition in rules])
    shared = refuse_ties(settle({"cpf": repeated_keys(df, _typed("cpf"), among=complete)})["cpf"], "cpf")
    df = shared.attach(df, _typed("cpf"), "_newest_cpf", "_newest")
    rules += [
        (S.DUPLICATED_CPF, older_copy(df, "_newest_cpf")),
        (S.INVALID_BIRTH_DATE, F.col(_typed("data_nascimento")).isNull()),
    ]
    return _finish(df, "clientes", rules)


def tag_contas(prepared: DataFrame, repeated: KeySet, parents: Parents) -> DataFrame:
    df = _with_money(_attach_keys(prepared, "contas", repeated, parents), "saldo")
    rules = _leading_rules(df, "contas") + _reference_rules("contas")
    rules.append((S.INVALID_MONEY, F.col(_typed("saldo")).isNull()))
    return _finish(df, "contas", rules)


def tag_cartoes(prepared: DataFrame, repeated: KeySet, parents: Parents) -> DataFrame:
    """Full card numbers appear neither in accepted nor in rejected rows."""
    number = F.col("numero_cartao")
    df = _attach_keys(prepared, "cartoes", repeated, parents).withColumns({
        _typed("numero_cartao"): clean.normalize_card(number),
        "numero_cartao_mascarado": clean.mask_card(clean.digits(number)),
    })
    rules = _leading_rules(df, "cartoes", S.REQUIRED_OR_CARD, invalid=F.col(_typed("numero_cartao")).isNull())
    rules += _reference_rules("cartoes")
    rules.append((S.INVALID_CARD_TYPE, ~F.col("tipo_cartao").isin(*S.CARD_TYPES)))
    return _finish(df, "cartoes", rules, hidden=("numero_cartao",))


def tag_emprestimos(prepared: DataFrame, repeated: KeySet, parents: Parents) -> DataFrame:
    df = _with_money(_attach_keys(prepared, "emprestimos", repeated, parents), "valor_contratado")
    df = df.withColumn(_typed("data_contrato"), clean.normalize_date(F.col("data_contrato")))
    rules = _leading_rules(df, "emprestimos") + _reference_rules("emprestimos")
    rules += [
        (S.INVALID_LOAN_AMOUNT, not_positive(F.col(_typed("valor_contratado")))),
        (S.INVALID_INSTALLMENTS, ~F.col("parcelas").isin(*S.INSTALLMENTS)),
        (S.INVALID_CONTRACT_DATE, F.col(_typed("data_contrato")).isNull()),
    ]
    return _finish(df, "emprestimos", rules)


def tag_transacoes(prepared: DataFrame, repeated: KeySet, parents: Parents) -> DataFrame:
    df = _with_money(_attach_keys(prepared, "transacoes", repeated, parents), "valor")
    moment = clean.normalize_timestamp(F.col("data_hora"), df.schema["data_hora"].dataType)
    df = df.withColumn(_typed("data_hora"), moment)
    rules = _leading_rules(df, "transacoes") + _reference_rules("transacoes")
    rules += [
        (S.SAME_ACCOUNT, F.col("conta_origem_id") == F.col("conta_destino_id")),
        (S.INVALID_AMOUNT, not_positive(F.col(_typed("valor")))),
        (S.INVALID_TIMESTAMP, F.col(_typed("data_hora")).isNull()),
    ]
    return _finish(df, "transacoes", rules)


TAGGERS: dict[str, Callable[[DataFrame, KeySet, Parents], DataFrame]] = {
    "agencias": tag_agencias,
    "clientes": tag_clientes,
    "tipos_transacao": tag_tipos_transacao,
    "contas": tag_contas,
    "cartoes": tag_cartoes,
    "emprestimos": tag_emprestimos,
    "transacoes": tag_transacoes,
}


def trusted_rows(tagged: DataFrame, table: str) -> DataFrame:
    """Accepted rows with the typed columns and any audit columns."""
    audit = [c for c in S.AUDIT_COLUMNS if c in tagged.columns]
    return tagged.where(F.col(REASON).isNull()).select(*S.contract(table).trusted_columns, *audit)


def reject_rows(tagged: DataFrame) -> DataFrame:
    """Rejected rows with their reason, and the cleaned source text where a column was normalised."""
    texts = [c.removeprefix(EVIDENCE) for c in tagged.columns if c.startswith(EVIDENCE)]
    kept = [c for c in tagged.columns if not c.startswith(EVIDENCE)]
    return rejected(tagged).select(*[F.col(EVIDENCE + c).alias(c) if c in texts else F.col(c) for c in kept])


def ancestry(table: str) -> list[str]:
    """The table and all tables it refers to, directly or not, in load order."""
    needed = {table}
    for ref in S.contract(table).references:
        needed.update(ancestry(ref.parent))
    return [t for t in S.TABLES if t in needed]


class Trusted:
    """Tagged frames of ``tables`` over raw frames, each built when first asked for.

    With ``keep`` key and reason of a table that others refer to are written to the checkpoint folder once, for a
    query that counts over several tables and needs no other column.
    """

    def __init__(self, raw: Mapping[str, DataFrame], tables: Sequence[str] = S.TABLES, keep: bool = False):
        self._parents = {r.parent for t in tables for r in S.contract(t).references} if keep else set()
        self._prepared = {t: prepare(raw[t], t) for t in tables}
        self._repeated = settle_repeated(self._prepared)
        self._tagged: dict[str, DataFrame] = {}

    def tagged(self, table: str) -> DataFrame:
        if table not in self._tagged:
            parents = {r.parent: self.keys(r.parent) for r in S.contract(table).references}
            tagged = TAGGERS[table](self._prepared[table], self._repeated[table], parents)
            self._tagged[table] = kept(tagged.select(S.contract(table).key, REASON)) if table in self._parents else tagged
        return self._tagged[table]

    def keys(self, table: str) -> DataFrame:
        """Keys of the accepted rows, all that a reference asks for."""
        return self.tagged(table).where(F.col(REASON).isNull()).select(S.contract(table).key)

    def rows(self, table: str) -> DataFrame:
        return trusted_rows(self.tagged(table), table)

    def rejects(self, table: str) -> DataFrame:
        return reject_rows(self.tagged(table))
