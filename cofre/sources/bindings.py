"""The seven source tables as views of the benchmark tables.

``bank_*`` satisfy every contract. ``raw_*`` carry defects for the quality rules, and their
``data_hora`` is local time. All are plain projections, so pruning and pushdown reach the scans.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cofre.schemas import TABLES

# Transaction type per order priority, and its defective variant (priority, id, text, position).
_TIPOS = "(1, 'PIX'), (2, 'TED'), (3, 'DOC'), (4, 'SAQUE'), (5, 'DEPOSITO')"
_RAW_TIPOS = """(1, 1, ' PIX ', 1), (2, 2, 'TED', 2), (2, 2, 'TED   ', 3), (3, 3, 'DOC', 4), (4, 4, 'SAQUE', 5),
    (5, 5, 'DEPOSITO', 6), (5, 6, cast(null as string), 7), (5, cast(null as int), 'X', 8)"""

_INSTALLMENTS = """case o_orderkey % 6 when 0 then 6 when 1 then 12 when 2 then 18
    when 3 then 24 when 4 then 36 else 48 end"""
_MOMENT = "o_orderdate + ((o_orderkey * 7919) % 86400) * interval '1' second"

VIEWS: dict[str, str] = {
    "bank_agencias": """
        select n_nationkey agencia_id, n_name nome_agencia, r_name cidade
        from {nation} join {region} on n_regionkey = r_regionkey""",
    "bank_clientes": """
        select c_custkey cliente_id, c_name nome, lpad(cast(c_custkey as string), 11, '0') cpf,
               date '1950-01-01' + cast(c_custkey % 18250 as int) data_nascimento
        from {customer}""",
    "bank_tipos_transacao": f"""
        select v.tipo_transacao_id, v.descricao
        from (select distinct cast(substr(o_orderpriority, 1, 1) as int) priority from {{orders}}) o
        join (values {_TIPOS}) v(tipo_transacao_id, descricao) on o.priority = v.tipo_transacao_id""",
    "bank_contas": """
        select c_custkey conta_id, case when c_custkey % 6 = 5 then c_custkey - 1 else c_custkey end cliente_id,
               c_nationkey agencia_id, cast(c_acctbal as decimal(15,2)) saldo
        from {customer}""",
    "bank_cartoes": """
        select p_partkey cartao_id, p_partkey % 150 conta_id,
               '4000' || lpad(cast(p_partkey as string), 12, '0') numero_cartao,
               case when p_partkey % 10 < 4 then 'CREDIT' else 'DEBIT' end tipo_cartao
        from {part}""",
    "bank_emprestimos": f"""
        select o_orderkey emprestimo_id, o_custkey cliente_id, cast(o_totalprice as decimal(15,2)) valor_contratado,
               {_INSTALLMENTS} parcelas, cast(o_orderdate as date) data_contrato
        from {{orders}}""",
    "bank_transacoes": f"""
        select o_orderkey transacao_id, o_custkey conta_origem_id,
               case when o_custkey = o_orderkey % 150 then (o_orderkey + 1) % 150 else o_orderkey % 150 end conta_destino_id,
               cast(substr(o_orderpriority, 1, 1) as int) tipo_transacao_id,
               cast(o_totalprice as decimal(15,2)) valor, {_MOMENT} data_hora
        from {{orders}}""",
    "raw_agencias": """
        select case when n_nationkey = 24 then null else n_nationkey end agencia_id,
               '  ' || replace(n_name, '_', '   ') || ' ' nome_agencia,
               case when n_nationkey = 23 then null else r_name end cidade, n_nationkey _row_seq
        from {nation} join {region} on n_regionkey = r_regionkey""",
    "raw_clientes": """
        select case when k % 101 = 100 then null else k end cliente_id,
               case when k % 89 = 88 then null else '  ' || c_name || '   x ' end nome,
               case when k % 53 = 52 then '123'
                    when k % 71 = 70 then lpad(cast(k - 1 as string), 11, '0')
                    else substr(p,1,3) || '.' || substr(p,4,3) || '.' || substr(p,7,3) || '-' || substr(p,10,2) end cpf,
               case when k % 67 = 66 then 'not-a-date'
                    else cast(date '1950-01-01' + cast(k % 18250 as int) as string) end data_nascimento,
               k _row_seq
        from (select c_custkey k, lpad(cast(c_custkey as string), 11, '0') p, c_name from {customer}) s""",
    "raw_tipos_transacao": f"""
        select v.tipo_transacao_id, v.descricao, v._row_seq
        from (select distinct cast(substr(o_orderpriority, 1, 1) as int) priority from {{orders}}) o
        join (values {_RAW_TIPOS}) v(priority, tipo_transacao_id, descricao, _row_seq) on o.priority = v.priority""",
    "raw_contas": """
        select case when c_custkey % 103 = 102 then null else c_custkey end conta_id,
               case when c_custkey % 61 = 60 then c_custkey + 1000000000
                    when c_custkey % 6 = 5 then c_custkey - 1 else c_custkey end cliente_id,
               case when c_custkey % 47 = 46 then 999 else c_nationkey end agencia_id,
               case when c_custkey % 59 = 58 then null
                    when c_custkey % 43 = 42 then 'abc'
                    when c_custkey % 5 = 0 then cast(cast(c_acctbal as decimal(15,2)) as string) || '5'
                    else cast(cast(c_acctbal as decimal(15,2)) as string) end saldo,
               c_custkey _row_seq
        from {customer}""",
    "raw_cartoes": """
        select case when k % 211 = 210 then null else k end cartao_id,
               case when k % 20 = 7 then k + 1000000000 else k % 150 end conta_id,
               case when k % 31 = 30 then '4000 123'
                    else '4000 ' || substr(p,1,4) || ' ' || substr(p,5,4) || '-' || substr(p,9,4) end numero_cartao,
               case when k % 10 = 0 then 'GIFT' when k % 10 < 4 then 'CREDIT' else 'DEBIT' end tipo_cartao,
               k _row_seq
        from (select p_partkey k, lpad(cast(p_partkey as string), 12, '0') p from {part}) s""",
    "raw_emprestimos": """
        select l_orderkey * 10 + l_linenumber emprestimo_id, l_suppkey cliente_id,
               cast(case when (l_orderkey + l_partkey) % 97 = 0 then -l_extendedprice
                         else l_extendedprice end as decimal(15,2)) valor_contratado,
               case when l_partkey % 197 = 196 then null else cast(l_quantity as int) end parcelas,
               case when l_partkey % 23 = 22 then 'not-a-date'
                    when l_partkey % 69 = 20 then '2024'
                    when l_partkey % 69 = 43 then '2024-05'
                    when l_partkey % 69 = 66 then '99999-01-01'
                    else cast(cast(l_shipdate as date) as string) end data_contrato,
               l_shipdate _ingestion_timestamp, l_partkey _row_seq
        from {lineitem}""",
    "raw_transacoes": f"""
        select o_orderkey transacao_id, o_custkey conta_origem_id, o_orderkey % 150 conta_destino_id,
               case when o_orderkey % 113 = 112 then 9
                    else cast(substr(o_orderpriority, 1, 1) as int) end tipo_transacao_id,
               case when o_orderkey % 131 = 130 then null
                    when o_orderkey % 127 = 126 then cast(0 as decimal(15,2))
                    else cast(o_totalprice as decimal(15,2)) end valor,
               {_MOMENT} data_hora, o_orderkey _row_seq
        from {{orders}}""",
}

_INPUTS = ("nation", "region", "customer", "orders", "part", "lineitem")


class OnDemand(dict):
    """Tables by name, each built when first asked for."""

    def __init__(self, build: Callable[[str], DataFrame]):
        super().__init__()
        self._build = build

    def __missing__(self, table: str) -> DataFrame:
        self[table] = self._build(table)
        return self[table]


class Bindings:
    """Source tables over the Parquet files of one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self._table = cache(lambda name: spark.read.parquet(f"{folder}/{name}.parquet"))

    def view(self, name: str) -> DataFrame:
        text = VIEWS[name]
        return self.spark.sql(text, **{t: self._table(t) for t in _INPUTS if "{" + t + "}" in text})

    def bank(self, table: str) -> DataFrame:
        return self.view(f"bank_{table}")

    def raw(self, table: str) -> DataFrame:
        return self.view(f"raw_{table}")

    def all_bank(self) -> dict[str, DataFrame]:
        return {table: self.bank(table) for table in TABLES}

    def all_raw(self) -> dict[str, DataFrame]:
        return OnDemand(self.raw)

    def manifest(self) -> DataFrame:
        """Which tables of which batch were written, and whether and when the batch was committed.

        Batches were not committed in the order of their ingestion. Every nation stands for a batch and every ninth (batch, table) pair is left out.
        """
        tables = F.posexplode(F.array(*[F.lit(t) for t in TABLES])).alias("position", "table_name")
        batch = F.col("n_nationkey")
        first_day = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
        return (
            self._table("nation")
            .select(batch, tables)
            .where((batch + F.col("position") + 1) % 9 != 0)
            .select(
                "table_name",
                F.concat(F.lit("batch-"), F.lpad(batch.cast("string"), 3, "0")).alias("batch_id"),
                (first_day + F.make_dt_interval(days=batch)).alias("ingestion_ts"),
                (batch % 2 == 0).alias("committed"),
                (first_day + F.make_dt_interval(days=(batch * 7) % 25, hours=F.lit(1))).alias("committed_at"),
            )
        )
