"""The registered queries once more, as plain SQL for an independent engine."""

from __future__ import annotations

import re

from cofre.schemas import CONTRACTS, TABLES, TRANSACTION_TYPES
from cofre.plans.checks import NOT_NULL, RELATIONSHIPS, UNIQUE
from cofre.sources.bindings import VIEWS

_ZONE = "'America/Sao_Paulo'"
_AUDIT = "'banking_oltp_postgres' _source_system, timestamp '2024-01-01 00:00:00' _ingestion_timestamp, 'batch-000' _batch_id"


def _tidy(column: str) -> str:
    return rf"trim(regexp_replace({column}, '\s+', ' ', 'g'))"


def _digits(column: str, length: int) -> str:
    only = rf"regexp_replace({column}, '\D', '', 'g')"
    return f"case when length({only}) = {length} then {only} end"


def _money(column: str) -> str:
    return f"cast(round_even(try_cast({column} as decimal(38,10)), 2) as decimal(15,2))"


def _date(column: str) -> str:
    return rf"case when regexp_matches({column}, '^\d{{4}}-\d{{2}}-\d{{2}}([ T].*)?$') then try_cast({column} as date) end"


def _utc(ts: str) -> str:
    return f"timezone('UTC', timezone({_ZONE}, {ts}))"


def _local(utc: str) -> str:
    return f"timezone({_ZONE}, timezone('UTC', {utc}))"


_GAP = f"{_local(_utc('data_hora'))} <> data_hora"
_OVERLAP = " or ".join(f"{_local(_utc('data_hora') + f' {sign} interval 1 hour')} = data_hora" for sign in "+-")
_MOMENT = f"case when not ({_GAP} or {_OVERLAP}) then {_utc('data_hora')} end"

# Sum as decimal(38,2) and mean as one division of doubles.
def _total(column: str) -> str:
    return f"cast(sum({column}) as decimal(38,2))"


def _mean(column: str) -> str:
    return f"cast(sum({column}) as double) / nullif(count({column}), 0)"


_PK = "'Null or duplicated primary key.'"
_REQUIRED = "'Required field is null.'"


def _unknown(child: str, column: str, parent: str, key: str) -> str:
    text = f"'Referenced {column} does not exist.'"
    return f"when {child}.{column} not in (select {key} from silver_{parent}) then {text}"


# Named building blocks. Each may use the ones above it and the views of the source tables.
BLOCKS: dict[str, str] = dict(VIEWS)
for _name, _text in BLOCKS.items():
    BLOCKS[_name] = re.sub(r"\{(\w+)\}", r"\1", _text)

BLOCKS |= {
    "batch_manifest": """
        select b.table_name, 'batch-' || lpad(cast(n_nationkey as varchar), 3, '0') batch_id,
               timestamp '2024-01-01 00:00:00' + n_nationkey * interval '1' day ingestion_ts,
               n_nationkey % 2 = 0 committed,
               timestamp '2024-01-01 01:00:00' + (n_nationkey * 7) % 25 * interval '1' day committed_at
        from nation, (values {}) b(id, table_name)
        where (n_nationkey + b.id) % 9 <> 0""".format(
        ", ".join(f"({i}, '{t}')" for i, t in enumerate(TABLES, 1))
    ),
    "complete": """
        select batch_id, min(ingestion_ts) ingestion_ts, bool_and(committed) committed, max(committed_at) committed_at
        from batch_manifest group by batch_id having count(distinct table_name) = 7""",
    "tagged_agencias": f"""
        select *, case when agencia_id is null or rn > 1 then {_PK}
                       when nome_agencia is null or cidade is null then {_REQUIRED} end reason
        from (select agencia_id, {_tidy('nome_agencia')} nome_agencia, {_tidy('cidade')} cidade,
                     row_number() over (partition by agencia_id order by _row_seq desc) rn
              from raw_agencias)""",
    "tagged_tipos_transacao": f"""
        select *, case when tipo_transacao_id is null or rn > 1 then {_PK}
                       when descricao is null then {_REQUIRED} end reason
        from (select tipo_transacao_id, {_tidy('descricao')} descricao,
                     row_number() over (partition by tipo_transacao_id order by _row_seq desc) rn
              from raw_tipos_transacao)""",
    "complete_clientes": f"""
        select *, case when cliente_id is null or rn > 1 then {_PK}
                       when nome is null or cpf is null or born is null
                       then 'Required field is null or CPF is invalid.' end early
        from (select cliente_id, {_tidy('nome')} nome, {_digits('cpf', 11)} cpf, {_tidy('data_nascimento')} born,
                     _row_seq, row_number() over (partition by cliente_id order by _row_seq desc) rn
              from raw_clientes)""",
    "tagged_clientes": f"""
        select cliente_id, nome, cpf, {_date('born')} data_nascimento,
               case when early is not null then early
                    when row_number() over (partition by early, cpf order by _row_seq desc) > 1
                    then 'Duplicated CPF.'
                    when {_date('born')} is null then 'Invalid birth date.' end reason
        from complete_clientes""",
    "silver_agencias": "select agencia_id, nome_agencia, cidade from tagged_agencias where reason is null",
    "silver_tipos_transacao": "select tipo_transacao_id, descricao from tagged_tipos_transacao where reason is null",
    "silver_clientes": "select cliente_id, nome, cpf, data_nascimento from tagged_clientes where reason is null",
    "tagged_contas": f"""
        select conta_id, cliente_id, agencia_id, {_money('c.saldo')} saldo,
               case when conta_id is null or rn > 1 then {_PK}
                    when cliente_id is null or agencia_id is null or c.saldo is null then {_REQUIRED}
                    {_unknown('c', 'cliente_id', 'clientes', 'cliente_id')}
                    {_unknown('c', 'agencia_id', 'agencias', 'agencia_id')}
                    when {_money('c.saldo')} is null then 'Invalid monetary value.' end reason
        from (select conta_id, cliente_id, agencia_id, {_tidy('saldo')} saldo,
                     row_number() over (partition by conta_id order by _row_seq desc) rn
              from raw_contas) c""",
    "silver_contas": "select conta_id, cliente_id, agencia_id, saldo from tagged_contas where reason is null",
    "tagged_cartoes": f"""
        select cartao_id, conta_id, tipo_cartao, '**** **** **** ' || right(numero, 4) numero_cartao_mascarado,
               case when cartao_id is null or rn > 1 then {_PK}
                    when conta_id is null or numero is null or tipo_cartao is null
                    then 'Required field is null or card number is invalid.'
                    {_unknown('c', 'conta_id', 'contas', 'conta_id')}
                    when tipo_cartao not in ('DEBIT', 'CREDIT') then 'Invalid card type.' end reason
        from (select cartao_id, conta_id, {_digits('numero_cartao', 16)} numero, {_tidy('tipo_cartao')} tipo_cartao,
                     row_number() over (partition by cartao_id order by _row_seq desc) rn
              from raw_cartoes) c""",
    "silver_cartoes": """
        select cartao_id, conta_id, tipo_cartao, numero_cartao_mascarado from tagged_cartoes where reason is null""",
    "latest_emprestimos": """
        select *, row_number() over (partition by emprestimo_id
                                     order by _ingestion_timestamp desc nulls first, _row_seq desc) rn
        from raw_emprestimos""",
    "tagged_emprestimos": f"""
        select emprestimo_id, cliente_id, valor_contratado, parcelas, {_date('e.data_contrato')} data_contrato,
               case when emprestimo_id is null or rn > 1 then {_PK}
                    when cliente_id is null or valor_contratado is null or parcelas is null
                         or e.data_contrato is null then {_REQUIRED}
                    {_unknown('e', 'cliente_id', 'clientes', 'cliente_id')}
                    when valor_contratado <= 0 then 'Loan amount must be greater than zero.'
                    when parcelas not in (6, 12, 18, 24, 36, 48) then 'Invalid installment count.'
                    when {_date('e.data_contrato')} is null then 'Invalid contract date.' end reason
        from latest_emprestimos e""",
    "silver_emprestimos": """
        select emprestimo_id, cliente_id, valor_contratado, parcelas, data_contrato
        from tagged_emprestimos where reason is null""",
    "utc_transacoes": f"select * replace ({_MOMENT} as data_hora), data_hora raw_data_hora from raw_transacoes",
    "tagged_transacoes": f"""
        select transacao_id, conta_origem_id, conta_destino_id, tipo_transacao_id, valor, data_hora,
               case when transacao_id is null or rn > 1 then {_PK}
                    when conta_origem_id is null or conta_destino_id is null or tipo_transacao_id is null
                         or valor is null or raw_data_hora is null then {_REQUIRED}
                    {_unknown('t', 'conta_origem_id', 'contas', 'conta_id')}
                    {_unknown('t', 'conta_destino_id', 'contas', 'conta_id')}
                    {_unknown('t', 'tipo_transacao_id', 'tipos_transacao', 'tipo_transacao_id')}
                    when conta_origem_id = conta_destino_id then 'Source and destination accounts must be different.'
                    when valor <= 0 then 'Transaction amount must be greater than zero.'
                    when data_hora is null then 'Invalid transaction timestamp.' end reason
        from (select *, row_number() over (partition by transacao_id order by _row_seq desc) rn
              from utc_transacoes) t""",
    "silver_transacoes": """
        select transacao_id, conta_origem_id, conta_destino_id, tipo_transacao_id, valor, data_hora
        from tagged_transacoes where reason is null""",
    "dim_cliente": "select row_number() over (order by cliente_id) cliente_sk, * from bank_clientes",
    "dim_conta": "select row_number() over (order by conta_id) conta_sk, * from bank_contas",
    "dim_tipo_transacao": """
        select row_number() over (order by tipo_transacao_id) tipo_transacao_sk, * from bank_tipos_transacao""",
    "distinct_dates": """
        select cast(data_hora as date) as data from bank_transacoes
        union select data_contrato from bank_emprestimos""",
    "dim_data": """
        select row_number() over (order by data) data_sk, data, cast(day(data) as integer) dia,
               cast(month(data) as integer) mes, monthname(data) nome_mes, cast(quarter(data) as integer) trimestre,
               cast(year(data) as integer) ano, cast(isodow(data) as integer) dia_semana
        from distinct_dates""",
    "fato_transacao": """
        select row_number() over (order by t.transacao_id) transacao_sk, t.transacao_id,
               (select cliente_sk from dim_cliente c where c.cliente_id = o.cliente_id) cliente_sk,
               o.conta_sk conta_origem_sk, d.conta_sk conta_destino_sk, dd.data_sk, tt.tipo_transacao_sk,
               t.valor, t.data_hora
        from bank_transacoes t, dim_conta o, dim_conta d, dim_data dd, dim_tipo_transacao tt
        where t.conta_origem_id = o.conta_id and t.conta_destino_id = d.conta_id
          and cast(t.data_hora as date) = dd.data and t.tipo_transacao_id = tt.tipo_transacao_id
          and o.cliente_id in (select cliente_id from dim_cliente)""",
    "fato_emprestimo": """
        select row_number() over (order by e.emprestimo_id) emprestimo_sk, e.emprestimo_id, c.cliente_sk, d.data_sk,
               e.valor_contratado, e.parcelas,
               cast(cast((2 * cast(e.valor_contratado * 100 as bigint) + e.parcelas) // (2 * e.parcelas)
                         as decimal(18,0)) / 100 as decimal(15,2)) valor_medio_parcela,
               e.data_contrato
        from bank_emprestimos e, dim_cliente c, dim_data d
        where e.cliente_id = c.cliente_id and e.data_contrato = d.data""",
}


def _with_blocks(body: str) -> str:
    """``body`` preceded by the blocks it needs, in order."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for word in set(re.findall(r"\w+", text)):
            if word in BLOCKS and word not in needed:
                needed.add(word)
                visit(BLOCKS[word])

    visit(body)
    blocks = ",\n".join(f"{name} as ({text})" for name, text in BLOCKS.items() if name in needed)
    return f"with {blocks}\n{body}" if needed else body


def _monthly(fact: str, amount: str, count_name: str, amount_name: str) -> str:
    return f"""select ano, mes, nome_mes, count(*) {count_name}, {_total(amount)} {amount_name}
               from {fact} join dim_data using (data_sk) group by ano, mes, nome_mes order by ano, mes"""


def _fk(table: str, column: str, parent: str, key: str) -> str:
    return f"""select {CONTRACTS[table].key}, {column} from raw_{table} x
               where {column} is not null
                 and not exists (select 1 from bank_{parent} p where p.{key} = x.{column})"""


def _fk_to_trusted(table: str, column: str, parent: str, key: str) -> str:
    return (
        f"select {CONTRACTS[table].key}, {column} from raw_{table} "
        f"where {column} is not null and {column} not in (select {key} from silver_{parent})"
    )


def _orphans(table: str) -> str:
    lacks = " or ".join(
        f"not exists (select 1 from bank_{r.parent} p where p.{r.parent_key} = x.{r.column})"
        for r in CONTRACTS[table].references
    )
    return f"select count(*) orphans from raw_{table} x where {lacks}"


def _check(model: str, column: str, check: str, count: str) -> str:
    return f"select '{model}' model, '{column}' \"column\", '{check}' \"check\", cast({count} as bigint) violations"


def _model(name: str) -> str:
    return name.replace("stg_", "bank_")


def _not_null() -> str:
    lists = NOT_NULL | {f"raw_{t}": CONTRACTS[t].source_columns for t in TABLES}
    return " union all ".join(
        _check(m, c, "not_null", f"count(*) - count({c})") + f" from {_model(m)}" for m, cs in lists.items() for c in cs
    )


def _unique() -> str:
    lists = UNIQUE | {f"raw_{t}": (CONTRACTS[t].key,) for t in TABLES}
    return " union all ".join(
        _check(m, c, "unique", "count(*)")
        + f" from (select {c} from {_model(m)} where {c} is not null group by {c} having count(*) > 1)"
        for m, cs in lists.items()
        for c in cs
    )


def _relationships() -> str:
    links = [(m, c, _model(p), k) for m, ls in RELATIONSHIPS.items() for c, p, k in ls]
    links += [
        (f"raw_{t}", r.column, f"bank_{r.parent}", r.parent_key) for t in TABLES for r in CONTRACTS[t].references
    ]
    return " union all ".join(
        _check(m, c, "relationships", "count(*)")
        + f""" from {_model(m)} x where {c} is not null
               and not exists (select 1 from {p} p where p.{k} = x.{c})"""
        for m, c, p, k in links
    )


def _both(table: str, measures: str) -> str:
    return " union all ".join(f"select '{f}_{table}' table_name, {measures} from {f}_{table}" for f in ("bank", "raw"))


def _staged(table: str) -> str:
    columns = ", ".join(CONTRACTS[table].trusted_columns)
    if table == "cartoes":
        columns = "cartao_id, conta_id, tipo_cartao, '**** **** **** ' || right(numero_cartao, 4) numero_cartao_mascarado"
    return f"select {columns}, {_AUDIT} from bank_{table}"


def _scalar(table: str, column: str, expression: str) -> str:
    return f"select _row_seq, {column} raw_{column}, {expression} {column} from raw_{table}"


_SEED = ", ".join(f"({i}, '{text}')" for i, text in TRANSACTION_TYPES)

_TEXT: dict[str, str] = {
    "scan_transacoes": "select * from bank_transacoes",
    "bronze_audit": f"select *, {_AUDIT} from bank_transacoes",
    "batch_ids": "select distinct batch_id from batch_manifest where table_name = 'clientes'",
    "complete_batches": "select batch_id, ingestion_ts from complete",
    "latest_complete_batch": """
        select batch_id, ingestion_ts from complete where committed order by ingestion_ts desc limit 1""",
    "latest_silver_batch": """
        select batch_id, committed_at from complete where committed order by committed_at desc limit 1""",
    "seed_insert_if_absent": f"""
        select tipo_transacao_id, descricao from bank_tipos_transacao where tipo_transacao_id % 2 = 1
        union all
        select id, text from (values {_SEED}) s(id, text)
        where id not in (select tipo_transacao_id from bank_tipos_transacao where tipo_transacao_id % 2 = 1)""",
    "next_id": "select cast(coalesce(max(cliente_id), 0) + 1 as bigint) next_id from bank_clientes",
    "append_with_ids": """
        select * from bank_clientes where cliente_id % 3 <> 0
        union all
        select (select max(cliente_id) from bank_clientes where cliente_id % 3 <> 0)
               + row_number() over (order by cliente_id), nome, cpf, data_nascimento
        from bank_clientes where cliente_id % 3 = 0""",
    "append_new_natural_keys": f"""
        select cliente_id, nome, cpf from bank_clientes where cliente_id % 3 = 0
        union all
        select _row_seq, nome, cpf
        from (select _row_seq, {_tidy('nome')} nome, {_digits('cpf', 11)} cpf from raw_clientes) r
        where cpf is not null and cpf not in (select cpf from bank_clientes where cliente_id % 3 = 0)
        qualify row_number() over (partition by cpf order by _row_seq) = 1""",
    "clean_text": f"""
        select _row_seq, nome_agencia raw_nome_agencia, {_tidy('nome_agencia')} nome_agencia, {_tidy('cidade')} cidade
        from raw_agencias""",
    "normalize_cpf": _scalar("clientes", "cpf", _digits("cpf", 11)),
    "normalize_card": _scalar("cartoes", "numero_cartao", _digits("numero_cartao", 16)),
    "mask_card": _scalar(
        "cartoes", "numero_cartao", f"'**** **** **** ' || right({_digits('numero_cartao', 16)}, 4)"
    ),
    "normalize_money": _scalar("contas", "saldo", _money("saldo")),
    "normalize_date": _scalar("emprestimos", "data_contrato", _date("data_contrato")),
    "normalize_timestamp": "select transacao_id, raw_data_hora, data_hora from utc_transacoes",
    "dst_invalid_timestamps": "select transacao_id, raw_data_hora from utc_transacoes where data_hora is null",
    "split_null_pk": """
        select case when cliente_id is null then 'invalid' else 'valid' end part, cliente_id, _row_seq
        from raw_clientes""",
    "dedupe_latest": "select * exclude (rn) from latest_emprestimos where emprestimo_id is not null and rn = 1",
    "dedupe_rejects": """
        select 'clientes' table_name, cliente_id id, _row_seq from complete_clientes
        where cliente_id is null or rn > 1
        union all
        select 'emprestimos', emprestimo_id, _row_seq from latest_emprestimos where rn > 1""",
    "duplicated_cpf": """
        select cliente_id, cpf from complete_clientes where early is null
        qualify count(*) over (partition by cpf) > 1""",
    "fk_contas_cliente": _fk("contas", "cliente_id", "clientes", "cliente_id"),
    "fk_contas_agencia": _fk("contas", "agencia_id", "agencias", "agencia_id"),
    "fk_cartoes_conta": _fk("cartoes", "conta_id", "contas", "conta_id"),
    "fk_emprestimos_cliente": _fk_to_trusted("emprestimos", "cliente_id", "clientes", "cliente_id"),
    "fk_transacoes_origem": _fk_to_trusted("transacoes", "conta_origem_id", "contas", "conta_id"),
    "fk_transacoes_destino": _fk_to_trusted("transacoes", "conta_destino_id", "contas", "conta_id"),
    "fk_transacoes_tipo": _fk("transacoes", "tipo_transacao_id", "tipos_transacao", "tipo_transacao_id"),
    "join_many_to_one": """
        select transacao_id, conta_origem_id, valor, cliente_id, agencia_id
        from bank_transacoes, bank_contas where conta_origem_id = conta_id""",
    "join_hot_account": """
        select transacao_id, conta_id conta_origem_id, cliente_id, valor
        from bank_transacoes, bank_contas where case when transacao_id % 3 = 0 then 1 else conta_origem_id end = conta_id""",
    "surrogate_key_text": "select cpf, cliente_id, row_number() over (order by cpf) cliente_sk from bank_clientes",
    "surrogate_key_sparse": """
        select chave, cliente_id, row_number() over (order by chave) cliente_sk
        from (select cast(cliente_id * 7919 % 99991 as bigint) * 90000000000000 + cliente_id chave, cliente_id from bank_clientes)""",
    "reject_summary": " union all ".join(
        f"select '{t}' entity, reason _reject_reason, count(*) n from tagged_{t} where reason is not null group by reason"
        for t in TABLES
    ),
    "daily_transaction_volume": f"""
        select cast(data_hora as date) as data, count(transacao_id) quantidade_transacoes,
               {_total('valor')} volume_financeiro
        from bank_transacoes group by all order by data""",
    "daily_pix_transaction_volume": f"""
        select cast(data_hora as date) as data, count(transacao_id) quantidade_transacoes_pix,
               {_total('valor')} volume_financeiro_pix
        from bank_transacoes
        where tipo_transacao_id in (select tipo_transacao_id from bank_tipos_transacao where upper(descricao) = 'PIX')
        group by all order by data""",
    "financial_volume_by_agency": f"""
        select agencia_id, count(transacao_id) quantidade_transacoes, {_total('valor')} volume_financeiro
        from bank_transacoes, bank_contas where conta_origem_id = conta_id
        group by agencia_id order by volume_financeiro desc, agencia_id""",
    "transactions_per_customer": """
        select cliente_id, count(transacao_id) quantidade_transacoes
        from bank_transacoes, bank_contas where conta_origem_id = conta_id
        group by cliente_id order by quantidade_transacoes desc, cliente_id""",
    "average_balance_by_agency": f"""
        select agencia_id, count(conta_id) quantidade_contas, {_mean('saldo')} saldo_medio
        from bank_contas group by agencia_id order by saldo_medio desc, agencia_id""",
    "customers_with_loans": f"""
        select c.cliente_id, c.nome, count(emprestimo_id) quantidade_emprestimos,
               {_total('valor_contratado')} valor_total_emprestimos, {_mean('parcelas')} parcelas_media
        from bank_emprestimos e, bank_clientes c where e.cliente_id = c.cliente_id
        group by c.cliente_id, c.nome order by valor_total_emprestimos desc, c.cliente_id""",
    "loan_volume": f"""
        select count(*) quantidade_emprestimos, coalesce({_total('valor_contratado')}, 0) volume_total_emprestimos,
               {_mean('valor_contratado')} valor_medio_emprestimo, {_mean('parcelas')} parcelas_media
        from bank_emprestimos""",
    "dim_cliente": "select * from dim_cliente",
    "dim_cliente_buckets": "select * from dim_cliente",
    "dim_conta": "select * from dim_conta",
    "dim_tipo_transacao": "select * from dim_tipo_transacao",
    "dim_data": "select * from dim_data",
    "distinct_dates": "select * from distinct_dates",
    "fato_transacao": "select * from fato_transacao",
    "fato_transacao_buckets": "select * from fato_transacao",
    "fato_emprestimo": "select * from fato_emprestimo",
    "report_01_total_volume": f"select {_total('valor')} valor_total_movimentado from fato_transacao",
    "report_02_operation_count": "select count(*) quantidade_operacoes from fato_transacao",
    "report_03_by_type": f"""
        select tipo_transacao_id, descricao tipo_transacao, count(*) quantidade_operacoes,
               {_total('valor')} valor_total_movimentado
        from fato_transacao join dim_tipo_transacao using (tipo_transacao_sk)
        group by all order by valor_total_movimentado desc, tipo_transacao_id""",
    "report_04_monthly_transactions": _monthly(
        "fato_transacao", "valor", "quantidade_operacoes", "valor_total_movimentado"
    ),
    "report_05_loan_overview": f"""
        select count(*) quantidade_emprestimos, {_total('valor_contratado')} valor_total_contratado,
               {_mean('valor_contratado')} valor_medio_contratado, {_mean('parcelas')} media_parcelas
        from fato_emprestimo""",
    "report_06_loans_by_year": f"""
        select ano, count(*) quantidade_emprestimos, {_total('valor_contratado')} valor_total_contratado,
               {_mean('valor_contratado')} valor_medio_contratado
        from fato_emprestimo join dim_data using (data_sk) group by ano order by ano""",
    "report_07_loans_by_installments": f"""
        select parcelas, count(*) quantidade_emprestimos, {_total('valor_contratado')} valor_total_contratado,
               {_mean('valor_contratado')} valor_medio_contratado
        from fato_emprestimo group by parcelas order by parcelas""",
    "report_08_top10_customers": f"""
        select cliente_id, count(emprestimo_id) quantidade_emprestimos,
               {_total('valor_contratado')} valor_total_contratado
        from fato_emprestimo join dim_cliente using (cliente_sk)
        group by cliente_id order by valor_total_contratado desc, cliente_id limit 10""",
    "report_09_monthly_loans": _monthly(
        "fato_emprestimo", "valor_contratado", "quantidade_emprestimos", "valor_total_contratado"
    ),
    "report_10_avg_installment": f"select {_mean('valor_medio_parcela')} valor_medio_parcela from fato_emprestimo",
    "contract_not_null": _not_null(),
    "contract_unique": _unique(),
    "contract_relationships": _relationships(),
    "cpf_uniqueness": _both("clientes", "count(*) total, count(distinct cpf) distinct_values"),
    "key_uniqueness": " union all ".join(
        _both(t, f"count(*) total, count(distinct {CONTRACTS[t].key}) distinct_values") for t in TABLES
    ),
    "row_counts": " union all ".join(f"select '{t}' table_name, count(*) as rows from bank_{t}" for t in TABLES),
    "same_account_count": _both(
        "transacoes", "count(*) filter (where conta_origem_id = conta_destino_id) violations"
    ),
    "non_positive_installments": _both("emprestimos", "count(*) filter (where parcelas <= 0) violations"),
}
for _table in TABLES:
    _TEXT[f"stg_{_table}"] = _staged(_table)
    _TEXT[f"silver_{_table}"] = f"select * from silver_{_table}"
    _TEXT[f"rejects_{_table}"] = (
        f"select {CONTRACTS[_table].key}, reason _reject_reason from tagged_{_table} where reason is not null"
    )
for _table in ("contas", "cartoes", "emprestimos", "transacoes"):
    _TEXT[f"orphans_{_table}"] = _orphans(_table)


def oracle_sql() -> dict[str, str]:
    return {name: _with_blocks(text) for name, text in _TEXT.items()}
