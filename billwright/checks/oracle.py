"""The same queries as plain SQL, for an engine that has the star tables as views.

Written from the definitions, not from the DataFrame code: totals add up the
view's rows, the backfill sums every window on its own, and Easter comes from a
different formula.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from billwright.checks.queries import AS_OF, RECIPIENTS, ROWS_PER_PART, SINCE, SOURCE_QUERY
from billwright.plans.message import TABLE_CLOSING, TABLE_OPENING
from billwright.schemas import BASE_TABLES
from billwright.sources.star import STAR_COLUMNS, STATEMENTS


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


_STAR_NAMES = {name: name for name in STAR_COLUMNS}
_BASE = {name: sql.format(**_STAR_NAMES) for name, sql in STATEMENTS.items()}

_KEPT_ORDER = "cod_empresa=1 and lower(n_os) not like 'e%'"
_HEADERS = (
    "select * from tnota_fiscal where cod_empresa=1 and condicao_pagamento is not null"
    " and rtrim(condicao_pagamento)<>'' and cli_for=0"
)
_CFOPS = "'5101', '5102', '5124', '5933', '6101', '6102', '6118', '6123', '6124', '6933'"

_VIEW = f"""
select case when h.nfse=1 then 'NFSe' else 'NF' end as tipo, h.numero as nf,
 cast(h.dt_emissao as date) as data_emissao, h.cancelada as cancelada,
 case when h.cancelada=1 then 'Cancelada'
  when ret.k is not null then 'Devolvida pela NF ' || rpad(cast(ret.v as varchar), 30, ' ')
  when h.nfse=1 then 'Autorizada'
  when h.nfe_desc_status is null or rtrim(h.nfe_desc_status)='' then 'Aguardando Aprovação'
  else 'Autorizada' end as status,
 h.cfop as cfop, h.natureza_op as natureza_operacao, h.entrada as entrada, h.saida as saida,
 i.codigo as cod_interno, coalesce(o.n_os, byp.v) as os, h.razao_social as cliente,
 coalesce(i.produto, 'SERVIÇO') as produto, coalesce(i.qtde, s.qtde) as qtd,
 coalesce(i.unidade, s.unidade) as un,
 cast(coalesce(i.vl_total + i.vl_ipi, s.vl_total) as decimal(21,4)) as valor, bil.v as "of"
from headers h
left join (select * from tnota_fiscal_item where cod_empresa=1) i on i.numero_nf=h.numero
left join (select * from tnota_fiscal_servico where cod_empresa=1) s on h.numero=s.numero_nf
left join (select * from torcamento_itens where cod_empresa=1) ti on i.guid_orcamento=ti.guid_linha
left join (select * from torcamento where cod_empresa=1 and estagio_orc='GANHOU' and status=1) q
 on ti.cod_orcamento=q.codigo
left join kept_orders o on i.guid_orcamento=o.guid_orcamento
left join return_notes ret on ret.k=h.numero
left join product_orders byp on byp.k=i.codigo
left join billing_orders bil on bil.k=h.numero"""

_FIXED_DAYS = """
(1, 1, 'Confraternização Universal'), (4, 21, 'Tiradentes'), (5, 1, 'Dia do Trabalhador'),
(9, 7, 'Independência do Brasil'), (10, 12, 'Nossa Senhora Aparecida'), (11, 2, 'Finados'),
(11, 15, 'Proclamação da República'), (12, 25, 'Natal')"""


def _holidays(movable: str) -> str:
    """Holidays of the years of the data, all of them before any that began later."""
    return f"""
with y as (select distinct year(as_of) as y from days),
a as (select y, y%19 as g, y//100 as c from y),
b as (select y, g, c, (c - c//4 - (8*c+13)//25 + 19*g + 15)%30 as h from a),
d as (select y, g, c, h - (h//28)*(1 - (29//(h+1))*((21-g)//11)) as i from b),
e as (select y, i - (y + y//4 + i + 2 - c + c//4)%7 as l from d),
f as (select y, l, 3 + (l+40)//44 as m from e)
select make_date(y, fixed.m, fixed.d) as date, fixed.name as name, 'BR' as region
from y, (values {_FIXED_DAYS}) fixed(m, d, name)
union all
select make_date(y, m, l + 28 - 31*(m//4)) + after, name, 'BR' from f, (values {movable}) v(after, name)"""


_GOOD_FRIDAY = "(-2, 'Sexta-feira Santa')"
_OPTIONAL = (
    f"{_GOOD_FRIDAY}, (-48, 'Carnaval (segunda-feira)'), (-47, 'Carnaval'),"
    " (-46, 'Quarta-feira de Cinzas'), (60, 'Corpus Christi')"
)

_MONTH_DAYS = (
    "select month, cast(unnest(generate_series(cast(month as timestamp),"
    " cast(last_day(month) as timestamp), interval 1 day)) as date) as day from months"
)

_FIRST_STRICT = f"""
select month, min(day) as first_business_day from ({_MONTH_DAYS}) m
where isodow(day)<6 and day not in (select date from holidays) group by month"""

_FIRST_OPTIONAL = _FIRST_STRICT.replace("from holidays", "from optional_days")

_FIRST_COMPAT = f"""
with d as ({_MONTH_DAYS}),
w as (select month, min(day) as weekday from d where isodow(day)<6 group by month)
select d.month as month, min(d.day) as first_business_day
from d join w on d.month=w.month and d.day>=w.weekday
where d.day not in (select date from holidays) group by d.month"""

_WINDOWS = """
select as_of, coalesce(as_of = first_business_day, false) as is_first,
 cast(case when as_of = first_business_day then date_trunc('month', as_of) - interval 1 month
  else date_trunc('month', as_of) end as date) as window_start
from days left join first_days on date_trunc('month', as_of) = month"""

_BACKFILL = """
select w.as_of as as_of, w.window_start as window_start,
 cast(coalesce(sum(t.total), 0) as decimal(38,4)) as total
from windows w left join day_totals t on t.day between w.window_start and w.as_of
group by w.as_of, w.window_start"""

_ORDER = (
    "data_emissao desc nulls last, nf desc nulls last, produto nulls first, valor nulls first,"
    " tipo nulls first, status nulls first, os nulls first, cliente nulls first"
)
_REPORT = f"""
select cast(row_number() over (order by {_ORDER}) - 1 as bigint) as idx, tipo, nf, data_emissao,
 status, os, produto, cliente, valor
from invoice_view where saida='X' and cfop in ({_CFOPS})"""


def _total_text(amount: str) -> str:
    return f"'R$' || format('{{:,.2f}}', round_even({amount}, 2))"


def _brl_text(amount: str) -> str:
    digits = f"format('{{:,.2f}}', round_even(abs({amount}), 2))"
    return (
        f"case when {amount}<0 then '-' else '' end || 'R$' || chr(160) ||"
        f" translate({digits}, ',.', '.,')"
    )


def _style(text: str) -> str:
    return (
        f"case when {text}='Cancelada' then 'background-color: red'"
        f" when starts_with({text}, 'Devolvida') then 'background-color: yellow' else 'border: 1px solid black' end"
    )


def _cell(text: str) -> str:
    escaped = text
    for mark, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        escaped = f"replace({escaped}, '{mark}', '{entity}')"
    return f"""'<td style="' || {_style(text)} || '">' || coalesce({escaped}, '') || '</td>'"""


_TEXT_CELLS = (
    "tipo", "cast(nf as varchar)", "strftime(data_emissao, '%d/%m/%Y')", "status", "os",
    "produto", "cliente", f"({_brl_text('valor')})",
)
_ROW_HTML = (
    "'<tr><th>' || cast(idx as varchar) || '</th>' || "
    + " || ".join(_cell(text) for text in _TEXT_CELLS)
    + " || '</tr>'"
)

# Named parts that a query may build on; each may use those before it.
_PARTS: dict[str, str] = {
    **_BASE,
    "headers": _HEADERS,
    "kept_orders": f"select * from tos where {_KEPT_ORDER}",
    "return_notes": "select nfref_numero_nf as k, min(numero_nf) as v from tnota_fiscal_nfref"
    " where cod_empresa=1 group by 1",
    "product_orders": "select cod_pecas as k, min(n_os) as v from kept_orders"
    " where cod_pecas is not null group by 1",
    "billing_orders": "select numero_nf as k, min(codigo) as v from tordem_fat"
    " where cod_empresa=1 and status=1 group by 1",
    "invoice_view": _VIEW,
    "report": _REPORT,
    "day_totals": "select data_emissao as day, sum(coalesce(valor, 0)) as total from report"
    " where status='Autorizada' group by 1",
    "month_totals": "select cast(date_trunc('month', day) as date) as mes,"
    " cast(sum(total) as decimal(38,4)) as total from day_totals group by 1",
    "days": "select cast(unnest(generate_series(min(dt_emissao), max(dt_emissao),"
    " interval 1 day)) as date) as as_of from tnota_fiscal",
    "months": "select distinct cast(date_trunc('month', as_of) as date) as month from days",
    "holidays": _holidays(_GOOD_FRIDAY),
    "optional_days": _holidays(_OPTIONAL),
    "first_strict": _FIRST_STRICT,
    "first_optional": _FIRST_OPTIONAL,
    "first_days": _FIRST_COMPAT,
    "windows": _WINDOWS,
    "backfill": _BACKFILL,
    "html_rows": f"select idx, {_ROW_HTML} as row_html from report",
}


def _uses(sql: str, part: str) -> bool:
    return re.search(rf"\b{part}\b", sql) is not None


def _query(sql: str, given: Iterable[str] = ()) -> str:
    """Put the parts a query needs, directly or not, in front of it, but those given."""
    needed, text = [], sql
    for part, body in reversed(_PARTS.items()):
        if part not in given and _uses(text, part):
            needed.append(f"{part} as ({body})")
            text += body
    return f"with {', '.join(reversed(needed))}\n{sql}" if needed else sql


def _subject(day: str) -> str:
    return f"'Faturamento ' || day({day}) || '-' || month({day}) || '-' || year({day})"


_OPENING = "\n Bom dia,<br><br>\n O faturamento do mês está em <b>"
_LIST = "</b>.<br>\n Abaixo, a lista detalhada:<br>\n \n "
_CLOSING = """

 <br>OBS: Notas fiscais canceladas ou devolvidas <b>NÃO</b> contabilizam faturamento.<br>
 <br><br>Em caso de dúvidas ou sugestões, favor entrar em contato.<br>
 Este é um e-mail automático, mas sinta-se livre para respondê-lo.
 """


def _segment(total_text: str) -> str:
    """One of the segments that make a body when put together."""
    return (
        f"case when part = 0 then {_text(_OPENING)} || {total_text} ||"
        f" {_text(_LIST + TABLE_OPENING)} else '' end || coalesce(rows_html, '') ||"
        f" case when part = parts - 1 then {_text(TABLE_CLOSING + _CLOSING)} else '' end"
    )


_ADDRESSES = ", ".join(f"({_text(a.strip())})" for a in RECIPIENTS.split(";") if a.strip())
_TO = f"(values {_ADDRESSES}) recipients(address)"
_DAILY_BODIES = f"""
with day_rows as (
 select row_number() over (partition by data_emissao order by idx) - 1 as idx, * exclude (idx) from report),
html as (select data_emissao as as_of, idx // {ROWS_PER_PART} as part, idx, {_ROW_HTML} as row_html from day_rows),
totals as (
 select data_emissao as as_of, cast(greatest(1, ceil(count(*) / {ROWS_PER_PART})) as integer) as parts,
  cast(coalesce(sum(case when status='Autorizada' then valor end), 0) as decimal(38,4)) as total
 from day_rows group by 1),
tables as (select as_of, part, parts, total, string_agg(row_html, '' order by idx) as rows_html
 from html join totals using (as_of) group by all)
select as_of, cast(part as integer) as part, parts, {_segment(_total_text("total"))} as html_body from tables"""
_SINCE = f"date '{SINCE}'"
_MONTH_SUM = (
    "select cast(coalesce(sum(case when status='Autorizada' then valor end), 0) as decimal(38,4))"
    f" as total from report where data_emissao >= {_SINCE}"
)
_MONTH_HTML = f"""
select * from (with month_rows as (
 select row_number() over (order by idx) - 1 as idx, * exclude (idx)
 from report where data_emissao >= {_SINCE}),
html as (select idx, idx // {ROWS_PER_PART} as part, {_ROW_HTML} as row_html from month_rows),
total as ({_MONTH_SUM}),
numbers as (
 select cast(greatest(1, ceil(count(*) / {ROWS_PER_PART})) as integer) as parts from html),
parts as (select parts, unnest(generate_series(0, parts - 1)) as part from numbers),
tables as (select part, string_agg(row_html, '' order by idx) as rows_html from html group by part)
select address as "to", {_subject(f"date '{AS_OF}'")} as subject, cast(part as integer) as part,
 parts,
 {_segment(_total_text("total"))} as html_body
from parts left join tables using (part), total, {_TO}) message"""

_VALUE = "cast(vl_total + vl_ipi as decimal(21,4))"

_SQL: dict[str, str] = {
    "s1_source_query": SOURCE_QUERY,
    **{
        f"s2_scan_{name}": f"select {', '.join(schema.names)} from {name}"
        for name, schema in BASE_TABLES.items()
    },
    "s3_invoice_view": "select * from invoice_view",
    "p1_doc_type": "select numero, nfse, case when nfse=1 then 'NFSe' else 'NF' end as tipo"
    " from tnota_fiscal",
    "p2_issue_date": "select numero, cast(dt_emissao as date) as data_emissao from tnota_fiscal",
    "p3_status": "select numero as nf, case when cancelada=1 then 'Cancelada'"
    " when k is not null then 'Devolvida pela NF ' || rpad(cast(v as varchar), 30, ' ')"
    " when nfse=1 then 'Autorizada'"
    " when nfe_desc_status is null or rtrim(nfe_desc_status)='' then 'Aguardando Aprovação'"
    " else 'Autorizada' end as status from headers left join return_notes on k=numero",
    "p4_rename": "select numero as nf, cancelada, cfop, natureza_op as natureza_operacao,"
    " entrada, saida, razao_social as cliente from tnota_fiscal",
    "p5_product_default": "select numero_nf, codigo, coalesce(produto, 'SERVIÇO') as produto"
    " from tnota_fiscal_item",
    "p6_qty_unit": "select nf, cod_interno, qtd, un from invoice_view",
    "p7_line_value": "select nf, cod_interno, valor from invoice_view",
    "p8_service_order": "select nf, cod_interno, os from invoice_view",
    "p9_return_label": "select k as returned_nf,"
    " 'Devolvida pela NF ' || rpad(cast(v as varchar), 30, ' ') as label from return_notes",
    "p10_report_columns": "select tipo, nf, data_emissao, status, os, produto, cliente, valor"
    " from invoice_view",
    "f1_company": " union all ".join(
        f"select '{name}' as table_name, count(*) as kept from {name} where cod_empresa=1"
        for name in BASE_TABLES
    ),
    "f2_payment_terms": "select numero, condicao_pagamento from tnota_fiscal"
    " where condicao_pagamento is not null and rtrim(condicao_pagamento)<>''",
    "f3_conjunction": "select 'tnota_fiscal' as table_name, numero as key from tnota_fiscal"
    " where cli_for=0 union all select 'torcamento', codigo from torcamento"
    " where estagio_orc='GANHOU' and status=1 union all select 'tordem_fat', codigo"
    " from tordem_fat where status=1",
    "f4_not_like": f"select n_os, guid_orcamento from tos where {_KEPT_ORDER}",
    "f5_null_or_blank": "select numero, nfe_desc_status,"
    " (nfe_desc_status is null or rtrim(nfe_desc_status)='') as em_branco from tnota_fiscal",
    "f6_outgoing": "select numero, saida from tnota_fiscal where saida='X'",
    "f7_cfop_isin": f"select numero, cfop from tnota_fiscal where cfop in ({_CFOPS})",
    "f8_date_from": "select numero, cast(dt_emissao as date) as data_emissao from tnota_fiscal"
    f" where cast(dt_emissao as date) >= {_SINCE}",
    "f9_authorised": "select nf, status, valor from invoice_view where status='Autorizada'",
    "j1_header_items": "select h.numero as nf, codigo, guid_orcamento, qtde as goods_qty,"
    " vl_total as goods_total from (select * from tnota_fiscal_item where cod_empresa=1) i"
    " right join headers h on i.numero_nf=h.numero",
    "j2_services": "select h.numero as nf, codigo, i.vl_total as goods_total,"
    " s.unidade as service_unit, s.vl_total as service_total"
    " from (select * from tnota_fiscal_item where cod_empresa=1) i"
    " right join headers h on i.numero_nf=h.numero"
    " left join (select * from tnota_fiscal_servico where cod_empresa=1) s"
    " on h.numero=s.numero_nf",
    "j3_quote_lines": "select numero_nf as goods_nf, codigo, guid_orcamento, cod_orcamento"
    " from (select * from tnota_fiscal_item where cod_empresa=1) i"
    " left join (select * from torcamento_itens where cod_empresa=1) q"
    " on guid_orcamento=guid_linha",
    "j4_quotes": "select guid_linha, cod_orcamento, q.codigo as won_quote"
    " from (select * from torcamento_itens where cod_empresa=1) i left join"
    " (select * from torcamento where cod_empresa=1 and estagio_orc='GANHOU' and status=1) q"
    " on cod_orcamento=q.codigo",
    "j5_service_orders": "select numero_nf as goods_nf, codigo, i.guid_orcamento as guid_orcamento,"
    " n_os from (select * from tnota_fiscal_item where cod_empresa=1) i"
    " left join kept_orders o on i.guid_orcamento=o.guid_orcamento",
    "j6_is_returned": "select numero as nf, numero in (select distinct nfref_numero_nf"
    " from tnota_fiscal_nfref where cod_empresa=1) as devolvida from headers",
    "j7_return_note": "select numero as nf, v as return_number from headers"
    " left join return_notes on k=numero",
    "j8_os_by_product": "select numero_nf, codigo, v as product_order"
    " from (select * from tnota_fiscal_item where cod_empresa=1) i"
    " left join product_orders on k=codigo",
    "j9_billing_order": 'select numero as nf, v as "of" from headers'
    " left join billing_orders on k=numero",
    "a1_month_total": "select mes, total from month_totals",
    "a2_distinct_returned": "select distinct nfref_numero_nf from tnota_fiscal_nfref"
    " where cod_empresa=1",
    "a3_top1_per_key": "select 'return_note' as lookup, k as key, cast(v as varchar) as value"
    " from return_notes union all select 'product_order', k, v from product_orders"
    " union all select 'billing_order', k, cast(v as varchar) from billing_orders",
    "o1_sorted_report": "select * from report",
    "o2_row_index": "select cast(row_number() over (order by cast(dt_emissao as date) desc,"
    " numero desc) - 1 as bigint) as idx, numero, cast(dt_emissao as date) as data_emissao"
    " from tnota_fiscal",
    "c1_parse_date": "select numero, strptime(strftime(dt_emissao, '%Y-%m-%d %H:%M:%S'),"
    " '%Y-%m-%d %H:%M:%S') as emissao from tnota_fiscal",
    "c2_date_text": "select numero, strftime(dt_emissao, '%d/%m/%Y') as data_texto"
    " from tnota_fiscal",
    "c3_total_text": f"select mes, {_total_text('total')} as total_texto from month_totals",
    "c4_brl_text": f"select numero_nf, codigo, {_brl_text('value')} as valor_texto from (select"
    f" numero_nf, codigo, case when codigo%2=0 then -{_VALUE} else {_VALUE} end as value"
    " from tnota_fiscal_item) i",
    "c5_cell_style": f"select nf, status, {_style('status')} as estilo from invoice_view",
    "c6_blank_nulls": "select numero_nf, codigo, coalesce(produto, '') as limpo,"
    " replace(replace('Fernando ' || coalesce(produto, 'None'), 'None', ''), 'nan', '')"
    " as literal from tnota_fiscal_item",
    "c7_subject": f"select as_of, {_subject('as_of')} as subject from days",
    "c8_body": f"select * from ({_DAILY_BODIES}) bodies",
    "c9_recipients": "select numero, address from (select numero, trim(unnest(string_split("
    "razao_social || '@x; ;' || cfop || '@y;', ';'))) as address from tnota_fiscal) a"
    " where address<>''",
    "b1_holidays": "select date, name, region from holidays",
    "b1_holidays_optional": "select date, name, region from optional_days",
    "b2_first_bd_optional": "select month, first_business_day from first_optional",
    "b2_first_bd_compat": "select month, first_business_day from first_days",
    "b2_first_bd_strict": "select month, first_business_day from first_strict",
    "b3_is_first_bd": "select as_of, is_first from windows",
    "b4_window_start": "select as_of, window_start from windows",
    "b5_backfill_totals": "select as_of, window_start, total from backfill",
    "s4_html_rows": "select idx, row_html from html_rows",
    "s5_outbox": f'select address as "to", {_subject("as_of")} as subject, bodies.*'
    f" from ({_DAILY_BODIES}) bodies, {_TO}",
    "r1_monthly_detail": "select row_number() over (order by idx) - 1 as idx, tipo, nf,"
    " strftime(data_emissao, '%d/%m/%Y') as data_emissao, status, os, produto, cliente,"
    f" {_brl_text('valor')} as valor from report where data_emissao >= {_SINCE}",
    "r2_monthly_total": f"select total, {_total_text('total')} as total_text from ({_MONTH_SUM}) t",
    "r3_message": _MONTH_HTML,
}

# Other ways to the same results.
_SQL |= {
    "f8_month_folders": _SQL["r2_monthly_total"],
    "j1_bucketed_view": _SQL["s3_invoice_view"],
    "s3_refreshed_view": _SQL["s3_invoice_view"],
    "j3_collated_view": _SQL["s3_invoice_view"],
    "b5_ledger_totals": _SQL["b5_backfill_totals"],
    "s5_outbox_again": _SQL["s5_outbox"],
    "c1_set_aside": "select numero, 'dt_emissao: sem data' as reason,"
    " (select count(*) from tnota_fiscal where numero%10<>3) as went_on"
    " from tnota_fiscal where numero%10=3",
}

ORACLE_SQL: dict[str, str] = {name: _query(sql) for name, sql in _SQL.items()}


def over_base_tables(name: str) -> str:
    """A query for an engine that has the eight base tables themselves."""
    return _query(_SQL[name], given=_BASE)
