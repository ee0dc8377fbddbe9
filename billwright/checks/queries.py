"""One query per operator of the report, each over the whole tables of a star schema folder."""

from __future__ import annotations

import datetime
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from billwright import sinks
from billwright.functions import lines as L
from billwright.functions import text as X
from billwright.operators import calendar as C
from billwright.operators import lookups
from billwright.operators.position import with_position
from billwright.operators.skew import Spread, with_row_id
from billwright.operators.storage import new_folder
from billwright.plans import message as M
from billwright.plans import report as P
from billwright.plans.inputs import Inputs
from billwright.plans.ledger import CHANGE, DailyLedger
from billwright.plans.refresh import refresh_view, store_view, stored_view
from billwright.plans.view import ViewSteps, invoice_view
from billwright.rules import Rules
from billwright.schemas import BASE_TABLES, REPORT_COLUMNS
from billwright.sources import landing
from billwright.sources.setaside import conform_or_set_aside
from billwright.sources.star import star_tables
from billwright.sources.tables import InvoiceTables

# The last day in the data, and the start of the window its report covers.
AS_OF = datetime.date(2001, 8, 1)
SINCE = datetime.date(2001, 7, 1)
RECIPIENTS = "a@x;;b@y; c@z"
ROWS_PER_PART = 250

SOURCE_QUERY = """select numero, dt_emissao, razao_social, cfop
from tnota_fiscal where cod_empresa = 1 and saida = 'X'"""

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def _on_tables(function: Callable[[InvoiceTables], DataFrame]) -> Callable:
    """Register a query on the base tables under the function's name."""
    QUERIES[function.__name__] = lambda spark, folder: function(star_tables(spark, folder))
    return function


def _scan(name: str) -> Query:
    return lambda spark, folder: star_tables(spark, folder)[name]


# Sources.

QUERIES["s1_source_query"] = lambda spark, folder: star_tables(spark, folder).query(
    spark, SOURCE_QUERY
)
QUERIES |= {f"s2_scan_{name}": _scan(name) for name in BASE_TABLES}


@_on_tables
def s3_invoice_view(tables: InvoiceTables) -> DataFrame:
    return invoice_view(tables)


# Projections.


@_on_tables
def p1_doc_type(tables: InvoiceTables) -> DataFrame:
    return tables["tnota_fiscal"].select(
        "numero", "nfse", L.document_type(F.col("nfse")).alias("tipo")
    )


@_on_tables
def p2_issue_date(tables: InvoiceTables) -> DataFrame:
    return tables["tnota_fiscal"].select("numero", F.to_date("dt_emissao").alias("data_emissao"))


def _with_notes(tables: InvoiceTables) -> DataFrame:
    """Headers with their return note, as the view joins them."""
    return ViewSteps(Inputs(tables)).with_lookups().result()


@_on_tables
def p3_status(tables: InvoiceTables) -> DataFrame:
    status = L.status(
        F.col("cancelada"), F.col("returned_nf").isNotNull(), F.col("return_number"),
        F.col("nfse"), F.col("nfe_desc_status"),
    )
    return _with_notes(tables).select("nf", status.alias("status"))


@_on_tables
def p4_rename(tables: InvoiceTables) -> DataFrame:
    return tables["tnota_fiscal"].select(
        F.col("numero").alias("nf"), "cancelada", "cfop",
        F.col("natureza_op").alias("natureza_operacao"), "entrada", "saida",
        F.col("razao_social").alias("cliente"),
    )


@_on_tables
def p5_product_default(tables: InvoiceTables) -> DataFrame:
    return tables["tnota_fiscal_item"].select(
        "numero_nf", "codigo", L.product_name(F.col("produto")).alias("produto")
    )


@_on_tables
def p6_qty_unit(tables: InvoiceTables) -> DataFrame:
    return invoice_view(tables).select("nf", "cod_interno", "qtd", "un")


@_on_tables
def p7_line_value(tables: InvoiceTables) -> DataFrame:
    return invoice_view(tables).select("nf", "cod_interno", "valor")


@_on_tables
def p8_service_order(tables: InvoiceTables) -> DataFrame:
    return invoice_view(tables).select("nf", "cod_interno", "os")


@_on_tables
def p9_return_label(tables: InvoiceTables) -> DataFrame:
    return lookups.return_notes(Inputs(tables).returns()).select(
        "returned_nf", L.return_label(F.col("return_number")).alias("label")
    )


@_on_tables
def p10_report_columns(tables: InvoiceTables) -> DataFrame:
    return invoice_view(tables).select(*REPORT_COLUMNS)


# Filters.


@_on_tables
def f1_company(tables: InvoiceTables) -> DataFrame:
    counts = [
        tables.of_company(name, 1).agg(F.lit(name).alias("table_name"), F.count("*").alias("kept"))
        for name in BASE_TABLES
    ]
    united = counts[0]
    for count in counts[1:]:
        united = united.unionByName(count)
    return united


@_on_tables
def f2_payment_terms(tables: InvoiceTables) -> DataFrame:
    kept = tables["tnota_fiscal"].where(L.has_text(F.col("condicao_pagamento")))
    return kept.select("numero", "condicao_pagamento")


@_on_tables
def f3_conjunction(tables: InvoiceTables) -> DataFrame:
    headers = tables["tnota_fiscal"].where(F.col("cli_for") == 0)
    quotes = tables["torcamento"].where(L.is_won(F.col("estagio_orc"), F.col("status")))
    billing = tables["tordem_fat"].where(F.col("status") == 1)

    def keys(df: DataFrame, name: str, key: str) -> DataFrame:
        return df.select(F.lit(name).alias("table_name"), F.col(key).alias("key"))

    return (
        keys(headers, "tnota_fiscal", "numero")
        .unionByName(keys(quotes, "torcamento", "codigo"))
        .unionByName(keys(billing, "tordem_fat", "codigo"))
    )


@_on_tables
def f4_not_like(tables: InvoiceTables) -> DataFrame:
    return Inputs(tables).kept_orders().select("n_os", "guid_orcamento")


@_on_tables
def f5_null_or_blank(tables: InvoiceTables) -> DataFrame:
    blank = L.is_blank(F.col("nfe_desc_status")).alias("em_branco")
    return tables["tnota_fiscal"].select("numero", "nfe_desc_status", blank)


@_on_tables
def f6_outgoing(tables: InvoiceTables) -> DataFrame:
    return tables["tnota_fiscal"].where(L.is_outgoing(F.col("saida"))).select("numero", "saida")


@_on_tables
def f7_cfop_isin(tables: InvoiceTables) -> DataFrame:
    return tables["tnota_fiscal"].where(L.is_project_sale(F.col("cfop"))).select("numero", "cfop")


@_on_tables
def f8_date_from(tables: InvoiceTables) -> DataFrame:
    day = F.to_date("dt_emissao")
    return tables["tnota_fiscal"].where(day >= F.lit(SINCE)).select(
        "numero", day.alias("data_emissao")
    )


@_on_tables
def f9_authorised(tables: InvoiceTables) -> DataFrame:
    view = invoice_view(tables)
    return view.where(L.is_authorised(F.col("status"))).select("nf", "status", "valor")


# Joins and lookups.


@_on_tables
def j1_header_items(tables: InvoiceTables) -> DataFrame:
    return ViewSteps(Inputs(tables)).with_goods().result().select(
        "nf", "codigo", "guid_orcamento", "goods_qty", "goods_total"
    )


@_on_tables
def j2_services(tables: InvoiceTables) -> DataFrame:
    return ViewSteps(Inputs(tables)).with_services().result().select(
        "nf", "codigo", "goods_total", "service_unit", "service_total"
    )


@_on_tables
def j3_quote_lines(tables: InvoiceTables) -> DataFrame:
    steps = ViewSteps(Inputs(tables))
    return (
        steps.goods_over_guids()
        .left_join(
            steps.quote_lines(), "guid_linha", steps.hot["quote_lines.guid"], ["quote_line_row"]
        )
        .result()
        .select("goods_nf", "codigo", "guid_orcamento", "cod_orcamento")
    )


@_on_tables
def j4_quotes(tables: InvoiceTables) -> DataFrame:
    return ViewSteps(Inputs(tables)).quotes().select("guid_linha", "cod_orcamento", "won_quote")


@_on_tables
def j5_service_orders(tables: InvoiceTables) -> DataFrame:
    steps = ViewSteps(Inputs(tables))
    return (
        steps.join_orders(steps.goods_over_guids())
        .result()
        .select("goods_nf", "codigo", "guid_orcamento", "n_os")
    )


@_on_tables
def j6_is_returned(tables: InvoiceTables) -> DataFrame:
    return _with_notes(tables).select(
        "nf", F.col("returned_nf").isNotNull().alias("devolvida")
    )


@_on_tables
def j7_return_note(tables: InvoiceTables) -> DataFrame:
    return _with_notes(tables).select("nf", "return_number")


@_on_tables
def j8_os_by_product(tables: InvoiceTables) -> DataFrame:
    steps = ViewSteps(Inputs(tables))
    hot = steps.inputs.hot_keys("goods.product")["goods.product"]
    goods = with_row_id(steps.inputs.goods().select("numero_nf", "codigo"), "row")
    spread = Spread.over(goods, "codigo", hot, ["row"], nullable=True)
    return steps.join_product_orders(spread).result().select("numero_nf", "codigo", "product_order")


@_on_tables
def j9_billing_order(tables: InvoiceTables) -> DataFrame:
    return ViewSteps(Inputs(tables)).with_lookups().result().select("nf", "of")


# Aggregates and order.


@_on_tables
def a1_month_total(tables: InvoiceTables) -> DataFrame:
    return monthly_totals(P.report_inputs(tables))


def monthly_totals(inputs: Inputs) -> DataFrame:
    month = C.month_of(F.col("data_emissao")).alias("mes")
    return P.daily_totals(inputs).groupBy(month).agg(
        F.sum("total").cast(P.TOTAL_VALUE).alias("total")
    )


@_on_tables
def a2_distinct_returned(tables: InvoiceTables) -> DataFrame:
    return lookups.returned_invoices(Inputs(tables).returns())


@_on_tables
def a3_top1_per_key(tables: InvoiceTables) -> DataFrame:
    inputs = Inputs(tables)

    def named(df: DataFrame, name: str) -> DataFrame:
        key, value = df.columns
        return df.select(
            F.lit(name).alias("lookup"), F.col(key).alias("key"),
            F.col(value).cast("string").alias("value"),
        )

    return (
        named(lookups.return_notes(inputs.returns()), "return_note")
        .unionByName(named(lookups.product_orders(inputs.orders_by_product()), "product_order"))
        .unionByName(named(lookups.billing_orders(inputs.billing_orders()), "billing_order"))
    )


@_on_tables
def o1_sorted_report(tables: InvoiceTables) -> DataFrame:
    return P.sorted_report(P.report_rows(P.report_inputs(tables)))


@_on_tables
def o2_row_index(tables: InvoiceTables) -> DataFrame:
    dated = tables["tnota_fiscal"].select("numero", F.to_date("dt_emissao").alias("data_emissao"))
    return with_position(dated, [F.desc("data_emissao"), F.desc("numero")])


# Texts.


@_on_tables
def c1_parse_date(tables: InvoiceTables) -> DataFrame:
    text = F.date_format("dt_emissao", "yyyy-MM-dd HH:mm:ss")
    return tables["tnota_fiscal"].select("numero", X.parse_timestamp(text).alias("emissao"))


@_on_tables
def c2_date_text(tables: InvoiceTables) -> DataFrame:
    return tables["tnota_fiscal"].select(
        "numero", X.date_text(F.to_date("dt_emissao")).alias("data_texto")
    )


@_on_tables
def c3_total_text(tables: InvoiceTables) -> DataFrame:
    totals = monthly_totals(P.report_inputs(tables))
    return totals.select("mes", X.total_text(F.col("total")).alias("total_texto"))


@_on_tables
def c4_brl_text(tables: InvoiceTables) -> DataFrame:
    value = L.goods_value(F.col("vl_total"), F.col("vl_ipi"))
    signed = F.when(F.col("codigo") % 2 == 0, -value).otherwise(value)
    return tables["tnota_fiscal_item"].select(
        "numero_nf", "codigo", X.brl_text(signed).alias("valor_texto")
    )


@_on_tables
def c5_cell_style(tables: InvoiceTables) -> DataFrame:
    return invoice_view(tables).select(
        "nf", "status", X.cell_style(F.col("status")).alias("estilo")
    )


@_on_tables
def c6_blank_nulls(tables: InvoiceTables) -> DataFrame:
    as_shown = F.concat_ws(" ", F.lit("Fernando"), F.coalesce("produto", F.lit("None")))
    return tables["tnota_fiscal_item"].select(
        "numero_nf", "codigo", X.blank_if_null(F.col("produto")).alias("limpo"),
        X.drop_empty_tokens(as_shown).alias("literal"),
    )


def _days(tables: InvoiceTables) -> DataFrame:
    """Every day from the first to the last issue date."""
    return C.day_spine(
        tables["tnota_fiscal"].select(F.to_date("dt_emissao").alias("issued")), "issued"
    )


@_on_tables
def c7_subject(tables: InvoiceTables) -> DataFrame:
    return _days(tables).select("as_of", X.subject(F.col("as_of")).alias("subject"))


def _backfill(tables: InvoiceTables) -> DataFrame:
    days = _days(tables)
    return P.backfill_totals(P.daily_totals(P.report_inputs(tables)), days, C.holidays_around(days))


def _daily_bodies(tables: InvoiceTables) -> DataFrame:
    """For every issue date the body with that day's rows, in segments."""
    positioned = P.sorted_report(P.report_rows(P.report_inputs(tables)))
    authorised = F.when(L.is_authorised(F.col("status")), F.col("valor"))
    totals = positioned.groupBy(F.col("data_emissao").alias("as_of")).agg(
        F.min("idx").alias("first"), F.coalesce(F.sum(authorised), F.lit(0)).cast(P.TOTAL_VALUE).alias("total")
    )
    # One row per day of the calendar: small enough for a broadcast, however many rows the days have.
    firsts = F.broadcast(totals.select("as_of", "first"))
    rows = positioned.join(firsts, F.col("data_emissao") == F.col("as_of"))
    rows = rows.withColumn("idx", F.col("idx") - F.col("first"))
    return M.parts_of_rows(rows, totals.select("as_of", "total"), ROWS_PER_PART, by="as_of")


@_on_tables
def c8_body(tables: InvoiceTables) -> DataFrame:
    return _daily_bodies(tables)


@_on_tables
def c9_recipients(tables: InvoiceTables) -> DataFrame:
    listed = F.concat(F.col("razao_social"), F.lit("@x; ;"), F.col("cfop"), F.lit("@y;"))
    return tables["tnota_fiscal"].select(
        "numero", F.explode(X.recipients(listed)).alias("address")
    )


# Calendar.


@_on_tables
def b1_holidays(tables: InvoiceTables) -> DataFrame:
    return C.holidays_around(_days(tables))


@_on_tables
def b1_holidays_optional(tables: InvoiceTables) -> DataFrame:
    return C.holidays_around(_days(tables), optional=True)


def _first_business_days(tables: InvoiceTables, mode: str, optional: bool = False) -> DataFrame:
    days = _days(tables)
    months = days.select(C.month_of(F.col("as_of")).alias("month")).distinct()
    return C.first_business_days(months, C.holidays_around(days, optional=optional), mode)


@_on_tables
def b2_first_bd_optional(tables: InvoiceTables) -> DataFrame:
    return _first_business_days(tables, C.STRICT, optional=True)


@_on_tables
def b2_first_bd_compat(tables: InvoiceTables) -> DataFrame:
    return _first_business_days(tables, C.COMPAT)


@_on_tables
def b2_first_bd_strict(tables: InvoiceTables) -> DataFrame:
    return _first_business_days(tables, C.STRICT)


@_on_tables
def b3_is_first_bd(tables: InvoiceTables) -> DataFrame:
    days = _days(tables)
    return C.is_first_business_day(days, C.holidays_around(days))


@_on_tables
def b4_window_start(tables: InvoiceTables) -> DataFrame:
    days = _days(tables)
    return C.window_starts(days, C.holidays_around(days)).select("as_of", "window_start")


@_on_tables
def b5_backfill_totals(tables: InvoiceTables) -> DataFrame:
    return _backfill(tables)


# Reports and messages.


@_on_tables
def s4_html_rows(tables: InvoiceTables) -> DataFrame:
    return M.html_rows(P.formatted_report(P.sorted_report(P.report_rows(P.report_inputs(tables)))))


@_on_tables
def s5_outbox(tables: InvoiceTables) -> DataFrame:
    return M.outbox(_daily_bodies(tables), RECIPIENTS, X.subject(F.col("as_of")))


def _month(spark: SparkSession, folder: str) -> Inputs:
    return P.report_inputs(star_tables(spark, folder), since=C.window_start_on(spark, AS_OF))


def r1_monthly_detail(spark: SparkSession, folder: str) -> DataFrame:
    return P.monthly_detail(_month(spark, folder))


def r2_monthly_total(spark: SparkSession, folder: str) -> DataFrame:
    return P.monthly_total(_month(spark, folder))


def r3_message(spark: SparkSession, folder: str) -> DataFrame:
    return M.report_message(_month(spark, folder), AS_OF, RECIPIENTS, ROWS_PER_PART)


def f8_month_folders(spark: SparkSession, folder: str) -> DataFrame:
    """The month's total from tables that lie by month."""
    landed = landing.land_by_month(star_tables(spark, folder), spark, new_folder(spark, "months"))
    return P.monthly_total(P.report_inputs(landed, since=C.window_start_on(spark, AS_OF)))


def j1_bucketed_view(spark: SparkSession, folder: str) -> DataFrame:
    """The view from tables dealt by invoice number."""
    path = new_folder(spark, "buckets")
    prefix = f"billwright_{path.rsplit('-', 1)[1]}"
    return invoice_view(landing.land_in_buckets(star_tables(spark, folder), spark, prefix, 8, path))


@_on_tables
def j3_collated_view(tables: InvoiceTables) -> DataFrame:
    """The view with guids, stages and order prefixes compared by a collation."""
    return invoice_view(tables, Rules(collation="UTF8_LCASE_RTRIM"))


def _halves(tables: InvoiceTables) -> tuple[InvoiceTables, dict[str, DataFrame]]:
    """Half of the rows of every table as a beginning, and the other half as what comes later."""
    late = {
        name: tables[name].where(F.pmod(F.xxhash64(*tables[name].columns), F.lit(2)) == 1) for name in BASE_TABLES
    }
    early = InvoiceTables(
        lambda name: tables[name].where(F.pmod(F.xxhash64(*tables[name].columns), F.lit(2)) == 0)
    )
    return early, late


def s3_refreshed_view(spark: SparkSession, folder: str) -> DataFrame:
    """The stored view of half of all rows, brought up to date with the other half."""
    tables, path = star_tables(spark, folder), new_folder(spark, "view")
    early, late = _halves(tables)
    store_view(early, path)
    refresh_view(tables, late, path)
    return stored_view(spark, tables, path)


def b5_ledger_totals(spark: SparkSession, folder: str) -> DataFrame:
    """The totals of all days from a ledger of half of all rows and the changes since."""
    tables = star_tables(spark, folder)
    early, late = _halves(tables)
    ledger = DailyLedger(spark, new_folder(spark, "ledger"))
    ledger.start(early)
    # What came was cancelled at first, and corrected in a batch of its own.
    wrong = late["tnota_fiscal"].withColumn("cancelada", F.lit(1))
    ledger.add(late | {"tnota_fiscal": wrong})
    ledger.add({"tnota_fiscal": wrong.withColumn(CHANGE, F.lit(-1)).unionByName(
        late["tnota_fiscal"].withColumn(CHANGE, F.lit(1))
    )})
    days = _days(tables)
    return P.backfill_totals(ledger.daily_totals(), days, C.holidays_around(days))


def s5_outbox_again(spark: SparkSession, folder: str) -> DataFrame:
    """The outbox of all days, that of the last window written again, read back."""
    tables, path = star_tables(spark, folder), new_folder(spark, "outbox")
    # Not stored: both writes come from the numbered rows, which are, and texts this long are no columns for Parquet.
    messages = M.outbox(_daily_bodies(tables), RECIPIENTS, X.subject(F.col("as_of")))
    for sent in (messages, messages.where(F.col("as_of") >= F.lit(SINCE))):
        sinks.write_outboxes(sent, path, "as_of", compression="gzip")
    return sinks.read_outbox(spark, path).withColumnRenamed("day", "as_of")


@_on_tables
def c1_set_aside(tables: InvoiceTables) -> DataFrame:
    """Invoices whose date can't be read, beside the count of those that go on."""
    text = F.date_format("dt_emissao", "yyyy-MM-dd HH:mm:ss")
    spoilt = F.when(F.col("numero") % 10 == 3, F.lit("sem data")).otherwise(text)
    came = tables["tnota_fiscal"].withColumn("dt_emissao", spoilt)
    good, aside = conform_or_set_aside(came, BASE_TABLES["tnota_fiscal"])
    return aside.select("numero", "reason", good.agg(F.count(F.lit(1))).scalar().alias("went_on"))


QUERIES |= {
    "f8_month_folders": f8_month_folders,
    "j1_bucketed_view": j1_bucketed_view,
    "s3_refreshed_view": s3_refreshed_view,
    "b5_ledger_totals": b5_ledger_totals,
    "s5_outbox_again": s5_outbox_again,
    "r1_monthly_detail": r1_monthly_detail,
    "r2_monthly_total": r2_monthly_total,
    "r3_message": r3_message,
}
