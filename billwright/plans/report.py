"""The invoicing report: its rows, its total, and the total for every day at once."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from billwright.functions import lines as L
from billwright.functions import text as X
from billwright.operators import calendar, lookups
from billwright.operators.position import with_position
from billwright.operators.skew import Spread, with_row_id
from billwright.operators.storage import stored
from billwright.plans import view as V
from billwright.plans.inputs import Inputs
from billwright.rules import Rules
from billwright.schemas import REPORT_COLUMNS, TOTAL_VALUE
from billwright.sources.tables import InvoiceTables


def in_report(
    rules: Rules, since: datetime.date | None = None, until: datetime.date | None = None
) -> Column:
    """Condition on the header: an outgoing project sale issued in the window.

    A report has a lower bound only; ``until`` is for reports on past dates.
    """
    reported = L.is_outgoing(F.col("saida")) & L.is_project_sale(F.col("cfop"), rules.cfops)
    day = F.to_date("dt_emissao")
    if since is not None:
        reported &= day >= F.lit(since)
    if until is not None:
        reported &= day <= F.lit(until)
    return reported


def report_inputs(
    tables: InvoiceTables,
    rules: Rules | None = None,
    since: datetime.date | None = None,
    until: datetime.date | None = None,
) -> Inputs:
    """What a report reads: the whole history, or a window that starts on a date.

    The tables have to be landed; a live database is refused.
    """
    tables.check_landed()
    rules = rules or Rules()
    return Inputs(
        tables, rules, in_report(rules, since, until), narrow=since is not None, issued=(since, until)
    )


def report_rows(inputs: Inputs) -> DataFrame:
    """The rows of the view that are in the report, in its eight columns."""
    return V.view_of(inputs).select(*REPORT_COLUMNS)


def report_order() -> list[Column]:
    """Latest first; the rest only settles in which order equal dates come."""
    return [
        F.desc_nulls_last("data_emissao"), F.desc_nulls_last("nf"),
        *[F.asc_nulls_first(name) for name in ("produto", "valor", "tipo", "status", "os", "cliente")],
    ]


def sorted_report(rows: DataFrame) -> DataFrame:
    """The report rows with their position, which is shown as row header."""
    return with_position(rows, report_order())


def formatted_report(positioned: DataFrame) -> DataFrame:
    """Date and value as text; the typed columns are left behind."""
    return positioned.withColumns({
        "data_emissao": X.date_text(F.col("data_emissao")),
        "valor": X.brl_text(F.col("valor")),
    })


def _goods_per_invoice(inputs: Inputs, hot: dict) -> DataFrame:
    """Per invoice: value of the goods rows of the view, and how many have no value.

    A goods line appears in the view once per quote row and service order of its
    guid, so it is counted that often instead of being repeated.
    """
    lines = inputs.goods().select(
        F.col("numero_nf").alias("goods_nf"), "guid_orcamento",
        L.goods_value(F.col("vl_total"), F.col("vl_ipi")).alias("value"),
    )
    if hot["goods.guid"]:
        lines = with_row_id(lines, "goods_row")
    # Lines without a guid are repeated by nothing; they stay where they are.
    single = lines.where(F.col("guid_orcamento").isNull()).withColumn("times", F.lit(1).cast("long"))
    joined = (
        Spread.over(lines.where(F.col("guid_orcamento").isNotNull()), "guid_orcamento", hot["goods.guid"], ["goods_row"])
        .left_join(_repeats_per_guid(inputs, hot), "guid")
        .result()
    )
    times = F.coalesce("times", F.lit(1))
    return joined.select("goods_nf", "value", "times").unionByName(
        single.select("goods_nf", "value", "times")
    ).groupBy("goods_nf").agg(
        F.sum((F.col("value") * times).cast(TOTAL_VALUE)).alias("goods_value"),
        F.sum(F.when(F.col("value").isNull(), times).otherwise(0)).alias("valueless_rows"),
    )


def _repeats_per_guid(inputs: Inputs, hot: dict) -> DataFrame:
    """``(guid, times)`` for the guids that repeat a goods line in the view.

    For the whole history they are stored, so that Spark sees their size when it
    plans the join: where they are few, the goods lines need no shuffle by guid.
    """
    quotes, orders = _quote_rows(inputs, hot), _order_rows(inputs)
    times = F.coalesce("quote_rows", F.lit(1)) * F.coalesce("order_rows", F.lit(1))
    repeats = quotes.join(orders, F.col("guid_linha") == F.col("order_guid"), "full").select(
        F.coalesce("guid_linha", "order_guid").alias("guid"), times.alias("times")
    )
    return repeats if inputs.narrow else stored(repeats)


def _quote_rows(inputs: Inputs, hot: dict) -> DataFrame:
    """Per guid with more than one: the rows its quote lines and won quotes make."""
    won = (
        inputs.won_quotes()
        .groupBy(F.col("codigo").alias("won_quote"))
        .agg(F.count("*").alias("won_rows"))
        .where(F.col("won_rows") > 1)
    )
    lines = (
        inputs.quote_lines()
        .where(F.col("guid_linha").isNotNull())
        .groupBy("guid_linha", "cod_orcamento")
        .agg(F.count("*").alias("line_rows"))
    )
    return (
        Spread.over(lines, "cod_orcamento", hot["quote_lines.quote"], ["guid_linha"], nullable=True)
        .left_join(won, "won_quote")
        .result()
        .groupBy("guid_linha")
        .agg(F.sum(F.col("line_rows") * F.coalesce("won_rows", F.lit(1))).alias("quote_rows"))
        .where(F.col("quote_rows") > 1)
    )


def _order_rows(inputs: Inputs) -> DataFrame:
    """Per guid with more than one: its service orders."""
    return (
        inputs.orders_by_guid()
        .where(F.col("guid_orcamento").isNotNull())
        .groupBy(F.col("guid_orcamento").alias("order_guid"))
        .agg(F.count("*").alias("order_rows"))
        .where(F.col("order_rows") > 1)
    )


def _services_per_invoice(inputs: Inputs) -> DataFrame:
    return (
        inputs.services()
        .groupBy(F.col("numero_nf").alias("service_nf"))
        .agg(F.count("*").alias("service_rows"), F.sum("vl_total").alias("service_value"))
    )


def daily_totals(inputs: Inputs) -> DataFrame:
    """``(data_emissao, total)``: authorised value of the reported invoices by issue date.

    The same sum as over the view's rows, but without making them: goods and
    service lines are added up per invoice first. A goods row counts once per
    service line; a row without goods value takes the service value instead.
    """
    hot = inputs.hot_keys("headers.nf", "goods.guid", "quote_lines.quote")
    headers = inputs.headers().where(
        L.may_be_authorised(F.col("cancelada"), F.col("nfse"), F.col("nfe_desc_status"))
    )
    headers = headers.select(
        F.col("numero").alias("nf"), F.to_date("dt_emissao").alias("data_emissao")
    )
    if hot["headers.nf"]:
        headers = with_row_id(headers, "header_row")
    invoices = (
        Spread.over(headers, "nf", hot["headers.nf"], ["header_row"])
        .left_join(lookups.returned_invoices(inputs.returns()), "nfref_numero_nf")
        .left_join(_goods_per_invoice(inputs, hot), "goods_nf")
        .left_join(_services_per_invoice(inputs), "service_nf")
        .result()
        .where(F.col("nfref_numero_nf").isNull())
    )
    return invoices.groupBy("data_emissao").agg(F.sum(invoice_total()).cast(TOTAL_VALUE).alias("total"))


def invoice_total() -> Column:
    """The value of an invoice's rows of the view, from the sums of its goods and service lines."""
    service_value = F.coalesce(F.col("service_value"), F.lit(0)).cast(TOTAL_VALUE)
    goods_value = (
        F.coalesce("goods_value", F.lit(0)) * F.coalesce("service_rows", F.lit(1))
    ).cast(TOTAL_VALUE)
    return F.when(F.col("goods_nf").isNull(), service_value).otherwise(
        goods_value + (service_value * F.col("valueless_rows")).cast(TOTAL_VALUE)
    )


def _total(amount: Column) -> Column:
    """The sum of no rows is 0."""
    return F.coalesce(amount, F.lit(0)).cast(TOTAL_VALUE)


def report_total(inputs: Inputs) -> DataFrame:
    """One row ``(total)``: the authorised value of the window."""
    return daily_totals(inputs).agg(_total(F.sum("total")).alias("total"))


def total_of_rows(rows: DataFrame) -> DataFrame:
    """One row ``(total)``: the authorised value of report rows already at hand."""
    authorised = F.when(L.is_authorised(F.col("status")), F.col("valor"))
    return rows.agg(_total(F.sum(authorised)).alias("total"))


def backfill_totals(
    daily: DataFrame,
    days: DataFrame,
    holiday_table: DataFrame,
    mode: str = calendar.COMPAT,
) -> DataFrame:
    """``(as_of, window_start, total)``: the total each day's report would have shown.

    ``daily`` are the daily totals, ``days(as_of)`` all days to report on. Each
    day's total runs up to that day; on the first business day the whole month
    before is added. Running sums are taken per month, over its days only.
    """
    month = calendar.month_of(F.col("data_emissao"))
    nothing = F.lit(None).cast(TOTAL_VALUE)
    # Each daily total counts on its day, and for the whole of the next month's first report.
    counts = F.array(
        F.struct(
            month.alias("month"), F.col("data_emissao").alias("day"),
            F.col("total").alias("amount"), nothing.alias("last_month"),
        ),
        F.struct(
            F.add_months(month, 1).alias("month"), F.lit(None).cast("date").alias("day"),
            nothing.alias("amount"), F.col("total").alias("last_month"),
        ),
    )
    asked = days.select(
        calendar.month_of(F.col("as_of")).alias("month"), F.col("as_of").alias("day"),
        nothing.alias("amount"), nothing.alias("last_month"), F.lit(True).alias("asked"),
    )
    rows = daily.select(F.inline(counts)).withColumn("asked", F.lit(False)).unionByName(asked)
    whole_month = Window.partitionBy("month")
    up_to_day = whole_month.orderBy("day").rangeBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    running = rows.select(
        F.col("day").alias("as_of"), "asked",
        F.sum("amount").over(up_to_day).alias("to_date"),
        F.sum("last_month").over(whole_month).alias("last_month"),
    ).where("asked")
    total = F.coalesce("to_date", F.lit(0)) + F.when(
        F.col("is_first"), F.coalesce("last_month", F.lit(0))
    ).otherwise(0)
    return (
        calendar.window_starts(days, holiday_table, mode)
        .join(running, "as_of")
        .select("as_of", "window_start", _total(total).alias("total"))
    )


def monthly_detail(inputs: Inputs) -> DataFrame:
    """The finished report: position and the eight columns, as text where people read them."""
    return formatted_report(sorted_report(report_rows(inputs)))


def monthly_total(inputs: Inputs) -> DataFrame:
    """One row ``(total, total_text)``."""
    return report_total(inputs).withColumn("total_text", X.total_text(F.col("total")))
