"""The view as stored files, kept up to date by what changed in the base tables.

A change to any of the eight tables is traced to the invoice numbers whose rows of the
view it can touch. Only those invoices are joined again, and only the months they lie in
are written anew.

Large tables are joined a span of invoice numbers at a time, and the months written a few
at a time, with the shuffle files of one step gone before the next: what lies on disk
besides the view and its new rows doesn't grow with the tables that hang on the number.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping
from functools import reduce
from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from billwright.functions import lines as L
from billwright.operators.storage import discard, new_folder, shuffles_removed, stored, stored_parts
from billwright.plans.inputs import Inputs
from billwright.plans.view import invoice_view, view_of
from billwright.rules import Rules
from billwright.schemas import BASE_TABLES
from billwright.sources.tables import MONTH, NUMBER_KEYS, InvoiceTables, conform

# Lines are cut to the changed invoices if at most one in so many invoices is one of them.
FEW = 4

# So many invoices are joined at a time, and so many rows of the view written at a time.
INVOICES_AT_A_TIME = 10_000_000
ROWS_AT_A_TIME = 40_000_000

# Quantiles of the invoice numbers that are looked up; there are no more spans than these.
MOST_SPANS = 256

Span = Callable[[Column], Column]


def _month() -> Column:
    return F.trunc("data_emissao", "month").alias(MONTH)


def _spans(numbers: Column, rows: DataFrame) -> list[Span]:
    """Conditions on the invoice number that part these rows by their ``numbers``; null is in the first.

    Numbers are the only thing on which the tables that are cut by them meet, so that the
    view is that of all spans. A number is never parted, however many rows it has.
    """
    steps = [step / MOST_SPANS for step in range(1, MOST_SPANS)]
    found = rows.agg(
        F.count(F.lit(1)).alias("rows"), F.percentile_approx(numbers, steps, 10 * MOST_SPANS).alias("steps")
    ).first()
    count = min(MOST_SPANS, ceil(found["rows"] / INVOICES_AT_A_TIME))
    cuts = sorted({found["steps"][MOST_SPANS * cut // count - 1] for cut in range(1, count)}) if found["steps"] else []

    def between(low: int | None, high: int | None) -> Span:
        if low is None:
            return lambda number: number.isNull() | (number < high)
        return lambda number: (number >= low) if high is None else (number >= low) & (number < high)

    return [between(low, high) for low, high in zip([None, *cuts], [*cuts, None])] if cuts else [lambda _: F.lit(True)]


def store_view(tables: InvoiceTables, folder: str, rules: Rules | None = None) -> None:
    """Write the whole view, a folder for each month of issue; what was there is replaced."""
    tables.check_landed()
    rules = rules or Rules()
    spark = tables["tnota_fiscal"].sparkSession
    with shuffles_removed(spark):
        spans = _spans(F.col("numero"), tables.of_company("tnota_fiscal", rules.company))
        views = (
            view_of(Inputs(tables.of_numbers(span), rules), goods_first=True).select("*", _month()) for span in spans
        )
        if len(spans) == 1:
            _by_month(next(views)).option("partitionOverwriteMode", "static").parquet(folder)
            return
        aside = new_folder(spark, "stored")
        rows = stored_parts(views, aside)
        sizes = {row[MONTH]: row["count"] for row in rows.groupBy(MONTH).count().collect()}  # one row for each month
        for place, months in enumerate(_at_a_time(sizes) or [[]]):
            mode = "dynamic" if place else "static"
            _by_month(rows.where(_in(months))).option("partitionOverwriteMode", mode).parquet(folder)
        discard(spark, aside)


def _at_a_time(sizes: Mapping[object, int]) -> list[list]:
    """Months in their order, as many together as have ``ROWS_AT_A_TIME`` rows, one at least."""
    found, rows = [], 0
    for month in sorted(sizes, key=lambda month: (month is not None, month)):
        if not found or rows + sizes[month] > ROWS_AT_A_TIME:
            found.append([])
            rows = 0
        found[-1].append(month)
        rows += sizes[month]
    return found


def _in(months: list) -> Column:
    inside = F.col(MONTH).isin([month for month in months if month])
    return inside | F.col(MONTH).isNull() if None in months else inside


def _by_month(rows: DataFrame):
    """A writer of rows that have their month; files of a month lie by invoice number."""
    every = F.xxhash64(*[name for name in rows.columns if name != MONTH])
    dealt = rows.repartitionByRange(F.col(MONTH), F.col("nf"), every).sortWithinPartitions(MONTH, "nf")
    return dealt.write.partitionBy(MONTH).mode("overwrite")


def _stored_with_months(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(T.StructType([*schema.fields, T.StructField(MONTH, T.DateType())])).parquet(folder)


def stored_view(spark: SparkSession, tables: InvoiceTables, folder: str, rules: Rules | None = None) -> DataFrame:
    """The stored view in its 17 columns."""
    schema = _view_schema(tables, rules)
    return _stored_with_months(spark, folder, schema).select(*schema.names)


def _view_schema(tables: InvoiceTables, rules: Rules | None) -> T.StructType:
    """Columns and types of the view, from tables without rows."""
    nothing = InvoiceTables(lambda name: tables[name].where("false"))
    return invoice_view(nothing, rules).schema


def affected_invoices(
    tables: InvoiceTables, changed: Mapping[str, DataFrame], rules: Rules | None = None
) -> DataFrame:
    """(wanted_nf): every invoice number whose rows of the view may differ after the changes.

    ``tables`` are the tables after the changes. ``changed`` has, by table, every row that
    went and every row that came (of a changed row, both images); tables without changes
    may be missing. A quote line leads to the goods lines of its guid, a quote to its lines
    and on, a service order to the goods lines of its guid and of its product. As rows
    that went are in ``changed``, the tables before the changes are not needed. Null is
    a number: invoices without one are in the view.
    """
    rules = rules or Rules()
    spark = next(iter(changed.values())).sparkSession if changed else None
    if spark is None:
        raise ValueError("no table of changes")
    if unknown := set(changed) - set(BASE_TABLES):
        raise ValueError(f"unknown tables: {', '.join(sorted(unknown))}")

    def rows(name: str, after: bool = False) -> DataFrame:
        schema = BASE_TABLES[name]
        moved = conform(changed[name], schema) if name in changed else spark.createDataFrame([], schema)
        moved = moved.where(F.col("cod_empresa") == rules.company)
        return moved.unionByName(tables.of_company(name, rules.company).select(*schema.names)) if after else moved

    guid = lambda column, name: L.compared_text(F.col(column), rules.case_sensitive, rules.collation).alias(name)
    numbers = [rows(name).select(F.col(key).alias("wanted_nf")) for name, key in NUMBER_KEYS.items() if name in changed]
    # Stored by themselves, so that the shuffles behind them don't lie on disk together.
    numbers = [stored(reduce(DataFrame.unionByName, numbers).distinct())] if numbers else []
    guids, products = [], []
    if "torcamento_itens" in changed:
        guids.append(rows("torcamento_itens").select(guid("guid_linha", "guid")))
    if "torcamento" in changed:
        quotes = rows("torcamento").select(F.col("codigo").alias("quote")).distinct()
        lines = rows("torcamento_itens", after=True)
        guids.append(lines.join(quotes, F.col("cod_orcamento") == F.col("quote"), "left_semi").select(guid("guid_linha", "guid")))
    if "tos" in changed:
        guids.append(rows("tos").select(guid("guid_orcamento", "guid")))
        products.append(rows("tos").select(F.col("cod_pecas").alias("product")))
    goods = tables.of_company("tnota_fiscal_item", rules.company)
    # Goods lines are read once for all guids and once for all products.
    for found, column in ((guids, guid("guid_orcamento", "key")), (products, F.col("codigo").alias("key"))):
        if found:
            keys = reduce(DataFrame.unionByName, found)
            name = keys.columns[0]
            keys = keys.where(F.col(name).isNotNull()).distinct()
            lines = goods.select(F.col("numero_nf").alias("wanted_nf"), column)
            numbers.append(stored(lines.join(keys, F.col("key") == F.col(name), "left_semi").select("wanted_nf").distinct()))
    return stored(reduce(DataFrame.unionByName, numbers).distinct())


def _are_few(wanted: DataFrame, tables: InvoiceTables, rules: Rules) -> bool:
    """Whether it pays to cut and store the lines of the wanted numbers before they are joined."""
    return wanted.count() * FEW <= tables.of_company("tnota_fiscal", rules.company).count()


def refresh_view(
    tables: InvoiceTables, changed: Mapping[str, DataFrame], folder: str, rules: Rules | None = None
) -> DataFrame:
    """Bring the stored view up to date; returns the months that were written anew.

    ``tables`` and ``changed`` are as for ``affected_invoices``. A month of which nothing
    is left loses its folder. The months are replaced one by one, so
    a run that broke off is to be repeated with the same changes; it then does all of it
    again and comes to the same result.
    """
    tables.check_landed()
    with shuffles_removed(tables["tnota_fiscal"].sparkSession):
        return _refreshed(tables, changed, folder, rules or Rules())


def _refreshed(tables: InvoiceTables, changed: Mapping[str, DataFrame], folder: str, rules: Rules) -> DataFrame:
    wanted = affected_invoices(tables, changed, rules)
    spark = wanted.sparkSession
    schema = _view_schema(tables, rules)
    few = _are_few(wanted, tables, rules)
    spans = _spans(F.col("wanted_nf"), wanted)
    aside = new_folder(spark, "stored")
    new = stored_parts(_views_of(spans, tables, rules, few, wanted), aside)
    same = F.col("nf").eqNullSafe(F.col("wanted_nf"))
    # A number's rows lie in the months of its invoices, before the changes and after them.
    flagged = wanted.withColumn("is_wanted", F.lit(True))
    old = _stored_with_months(spark, folder, schema)
    seen = old.select("nf", MONTH).join(flagged, same, "left").groupBy(MONTH).agg(
        F.bool_or(F.col("is_wanted").isNotNull()).alias("is_touched"),
        F.count_if(F.col("is_wanted").isNull()).alias("rows"),
    )
    came = new.groupBy(MONTH).agg(F.lit(True).alias("is_touched"), F.count(F.lit(1)).alias("rows"))
    both = seen.unionByName(came).groupBy(MONTH).agg(F.bool_or("is_touched").alias("is_touched"), F.sum("rows").alias("rows"))
    touched = stored(both.where("is_touched"))
    sizes = {row[MONTH]: row["rows"] for row in touched.collect()}  # one date for each month
    for months in _at_a_time(sizes):
        # The months are written beside those that are read, and take their places at the end.
        kept = _stored_with_months(spark, folder, schema).where(_in(months)).join(wanted, same, "left_anti")
        rows = kept.unionByName(new.where(_in(months)))
        _by_month(rows).option("partitionOverwriteMode", "dynamic").parquet(folder)
    _clear_months(spark, folder, touched.where("rows = 0"))
    if len(spans) > 1:
        discard(spark, aside)
    return touched.select(MONTH)


def _views_of(
    spans: Iterable[Span], tables: InvoiceTables, rules: Rules, few: bool, wanted: DataFrame
) -> Iterator[DataFrame]:
    """The rows of the wanted invoices, with their month, of one span after the other."""
    for span in spans:
        inputs = Inputs(tables.of_numbers(span), rules, narrow=few, wanted=wanted.where(span(F.col("wanted_nf"))))
        yield view_of(inputs, goods_first=not few).select("*", _month())


def _clear_months(spark: SparkSession, folder: str, months: DataFrame) -> None:
    """Remove the folders of months that have no rows any more, which no write replaces."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    for row in months.collect():
        month = "__HIVE_DEFAULT_PARTITION__" if row[MONTH] is None else row[MONTH].isoformat()
        files.delete(path(f"{folder}/{MONTH}={month}"), True)
