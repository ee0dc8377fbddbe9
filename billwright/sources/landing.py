"""Copies of the base tables laid out for what reads them: by month, or in buckets.

By month, headers lie in a folder for each month of issue and everything that hangs on an
invoice number in the folder of that number's first month, so that a report on some months
opens the files of those months only. In buckets, the five tables that meet on the invoice
number are dealt by it and sorted, so that their joins need no shuffle.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from billwright.operators.storage import stored
from billwright.schemas import BASE_TABLES
from billwright.sources.tables import LINE_MONTH, MONTH, NUMBER_KEYS, InvoiceTables


# Rows of one table that a bucket has on average, so that a task sorts it in memory.
ROWS_PER_BUCKET = 1_000_000


def month_of_issue() -> Column:
    return F.trunc("dt_emissao", "month")


def _first_months(headers: DataFrame) -> DataFrame:
    """(_company, _number, _first): the first month of every invoice number, which may repeat."""
    known = headers.where(F.col("numero").isNotNull() & F.col("cod_empresa").isNotNull())
    return stored(
        known.groupBy(F.col("cod_empresa").alias("_company"), F.col("numero").alias("_number"))
        .agg(F.min(month_of_issue()).alias("_first"))
    )


def _with_first_month(rows: DataFrame, key: str, first: DataFrame, name: str) -> DataFrame:
    same = (F.col("cod_empresa") == F.col("_company")) & (F.col(key) == F.col("_number"))
    return rows.join(first, same, "left").withColumn(name, F.col("_first")).drop("_company", "_number", "_first")


def land_by_month(tables: InvoiceTables, spark: SparkSession, folder: str) -> InvoiceTables:
    """Copy all tables to ``folder`` with a folder for each month, and go on with the copies.

    Rows of an invoice without date, and lines of a number that no invoice has, lie in a
    folder of their own, which a report on months never opens. Quotes and service orders
    have no month. Within a month, files lie by invoice number; a number with very many
    rows goes over several files. What the folder held of the tables is replaced.
    """
    first = _first_months(tables["tnota_fiscal"])
    for name, schema in BASE_TABLES.items():
        df, key = tables[name], NUMBER_KEYS.get(name)
        writer = df.write
        if key:
            if name == "tnota_fiscal":
                df = _with_first_month(df, key, first, LINE_MONTH).withColumn(MONTH, month_of_issue())
            else:
                df = _with_first_month(df, key, first, MONTH)
            row = F.xxhash64(*schema.names)
            writer = (
                df.repartitionByRange(F.col(MONTH), F.col(key), row)
                .sortWithinPartitions(MONTH, key).write.partitionBy(MONTH)
            )
        writer.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{folder}/{name}")
    return from_months(spark, folder)


def from_months(spark: SparkSession, folder: str) -> InvoiceTables:
    """The tables of ``land_by_month``."""

    def read(name: str) -> DataFrame:
        schema = BASE_TABLES[name]
        added = [LINE_MONTH] if name == "tnota_fiscal" else []
        added += [MONTH] if name in NUMBER_KEYS else []
        fields = [*schema.fields, *[T.StructField(column, T.DateType()) for column in added]]
        return spark.read.schema(T.StructType(fields)).parquet(f"{folder}/{name}")

    return InvoiceTables(read, by_month=True)


def land_in_buckets(
    tables: InvoiceTables, spark: SparkSession, prefix: str, buckets: int, folder: str | None = None
) -> InvoiceTables:
    """Copy all tables to ``<prefix>_<table>`` of the session's catalog, and go on with the copies.

    The tables that hang on the invoice number are dealt by it into ``buckets``, or into
    more if the largest of them, whose rows are counted, wants more. One
    number is in one bucket: those with very many rows are still split, and for that
    shuffled, when they are joined. With ``folder``, the files lie there and not in the
    warehouse. Tables of the same names are replaced.
    """
    most = max(tables[name].count() for name in NUMBER_KEYS)
    buckets = max(buckets, ceil(most / ROWS_PER_BUCKET))
    for name in BASE_TABLES:
        df, key = tables[name], NUMBER_KEYS.get(name)
        if key:
            writer = df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key)
        else:
            writer = df.write
        if folder:
            writer = writer.option("path", f"{folder}/{name}")
        writer.mode("overwrite").format("parquet").saveAsTable(f"{prefix}_{name}")
    return from_catalog(spark, prefix)


def from_catalog(spark: SparkSession, prefix: str) -> InvoiceTables:
    """The tables ``<prefix>_<table>`` of the session's catalog, in buckets or not."""
    return InvoiceTables(lambda name: spark.table(f"{prefix}_{name}"))
