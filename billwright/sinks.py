"""Writing reports and messages. Every sink is written by the executors in parallel."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from billwright.plans.message import TABLE_CLOSING, TABLE_OPENING

#: Folders of the outbox.
DAY, RECIPIENT = "sent_on", "recipient"

# Parts of a message that share a file.
PARTS_PER_FILE = 16


def write_html_rows(html: DataFrame, folder: str) -> None:
    """One HTML document as text files: read by name, their lines open the table, list
    its rows in report order, and close it."""
    frame = html.sparkSession.range(2).select(
        F.when(F.col("id") == 0, F.lit(-1)).cast("long").alias("idx"),
        F.when(F.col("id") == 0, TABLE_OPENING).otherwise(TABLE_CLOSING).alias("row_html"),
    )
    lines = html.select(F.col("idx").cast("long").alias("idx"), "row_html").unionByName(frame)
    lines.orderBy(F.asc_nulls_last("idx")).select("row_html").write.mode("overwrite").text(folder)


def write_outbox(messages: DataFrame, folder: str, day: datetime.date) -> None:
    """One JSON record per message of a day, for whatever sends them.

    Records lie by day and recipient. Sending a day again replaces what the day had for
    the recipients at hand, whatever its number of parts, and leaves other days and
    recipients alone.
    """
    _by_day_and_recipient(messages.withColumn(DAY, F.lit(day))).json(folder)


def write_outboxes(messages: DataFrame, folder: str, day: str, compression: str | None = None) -> None:
    """The messages of many days at once, told by the column ``day``.

    They repeat a report for every recipient; ``compression`` is a codec of Spark's JSON files.
    """
    _by_day_and_recipient(messages.withColumnRenamed(day, DAY)).json(folder, compression=compression)


def _by_day_and_recipient(messages: DataFrame) -> DataFrameWriter:
    block = F.floor(F.col("part") / PARTS_PER_FILE)
    dealt = messages.withColumn(RECIPIENT, F.col("to")).repartition(DAY, RECIPIENT, block)
    return dealt.write.partitionBy(DAY, RECIPIENT).mode("overwrite").option("partitionOverwriteMode", "dynamic")


def read_outbox(spark: SparkSession, folder: str, day: datetime.date | None = None) -> DataFrame:
    """(day, to, subject, part, parts, html_body) of the outbox, or of one of its days."""
    schema = "to string, subject string, part int, parts int, html_body string"
    records = spark.read.schema(f"{schema}, {DAY} date, {RECIPIENT} string").json(folder)
    records = records if day is None else records.where(F.col(DAY) == F.lit(day))
    return records.select(F.col(DAY).alias("day"), "to", "subject", "part", "parts", "html_body")
