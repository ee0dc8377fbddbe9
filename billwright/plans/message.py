"""The report as HTML, and the messages that carry it."""

from __future__ import annotations

import datetime
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from billwright.functions import text as X
from billwright.operators.storage import stored
from billwright.plans import report as P
from billwright.plans.inputs import Inputs
from billwright.schemas import REPORT_COLUMNS, VIEW_HEADINGS

# Rows of one segment of a message, so that no task holds a whole report as one text.
ROWS_PER_PART = 10_000

# Rows that one task makes into HTML: about 150 MB of it.
ROWS_PER_TASK = 250_000

TABLE_OPENING = (
    "<table><thead><tr><th></th>"
    + "".join(f"<th>{VIEW_HEADINGS[name]}</th>" for name in REPORT_COLUMNS)
    + "</tr></thead><tbody>"
)
TABLE_CLOSING = "</tbody></table>"


def row_html(literal_cleanup: bool = False) -> Column:
    """One formatted report row as a table row, its position as row header."""
    parts = [F.lit("<tr><th>"), F.col("idx").cast("string"), F.lit("</th>")]
    parts += [X.cell(F.col(name).cast("string")) for name in REPORT_COLUMNS]
    html = F.concat(*parts, F.lit("</tr>"))
    return X.drop_empty_tokens(html) if literal_cleanup else html


def html_rows(formatted: DataFrame, literal_cleanup: bool = False) -> DataFrame:
    """``(idx, row_html)``."""
    return formatted.select("idx", row_html(literal_cleanup).alias("row_html"))


def message_parts(
    html: DataFrame, totals: DataFrame, rows_per_part: int = ROWS_PER_PART, by: str | None = None
) -> DataFrame:
    """``(part, parts, html_body)``: the segments of one document, in order.

    Put together they are the same text whatever ``rows_per_part``: the first opens the
    body and its table, the last closes both. ``totals`` is the one-row total. With
    ``by`` there is a document for each value in ``totals`` (by, total), and ``idx``
    counts the rows of each from 0. A document without rows still is one segment.
    """
    return _segments(html.withColumn("part", _part(rows_per_part)), totals, rows_per_part, by)


def parts_of_rows(
    positioned: DataFrame,
    totals: DataFrame,
    rows_per_part: int = ROWS_PER_PART,
    by: str | None = None,
    literal_cleanup: bool = False,
) -> DataFrame:
    """``message_parts`` of report rows with their position, which are counted at once.

    HTML is many times as long as the row it shows, so rows are dealt out by segment
    first, over as many tasks as their number wants, and become HTML where they arrive.
    """
    keys = [by] if by else []
    rows = positioned.select(*keys, "idx", *REPORT_COLUMNS).withColumn("part", _part(rows_per_part))
    tasks = max(rows.sparkSession.sparkContext.defaultParallelism, ceil(rows.count() / ROWS_PER_TASK))
    html = P.formatted_report(rows.repartition(tasks, *keys, "part")).select(
        *keys, "idx", "part", row_html(literal_cleanup).alias("row_html")
    )
    return _segments(html, totals, rows_per_part, by)


def _part(rows_per_part: int) -> Column:
    return F.floor(F.col("idx") / rows_per_part).cast("int")


def _segments(html: DataFrame, totals: DataFrame, rows_per_part: int, by: str | None) -> DataFrame:
    """The segments of rows that know the ``part`` they are in."""
    keys = [by] if by else []
    tables = html.groupBy(*keys, "part").agg(
        F.expr("listagg(row_html, '') within group (order by idx)").alias("rows_html")
    )
    count = F.greatest(F.lit(1), F.ceil(F.coalesce("rows", F.lit(0)) / rows_per_part)).cast("int")
    sizes = html.groupBy(*keys).agg(F.count("*").alias("rows"))
    if by:
        documents = totals.join(sizes, by, "left")
    else:
        documents = sizes.withColumn("total", totals.select("total").scalar())
    numbers = documents.select(*keys, "total", count.alias("parts")).select(
        "*", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")
    )
    opening = F.concat(X.body_opening(X.total_text(F.col("total"))), F.lit(TABLE_OPENING))
    segment = F.concat(
        F.when(F.col("part") == 0, opening).otherwise(""),
        F.coalesce("rows_html", F.lit("")),
        F.when(F.col("part") == F.col("parts") - 1, TABLE_CLOSING + X.BODY_CLOSING).otherwise(""),
    )
    joined = numbers.join(tables, [*keys, "part"], "left")
    return joined.select(*keys, "part", "parts", segment.alias("html_body"))


def outbox(bodies: DataFrame, addresses: str, subject: Column) -> DataFrame:
    """One record per recipient and body; the other columns of ``bodies`` stay."""
    return bodies.select(
        F.explode(X.recipients(F.lit(addresses))).alias("to"), subject.alias("subject"), "*"
    )


def report_message(
    inputs: Inputs,
    as_of: datetime.date,
    addresses: str,
    rows_per_part: int = ROWS_PER_PART,
    literal_cleanup: bool = False,
) -> DataFrame:
    """The message of one report, in segments: ``(to, subject, part, parts, html_body)``.

    The report's rows are made once; list and total both come from them.
    """
    rows = stored(P.report_rows(inputs), rebalance=False)
    parts = parts_of_rows(P.sorted_report(rows), P.total_of_rows(rows), rows_per_part, literal_cleanup=literal_cleanup)
    return outbox(parts, addresses, X.subject(F.lit(as_of)))
