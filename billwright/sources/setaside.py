"""Rows of a source that can't be read as their table's types, apart from those that can."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from billwright.operators.storage import stored

REASON = "reason"


def conform_or_set_aside(df: DataFrame, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """(rows in the columns and types of ``schema``, the other rows as they came with a reason).

    A row is set aside if a value that isn't null can't be read as its column's type; the
    reason names each such column with the value. The source is read once. ``conform``
    is the strict way, which fails the job instead. A column that the source lacks is an
    error either way.
    """
    read = {field.name: F.col(field.name).try_cast(field.dataType) for field in schema}
    failed = F.array(*[
        F.when(F.col(name).isNotNull() & value.isNull(), F.concat(F.lit(f"{name}: "), F.col(name).cast("string")))
        for name, value in read.items()
    ])
    reason = F.array_join(F.array_compact(failed), "; ")
    marked = stored(
        df.select(*[F.col(name) for name in schema.names], reason.alias(REASON)), rebalance=False
    )
    good = marked.where(F.col(REASON) == "").select(*[value.alias(name) for name, value in read.items()])
    return good, marked.where(F.col(REASON) != "")
