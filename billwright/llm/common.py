"""What several operators share: columns taken by name, intermediate tables, short texts."""

from __future__ import annotations

import contextlib
import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from billwright.operators.storage import new_folder

#: Bytes of a batch of rows with texts.
BATCH_BYTES = 8 << 20
#: White space as the contracts use it: \x20 and \x09 to \x0D, which is what bytes.split() takes.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def columns(df: DataFrame, **named: str | Column) -> DataFrame:
    """Only the named columns of ``df`` under new names, whatever else it holds."""
    return df.select(*[
        (df[c] if isinstance(c, str) else c).alias(name) for name, c in named.items()
    ])


def id_and_text(docs: DataFrame) -> DataFrame:
    """``doc_id`` as long and ``text``, null text as empty."""
    return docs.select(
        docs["doc_id"].cast("long").alias("doc_id"),
        F.coalesce(docs["text"], F.lit("")).alias("text"),
    )


def shared_path(spark: SparkSession, kind: str) -> str:
    """A new path in the folder that the driver and all executors share."""
    return new_folder(spark, kind)


def written(df: DataFrame) -> DataFrame:
    """``df`` written once as Parquet to the shared folder and read back.

    It cuts the lineage: an executor that is lost later takes nothing with it, and
    Spark knows the size when it plans what follows.
    """
    path = shared_path(df.sparkSession, "llm")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def crc_remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % F.lit(divisor)


def bounded(texts: pa.StringArray, most: int) -> Iterator[tuple[int, int]]:
    """(first row, number of rows) of the runs of a batch that hold about ``most`` bytes of text, or one text."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < len(ends):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield start, stop - start
        start = stop


_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"


def by_batches(
    df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | StructType
) -> DataFrame:
    """``df.mapInArrow(run, schema)`` for rows that hold texts.

    Batches are in memory several times over, outside of the heap, in the executor and in
    Python, so they are kept small: where the session sets no limit of their size, it is
    given BATCH_BYTES. A worker gives back what a task took before it waits for the next.
    """
    conf = df.sparkSession.conf
    if conf.get(_LIMIT, None) is None:
        conf.set(_LIMIT, f"{BATCH_BYTES}b")

    def tidy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return df.mapInArrow(tidy, schema)


def give_back() -> None:
    """Return memory that this process no longer uses, as far as its libraries can."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only some C libraries know how
        ctypes.CDLL(None).malloc_trim(0)
