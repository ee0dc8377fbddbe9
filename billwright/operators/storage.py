"""Intermediate results in the folder that all executors share.

They outlive the executors that made them, unlike cached blocks.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Spark's option to remove the shuffle files of a query when it ends.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def use_shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder; where none is set, in local mode, one of our own."""
    context = spark.sparkContext
    if not context.getCheckpointDir():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not context.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="checkpoints-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


_made: list[str] = []


def new_folder(spark: SparkSession, kind: str) -> str:
    """The path of a folder that isn't there yet, in the shared one."""
    path = f"{use_shared_folder(spark)}/{kind}-{uuid.uuid4().hex}"
    _made.append(path)
    return path


def discard_stored(spark: SparkSession) -> int:
    """Remove the intermediate results of this process; returns how many there were.

    For use when results have been written: what still reads an intermediate result fails after this.
    """
    found = list(_made)
    for name in found:
        discard(spark, name)
    return len(found)


def discard(spark: SparkSession, name: str) -> None:
    """Remove the one intermediate result that lies in this folder."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(name)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    _made[:] = [other for other in _made if other != name]


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Within this, the shuffle files of each query go when it ends.

    Otherwise they stay until the driver happens to collect its garbage, and those of a
    chain of large queries lie on the executors' disks all at once.
    """
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def stored(df: DataFrame, rebalance: bool = True) -> DataFrame:
    """``df`` written once as Parquet, for a result that several jobs go on with.

    Rebalanced first, unless it is as large as what it was read from: what is left of
    many scan tasks would make many small files. Read back, it has file statistics, so
    that Spark knows its size when it plans.
    """
    path = new_folder(df.sparkSession, "stored")
    (df.hint("rebalance") if rebalance else df).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored_parts(parts: Iterable[DataFrame], folder: str) -> DataFrame:
    """The rows of all parts, written to ``folder`` one part after the other and without being dealt out anew."""
    for part in parts:
        part.write.mode("append").parquet(folder)
    return part.sparkSession.read.schema(part.schema).parquet(folder)
