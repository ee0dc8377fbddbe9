"""Connected components of links, as rounds of joins and small aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from billwright.llm.common import written


def _towards(links: DataFrame, larger_only: bool) -> DataFrame:
    """Links neighbours of each node to the smallest node among them and itself.

    ``links`` is (a, b) with a > b. Either only the larger neighbours are moved, or only
    the smaller ones; that keeps what is connected. The smallest neighbour is found by a
    partial aggregate, and a hub's links are spread by the skew join.
    """
    sides = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))) if larger_only else links
    least = sides.groupBy("a").agg(F.min("b").alias("m"))
    least = least.select(F.col("a").alias("of"), F.least("a", "m").alias("m"))
    joined = sides.join(least, F.col("a") == F.col("of"))
    if larger_only:
        moved = joined.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        moved = joined.where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        moved = moved.unionByName(least.select(F.col("of").alias("a"), F.col("m").alias("b")))
    return moved.where(F.col("a") != F.col("b")).distinct()


def connected(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b); the smallest node names it.

    Links have no direction; loops, repeated links and links with a null are ignored.
    Nodes without links aren't in the result, no links give no rows. Larger neighbours
    and smaller neighbours are moved to the smallest in turn until nothing moves, which
    takes rounds of the order of the logarithm of the longest path. Each round is
    written to the shared folder.
    """
    now = written(
        links.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").cast("long").alias("a"), F.least("a", "b").cast("long").alias("b"))
        .distinct()
    )
    mark = _mark(now)
    for _ in range(most_rounds if mark[0] else 0):
        now, before = written(_towards(_towards(now, True), False)), mark
        mark = _mark(now)
        if mark == before:
            break
    else:
        if mark[0]:
            raise RuntimeError(f"links did not settle in {most_rounds} rounds")
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)


def _mark(links: DataFrame) -> tuple:
    hashed = F.xxhash64("a", "b")
    row = links.agg(
        F.count(F.lit(1)).alias("n"), F.sum(hashed.cast("decimal(20,0)")).alias("s"), F.bit_xor(hashed).alias("x")
    ).first()
    return row["n"], row["s"], row["x"]
