"""Exact top-k by inner product with a vector-approximation file.

The file holds, for each vector, the cell of every component: its upper bits. A scan of
the cells alone bounds each inner product from above and below. Exact vectors are then
read in the order of their bounds, until no bound that is left can displace the k-th
result. The file and the exact vectors are columns of one Parquet table.

Queries are taken in blocks of bounded size; a block goes to every task, each task
searches its part of the table, and the parts' results, k for each query, are merged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from billwright.llm.common import written
from billwright.llm.vectors import integers, matrix, products, usable

#: Bits of a component that a cell leaves out, queries of a block, rows scanned at once,
#: and exact vectors read at once.
CELL_BITS = 4
QUERY_BLOCK = 4096
_ROWS = 4096
_QUERIES = 256
_READ = 32


def approximate(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, cells array<long>, exact array<long>): the file, in the shared folder.

    ``exact`` is floor(256 * x) of every component, a cell its upper bits.
    """
    rows = usable(vectors, id_col, vector_col).where("id is not null")
    cells = F.transform("exact", lambda x: F.shiftright(x, CELL_BITS))
    return written(rows.select("id", integers("vector").alias("exact")).select("id", cells.alias("cells"), "exact"))


def _search(ids, cells, exact, query_ids, queries, best, k):
    """Improves ``best`` (scores, ids; k for each query, best first) by one block of rows.

    Bounds are taken in doubles; where these aren't exact, they are widened by more than the error.
    """
    width = (1 << CELL_BITS) - 1
    least = cells.astype(np.float64) * (1 << CELL_BITS)
    doubles = queries.astype(np.float64)
    most = (np.abs(least).max(initial=0.0) + width) * np.abs(doubles).max(initial=0.0) * max(1, least.shape[1])
    slack = most * least.shape[1] * 2.0**-50 if most >= 2**51 else 0.0
    for start in range(0, len(queries), _QUERIES):
        block = doubles[start : start + _QUERIES]
        at_least = block @ least.T  # of the cells' lower corners
        upper = at_least + width * np.maximum(block, 0).sum(1)[:, None] + slack
        lower = at_least + width * np.minimum(block, 0).sum(1)[:, None] - slack
        scores, found = best[0][start : start + _QUERIES], best[1][start : start + _QUERIES]
        count = min(k + 1, lower.shape[1])  # one more, as the query may be among the rows
        sure = -np.partition(-lower, count - 1, axis=1)[:, count - 1] if count > k else np.full(len(block), -np.inf)
        floor = np.maximum(sure, scores[:, -1].astype(np.float64))
        for n in np.flatnonzero((upper >= floor[:, None]).any(1)):
            rows = np.flatnonzero(upper[n] >= floor[n])
            rows = rows[np.argsort(-upper[n][rows], kind="stable")]
            query, own = queries[start + n], query_ids[start + n]
            for low in range(0, len(rows), _READ):
                some = rows[low : low + _READ]
                if upper[n][some[0]] < float(scores[n, -1]):
                    break  # nothing that is left reaches the k-th
                some = some[ids[some] != own]
                both = np.concatenate([scores[n], products(exact[some], query[None])[:, 0]])
                names = np.concatenate([found[n], ids[some]])
                order = np.lexsort((names, ~both))[:k]
                scores[n], found[n] = both[order], names[order]


def top_k(
    vectors: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest integer inner products of each query.

    Components count as floor(256 * x). Every row of ``vectors`` is a candidate but those
    with the query's own id; equal scores go to the smaller id. All are returned if there
    are fewer. Vectors that are null or hold a null or non-finite component take no part,
    nor do rows with a null id. Repeated rows are candidates of their own, and a repeated
    query row asks once. Components beyond 2 ** 62 either way count as that; scores are
    exact, and the nearest long if they don't fit into one. Empty tables give no rows.
    Vectors of different lengths are an error.
    """
    spark = vectors.sparkSession
    file = approximate(vectors, id_col, vector_col)
    asked = usable(queries, id_col, vector_col).where("id is not null").select(
        "id", integers("vector").alias("exact")
    ).dropDuplicates(["id"])
    numbered = written(
        asked.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(max(1, -(-asked.count() // QUERY_BLOCK)))))
        .repartition("block").sortWithinPartitions("block")
    )
    parts = None
    for block in sorted(row["block"] for row in numbered.select("block").distinct().collect()):
        # Of bounded size: about QUERY_BLOCK vectors.
        held = numbered.where(F.col("block") == block).select("id", "exact").toArrow().combine_chunks()
        shared = spark.sparkContext.broadcast(
            (held.column(0).to_numpy(), matrix(held.column(1).combine_chunks()))
        )
        some = file.mapInArrow(_searcher(shared, k), "query_id long, vec_id long, score long")
        parts = some if parts is None else parts.unionByName(some)
    if parts is None:
        parts = file.select(F.col("id").alias("query_id"), F.col("id").alias("vec_id"), F.lit(0).cast("long").alias("score")).where("false")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        parts.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def _searcher(shared, k: int):
    most = np.iinfo(np.int64).max

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query_ids, queries = shared.value
        scores = np.full((len(queries), k), ~most, np.int64)
        found = np.full((len(queries), k), most, np.int64)
        for batch in batches:
            for start in range(0, batch.num_rows, _ROWS):
                part = batch.slice(start, _ROWS)
                _search(
                    part.column(0).to_numpy(), matrix(part.column(1)), matrix(part.column(2)),
                    query_ids, queries, (scores, found), k,
                )
        have = (scores != ~most) | (found != most)  # places that no row has taken yet
        if have.any():
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(query_ids, have.sum(1))), pa.array(found[have]),
                    pa.array(scores[have]),
                ],
                names=["query_id", "vec_id", "score"],
            )

    return run
