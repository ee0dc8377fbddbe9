"""Near-duplicate embeddings by sorted projection passes.

A pass hashes every vector by the signs of random projections and sorts by the bits put
together. Vectors at a small angle share a long beginning, so each is compared with the
neighbours within a window of bounded width, and the pairs that are similar enough are
linked. Vectors that agree in so many leading bits that a window should hold them are a
run; a run longer than the window (a dense group) is compared as a whole, in cells of two
blocks. Passes with other projections find what one pass tears apart; the links of all
are united. Equal vectors are one class from the start.

The number of vectors decides how many leading bits make a run, and with the similarity
that decides how many passes it takes for the aimed recall.

A pair is counted in the first pass that brings it into a window or a run and in no other:
a vector carries its positions in all passes. A task compares one stretch of a pass with
itself and the next, or two blocks of a run, whatever the data.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from billwright.llm.common import written
from billwright.llm.components import connected
from billwright.llm.vectors import matrix, usable

#: The fewest passes, neighbours on either side, and sign bits of a hash.
PASSES = 8
WINDOW = 1024
BITS = 60
#: The share of pairs just at the threshold that some pass is expected to bring together.
RECALL = 0.95
#: Windows of a stretch: a vector goes to its stretch, and the first window of one to the stretch before.
STRETCH = 4
#: Vectors on either side of a cell of a run, and the most pairs looked at in one go.
BLOCK = 8192
_TRIES = 1 << 20


def _scheme(rows: int, least: float, window: int) -> tuple[int, int]:
    """(bits, passes): the leading bits that make a run, and how many passes RECALL takes.

    With log2(rows / window) bits an even spread has a window's worth in each run. Two
    vectors agree in a bit with the probability 1 - angle / pi.
    """
    agree = 1 - math.acos(max(-1.0, min(1.0, least))) / math.pi
    bits = min(BITS, max(0, math.ceil(math.log2(max(rows, 1) / window)))) if agree > 0 else 0
    together = agree**bits
    return bits, PASSES if together == 1 else max(PASSES, math.ceil(math.log(1 - RECALL) / math.log1p(-together)))


def _projections(size: int, seed: int, passes: int) -> np.ndarray:
    return np.random.default_rng(seed).standard_normal((passes, BITS, size))


def _keyed(vectors: DataFrame, seed: int, passes: int) -> DataFrame:
    """(node, pass, key): the hash of each vector in each pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = 1 << np.arange(BITS - 1, -1, -1, dtype=np.int64)
        for batch in batches:
            rows = matrix(batch.column(1))
            drawn = _projections(rows.shape[1], seed, passes)
            keys = np.stack([(rows @ one.T >= 0) @ place for one in drawn], axis=1)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(batch.column(0).to_numpy(), passes)),
                    pa.array(np.tile(np.arange(passes, dtype=np.int32), len(rows))),
                    pa.array(keys.ravel()),
                ],
                names=["node", "pass", "key"],
            )

    return vectors.select("node", "vector").mapInArrow(run, "node long, pass int, key long")


def _positions(keyed: DataFrame, bits: int, window: int) -> tuple[DataFrame, DataFrame]:
    """(node, places, runs) by pass, and (pass, run, n) of the runs longer than the window.

    A place is the rank of a vector in the order of a pass, a run is named by its first
    place and -1 if it isn't longer than the window. A range-partitioned sort; the sizes
    of its partitions, a row each, number the rows.
    """
    ordered = written(
        keyed.repartitionByRange("pass", "key", "node").sortWithinPartitions("pass", "key", "node")
        .select(
            "node", "pass", F.shiftright("key", BITS - bits).alias("prefix"),
            F.monotonically_increasing_id().alias("at"),
        )
    )
    part, offset = F.shiftright("at", 33), F.col("at").bitwiseAND((1 << 33) - 1)
    sizes = ordered.groupBy("pass", part.alias("part")).agg(
        F.count(F.lit(1)).alias("n"), F.min(offset).alias("low")
    ).toPandas().sort_values(["pass", "part"])
    sizes["before"] = sizes.groupby("pass")["n"].cumsum() - sizes["n"] - sizes["low"]
    starts = ordered.sparkSession.createDataFrame(
        [(int(a), int(b), int(c)) for a, b, c in sizes[["pass", "part", "before"]].itertuples(index=False)],
        "_pass int, _part long, before long",
    )
    placed = ordered.join(
        starts, (F.col("pass") == F.col("_pass")) & (part == F.col("_part"))
    ).select("node", "pass", "prefix", (offset + F.col("before")).alias("place"))
    dense = written(
        placed.groupBy("pass", "prefix").agg(F.min("place").alias("run"), F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > window + 1)
    )
    in_run = dense.select(F.col("pass").alias("_pass"), F.col("prefix").alias("_prefix"), "run")
    by_node = (
        placed.join(in_run, (F.col("pass") == F.col("_pass")) & (F.col("prefix") == F.col("_prefix")), "left")
        .select("node", F.struct("pass", "place", F.coalesce("run", F.lit(-1).cast("long")).alias("run")).alias("p"))
        .groupBy("node").agg(F.array_sort(F.collect_list("p")).alias("p"))
    )
    return by_node.select(
        F.col("node").alias("_node"), F.transform("p", lambda x: x["place"]).alias("places"),
        F.transform("p", lambda x: x["run"]).alias("runs"),
    ), dense.select("pass", "run", "n")


def _joined(parts: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``parts`` after the parts of each a and b have become one, named by the smallest."""
    while (apart := parts[a] != parts[b]).any():
        a, b = a[apart], b[apart]
        up = np.arange(len(parts))
        np.minimum.at(up, np.maximum(parts[a], parts[b]), np.minimum(parts[a], parts[b]))
        while (further := up[up] != up).any():
            up[further] = up[up[further]]
        parts = up[parts]
    return parts


def _compared(cell: pd.DataFrame, least: float, window: int, far: bool = False) -> pd.DataFrame:
    """(node, links, linked): links of this cell's vectors within the window, or beyond it.

    ``linked`` joins the vectors that links connect, one link less than there are vectors.
    """
    own = int(cell["pass"].iloc[0])
    places = np.stack(cell["places"].to_numpy())
    order = np.argsort(places[:, own], kind="stable")
    places, runs = places[order], np.stack(cell["runs"].to_numpy())[order]
    vectors = np.stack(cell["vector"].to_numpy()).astype(np.float64)[order]
    vectors = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    nodes, sizes = cell["node"].to_numpy()[order], cell["copies"].to_numpy()[order]
    begins = int(np.count_nonzero(cell["home"]))  # the stretch or block itself comes first, then the other
    others = begins if far and begins < len(nodes) else 0
    counts, parts = np.zeros(len(nodes), np.int64), np.arange(len(nodes))
    step = max(1, min(256, _TRIES // len(nodes)))
    for low in range(0, begins, step):
        high = min(low + step, begins)
        first, end = max(low, others), len(nodes) if far else min(len(nodes), high + window)
        cosines = vectors[low:high] @ vectors[first:end].T
        a, b = np.nonzero(cosines >= least - 1e-9)
        sure = cosines[a, b] >= least + 1e-9
        a, b = a + low, b + first
        gap = places[b, own] - places[a, own]
        new = gap > window if far else (gap > 0) & (gap <= window)
        a, b, sure = a[new], b[new], sure[new]
        for earlier in range(own):
            run = runs[a, earlier]
            new = (np.abs(places[a, earlier] - places[b, earlier]) > window) & ((run < 0) | (run != runs[b, earlier]))
            a, b, sure = a[new], b[new], sure[new]
        close = np.flatnonzero(~sure)
        sure[close] = np.einsum("ij,ij->i", vectors[a[close]], vectors[b[close]]) >= least
        a, b = a[sure], b[sure]
        np.add.at(counts, a, sizes[b])
        np.add.at(counts, b, sizes[a])
        parts = _joined(parts, a, b)
    some = np.flatnonzero(counts)
    return pd.DataFrame({"node": nodes[some], "links": counts[some], "linked": nodes[parts[some]]})


def near_duplicates(
    vectors: DataFrame, least: float = 0.9, id_col: str = "vec_id", vector_col: str = "embedding",
    window: int = WINDOW, seed: int = 1,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``vectors``.

    Rows are linked if a pass compares them and their cosine, in double precision, is at
    least ``least``; that is expected of RECALL of the pairs just at it and of more above,
    however many rows there are and however dense they lie. Equal vectors are always linked. ``n_links`` counts the other rows
    linked directly, component_id is the smallest id that links reach, and a row is kept
    if that is its own. Null, zero and empty vectors, and ones that hold a null or
    non-finite component, are linked with nothing. Repeated rows are rows of their own. A
    row without id cannot name a component; it is kept if no row with an id is in its
    component. Vectors of different lengths are an error; no rows give no rows.
    """
    rows = vectors.select(
        vectors[id_col].cast("long").alias("id"), vectors[vector_col].cast("array<double>").alias("raw")
    )
    plain = usable(rows, "id", "raw").where(F.exists("vector", lambda x: x != 0))
    plain = plain.withColumn("vector", F.transform("vector", lambda x: x + 0.0))  # -0.0 is 0.0
    keyed = plain.withColumn("node", F.xxhash64("vector"))
    classes = written(
        keyed.groupBy("node").agg(
            F.min("id").alias("id"), F.count(F.lit(1)).alias("copies"), F.first("vector").alias("vector")
        )
    )
    count = classes.count()
    bits, passes = _scheme(count, least, window)
    positions, dense = _positions(_keyed(classes, seed, passes), bits, window)
    # As narrow as they can be without loss, since they are shuffled once for each pass.
    own_kind = vectors.schema[vector_col].dataType
    kind = "array<float>" if own_kind.simpleString() == "array<float>" else "array<double>"
    number = "array<int>" if count < 2**31 else "array<long>"
    placed = written(
        classes.join(positions, F.col("node") == F.col("_node"))
        .select("node", "copies", F.col("vector").cast(kind), F.col("places").cast(number), F.col("runs").cast(number))
    )
    own = placed.select("*", F.posexplode("places").alias("pass", "place"))
    stretch = F.floor(F.col("place") / (STRETCH * window))
    to_the_one_before = F.col("place") % (STRETCH * window) < window
    halves = own.select(
        "pass", "node", "copies", "vector", "places", "runs",
        F.explode(F.array(
            F.struct(stretch.alias("stretch"), F.lit(True).alias("home")),
            F.struct(F.when(to_the_one_before, stretch - 1).alias("stretch"), F.lit(False).alias("home")),
        )).alias("h"),
    ).select("*", "h.stretch", "h.home").where("stretch >= 0").drop("h")
    run = F.element_at("runs", F.col("pass") + 1)
    named_run = dense.select(F.col("pass").alias("_pass"), F.col("run").alias("_run"), "n")
    block = F.floor((F.col("place") - F.col("_run")) / BLOCK)
    numbers = F.sequence(F.lit(0).cast("long"), F.ceil(F.col("n") / BLOCK) - 1)
    cells = own.where(run >= 0).join(named_run, (F.col("pass") == F.col("_pass")) & (run == F.col("_run"))).select(
        "pass", "_run", "node", "copies", "vector", "places", "runs",
        F.inline(F.transform(numbers, lambda k: F.struct(
            F.least(k, block).alias("i"), F.greatest(k, block).alias("j"), (k >= block).alias("home"),
        ))),
    )
    beyond = cells.groupBy("pass", "_run", "i", "j").applyInPandas(
        lambda rows: _compared(rows, least, window, far=True), "node long, links long, linked long"
    )
    found = written(
        halves.groupBy("pass", "stretch").applyInPandas(
            lambda rows: _compared(rows, least, window) if rows["home"].any() else pd.DataFrame({"node": [], "links": [], "linked": []}),
            "node long, links long, linked long",
        ).unionByName(beyond)
    )
    links = found.groupBy("node").agg(F.sum("links").alias("links")).withColumnRenamed("node", "_node")
    parts = connected(found.select(F.col("node").alias("a"), F.col("linked").alias("b")))
    first = parts.join(classes.select("node", "id"), "node").groupBy("component").agg(F.min("id").alias("first"))
    named = parts.join(first, "component").select(F.col("node").alias("_in"), "first")
    by_class = (
        classes.select("node", "id", "copies")
        .join(links, F.col("node") == F.col("_node"), "left").join(named, F.col("node") == F.col("_in"), "left")
        .select(
            F.col("node").alias("_class"),
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("first", "id").alias("component_id"),
        )
    )
    finite = ~F.exists("raw", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable_ = (F.size("raw") > 0) & finite & F.exists("raw", lambda x: x != 0)
    node = F.when(usable_, F.xxhash64(F.transform("raw", lambda x: x + 0.0)))
    joined = rows.withColumn("_mine", node).join(by_class, F.col("_mine") == F.col("_class"), "left")
    component = F.when(F.col("_class").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return joined.select(
        F.col("id").alias("vec_id"), F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"),
    )
