"""Hard negatives by Fagin's threshold algorithm.

A negative of an anchor is hard if its score, an integer inner product with the anchor,
lies in a window below that of one of the anchor's positives. Candidates are searched in
blocks. A block keeps its rows sorted by every component. For an anchor, the lists are
read together from the end that its component's sign favours; whatever turns up in one
of them is scored on the whole vector at once. The components read last bound all rows
that have not turned up, and the block is done when that bound is below the k-th score of
every window (or below a window that is not full).

Anchors go to all tasks in blocks of bounded size, first to find their positives, then
with the windows that these give. A task carries its best from block to block, so that
later ones stop earlier, and hands over k rows for each window.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from billwright.llm.common import written
from billwright.llm.vectors import integers, matrix, products, usable

#: Anchors of a block, candidates of a block, and places of the lists read at first;
#: twice as many are read each time after.
ANCHOR_BLOCK = 16_384
_ROWS = 16_384
_DEPTH = 16


class SortedLists:
    """A block of candidates and, for every component, its rows in ascending order."""

    def __init__(self, ids: np.ndarray, kinds: np.ndarray, vectors: np.ndarray):
        self.ids, self.kinds, self.vectors = ids, kinds, vectors
        by_component = np.ascontiguousarray(vectors.T)
        self.order = np.argsort(by_component, axis=1, kind="stable").astype(np.int32)
        self.sorted = np.take_along_axis(by_component, self.order, 1)
        self._largest = int(np.abs(vectors.astype(np.float64)).max(initial=0.0)) + 1
        self._doubles = vectors.astype(np.float64)

    def accessed(self, anchor: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, int | None]]:
        """(rows that newly turned up, their scores, bound of those left; None if none are)."""
        count, used = len(self.ids), np.flatnonzero(anchor)
        weights, largest = anchor[used], int(np.abs(anchor.astype(np.float64)).max(initial=0.0)) + 1
        small = self._largest * largest * max(1, len(anchor)) < 2**52  # exact in doubles
        doubles = anchor.astype(np.float64)
        rising = weights > 0
        up, down = used[rising], used[~rising]
        seen, depth, step = np.zeros(count, bool), 0, _DEPTH if len(used) else count
        while depth < count:
            stop = min(count, depth + step)
            if stop < count:
                new = np.zeros(count, bool)
                new[self.order[up, count - stop : count - depth].ravel()] = True
                new[self.order[down, depth:stop].ravel()] = True
                rows = np.flatnonzero(new & ~seen)
                seen |= new
                last = np.where(rising, self.sorted[used, count - stop], self.sorted[used, stop - 1])
                bound = int(last @ weights) if small else sum(a * b for a, b in zip(last.tolist(), weights.tolist()))
            else:
                rows, bound = np.flatnonzero(~seen), None
            if small:
                scores = (self._doubles[rows] @ doubles).astype(np.int64)
            else:
                scores = products(self.vectors[rows], anchor[None])[:, 0]
            yield rows, scores, bound
            depth, step = stop, step * 2


class _Best:
    """The first ``k`` of what was offered, by score and then by smaller id."""

    __slots__ = ("k", "scores", "ids")

    def __init__(self, k: int):
        self.k, self.scores, self.ids = k, np.empty(0, np.int64), np.empty(0, np.int64)

    def offer(self, scores: np.ndarray, ids: np.ndarray) -> None:
        if len(self.scores) == self.k:
            good = scores >= self.scores[-1]
            scores, ids = scores[good], ids[good]
        if len(scores):
            scores, ids = np.concatenate([self.scores, scores]), np.concatenate([self.ids, ids])
            order = np.lexsort((ids, ~scores))[: self.k]  # ~x falls as x rises, at the ends of a long too
            self.scores, self.ids = scores[order], ids[order]

    def kth(self, least: int | None) -> int | None:
        """The score that others have to reach; ``least`` as long as there are fewer than k."""
        return int(self.scores[-1]) if len(self.scores) == self.k else least


def find_positives(lists: SortedLists, anchor_id: int, anchor: np.ndarray, best: _Best) -> None:
    """Offers ``best`` the rows of a block that all have the anchor's label."""
    for rows, scores, bound in lists.accessed(anchor):
        other = lists.ids[rows] != anchor_id
        best.offer(scores[other], lists.ids[rows[other]])
        needed = best.kth(None)
        if bound is not None and needed is not None and bound < needed:
            break


def find_negatives(lists: SortedLists, anchor_id: int, kind: int, anchor: np.ndarray, windows: list) -> None:
    """Offers the rows of a block with another label to ``windows``: (least, most, best) each."""
    if not windows:
        return
    for rows, scores, bound in lists.accessed(anchor):
        other = (lists.kinds[rows] != kind) & (lists.ids[rows] != anchor_id)
        rows, scores = rows[other], scores[other]
        for least, most, best in windows:
            inside = (scores >= least) & (scores <= most)
            best.offer(scores[inside], lists.ids[rows[inside]])
        if bound is not None and all(bound < best.kth(least) for least, _, best in windows):
            break


def window(positive_score: int, low: int, high: int) -> tuple[int, int] | None:
    """Least and greatest score from ``low`` to ``high`` percent of the positive's; None if there is none."""
    least, most = -(-low * positive_score // 100), high * positive_score // 100
    return (least, most) if least <= most else None


def _kinds(labels: pa.Array, numbers: dict[str, int]) -> np.ndarray:
    """Labels as numbers; -1 for those that no anchor of the block has."""
    coded = labels.dictionary_encode()
    known = np.array([numbers.get(label, -1) for label in coded.dictionary.to_pylist()], np.int64)
    return known[coded.indices.to_numpy()]


def _blocks(batches: Iterator[pa.RecordBatch], numbers: dict[str, int]):
    """(ids, kinds, vectors) of ``_ROWS`` rows, from batches (id, label, exact) of any size."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        for start in range(0, batch.num_rows, _ROWS):
            held.append(batch.slice(start, _ROWS))
            if sum(b.num_rows for b in held) >= _ROWS:
                yield _block(held, numbers)
                held = []
    if held:
        yield _block(held, numbers)


def _block(held: list[pa.RecordBatch], numbers: dict[str, int]):
    kinds = np.concatenate([_kinds(b.column(1), numbers) for b in held])
    return np.concatenate([b.column(0).to_numpy() for b in held]), kinds, np.concatenate([matrix(b.column(2)) for b in held])


def _positives(shared, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, labels, vectors = shared.value
        numbers = {label: n for n, label in enumerate(dict.fromkeys(labels))}
        by_kind: dict[int, list[int]] = {}
        for n, label in enumerate(labels):
            by_kind.setdefault(numbers[label], []).append(n)
        best = [_Best(k) for _ in labels]
        for of, kinds, values in _blocks(batches, numbers):
            for kind in np.unique(kinds[kinds >= 0]).tolist():
                same = kinds == kind
                lists = SortedLists(of[same], kinds[same], values[same])
                for n in by_kind[kind]:
                    find_positives(lists, ids[n], vectors[n], best[n])
        yield _batch(ids, np.zeros(len(ids), np.int32), best)

    return run


def _negatives(shared, k: int, low: int, high: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (ids, labels, vectors), anchors, places, scores = shared.value
        numbers = {label: n for n, label in enumerate(dict.fromkeys(labels))}
        best = [_Best(k) for _ in anchors]
        windows: list[list] = [[] for _ in labels]
        for own, anchor, score in zip(best, anchors.tolist(), scores.tolist()):
            if limits := window(score, low, high):
                windows[anchor].append((*limits, own))
        for block in _blocks(batches, numbers):
            lists = SortedLists(*block)
            for n, label in enumerate(labels):
                find_negatives(lists, ids[n], numbers[label], vectors[n], windows[n])
        yield _batch(ids[anchors], places, best)

    return run


FOUND = "anchor_id long, place int, other_id long, score long"


def _batch(anchors: np.ndarray, places: np.ndarray, best: list[_Best]) -> pa.RecordBatch:
    counts = [len(b.ids) for b in best]
    join = lambda parts: np.concatenate([np.empty(0, np.int64), *parts])
    columns = (
        np.repeat(anchors, counts), np.repeat(places, counts).astype(np.int32),
        join(b.ids for b in best), join(b.scores for b in best),
    )
    return pa.RecordBatch.from_arrays(list(map(pa.array, columns)), names=["anchor_id", "place", "other_id", "score"])


def _first(found: DataFrame, k: int) -> DataFrame:
    """The first ``k`` of what the tasks found for each anchor and place, with their rank."""
    order = Window.partitionBy("anchor_id", "place").orderBy(F.desc("score"), "other_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(
    vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90,
    id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Components count as floor(256 * x), those beyond 2 ** 62 either way as that; scores
    are exact, and the nearest long if they don't fit into one. An anchor's positives are
    the rows of its label with the highest scores, its negatives for each of them the
    highest-scoring rows of another label from ``low`` to ``high`` percent of the
    positive's score. Equal scores go to the smaller id; all are returned if there are
    fewer. A positive of score below 0 has an empty window.

    Rows with a null id, label or vector, and those with an empty vector or a null or
    non-finite component, take no part. Rows with the anchor's own id are not among what
    it finds; of several anchor rows with one id the smallest by label and components
    asks. Other repeated rows are rows of their own. Rows for which ``is_anchor`` is null
    are no anchors. Other columns are left out, whatever their names. Without rows or
    anchors there is no result. Vectors of different lengths are an error.

    No row is shuffled; each block of anchors scans the written vectors twice.
    """
    spark = vectors.sparkSession
    marked = vectors.select(
        vectors[id_col].alias("id_"), vectors[vector_col].alias("vector_"),
        F.struct(vectors[label_col].cast("string").alias("label"), F.coalesce(is_anchor, F.lit(False)).alias("asks")).alias("more"),
    )
    rows = written(
        usable(marked, "id_", "vector_", keep="more").where("id is not null and more.label is not null")
        .select("id", "more.label", integers("vector").alias("exact"), "more.asks")
    )
    asking = rows.where("asks").groupBy("id").agg(F.min(F.struct("label", "exact")).alias("a"))
    blocks = max(1, -(-asking.count() // ANCHOR_BLOCK))
    anchors = written(
        asking.select("id", "a.label", "a.exact", F.pmod(F.xxhash64("id"), F.lit(blocks)).alias("block"))
        .repartition("block").sortWithinPartitions("block", "id")
    )
    candidates, parts = rows.select("id", "label", "exact"), None
    for block in sorted(row["block"] for row in anchors.select("block").distinct().collect()):
        # Of bounded size: about ANCHOR_BLOCK vectors, and as many times ``positives`` scores.
        held = anchors.where(F.col("block") == block).select("id", "label", "exact").toArrow().combine_chunks()
        asked = (held.column(0).to_numpy(), held.column(1).to_pylist(), matrix(held.column(2).combine_chunks()))
        near = _first(candidates.mapInArrow(_positives(spark.sparkContext.broadcast(asked), positives), FOUND), positives)
        known = written(near)
        of = known.select("anchor_id", "rank", "score").toArrow()
        at = np.searchsorted(asked[0], of.column(0).to_numpy()) if of.num_rows else np.empty(0, np.int64)
        sent = spark.sparkContext.broadcast((asked, at, of.column(1).to_numpy(), of.column(2).to_numpy()))
        far = _first(candidates.mapInArrow(_negatives(sent, negatives, low, high), FOUND), negatives)
        some = far.join(
            known.select(
                F.col("anchor_id").alias("_anchor"), F.col("rank").alias("_place"),
                F.col("other_id").alias("positive_id"), F.col("score").alias("positive_score"),
            ),
            (F.col("anchor_id") == F.col("_anchor")) & (F.col("place") == F.col("_place")),
        ).select(
            "anchor_id", "positive_id", "rank", F.col("other_id").alias("negative_id"),
            "positive_score", F.col("score").alias("negative_score"),
        )
        parts = some if parts is None else parts.unionByName(some)
    if parts is None:
        schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
        return spark.createDataFrame([], schema)
    return parts
