"""Near-duplicates by bottom-k sketches from one hash function.

A document's shingles are hashed once; its sketch holds the smallest values, or all of
them where there are no more. Documents with equal sets are one class from the start.

Two passes over the retained values make the inverted lists. A coarse sketch leaves only
classes that share enough values with some other to be worth a look; the fine sketch of
those makes the lists. Two classes that are similar enough share at least a known number
of retained values, so one of them must be among the rarest few of either: only those
enter the lists (values in most documents, such as those of a common passage, come last).

In a list, every class is first compared with the list's most central one, which gives
as many pairs as the list has members. What that links is merged. Around a centre that
still has several components, those outside the largest meet all others, in cells of
bounded size. There bitmaps of what each holds of the centre rule out most pairs without
a look at the sets. Wherever two sets meet, the estimate on the sketch of their union
filters, and the full sets decide.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from billwright.llm.common import by_batches, written
from billwright.llm.components import connected

#: Retained values of the two sketches, and the risk of overlooking a similar pair.
COARSE, FINE = 32, 256
RISK = 1e-7
#: Classes on either side of a cell, and values of their sets.
BLOCK = 1024
VALUES = 2_000_000
_MIX = np.uint64(0x9E3779B97F4A7C15)


def shingle_hashes(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles of ``width`` words.

    A-Z are lower-cased, words are separated by ASCII white space. Fewer words than
    ``width`` are one shingle, no words are none.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, np.int64)
    known = {word: xxhash.xxh64_intdigest(word) for word in set(words)}
    values = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    width = min(width, len(words))
    count = len(words) - width + 1
    hashes = np.full(count, width, np.uint64)
    for n in range(width):
        hashes = (hashes ^ values[n : n + count]) * _MIX
        hashes ^= hashes >> np.uint64(29)
    hashes *= np.uint64(0xBF58476D1CE4E5B9)
    hashes ^= hashes >> np.uint64(32)
    return np.unique(hashes.view(np.int64))


def _key(hashes: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(hashes.tobytes()) - 2**63


def _list_array(lists: list[np.ndarray]) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int32)
    values = np.concatenate(lists) if lists else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(offsets, values)


def sketched(docs: DataFrame, width: int) -> DataFrame:
    """(doc_id, text_key, n_shingles, set_key, coarse) per row; set_key is null for no words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys_of_text, texts = batch.columns
            for start in range(0, batch.num_rows, 1000):
                sets = [shingle_hashes(t, width) for t in texts.slice(start, 1000).to_pylist()]
                keys = [_key(s) if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(start, 1000),
                        keys_of_text.slice(start, 1000),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(keys, pa.int64()),
                        _list_array([s[:COARSE] for s in sets]),
                    ],
                    names=["doc_id", "text_key", "n_shingles", "set_key", "coarse"],
                )

    source = docs.select(
        docs["doc_id"].cast("long").alias("doc_id"), F.xxhash64(docs["text"]).alias("text_key"), docs["text"]
    )
    return by_batches(
        source, run, "doc_id long, text_key long, n_shingles long, set_key long, coarse array<long>"
    )


def _least_shared(kept: int, percent: int) -> int:
    """Values that sketches of ``kept`` values share, but for RISK, at this similarity."""
    p, total, tail = percent / 100, 0.0, 0
    while tail < kept:
        total += math.comb(kept, tail) * p**tail * (1 - p) ** (kept - tail)
        if total > RISK:
            break
        tail += 1
    return max(tail, 1)


def _indexed(size: Column, kept: int, percent: int) -> Column:
    """How many of a sketch's rarest values enter the lists."""
    shared = F.least(F.lit(_least_shared(kept, percent)), F.ceil(F.least(size, F.lit(kept)) * percent / 100))
    return F.least(size, F.lit(kept)) - shared + 1


def _listed(classes: DataFrame, column: str, kept: int, percent: int) -> DataFrame:
    """(value, node, n, alone, shared) for the rarest retained values of each class.

    Values that no other class retains make no list but count as its rarest; ``alone``
    is their number, and ``shared`` has a bit for each place of the other ones.
    """
    values = classes.select("node", "n", F.posexplode(column).alias("at", "value"))
    seen = values.groupBy("value").agg(F.count(F.lit(1)).alias("seen")).where("seen > 1")
    own = Window.partitionBy("node")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("at") % 64)
    words = [
        F.coalesce(F.bit_or(F.when(F.floor(F.col("at") / 64) == n, bit)).over(own), F.lit(0).cast("long"))
        for n in range(kept // 64)
    ]
    ranked = (
        values.join(seen.withColumnRenamed("value", "_value"), F.col("value") == F.col("_value"))
        .select("node", "n", "at", "value", "seen")
        .withColumn("alone", F.least("n", F.lit(kept)) - F.count(F.lit(1)).over(own))
        .withColumn("shared", F.array(*words).cast("array<long>"))
        .withColumn("rank", F.row_number().over(own.orderBy("seen", "value")) + F.col("alone"))
    )
    return ranked.where(F.col("rank") <= _indexed(F.col("n"), kept, percent)).select(
        "value", "node", "n", "alone", "shared"
    )


def full_sets(docs: DataFrame, chosen: DataFrame, width: int) -> DataFrame:
    """(node, n, set): the whole set of each class in ``chosen``, from the text of one document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 200):
                part = batch.slice(start, 200)
                sets = [shingle_hashes(t, width) for t in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:2], part.column(3), _list_array(sets)], names=["node", "n", "copies", "set"]
                )

    same = F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.xxhash64("text") == F.col("_key"))
    rows = docs.join(chosen, same).select("node", "n", "text", "copies")
    sets = written(by_batches(rows, run, "node long, n long, copies long, set array<long>"))
    # Only a class of several rows can have been read from a repeated row.
    once = sets.where("copies = 1").unionByName(sets.where("copies > 1").dropDuplicates(["node"]))
    return once.select("node", "n", "set")


#: Of a sketch that isn't the whole set, the values below which others are surely known.
_SURE = FINE * 3 // 4


def _slack(percent: int, sample: int) -> float:
    """How far below the similarity its estimate from a sample stays, but for some 3e-7."""
    return 5 * math.sqrt(percent / 100 * (1 - percent / 100) / sample)


def _outline(a: np.ndarray, whole_a: bool, shared: list[int], b: np.ndarray, whole_b: bool):
    """Which of b's values a holds, how many other shared ones, and its size.

    Over the whole sets if both are known, else over the values up to one within b's
    sketch, if a is known so far; else None.
    """
    if whole_b and not whole_a:
        return None
    other = np.unpackbits(np.array(shared, np.int64).view(np.uint8), bitorder="little")[: len(a)]
    if not whole_b:
        b = b[:_SURE]
        if not whole_a and a[-1] < b[-1]:
            return None
        a = a[: np.searchsorted(a, b[-1], side="right")]
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    same = b[at] == a
    bits = np.zeros(FINE, bool)
    bits[at[same]] = True
    beside = int(np.count_nonzero(other[: len(a)].astype(bool) & ~same))
    return np.packbits(bits).view(np.int64).tolist(), beside, len(a)


def _alike(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two full sets are similar enough; the sketch of the union is asked first."""
    if min(len(a), len(b)) * 100 < percent * max(len(a), len(b)):
        return False
    if max(len(a), len(b)) > FINE:
        part_a, part_b = a[:FINE], b[:FINE]
        union = np.union1d(part_a, part_b)[:FINE]
        both = np.intersect1d(part_a, part_b, assume_unique=True)
        found = np.searchsorted(both, union[-1], side="right")
        if found / len(union) < percent / 100 - _slack(percent, FINE):
            return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


COMPARED = (
    "a long, b long, n long, alone long, alike boolean, "
    "held array<long>, beside long, size long, sampled boolean"
)


def _compared(stars: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Compares each class a with its centre b, and draws its outline against the centre.

    ``held`` has a bit for each value of b's sketch that a holds, ``beside`` is the number
    of a's other values that are in more than one class.
    """
    side = lambda x: sets.select(F.col("node").alias(x), F.col("set").alias(f"set_{x}"))
    joined = stars.join(side("a"), "a").join(side("b"), "b").select(
        "a", "b", "n", "alone", "shared", "set_a", "set_b"
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            alike, shapes, sampled = [], [], []
            for shared, a, b in zip(*batch.columns[4:]):
                a, b = a.values.to_numpy(), b.values.to_numpy()
                alike.append(_alike(a, b, percent))
                shape = _outline(a[:FINE], len(a) <= FINE, shared.as_py(), b[:FINE], len(b) <= FINE)
                shapes.append(shape or (None, None, None))
                sampled.append(len(b) > FINE)
            held, beside, size = zip(*shapes) if shapes else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:4], pa.array(alike, pa.bool_()), pa.array(held, pa.list_(pa.int64())),
                    pa.array(beside, pa.int64()), pa.array(size, pa.int64()), pa.array(sampled, pa.bool_()),
                ],
                names=[field.split()[0] for field in COMPARED.split(", ")],
            )

    return written(by_batches(joined, compare, COMPARED))


def _rooms(one: pd.Series, rows: pd.DataFrame, held: np.ndarray, percent: int) -> np.ndarray:
    """Which rows may be similar to one, by sizes and by outlines against the same centre."""
    # What no other sketch retains may still be in the part of a larger set that its sketch cuts off.
    whole = (rows["n"] <= FINE) & (one["n"] <= FINE)
    most = np.minimum(rows["n"] - np.where(whole, rows["alone"], 0), one["n"] - np.where(whole, one["alone"], 0))
    room = (100 * most >= percent * (rows["n"] + one["n"] - most)).to_numpy()
    if one["held"] is not None:
        # What two share is in the centre and held by both, or beside it and shared by both.
        # The count is of unsigned words: of a negative number it would be that of its absolute value.
        both = np.bitwise_count((held & np.array(one["held"], np.int64)).view(np.uint64)).sum(1, dtype=np.int64)
        most = both + np.minimum(rows["beside"].to_numpy(), one["beside"])
        needed = percent - 100 * _slack(percent, _SURE) * bool(one["sampled"])
        enough = 100 * most >= needed * (rows["size"].to_numpy() + one["size"] - most)
        room &= enough | rows["held"].isna().to_numpy()
    return room


def _links_in_cell(cell: pd.DataFrame, percent: int) -> pd.DataFrame:
    """(a, b): links between outsiders and members of other parts, one for each pair of parts."""
    rows = cell[~cell["out"]].reset_index(drop=True)
    outsiders, links, linked = cell[cell["out"]], [], set()
    if len(rows) and len(outsiders):
        nothing = [0] * (FINE // 64)
        held = np.array([nothing if h is None else list(h) for h in rows["held"]], np.int64)
        parts, nodes, sets = (rows[name].to_numpy() for name in ("part", "node", "set"))
        for _, one in outsiders.iterrows():
            for n in np.flatnonzero((parts != one["part"]) & _rooms(one, rows, held, percent)):
                pair = (min(parts[n], one["part"]), max(parts[n], one["part"]))
                if pair not in linked and _alike(np.asarray(one["set"]), np.asarray(sets[n]), percent):
                    linked.add(pair)
                    links.append((one["node"], nodes[n]))
    return pd.DataFrame(links, columns=["a", "b"], dtype="int64")


def _links_around(compared: DataFrame, merged: DataFrame, sets: DataFrame, percent: int, block: int) -> DataFrame:
    """(a, b): links between the components in ``merged`` that share a centre, as far as it
    takes to merge them.

    Classes outside the largest component around a centre meet all classes there. Both
    sides are dealt into blocks, and a cell holds one block of each.
    """
    merged = merged.select(F.col("node").alias("_in"), "component")
    members = written(
        compared.join(merged, F.col("a") == F.col("_in"), "left").select(
            F.col("a").alias("node"), F.col("b").alias("centre"), "n", "alone", "held", "beside",
            "size", "sampled", F.coalesce("component", "a").alias("part"),
        )
    )
    parts = members.groupBy("centre", "part").agg(F.count(F.lit(1)).alias("c"), F.sum("n").alias("v"))
    split = (
        parts.groupBy("centre").agg(
            F.max(F.struct("c", "part", "v")).alias("largest"), F.sum("c").alias("all"), F.sum("v").alias("values"),
            F.count(F.lit(1)).alias("parts"),
        )
        .where("parts > 1")
        .select(
            F.col("centre").alias("_centre"), F.col("largest.part").alias("_largest"),
            F.greatest(F.ceil(F.col("all") / block), F.ceil(F.col("values") / VALUES)).alias("_blocks"),
            F.greatest(
                F.ceil((F.col("all") - F.col("largest.c")) / block),
                F.ceil((F.col("values") - F.col("largest.v")) / VALUES),
            ).alias("_out_blocks"),
        )
    )
    several = members.join(split, F.col("centre") == F.col("_centre"))
    numbers = lambda upto: F.sequence(F.lit(0).cast("long"), upto - 1)
    in_block = F.pmod(F.xxhash64("node"), F.col("_blocks"))
    out_block = F.pmod(F.xxhash64("node"), F.col("_out_blocks"))
    as_member = F.transform(numbers(F.col("_out_blocks")), lambda k: F.struct(in_block.alias("i"), k.alias("j"), F.lit(False).alias("out")))
    as_outsider = F.transform(numbers(F.col("_blocks")), lambda k: F.struct(k.alias("i"), out_block.alias("j"), F.lit(True).alias("out")))
    places = F.when(F.col("part") == F.col("_largest"), as_member).otherwise(F.concat(as_member, as_outsider))
    cells = (
        several.join(sets.select(F.col("node").alias("_node"), "set"), F.col("node") == F.col("_node"))
        .select(
            "centre", "node", "n", "alone", "held", "beside", "size", "sampled", "part", "set",
            F.inline(places),
        )
    )
    return written(
        cells.groupBy("centre", "i", "j").applyInPandas(lambda cell: _links_in_cell(cell, percent), "a long, b long")
    )


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, block: int = BLOCK) -> DataFrame:
    """(doc_id, text_key, n_shingles, component_id, kept, chosen) for every row of ``docs``.

    Rows are linked whose sets of ``width``-word shingles have a Jaccard similarity of at
    least ``percent`` in a hundred; component_id is the smallest doc_id that links reach,
    and a row is kept if that is its own. Null and empty texts, and those without words,
    are linked with nothing. Repeated rows, and ones with equal ids, are rows of their
    own. A row without id is in its component but cannot name it: where no row of a
    component has an id, component_id is null. It is kept only if nothing links it to a
    row with an id. An empty table gives an empty result. ``text_key`` is the xxhash64 of
    the text, which tells rows with equal ids apart. ``chosen`` marks the row of each
    component with the smallest id, of these the smallest text key, and its exact
    copies; it marks every row without words.
    """
    docs = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text"))
    rows = written(sketched(docs, width))
    one = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_key")
    classes = written(
        rows.where("set_key is not null").groupBy(F.col("set_key").alias("node")).agg(
            F.min(one).alias("one"), F.count(F.lit(1)).alias("copies"),
            F.first("n_shingles").alias("n"), F.first("coarse").alias("coarse"),
        )
    )
    coarse = written(_listed(classes, "coarse", COARSE, percent).select("value", "node"))
    near = coarse.groupBy("value").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    some = (
        coarse.join(near.select(F.col("value").alias("_value")), F.col("value") == F.col("_value"))
        .select(F.col("node").alias("_node")).distinct()
    )
    chosen = classes.join(some, F.col("node") == F.col("_node"), "left_semi").select(
        "node", "n", "copies", F.col("one.doc_id").alias("_doc"), F.col("one.text_key").alias("_key")
    )
    sets = written(full_sets(docs, chosen, width))
    fine = sets.select("node", "n", F.slice("set", 1, FINE).alias("fine"))
    listed = written(_listed(fine, "fine", FINE, percent))
    centre = listed.groupBy("value").agg(
        F.min(F.struct("alone", "node")).alias("c"), F.count(F.lit(1)).alias("members")
    ).where("members > 1").select(F.col("value").alias("_value"), F.col("c.node").alias("centre"))
    # Whoever shares a list has its centre in common, so centres stand for lists from here.
    stars = written(
        listed.join(centre, F.col("value") == F.col("_value"))
        .select(F.col("node").alias("a"), F.col("centre").alias("b"), "n", "alone", "shared").distinct()
    )
    compared = _compared(stars, sets, percent)
    merged = connected(compared.where("alike and a != b").select("a", "b"))
    around = _links_around(compared, merged, sets, percent, block)
    parts = connected(merged.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(around))
    first = parts.join(classes.select("node", F.col("one").alias("own")), "node").groupBy("component").agg(
        F.min("own").alias("first")
    )
    named = parts.join(first, "component").select(F.col("node").alias("_node"), "first")
    # Written, so that a class of very many rows can be divided among tasks when they are joined.
    result = written(
        classes.select("node", "one").join(named, F.col("node") == F.col("_node"), "left").select(
            F.col("node").alias("_node"), F.coalesce("first", "one").alias("first")
        )
    )
    rows = rows.select("doc_id", "text_key", "n_shingles", "set_key")
    by_class = rows.join(result, F.col("set_key") == F.col("_node"))
    component = F.col("first.doc_id")
    chosen = F.col("doc_id").eqNullSafe(component) & (F.col("text_key") == F.col("first.text_key"))
    wordless = rows.where("set_key is null").select(
        "doc_id", "text_key", "n_shingles", F.col("doc_id").alias("component_id"),
        F.lit(True).alias("kept"), F.lit(True).alias("chosen"),
    )
    return by_class.select(
        "doc_id", "text_key", "n_shingles", component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"), chosen.alias("chosen"),
    ).unionByName(wordless)
