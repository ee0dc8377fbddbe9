"""Mixing sources to target weights by Sainte-Laguë apportionment of equal blocks of words.

The words of a source are dealt into shards of a few thousand documents, and a shard's
documents, in seeded order, form one stream that is cut into blocks of equally many
words. Highest quotients give each source a number of blocks, and again each shard of
the source. A shard with a quota of q of its n blocks takes every block q // n times and
q % n of them once more, evenly spaced from a seeded start; as the stream is in seeded
order, that is a seeded choice of words. What a document gives follows from its place
in the stream alone, so blocks are never made into rows.

The driver sees one row per source; a task sees one shard's documents, or one row per
shard of a source.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from billwright.llm.common import WORD_PATTERN, bounded, by_batches, written

SHARD_DOCS = 4096


def water_fill(sizes: Sequence[int], weights: Sequence[float], share: float, most: float) -> list[float]:
    """``share`` of all sizes by weight; none above ``most`` times its size, the rest reshared."""
    sizes, weights = np.asarray(sizes, float), np.asarray(weights, float)
    targets, open_ = np.zeros(len(sizes)), np.ones(len(sizes), bool)
    while open_.any():
        left = share * sizes.sum() - targets[~open_].sum()
        targets[open_] = left * weights[open_] / weights[open_].sum()
        above = open_ & (targets > most * sizes)
        if not above.any():
            break
        targets[above] = most * sizes[above]
        open_ &= ~above
    return targets.tolist()


def sainte_lague(weights: Sequence[float], seats: int, most: Sequence[int]) -> list[int]:
    """Seats by highest quotient weight / (2 * seats so far + 1), none above its ``most``.

    Equal quotients go to the earlier party. Where ``most`` leaves too little room,
    some seats stay empty. Parties without weight get none.
    """
    weights, most = np.asarray(weights, float), np.asarray(most, np.int64)
    most = np.where(weights > 0, most, 0)
    seats = min(int(seats), int(most.sum()))
    if seats <= 0:
        return [0] * len(weights)
    given = lambda price: np.minimum(most, np.floor(weights / price + 0.5)).astype(np.int64)
    low, high = float(weights.sum()) / (seats + len(weights)) / 4, 3 * float(weights.max())
    while given(low).sum() < seats:
        low /= 2
    for _ in range(200):  # the price of a seat, from above: at most as many as there are
        middle = (low + high) / 2
        low, high = (middle, high) if given(middle).sum() > seats else (low, middle)
    got = given(high)
    heap = [(-w / (2 * g + 1), n) for n, (w, g, m) in enumerate(zip(weights, got, most)) if g < m]
    heapq.heapify(heap)
    for _ in range(seats - int(got.sum())):
        _, n = heapq.heappop(heap)
        got[n] += 1
        if got[n] < most[n]:
            heapq.heappush(heap, (-weights[n] / (2 * got[n] + 1), n))
    return got.tolist()


def _shard_quotas(shards: pd.DataFrame, most: int) -> pd.DataFrame:
    """One source's shards with their share of its blocks."""
    shards = shards.sort_values("_shard")
    shards["_quota"] = sainte_lague(
        shards["_words"].to_numpy(), int(shards["_seats"].iloc[0]), most * shards["_blocks"].to_numpy()
    )
    return shards[["_source", "_shard", "_blocks", "_quota"]]


def mix(
    docs: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, most: int = 2,
    block_words: int = 32, seed: int = 0, keep: Sequence[str] = (),
) -> DataFrame:
    """(doc_id, size, source_size, target, taken) per row of ``docs``, and the plan of its cut.

    Sources, by code point with null last, weigh ``weights`` in turn and share ``share``
    times all words; a target stops at ``most`` times its source's words and the excess
    is reshared. ``taken`` counts the words that the mix takes, repeats included: at most
    ``most`` times the size. ``_cut`` tells where the document lies in its shard's stream
    and which blocks that takes, for ``taken_texts``; columns in ``keep`` come along.

    Null text has size 0 and gives nothing, a source without words has target 0, and an
    empty table gives an empty result. Rows with equal or null ids are rows of their own;
    id and text say where in the mix a row lies. Where copies of one row overfill a shard,
    it is divided by the places of its rows in the input.
    """
    spark = docs.sparkSession
    source = docs.select(
        docs["text"].alias("_text"), docs["doc_id"].cast("long").alias("doc_id"),
        docs["source"].alias("_source"), F.xxhash64(F.lit(seed), docs["doc_id"], docs["text"]).alias("_chance"),
        *[docs[name].alias(f"_kept_{name}") for name in keep],
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = TaskContext.get().partitionId() << 33
        for batch in batches:
            for start, count in bounded(batch.column(0), 4_000_000):
                some = batch.slice(start, count)
                sizes = [len((text or "").encode().split()) for text in some.column(0).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(sizes, pa.int64()), pa.array(range(place, place + count), pa.int64()), *some.columns[1:]],
                    names=["size", "_row", *some.schema.names[1:]],
                )
                place += count

    schema = StructType([
        StructField("size", LongType()), StructField("_row", LongType()), *source.schema.fields[1:]
    ])
    sized = by_batches(source, count, schema)
    if not keep:  # counting texts again costs less than writing them
        sized = written(sized)
    totals = sized.groupBy("_source").agg(
        F.sum("size").alias("words"), F.count(F.lit(1)).alias("docs")
    ).collect()
    totals.sort(key=lambda row: (row["_source"] is None, row["_source"] or ""))
    own = [float(weights[n % len(weights)]) for n in range(len(totals))]
    targets = water_fill([row["words"] for row in totals], own, share, most)
    seats = sainte_lague(
        targets,
        round(sum(targets) / block_words),
        [most * (-(-row["words"] // block_words) + -(-row["docs"] // SHARD_DOCS)) for row in totals],
    )
    sources = spark.createDataFrame(
        [
            (row["_source"], row["words"], target, n, -(-row["docs"] // SHARD_DOCS))
            for row, target, n in zip(totals, targets, seats)
        ],
        "_source string, source_size long, target double, _seats long, _shards long",
    )

    in_source = sized.join(
        sources.withColumnRenamed("_source", "_of"), F.col("_source").eqNullSafe(F.col("_of"))
    ).select(
        *sized.columns, "source_size", "target", "_seats", F.pmod("_chance", F.col("_shards")).alias("_first"),
    )
    # Few shards if any: it takes thousands of copies of one row to fill one twice over.
    full = written(
        in_source.groupBy(F.col("_source").alias("_of"), F.col("_first").alias("_in"))
        .agg(F.ceil(F.count(F.lit(1)) / SHARD_DOCS).alias("_parts")).where("_parts > 2")
    )
    part = F.when(F.col("_parts").isNotNull(), F.pmod(F.xxhash64(F.lit(seed), "_row"), F.col("_parts"))).otherwise(0)
    dealt = in_source.join(
        full, F.col("_source").eqNullSafe(F.col("_of")) & (F.col("_first") == F.col("_in")), "left"
    ).withColumn("_shard", F.shiftleft("_first", 31) + part).drop("_of", "_in", "_parts", "_first")
    shards = dealt.groupBy("_source", "_shard", "_seats").agg(F.sum("size").alias("_words")).withColumn(
        "_blocks", F.ceil(F.col("_words") / block_words)
    )
    # Written, so that Spark knows that it is small and need not shuffle texts to join it.
    quotas = written(
        shards.groupBy("_source").applyInPandas(
            lambda rows: _shard_quotas(rows, most),
            "_source string, _shard long, _blocks long, _quota long",
        ).select(F.col("_source").alias("_of"), F.col("_shard").alias("_in"), "_blocks", "_quota")
    )

    stream = Window.partitionBy("_source", "_shard").orderBy("_chance", "doc_id", "size", "_row")
    placed = dealt.withColumn(
        "_end", F.sum("size").over(stream.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    )
    blocks = F.greatest(F.col("_blocks"), F.lit(1))
    cut = F.struct(
        (F.col("_end") - F.col("size")).alias("begin"),
        F.col("_end").alias("end"),
        F.floor(F.col("_quota") / blocks).alias("whole"),
        (F.col("_quota") % blocks).alias("more"),
        blocks.alias("blocks"),
        F.pmod(F.xxhash64(F.lit(seed + 1), "_source", "_shard"), blocks).alias("phase"),
        F.lit(block_words).cast("long").alias("block_words"),
    )
    cut_rows = placed.join(
        quotas, F.col("_source").eqNullSafe(F.col("_of")) & (F.col("_shard") == F.col("_in"))
    ).withColumn("_cut", cut)
    extra = _chosen_below(F.col("_cut.end")) - _chosen_below(F.col("_cut.begin"))
    return cut_rows.select(
        "doc_id", "size", "source_size", "target",
        (F.col("_cut.whole") * F.col("size") + extra).alias("taken"),
        "_cut", *[F.col(f"_kept_{name}").alias(name) for name in keep],
    )


def _chosen_below(place: Column) -> Column:
    """How many words before ``place`` of the stream are in blocks that are taken once more."""
    block_words, block = F.col("_cut.block_words"), F.floor(place / F.col("_cut.block_words"))
    upto = lambda n: F.expr("1L") * F.floor((n * F.col("_cut.more") + F.col("_cut.phase")) / F.col("_cut.blocks"))
    return upto(block) * block_words + (place % block_words) * (upto(block + 1) - upto(block))


def _ranges(cut: dict) -> list[tuple[int, int]]:
    """The document's words, as (first, last + 1), that are taken once more."""
    found: list[tuple[int, int]] = []
    width, more, phase, blocks = cut["block_words"], cut["more"], cut["phase"], cut["blocks"]
    upto = lambda n: (n * more + phase) // blocks
    for block in range(cut["begin"] // width, -(-cut["end"] // width)) if more else ():
        if upto(block + 1) > upto(block):
            low = max(cut["begin"], block * width) - cut["begin"]
            high = min(cut["end"], (block + 1) * width) - cut["begin"]
            if found and found[-1][1] == low:
                found[-1] = (found[-1][0], high)
            elif low < high:
                found.append((low, high))
    return found


def taken_texts(mixed: DataFrame) -> DataFrame:
    """The mix itself, from ``mix(..., keep=("text", ...))``.

    A document comes as often as it is taken whole, and once more with the words that
    are taken besides: unbroken passages of the text, with a line break between them.
    One of which nothing is taken is not in the mix.
    """
    word = re.compile(WORD_PATTERN)
    schema = mixed.schema
    names = [field.name for field in schema]
    text_at, cut_at = names.index("text"), names.index("_cut")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, texts = [], []
            for n, (text, cut) in enumerate(
                zip(batch.column(text_at).to_pylist(), batch.column(cut_at).to_pylist())
            ):
                for _ in range(cut["whole"] if cut["end"] > cut["begin"] else 0):
                    rows.append(n)
                    texts.append(text)
                if ranges := _ranges(cut):
                    spans = [match.span() for match in word.finditer(text)]
                    rows.append(n)
                    texts.append("\n".join(text[spans[a][0] : spans[b - 1][1]] for a, b in ranges))
            if rows:
                taken = batch.take(pa.array(rows))
                yield taken.set_column(text_at, batch.schema.field(text_at), pa.array(texts, pa.string()))

    return by_batches(mixed, run, schema).drop("size", "source_size", "target", "taken", "_cut")
