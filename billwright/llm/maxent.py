"""Scores of texts under a hashed maximum-entropy model with class-factored softmax.

P(word | history) = P(class | history) * P(word | class). A word's class follows from
its ending. The class is a softmax over hashed features of the history: the word
before, the word before that (a skip), and both together. Its weights are trained by
gradient steps in every task, whose results are averaged by use over all tasks and sent
out again. The word within its class is a softmax with one weight for each word, which
has a closed form: add-one counts, with one place for all unknown words.

Texts are read once and packed: a row holds about a million tokens as numbers into the
row's own list of words, so that a row is all that a task needs to train. Rows are named by
the task that packed them and their place in it, which also says in which round they train,
and what tasks learned is added up in integers: the same table gives the same scores. Words are told
apart by a hash of 64 bits. Counts of the corpus are taken over the rows' word lists and
go back to the rows; tokens are never shuffled one by one.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from billwright.llm.common import by_batches, written

#: Classes (the end of a text is one), the fewest buckets of features, and synchronised rounds.
CLASSES = 16
BUCKETS = 1 << 15
ROUNDS = 2
#: Words of the vocabulary to a bucket, and the most buckets: what a worker holds of weights.
WORDS_PER_BUCKET = 64
MOST_BUCKETS = 1 << 20
TOKENS_PER_ROW = 1_000_000
_STEP = 16_384
_RATE = 0.7
END = b"\n"  # no word holds white space
_FEATURES = 3
#: Bits of a row's name for its place in its task, and the parts of a weight that are added up.
_PLACES = 32
_GRAIN = 2.0**-16
_START = np.uint64(0x51ED270B)

PACKED = (
    "row long, doc_ids array<long>, held array<boolean>, sizes array<int>, ids binary, "
    "hashes array<long>, classes array<tinyint>, train array<int>"
)


def word_hash(word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(word)


def word_class(word: bytes) -> int:
    """0 for the end of a text, else from the word's last two bytes."""
    return 0 if word == END else 1 + xxhash.xxh32_intdigest(word[-2:]) % (CLASSES - 1)


def _folded(ids: np.ndarray) -> bytes:
    """Numbers byte by byte, as most of their upper bytes are 0."""
    return zstandard.compress(ids.astype(np.int32).view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def _unfolded(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view(np.int32).ravel()


def pack(docs: DataFrame, held_out: Column) -> DataFrame:
    """Rows of about a million tokens, written once.

    ``sizes`` are the tokens of each document, its end included; ``ids`` number the
    row's own words, which are there as ``hashes`` and ``classes``, and ``train`` counts
    each word in documents that aren't held. A document is never divided.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        doc_ids, held, sizes, ids, known, total = [], [], [], [], {END: 0}, 0
        name = TaskContext.get().partitionId() << _PLACES

        def row() -> pa.RecordBatch:
            flat = np.concatenate(ids)
            learned = np.repeat(~np.array(held), sizes)
            train = np.bincount(flat[learned], minlength=len(known)).astype(np.int32)
            hashes = np.array([word_hash(w) for w in known], np.uint64).view(np.int64)
            values = (
                name, doc_ids, held, sizes, _folded(flat), hashes,
                np.array(list(map(word_class, known)), np.int8), train,
            )
            types = (
                pa.int64(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.int32()), pa.binary(),
                pa.list_(pa.int64()), pa.list_(pa.int8()), pa.list_(pa.int32()),
            )
            return pa.RecordBatch.from_arrays(
                [pa.array([v], t) for v, t in zip(values, types)],
                names=[field.split()[0] for field in PACKED.split(", ")],
            )

        for batch in batches:
            for doc_id, text, out in zip(*(column.to_pylist() for column in batch.columns)):
                words = (text or "").encode().lower().split()
                own = [known.setdefault(word, len(known)) for word in words]
                own.append(0)
                doc_ids.append(doc_id)
                held.append(out)
                sizes.append(len(own))
                ids.append(np.array(own, np.int32))
                total += len(own)
                if total >= TOKENS_PER_ROW:
                    yield row()
                    doc_ids, held, sizes, ids, known, total = [], [], [], [], {END: 0}, 0
                    name += 1
        if doc_ids:
            yield row()

    source = docs.select(
        docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text"), held_out.alias("held")
    )
    return written(by_batches(source, run, PACKED))


def bucket_count(kinds: int) -> int:
    """Buckets for a vocabulary of so many words, a power of two."""
    wanted = 1 << round(math.log2(max(kinds, 1) / WORDS_PER_BUCKET)) if kinds > WORDS_PER_BUCKET else 1
    return min(MOST_BUCKETS, max(BUCKETS, wanted))


def _mixed(values: np.ndarray, salt: int, count: int) -> np.ndarray:
    values = (values ^ np.uint64(salt)) * np.uint64(0x9E3779B97F4A7C15)
    return ((values ^ (values >> np.uint64(31))) % np.uint64(count)).astype(np.int32)


def features(ids: np.ndarray, sizes: np.ndarray, hashes: np.ndarray, count: int = BUCKETS) -> np.ndarray:
    """The buckets of each token's history out of ``count``, a row for each kind of feature."""
    own = hashes[ids]
    first = np.cumsum(sizes) - sizes
    one, two = np.roll(own, 1), np.roll(own, 2)
    one[first] = two[first] = _START
    two[(first + 1)[sizes > 1]] = _START
    both = one * np.uint64(0xC2B2AE3D27D4EB4F) + two
    return np.stack([_mixed(one, 1, count), _mixed(two, 2, count), _mixed(both, 3, count)])


def class_log_odds(weights: np.ndarray, buckets: np.ndarray) -> np.ndarray:
    """log P(class | history) of each token; the last row of the weights is the bias."""
    scores = weights[-1] + weights[buckets[0]]
    for row in buckets[1:]:
        scores += weights[row]
    scores -= scores.max(1, keepdims=True)
    scores -= np.log(np.exp(scores).sum(1, keepdims=True))
    return scores


def _descend(weights: np.ndarray, used: np.ndarray, buckets: np.ndarray, classes: np.ndarray) -> None:
    """Gradient steps over the tokens in their order; a bucket's steps shorten with its use."""
    for low in range(0, buckets.shape[1], _STEP):
        some, truth = buckets[:, low : low + _STEP], classes[low : low + _STEP]
        slope = np.exp(class_log_odds(weights, some))
        slope[np.arange(len(truth)), truth] -= 1
        weights[-1] -= _RATE * slope.mean(0) / np.sqrt(1 + used[-1] / _STEP / 10)
        used[-1] += len(truth)
        for row in some:
            order = np.argsort(row, kind="stable")
            sorted_ = row[order]
            begin = np.flatnonzero(np.append(True, sorted_[1:] != sorted_[:-1]))
            count = np.diff(np.append(begin, len(row))).astype(np.float32)
            at = sorted_[begin]
            total = np.add.reduceat(slope[order], begin)
            weights[at] -= total * (_RATE / (count + 4) / np.sqrt(1 + used[at] / 200))[:, None]
            used[at] += count


def _trained(packed: DataFrame, weights: np.ndarray) -> np.ndarray:
    """One synchronised round over the documents of ``packed`` that aren't held out."""
    shared = packed.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value.copy()
        used = np.zeros(len(own), np.float32)
        for batch in batches:
            for n in range(batch.num_rows):
                held, sizes, hashes = (batch.column(c)[n].values.to_numpy(zero_copy_only=False) for c in range(3))
                ids = _unfolded(batch.column(3)[n].as_py())
                buckets = features(ids, sizes, hashes.view(np.uint64), len(own) - 1)
                classes = batch.column(4)[n].values.to_numpy()[ids]
                learned = np.repeat(~held.astype(bool), sizes)
                _descend(own, used, buckets[:, learned], classes[learned])
        at = np.flatnonzero(used)
        for some in np.array_split(at, max(1, len(at) // 8192)) if len(at) else ():
            moved = np.rint(own[some].astype(np.float64) * used[some, None] / _GRAIN).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(some.astype(np.int32)), pa.array(used[some].astype(np.int64)), *map(pa.array, moved.T.copy())],
                names=["bucket", "used", *(f"w{c}" for c in range(CLASSES))],
            )

    names = ["used", *(f"w{c}" for c in range(CLASSES))]
    steps = packed.select("held", "sizes", "hashes", "ids", "classes").mapInArrow(
        run, "bucket int, " + ", ".join(f"{name} long" for name in names)
    )
    # As many rows as the model has buckets.
    rows = steps.groupBy("bucket").agg(*[F.sum(name).alias(name) for name in names]).toPandas()
    after = weights.copy()
    if len(rows):
        moved = rows[names[1:]].to_numpy() * _GRAIN / rows[["used"]].to_numpy()
        after[rows["bucket"].to_numpy()] = moved.astype(np.float32)
    return after


@dataclass
class Totals:
    """Tokens and distinct tokens learned from, for all and for each class."""

    tokens: int
    kinds: int
    class_tokens: np.ndarray
    class_kinds: np.ndarray


def counted(packed: DataFrame) -> DataFrame:
    """(row, at, count, first, class): how often the documents to learn from have each word of a row.

    ``first`` is set for one of the rows that share a word. One shuffle of the rows' word
    lists; the most frequent word is in it once for each packed row.
    """
    words = F.posexplode(F.arrays_zip("hashes", "train", "classes"))
    each = packed.select("row", words.alias("at", "w")).select(
        "row", "at", F.col("w.hashes").alias("hash"), F.col("w.train").alias("train"),
        F.col("w.classes").alias("class"),
    )
    same = Window.partitionBy("hash")
    count = F.sum("train").over(same)
    place = F.struct("row", "at")
    return written(each.select(
        "row", "at", count.alias("count"),
        ((F.min(place).over(same) == place) & (count > 0)).alias("first"), "class",
    ))


def totals(counts: DataFrame) -> Totals:
    rows = counts.where("first").groupBy("class").agg(
        F.sum("count").alias("tokens"), F.count(F.lit(1)).alias("kinds")
    ).collect()
    tokens, kinds = np.zeros(CLASSES, np.int64), np.zeros(CLASSES, np.int64)
    for row in rows:
        tokens[row["class"]], kinds[row["class"]] = row["tokens"], row["kinds"]
    return Totals(int(tokens.sum()), int(kinds.sum()), tokens, kinds)


def _rated(packed: DataFrame, weights: np.ndarray, known: Totals) -> DataFrame:
    """Scores of the documents of rows that have the counts of their words."""
    shared = packed.sparkSession.sparkContext.broadcast((weights, known))
    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, known = shared.value
        for batch in batches:
            for n in range(batch.num_rows):
                doc_ids, held, sizes, hashes, found = (batch.column(c)[n].values for c in range(5))
                sizes, hashes = sizes.to_numpy(), hashes.to_numpy().view(np.uint64)
                ids = _unfolded(batch.column(5)[n].as_py())
                classes = batch.column(6)[n].values.to_numpy()
                counts = np.empty(len(classes), np.int64)
                counts[found.field(0).to_numpy()] = found.field(1).to_numpy()
                base = np.log10((counts + 1) / (known.tokens + known.kinds + 1))
                within = np.log10((counts + 1) / (known.class_tokens + known.class_kinds + 1)[classes])
                buckets = features(ids, sizes, hashes, len(weights) - 1)
                score = np.empty(len(ids))
                for low in range(0, len(ids), _STEP):
                    of = classes[ids[low : low + _STEP]]
                    odds = class_log_odds(weights, buckets[:, low : low + _STEP])
                    score[low : low + _STEP] = odds[np.arange(len(of)), of] / np.log(10)
                begin = np.cumsum(sizes) - sizes
                sums = (np.add.reduceat(x[ids], begin) for x in ((counts > 0).astype(np.int64), base))
                yield pa.RecordBatch.from_arrays(
                    [
                        doc_ids, held, pa.array(sizes.astype(np.int64)), *map(pa.array, (
                            next(sums), np.full(len(sizes), known.tokens), next(sums),
                            np.add.reduceat(score + within[ids], begin),
                        )),
                    ],
                    names=[field.split()[0] for field in schema.split(", ")],
                )

    return packed.select("doc_ids", "held", "sizes", "hashes", "counts", "ids", "classes").mapInArrow(run, schema)


def score(docs: DataFrame, held_out: Column) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row.

    A text's tokens are its words, A-Z lower-cased and separated by ASCII white space,
    and one end. ``base_score`` adds log10 of (c + 1) / (N + V + 1), with c the token's
    count, N all tokens and V distinct ones in the documents that aren't held out;
    ``score`` is the log10 probability under the model. Known tokens have c > 0.

    Null and empty texts are one end. Rows whose ``held_out`` is null are held out. Rows
    are independent; repeated rows are learned from as often as they occur. With nothing
    to learn from, N is 0 and every class is equally likely. No rows give no rows.
    """
    packed = pack(docs, F.coalesce(held_out, F.lit(True)))
    counts = counted(packed)
    known = totals(counts)
    weights = np.zeros((bucket_count(known.kinds) + 1, CLASSES), np.float32)
    # Tasks and the rows of a task take turns, so that rounds have equally many rows.
    turn = F.shiftright("row", _PLACES) + F.col("row")
    for number in range(ROUNDS):
        weights = _trained(packed.where(F.pmod(turn, F.lit(ROUNDS)) == number), weights)
    found = counts.groupBy(F.col("row").alias("_row")).agg(
        F.collect_list(F.struct("at", "count")).alias("counts")
    )
    return _rated(packed.drop("train").join(found, F.col("row") == F.col("_row")), weights, known)
