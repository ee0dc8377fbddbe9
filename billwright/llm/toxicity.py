"""Toxic spans by a linear-chain conditional random field of two states.

Labels say which documents are toxic, not which words. Words, and beginnings of words,
that come in toxic documents many times as often as in others mark the toxic tokens
of the labelled documents; the field is fitted to these and generalises over beginnings
and over neighbouring words. Forward and backward odds give every token's marginal, the
marginals give a document's score, and runs of likely tokens are its offending offsets.

The model is fitted by the driver on a bounded sample and has a fixed size. Scoring needs
nothing but the text and the model, so nothing is shuffled. All texts of a batch are cut
into segments that go through the recursions side by side; a segment's transfer matrix
carries the exact messages over the cuts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StructField, StructType

from billwright.llm.common import bounded, by_batches, crc_remainder, written

#: Labelled documents of either label that the field is fitted to, chosen by a hash.
MOST_PER_LABEL = 1500
#: Characters of one of them, from its beginning, and of all together.
MOST_CHARS, MOST_CHARS_IN_ALL = 1_000_000, 32_000_000
#: How much more often a feature has to be in toxic documents, and in how many at least.
TELLING, LEAST_DOCS = 20.0, 5
WEIGHTS = 1 << 18
REJECT = 0.7
_SEGMENT = 512
_BYTES = 4_000_000  # of text that is scored together
_MOST_FEATURES = 6
_KNOWN = 250_000
_WORD = re.compile(r"[^\W\d_]+")


def _features(word: str) -> list[int]:
    """Places of the word itself, of its beginnings and of its ending among the weights."""
    word = word.lower()
    names = [f"w:{word}", f"s:{word[-3:]}"] + [f"p:{word[:n]}" for n in (3, 4, 5, 6) if len(word) > n]
    return [xxhash.xxh3_64_intdigest(name.encode()) % WEIGHTS for name in names]


@dataclass
class Field:
    """``emission`` scores a toxic token, ``move[i, j]`` a step from state i to j (1: toxic).

    ``link`` turns a document's highest log-odds and expected number of toxic tokens
    into its score; without it there was nothing to learn from and every score is 0.
    """

    emission: np.ndarray
    move: np.ndarray
    link: np.ndarray | None

    def of_words(self, words: list[str]) -> np.ndarray:
        return np.array([self.emission[_features(word)].sum() for word in words], np.float32)


def marginals(scores: np.ndarray, lengths: np.ndarray, move: np.ndarray, pairs: bool = False):
    """The chance that each token is toxic, for texts laid end to end; empty ones are fine.

    With ``pairs``, also the expected number of steps between states.
    """
    count = -(-lengths // _SEGMENT)
    text_of = np.repeat(np.arange(len(lengths)), count)
    nth = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    first = np.repeat(np.cumsum(lengths) - lengths, count) + nth * _SEGMENT
    size = np.minimum(np.repeat(lengths, count) - nth * _SEGMENT, _SEGMENT)
    if not len(size):
        return (np.zeros(0), np.zeros((2, 2))) if pairs else np.zeros(0)
    order = np.argsort(-size, kind="stable")  # the active segments are always the first
    rank = np.empty_like(order)
    rank[order] = np.arange(len(order))
    first, size, text_of = first[order], size[order], text_of[order]
    active = np.searchsorted(-size, -np.arange(1, size[0] + 1), side="right")
    grown = np.exp(np.clip(scores.astype(np.float64), -30, 30))
    (a00, a01), (a10, a11) = np.exp(move)

    # Transfer matrix of each segment: columns for the state before it, scaled.
    n = len(size)
    t0, t1, o0, o1 = np.zeros(n), np.ones(n), np.ones(n), np.zeros(n)
    cut = bool((count > 1).any())
    for step, k in enumerate(active if cut else ()):
        e = grown[first[:k] + step]
        nt0, no0 = e * (a11 * t0[:k] + a01 * o0[:k]), a10 * t0[:k] + a00 * o0[:k]
        nt1, no1 = e * (a11 * t1[:k] + a01 * o1[:k]), a10 * t1[:k] + a00 * o1[:k]
        scale = np.maximum(np.maximum(nt0, no0), np.maximum(nt1, no1))
        t0[:k], o0[:k], t1[:k], o1[:k] = nt0 / scale, no0 / scale, nt1 / scale, no1 / scale
    before, behind = np.zeros(n), np.ones(n)  # odds of toxic: ahead of the first, after the last token
    if cut:
        starts = np.cumsum(count) - count
        for text in np.flatnonzero(count > 1):
            places = rank[starts[text] : starts[text] + count[text]]
            odds = 0.0
            for here, there in zip(places[:-1], places[1:]):
                odds = (t0[here] + t1[here] * odds) / max(o0[here] + o1[here] * odds, 1e-300)
                before[there] = odds
            odds = 1.0
            for here, there in zip(places[-2::-1], places[:0:-1]):
                odds = (t1[there] * odds + o1[there]) / max(t0[there] * odds + o0[there], 1e-300)
                behind[here] = odds

    forward, chance = np.empty(len(grown)), np.empty(len(grown))
    odds = before.copy()
    for step, k in enumerate(active):
        at = first[:k] + step
        odds[:k] = np.clip(grown[at] * (a11 * odds[:k] + a01) / (a10 * odds[:k] + a00), 1e-150, 1e150)
        forward[at] = odds[:k]
    odds = behind.copy()
    steps = np.zeros((2, 2))
    for step in range(len(active) - 1, -1, -1):
        k = active[step]
        at = first[:k] + step
        both = np.clip(forward[at] * odds[:k], 1e-150, 1e150)
        chance[at] = both / (1 + both)
        ahead = np.clip(grown[at] * odds[:k], 1e-150, 1e150)
        if pairs:
            came = forward[at - 1] if step else before[:k]
            tt, to, ot, oo = came * a11 * ahead, came * a10, a01 * ahead, a00
            total = tt + to + ot + oo
            steps += [[(oo / total).sum(), (ot / total).sum()], [(to / total).sum(), (tt / total).sum()]]
        odds[:k] = np.clip((a11 * ahead + a10) / (a01 * ahead + a00), 1e-150, 1e150)
    return (chance, steps) if pairs else chance


def _summary(chance: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """(1, highest log-odds, log of 1 + expected toxic tokens) for each text."""
    found = np.tile([1.0, -12.0, 0.0], (len(lengths), 1))
    full = np.flatnonzero(lengths > 0)
    if len(full):
        begin = (np.cumsum(lengths) - lengths)[full]
        top = np.clip(np.maximum.reduceat(chance, begin), 1e-6, 1 - 1e-6)
        found[full, 1] = np.clip(np.log(top / (1 - top)), -12, 12)
        found[full, 2] = np.log1p(np.add.reduceat(chance, begin))
    return found


def _logistic(x: np.ndarray, y: np.ndarray, rate: float) -> np.ndarray:
    """Weights by Newton's method with a small penalty, as if a share ``rate`` were of class 1."""
    weight = np.where(y == 1, rate / max(1, y.sum()), (1 - rate) / max(1, (1 - y).sum())) * len(y)
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (weight * (p - y)) + 0.1 * w
        w -= np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(len(w)), gradient)
    return w


def _marked(texts: list[np.ndarray], toxic: np.ndarray, features: np.ndarray) -> np.ndarray:
    """For each weight whether its feature tells toxic documents; copies of one count once.

    ``texts`` number their words, ``features`` has the places of each word, or -1.
    """
    seen: set[int] = set()
    counts, number = np.zeros((2, WEIGHTS), np.int32), np.zeros(2, int)
    for words, label in zip(texts, toxic):
        three = words.astype(np.uint64)
        three = (three[:-2] * np.uint64(0x9E3779B97F4A7C15) ^ three[1:-1]) * np.uint64(0xC2B2AE3D27D4EB4F) ^ three[2:]
        rare = np.unique(three * np.uint64(0x165667B19E3779F9))[:4].tolist() if len(words) > 2 else []
        if not seen.isdisjoint(rare):
            continue
        seen.update(rare)
        number[label] += 1
        own = np.unique(features[np.unique(words)])
        counts[label, own[own >= 0]] += 1
    rate = (counts + 0.5) / (number + 1)[:, None]
    return (counts[1] >= LEAST_DOCS) & (rate[1] >= TELLING * rate[0])


def fit(texts: list[str], toxic: list[int], rate: float, rounds: int = 40) -> Field:
    """The field for labelled texts; a third of them sets the link to scores.

    ``rate`` is the share of toxic documents where the texts come from, which may be
    another than that among the texts.
    """
    field = Field(np.zeros(WEIGHTS, np.float32), np.zeros((2, 2)), None)
    label = np.array(toxic, int)
    vocabulary: dict[str, int] = {}
    numbered = []
    for text in texts:
        words = _WORD.findall(text)
        numbered.append(np.array([vocabulary.setdefault(w, len(vocabulary)) for w in words], np.int32))
    own = np.random.default_rng(0).permutation(len(texts)) % 3 < 2
    if not (label[own].any() and label[~own].any() and (label[own] == 0).any() and (label[~own] == 0).any()):
        return field
    places = np.full((len(vocabulary), _MOST_FEATURES), -1, np.int32)
    for word, n in vocabulary.items():
        found = _features(word)
        places[n, : len(found)] = found
    telling = _marked([n for n, o in zip(numbered, own) if o], label[own], places)
    at, column = np.nonzero(places >= 0)
    flat = places[at, column]
    marked = np.zeros(len(vocabulary), bool)
    marked[at[telling[flat]]] = True

    def laid_out(which: np.ndarray):
        chosen = [numbered[n] for n in np.flatnonzero(which)]
        return np.concatenate(chosen), np.array([len(ids) for ids in chosen])

    ids, lengths = laid_out(own)
    truth = (marked[ids] & np.repeat(label[own] == 1, lengths)).astype(float)
    began = np.zeros(len(ids), bool)
    began[(np.cumsum(lengths) - lengths)[lengths > 0]] = True
    came = np.where(began, 0, np.roll(truth, 1)).astype(int)
    steps = np.zeros((2, 2))
    np.add.at(steps, (came, truth.astype(int)), 1)
    weights, move = np.zeros(WEIGHTS), np.zeros((2, 2))
    past, past_move = np.full(WEIGHTS, 1e-6), np.full((2, 2), 1e-6)
    for _ in range(rounds):
        by_word = np.bincount(at, weights[flat], len(vocabulary))
        chance, expected = marginals(by_word[ids], lengths, move, pairs=True)
        off = np.bincount(ids, truth - chance, len(vocabulary))
        gradient = np.bincount(flat, off[at], WEIGHTS) - 0.1 * weights
        gradient_move = steps - expected - 0.1 * move
        past += gradient**2
        past_move += gradient_move**2
        weights += 0.5 * gradient / np.sqrt(past)
        move += 0.5 * gradient_move / np.sqrt(past_move)
    field = Field(weights.astype(np.float32), move, None)
    ids, lengths = laid_out(~own)
    by_word = np.bincount(at, field.emission[flat], len(vocabulary))
    summary = _summary(marginals(by_word[ids], lengths, move), lengths)
    field.link = np.zeros(3)
    used = np.ones(3, bool)
    while True:  # more toxic words never lower a score
        weights = _logistic(summary[:, used], label[~own], rate)
        if (weights[1:] >= 0).all():
            break
        used[np.flatnonzero(used)[1 + int(np.argmin(weights[1:]))]] = False
    field.link[used] = weights
    return field


def fit_from(docs: DataFrame, labels: DataFrame, divisor: int | None = 3, held_out: int = 1) -> Field:
    """Fits to labelled documents whose crc32 remainder is not ``held_out``.

    At most MOST_PER_LABEL of either label, by a hash of the id, with at most MOST_CHARS each
    and as many of them as hold MOST_CHARS_IN_ALL: that is what the driver holds. Rows with a null id or label are left out; a document labelled
    twice is toxic if any label says so. Ids that ``docs`` lacks give no text. Of rows with
    one id the last text in order counts, however many there are.
    """
    known = labels.select(labels["doc_id"].cast("long").alias("id"), labels["toxic"].cast("int").alias("toxic"))
    known = known.where("id is not null and toxic in (0, 1)")
    if divisor:
        known = known.where(crc_remainder(F.col("id"), divisor) != held_out)
    known = known.groupBy("id").agg(F.max("toxic").alias("toxic"))
    counts = {row["toxic"]: row["count"] for row in known.groupBy("toxic").count().collect()}
    rate = counts.get(1, 0) / max(1, sum(counts.values()))
    sample = None
    for toxic in (0, 1):
        some = known.where(F.col("toxic") == toxic).orderBy(F.xxhash64("id"), "id").limit(MOST_PER_LABEL)
        sample = some if sample is None else sample.unionByName(some)
    texts = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text"))
    text = F.substring(F.coalesce("text", F.lit("")), 1, MOST_CHARS)
    found = written(
        texts.join(F.broadcast(sample), F.col("doc_id") == F.col("id"))
        .groupBy("doc_id").agg(F.max(text).alias("text"), F.max("toxic").alias("toxic"))
    )
    sizes = {row["doc_id"]: row["size"] for row in found.select("doc_id", F.length("text").alias("size")).collect()}
    # An order that has nothing to do with the id, and is the same on every run.
    order = sorted(sizes, key=lambda i: xxhash.xxh3_64_intdigest(str(i).encode()))
    if sum(sizes.values()) > MOST_CHARS_IN_ALL:
        order = [i for i, upto in zip(order, np.cumsum([sizes[i] for i in order])) if upto <= MOST_CHARS_IN_ALL]
        found = found.where(F.col("doc_id").isin(order))
    by_id = {row["doc_id"]: row for row in found.collect()}
    return fit([by_id[i]["text"] for i in order], [by_id[i]["toxic"] for i in order], rate)


def score(docs: DataFrame, field: Field, keep: Sequence[str] = (), below: float | None = None) -> DataFrame:
    """(doc_id, score, spans) for every row of ``docs``, and its columns in ``keep``.

    With ``below``, only rows that score less than that; the others never leave the task.

    ``spans`` are the offsets (code points, end exclusive) of runs of words that are
    more likely toxic than not. Null text is empty, and what has no words scores as a text
    without a toxic word. Rows are independent: repeated ones and those with a null id
    are scored like any other.
    """
    shared = docs.sparkSession.sparkContext.broadcast(field)
    known: dict[str, float] = {}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for start, count in bounded(batch.column(1), _BYTES):
                part = batch.slice(start, count)
                texts = [text or "" for text in part.column(1).to_pylist()]
                words = [_WORD.findall(text) for text in texts]
                new = list(set().union(*words).difference(known))
                if len(known) + len(new) > _KNOWN:
                    known.clear()
                    new = list(set().union(*words))
                known.update(zip(new, model.of_words(new).tolist()))
                lengths = np.array([len(ws) for ws in words])
                scores = np.fromiter((s for ws in words for s in map(known.__getitem__, ws)), np.float64, lengths.sum())
                chance = marginals(scores, lengths, model.move)
                value = np.zeros(len(texts))
                if model.link is not None:
                    value = 1 / (1 + np.exp(-np.clip(_summary(chance, lengths) @ model.link, -30, 30)))
                ends = np.cumsum(lengths)
                spans = [
                    _spans(text, chance[end - n : end] >= 0.5)
                    for text, end, n in zip(texts, ends, lengths)
                ]
                own = [part.column(n) for n in places]
                found = pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(value), pa.array(spans, pa.list_(_SPAN)), *own], names=names
                )
                yield found if below is None else found.filter(pa.array(value < below))

    kept = [name for name in keep if name != "doc_id"]
    others = [name for name in kept if name != "text"]  # the text goes to the task once
    source = docs.select(
        docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("_text"),
        *[docs[name] for name in others],
    )
    places = [1 if name == "text" else 2 + others.index(name) for name in kept]
    schema = StructType([
        source.schema["doc_id"], StructField("score", DoubleType()),
        StructField("spans", ArrayType(StructType([
            StructField("start", IntegerType()), StructField("end", IntegerType())
        ]))),
        *[docs.schema[name] for name in kept],
    ])
    names = schema.names
    return by_batches(source, run, schema)


_SPAN = pa.struct([("start", pa.int32()), ("end", pa.int32())])


def _spans(text: str, toxic: np.ndarray) -> list[dict]:
    """Runs of toxic words."""
    if not toxic.any():
        return []
    found: list[dict] = []
    for n, match in enumerate(_WORD.finditer(text)):
        if toxic[n]:
            if n and toxic[n - 1]:
                found[-1]["end"] = match.end()
            else:
                found.append({"start": match.start(), "end": match.end()})
    return found
