"""Byte-level BPE by merge replay: all merges run over a slice of the corpus at once.

A task takes its documents in slices of bounded length. The distinct words of a slice
are laid out as one sequence of symbols; an inverted index leads from each pair's rank
to the positions that hold the pair. Ranks are then replayed from lowest to highest,
and a merge only touches the symbols to its left and right. Words are independent of
each other, so this gives what merging each word by itself gives.

Nothing is shuffled, and the vocabulary is the only thing that tasks share.
"""

from __future__ import annotations

import base64
import heapq
import itertools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from billwright.llm.common import bounded, by_batches

#: Characters of text that a task holds as words at a time, and words it remembers.
SLICE_CHARS = 2_000_000
KNOWN_WORDS = 300_000
_WORDS_AT_ONCE = 500_000
#: Bytes from which a word is merged by itself, and bits of an id.
_LONG_WORD = 64
_SHIFT = 24


def _spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for each length, end to end."""
    return np.repeat(starts - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())


class Vocabulary:
    """Ranks of byte sequences; an id is a rank."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.single = np.array([ranks[bytes([b])] for b in range(256)])
        joins = sorted(
            (ranks[token[:n]] << _SHIFT | ranks[token[n:]], rank)
            for token, rank in ranks.items()
            for n in range(1, len(token))
            if token[:n] in ranks and token[n:] in ranks
        )
        #: Every pair of ids that joins, in order, and the rank of what it gives.
        self._pairs, self._joined = np.array([*joins, (2**62, -1)], np.int64).T.copy()
        self._rank_of = dict(joins)

    @classmethod
    def read(cls, path: str) -> Vocabulary:
        """A rank file: one line for each token, in base64, and its rank."""
        with open(path, "rb") as lines:
            return cls({base64.b64decode(t): int(r) for t, r in map(bytes.split, lines)})

    def __reduce__(self):
        return Vocabulary, (self.ranks,)

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair joined; -1 for pairs that don't join."""
        keys = left << _SHIFT | right
        at = np.searchsorted(self._pairs, keys)
        return np.where(self._pairs[at] == keys, self._joined[at], -1)

    def replay(self, words: list[bytes]) -> list[tuple[int, ...]]:
        """The ids of each word; the lowest rank merges first, of equal ones the leftmost."""
        ids, lengths = self.replayed(words)
        each = iter(ids.tolist())
        return [tuple(itertools.islice(each, n)) for n in lengths.tolist()]

    def replayed(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words end to end, and how many each has."""
        whole = np.array([self.ranks.get(word, -1) for word in words], np.int32)
        bytes_in = np.array([len(word) for word in words], np.int64)
        lengths = np.where(whole >= 0, 1, 0)
        many = np.flatnonzero((whole < 0) & (bytes_in > 0) & (bytes_in <= _LONG_WORD))
        long = np.flatnonzero((whole < 0) & (bytes_in > _LONG_WORD))
        if len(many):
            many_ids, lengths[many] = self._replay_many([words[n] for n in many.tolist()])
        long_ids = [self._replay_long(words[n]) for n in long.tolist()]
        lengths[long] = [len(ids) for ids in long_ids]
        starts = np.cumsum(lengths) - lengths
        ids = np.empty(lengths.sum(), np.int32)
        ids[starts[whole >= 0]] = whole[whole >= 0]
        if len(many):
            ids[_spread(starts[many], lengths[many])] = many_ids
        for n, own in zip(long.tolist(), long_ids):
            ids[starts[n] : starts[n] + len(own)] = own
        return ids, lengths

    def _replay_many(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """As ``replayed``. Each time a rank is due, it merges once in every word that holds it."""
        sequence = np.frombuffer(b"".join(words), np.uint8)
        end = len(sequence)  # stands for no neighbour
        lengths = np.array([len(word) for word in words])
        stops = np.cumsum(lengths)
        word_of = np.repeat(np.arange(len(words)), lengths)
        tokens = np.append(self.single[sequence], -1)
        following, previous = np.arange(1, end + 2), np.arange(-1, end)
        following[stops - 1], following[end] = end, end
        previous[stops - lengths], previous[end] = end, end

        index: dict[int, list[np.ndarray]] = {}
        waiting: list[int] = []

        def add(places: np.ndarray, ranks: np.ndarray) -> None:
            order = np.argsort(ranks, kind="stable")[np.count_nonzero(ranks < 0) :]
            if not len(order):
                return
            places, ranks = places[order], ranks[order]
            cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
            bounds = [0, *cuts.tolist(), len(places)]
            for rank, low, high in zip(ranks[bounds[:-1]].tolist(), bounds, bounds[1:]):
                if rank not in index:
                    index[rank] = []
                    heapq.heappush(waiting, rank)
                index[rank].append(places[low:high])

        everywhere = np.arange(end)
        add(everywhere, self._ranks(tokens[:end], tokens[following[:end]]))
        while waiting:
            rank = heapq.heappop(waiting)
            places = np.unique(np.concatenate(index.pop(rank)))
            # Others went when a neighbour merged.
            places = places[self._ranks(tokens[places], tokens[following[places]]) == rank]
            if not len(places):
                continue
            words_there = word_of[places]
            first = np.append(True, words_there[1:] != words_there[:-1])
            if not first.all():  # the rest of a word waits for what its merge brings up
                add(places[~first], np.full(np.count_nonzero(~first), rank))
            places = places[first]
            right = following[places]
            after, before = following[right], previous[places]
            tokens[places], tokens[right] = rank, -1
            following[places] = after
            previous[after] = places
            add(
                np.concatenate([places, before]),
                self._ranks(
                    np.concatenate([tokens[places], tokens[before]]),
                    np.concatenate([tokens[after], tokens[places]]),
                ),
            )
        alive = tokens[:end] >= 0
        return tokens[:end][alive], np.bincount(word_of[alive], minlength=len(words))

    def _replay_long(self, word: bytes) -> tuple[int, ...]:
        """One word of any length, merge by merge; a rank's places may be many."""
        tokens = self.single[np.frombuffer(word, np.uint8)].tolist()
        end = len(tokens)
        following, previous = list(range(1, end + 1)), list(range(-1, end - 1))
        rank_of = self._rank_of.get
        waiting = [
            (rank, place)
            for place, pair in enumerate(zip(tokens, tokens[1:]))
            if (rank := rank_of(pair[0] << _SHIFT | pair[1], -1)) >= 0
        ]
        heapq.heapify(waiting)
        while waiting:
            rank, place = heapq.heappop(waiting)
            right = following[place]
            if tokens[place] < 0 or right == end:
                continue
            if rank_of(tokens[place] << _SHIFT | tokens[right]) != rank:
                continue
            after, before = following[right], previous[place]
            tokens[place], tokens[right], following[place] = rank, -1, after
            if after < end:
                previous[after] = place
                if (new := rank_of(rank << _SHIFT | tokens[after], -1)) >= 0:
                    heapq.heappush(waiting, (new, place))
            if before >= 0 and (new := rank_of(tokens[before] << _SHIFT | rank, -1)) >= 0:
                heapq.heappush(waiting, (new, before))
        return tuple(token for token in tokens if token >= 0)


class _Known:
    """Words whose ids are known, and the ids end to end."""

    def __init__(self):
        self.number: dict[str, int] = {}
        self._ids = np.empty(0, np.int32)
        self._starts, self._lengths = np.empty(0, np.int64), np.empty(0, np.int64)

    def learn(self, vocabulary: Vocabulary, held: list[tuple[int, list[str]]]) -> None:
        words = set().union(*(words for _, words in held))
        new = list(words.difference(self.number))
        if len(self.number) + len(new) > KNOWN_WORDS:
            self.__init__()  # too many to remember; begin with what is at hand
            new = list(words)
        ids, lengths = vocabulary.replayed([word.encode() for word in new])
        starts = np.cumsum(lengths) - lengths + len(self._ids)
        self.number.update(zip(new, range(len(self.number), len(self.number) + len(new))))
        self._ids = np.concatenate([self._ids, ids])
        self._starts = np.concatenate([self._starts, starts])
        self._lengths = np.concatenate([self._lengths, lengths])

    def ids_of(self, words: list[str]) -> np.ndarray:
        numbers = np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))
        return self._ids[_spread(self._starts[numbers], self._lengths[numbers])]


def _pieces(texts: list[str], split: Callable) -> Iterator[list[tuple[int, list[str]]]]:
    """Slices of (number of the text, words); long texts come in several pieces."""
    held, size = [], 0
    for number, text in enumerate(texts):
        words = (match.group() for match in split(text)) if len(text) > SLICE_CHARS else None
        while True:
            piece = split.__self__.findall(text) if words is None else list(
                itertools.islice(words, _WORDS_AT_ONCE)
            )
            if words is not None and not piece:
                break
            held.append((number, piece))
            size += sum(map(len, piece)) if words is not None else len(text)
            if size >= SLICE_CHARS:
                yield held
                held, size = [], 0
            if words is None:
                break
    if held:
        yield held


def encode(
    docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
    round_trip: bool = False,
) -> DataFrame:
    """(id, ids array<int>) for every row: the ids of the whole text.

    ``pattern`` splits the text into words that merge separately; it has to cover the
    text. Null text is empty, an empty text has no ids. Rows are independent: repeated
    ones and those with a null id are encoded like any other. Other columns are left
    out. The vocabulary file is read by the driver and broadcast; its size is fixed. With
    ``round_trip``, the ids are decoded where they are made, as ``decode`` would, into a
    column ``decoded``.
    """
    names = ["id", "ids", "decoded"] if round_trip else ["id", "ids"]
    shared = docs.sparkSession.sparkContext.broadcast(Vocabulary.read(ranks_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, split, known = shared.value, regex.compile(pattern).finditer, _Known()
        token = vocabulary.bytes_of.__getitem__
        for batch in batches:
            for start, count in bounded(batch.column(1), SLICE_CHARS):
                some = batch.slice(start, count)
                texts = [text or "" for text in some.column(1).to_pylist()]
                parts: list[list[np.ndarray]] = [[] for _ in texts]
                for held in _pieces(texts, split):
                    known.learn(vocabulary, held)
                    for number, words in held:
                        parts[number].append(known.ids_of(words))
                flat = [a for p in parts for a in p]
                lengths = [sum(map(len, p)) for p in parts]
                values = np.concatenate(flat) if flat else np.array([], np.int32)
                offsets = np.concatenate([[0], np.cumsum(lengths)])
                columns = [some.column(0), pa.ListArray.from_arrays(offsets.astype(np.int32), values)]
                if round_trip:
                    decoded = [
                        b"".join(map(token, values[low:high].tolist())) for low, high in zip(offsets, offsets[1:])
                    ]
                    columns.append(pa.array(decoded, pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, names=names)

    source = docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].alias("text"))
    found = by_batches(source, run, "id long, ids array<int>" + (", decoded binary" if round_trip else ""))
    return found.withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, ranks_path: str, ids_col: str = "ids") -> DataFrame:
    """``encoded`` with a column ``decoded``: the bytes of the ids; null for null ids.

    The bytes of ids that don't come from ``encode`` need not be valid UTF-8. An id that
    the vocabulary lacks is an error.
    """
    if "decoded" in encoded.columns:
        raise ValueError("there is already a column decoded")
    shared = encoded.sparkSession.sparkContext.broadcast(Vocabulary.read(ranks_path).bytes_of)
    place = encoded.columns.index(ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = shared.value.__getitem__
        for batch in batches:
            lists = batch.column(place)
            decoded = pa.array(
                [
                    b"".join(map(token, ids.values.to_numpy().tolist())) if ids.is_valid else None
                    for ids in lists
                ],
                pa.binary(),
            )
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, decoded], names=[*batch.schema.names, "decoded"]
            )

    schema = StructType([*encoded.schema.fields, StructField("decoded", BinaryType())])
    return by_batches(encoded, run, schema)


def ids_text(ids: Column) -> Column:
    """Decimal ids joined by commas; empty for no ids."""
    return F.array_join(ids.cast("array<string>"), ",")
