"""SentencePiece BPE by vectorised merge rounds over flat arrays of symbols.

White space becomes ``▁`` and a text is cut into words before each ``▁`` that follows
something else, since no piece reaches over such a place. A task merges the distinct
words that it has not met before, all at once: their characters lie in one flat array of
symbols. In a round, every word finds the least rank among its neighbouring pairs and
merges the pairs of that rank from the left, as long as no merge brings up a pair that
would have gone first. Merged symbols are closed up, words without a pair leave the
array, and rounds end when it is empty. The pairs that may merge, and what they give, are
two sorted arrays made from the model.

Nothing is shuffled; the model is the only thing that tasks share.
"""

from __future__ import annotations

import codecs
import itertools
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from billwright.llm.common import bounded, by_batches

#: Characters of text that a task holds as words at a time, and words it remembers.
SLICE_CHARS = 2_000_000
KNOWN_WORDS = 300_000
_WORDS_AT_ONCE = 500_000
_ROWS = 500
#: The mark of white space, what an unknown piece decodes to, kinds of pieces.
SPACE, UNKNOWN_TEXT = "▁", " ⁇ "
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
_WORD = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
_NONE = np.int64(2**62)  # the rank of a pair that doesn't merge


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of the fields of one message in protocol buffers' wire format."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            if byte < 128:
                return value
            shift += 7

    while at < len(data):
        key = varint()
        if key & 7 == 0:
            yield key >> 3, varint()
            continue
        size = {1: 8, 5: 4}.get(key & 7) or varint()
        yield key >> 3, data[at : at + size]
        at += size


def _spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for each length, end to end."""
    return np.repeat(starts - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())


class Model:
    """The pieces of a SentencePiece BPE model with byte fallback: (text, score, kind) by id.

    Texts are taken as they are (identity normalisation), with a blank before them if
    ``prefix`` is set. A model that needs anything else is refused when it is read.
    """

    def __init__(self, pieces: list[tuple[str, float, int]], prefix: bool = True):
        self.pieces, self.prefix = pieces, prefix
        normal = {text: n for n, (text, _, kind) in enumerate(pieces) if kind == NORMAL}
        self._bytes = np.array([n for n, piece in enumerate(pieces) if piece[2] == BYTE], np.int32)
        if len(self._bytes) != 256:
            raise ValueError("the model has no byte fallback")
        if any(SPACE in text.lstrip(SPACE) for text in normal):
            raise ValueError("a piece of the model reaches over words")
        # Characters that are in pieces but are none get symbols behind the pieces.
        inner = sorted(set("".join(normal)) - set(normal))
        symbol = normal | {c: len(pieces) + n for n, c in enumerate(inner)}
        self._beyond = len(pieces) + len(inner)  # and any other character its code above that
        chars = sorted((ord(c), n) for c, n in symbol.items() if len(c) == 1)
        self._codes, self._symbols = np.array([*chars, (2**31, -1)], np.int64).T.copy()
        scores = sorted({pieces[n][1] for n in normal.values()}, reverse=True)
        rank = {score: n for n, score in enumerate(scores)}
        joins = sorted(
            (symbol[text[:n]] << 32 | symbol[text[n:]], rank[pieces[whole][1]], whole)
            for text, whole in normal.items()
            for n in range(1, len(text))
            if text[:n] in symbol and text[n:] in symbol
        )
        self._pairs, self._rank, self._whole = np.array([*joins, (2**63 - 1, _NONE, -1)], np.int64).T.copy()
        self._inside = np.unique([ord(a) << 32 | ord(b) for text in normal for a, b in itertools.pairwise(text)])
        self._runs = self._run_pieces(normal)
        self.silent = {n for n, piece in enumerate(pieces) if piece[2] == CONTROL}
        #: What a piece decodes to, as bytes.
        kinds = {UNKNOWN: lambda text: UNKNOWN_TEXT, CONTROL: lambda text: ""}
        plain = lambda text: text.replace(SPACE, " ")
        self.bytes_of = [
            bytes([int(text[1:-1], 16)]) if kind == BYTE else kinds.get(kind, plain)(text).encode()
            for text, _, kind in pieces
        ]

    def _run_pieces(self, normal: dict[str, int]) -> list[list[int]]:
        """Ids of 0, 1, 2, ... marks in a row, if runs of marks can be cut after all else has merged.

        That is so if only runs have two marks in a row and they share the lowest score.
        Then a run grows from the left to the longest piece, whatever follows, and the
        rest goes on from there; so the list ends below twice that length.
        """
        runs = [text for text in normal if len(text) > 1 and not text.strip(SPACE)]
        least = min(self.pieces[n][1] for n in normal.values())
        lowest = {text for text, n in normal.items() if self.pieces[n][1] == least}
        if not runs or lowest - {SPACE} != set(runs) or any(SPACE * 2 in text for text in set(normal).difference(runs)):
            return []
        longest = max(map(len, runs))
        ids, lengths = self._in_rounds([SPACE * n for n in range(2 * longest + 1)])
        table = [part.tolist() for part in np.split(ids, np.cumsum(lengths)[:-1])]
        whole = normal[SPACE * longest]
        return table[:-1] if table[-1][0] == whole and table[longest] == [whole] else []

    def _run_ids(self, length: int) -> list[int]:
        longest = len(self._runs) // 2
        full = max(0, length // longest - 1)
        return self._runs[longest] * full + self._runs[length - full * longest]

    @classmethod
    def read(cls, path: str) -> Model:
        """A ``.model`` file."""
        with open(path, "rb") as file:
            message = list(_fields(file.read()))
        pieces = []
        for number, value in message:
            if number == 1:
                piece = dict(_fields(value))
                score = struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0
                pieces.append((piece[1].decode(), score, piece.get(3, NORMAL)))
        trainer, rules = (dict(_fields(next((v for n, v in message if n == f), b""))) for f in (2, 3))
        known = {kind for _, _, kind in pieces} <= {NORMAL, UNKNOWN, CONTROL, BYTE}
        plain = not rules.get(2) and rules.get(4, 1) == 0 and rules.get(5, 1) == 1 and not trainer.get(24)
        if trainer.get(3) != 2 or not known or not plain:
            raise ValueError("only BPE models that take texts as they are can be read")
        return cls(pieces, bool(rules.get(3, 1)))

    def __reduce__(self):
        return Model, (self.pieces, self.prefix)

    def words(self, text: str) -> Iterator[re.Match]:
        """The words of a text; no piece reaches from one into the next."""
        return _WORD.finditer(self.marked(text))

    def marked(self, text: str) -> str:
        """The text as it is encoded: white space marked, and a mark before it."""
        return (SPACE if self.prefix and text else "") + text.replace(" ", SPACE)

    def encoded(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words end to end, and how many each has."""
        extra = {}
        if self._runs:  # marks beyond the one before a word merge with nothing else
            for n, word in enumerate(words):
                if word.startswith(SPACE * 2):
                    rest = word.lstrip(SPACE)
                    extra[n] = len(word) - len(rest) - bool(rest)
            words = [word[extra[n]:] if n in extra else word for n, word in enumerate(words)]
        ids, lengths = self._in_rounds(words)
        if not extra:
            return ids, lengths
        parts, done, begin = [], 0, np.cumsum(lengths) - lengths
        for n, run in extra.items():
            at = begin[n]
            alone = bool(lengths[n]) and [ids[at]] == self._runs[1]
            parts += [ids[done:at], np.array(self._run_ids(run + alone), np.int32)]
            lengths[n] += len(parts[-1]) - alone
            done = at + alone
        return np.concatenate([*parts, ids[done:]]), lengths

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of each pair and the symbol that it merges to; ``_NONE`` for pairs that don't merge."""
        keys = left << 32 | right
        at = np.searchsorted(self._pairs, keys)
        found = self._pairs[at] == keys
        return np.where(found, self._rank[at], _NONE), self._whole[at]

    def _in_rounds(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """As ``encoded``, by rounds of merges over all words at once."""
        codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
        sizes = np.array([len(word) for word in words], np.int64)
        word_of = np.repeat(np.arange(len(words)), sizes)
        if not len(codes):
            return np.empty(0, np.int32), np.zeros(len(words), np.int64)
        at = np.searchsorted(self._codes, codes)
        symbols = np.where(self._codes[at] == codes, self._symbols[at], self._beyond + codes)
        # Two characters that are side by side in no piece part what is left and right of them.
        pairs = codes[:-1] << 32 | codes[1:]
        near = self._inside[np.minimum(np.searchsorted(self._inside, pairs), len(self._inside) - 1)] == pairs
        part = np.cumsum(np.append(False, (word_of[1:] != word_of[:-1]) | ~near))
        done = self._merged(symbols, part)
        words_of_parts = word_of[np.flatnonzero(np.append(True, part[1:] != part[:-1]))]
        symbols, word_of = done[0], words_of_parts[done[1]]
        # What is no piece goes as the bytes of its character.
        alone = np.flatnonzero(symbols >= len(self.pieces))
        if len(alone):
            kinds, which = np.unique(symbols[alone], return_inverse=True)
            behind = {n: c for c, n in zip(self._codes[:-1].tolist(), self._symbols[:-1].tolist()) if n >= len(self.pieces)}
            text = [chr(behind[s] if s < self._beyond else s - self._beyond).encode() for s in kinds.tolist()]
            flat = self._bytes[np.frombuffer(b"".join(text), np.uint8)]
            length = np.array([len(t) for t in text])
            counts = np.ones(len(symbols), np.int64)
            counts[alone] = length[which]
            ids = np.repeat(symbols, counts)
            ends = np.cumsum(counts)
            ids[_spread(ends[alone] - counts[alone], counts[alone])] = flat[
                _spread((np.cumsum(length) - length)[which], counts[alone])
            ]
            symbols, word_of = ids, np.repeat(word_of, counts)
        return symbols.astype(np.int32), np.bincount(word_of, minlength=len(words))

    def _merged(self, symbols: np.ndarray, part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(symbols, parts) after all merges; a part's symbols stay together and in order."""
        ranks, wholes = np.full(len(symbols), _NONE), np.full(len(symbols), -1)
        inside = np.flatnonzero(part[1:] == part[:-1])
        ranks[inside], wholes[inside] = self._ranks(symbols[inside], symbols[inside + 1])
        finished = []
        while len(symbols):
            first = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
            sizes = np.diff(np.append(first, len(symbols)))
            least = np.minimum.reduceat(ranks, first)
            if (ended := least == _NONE).any():
                over = np.repeat(ended, sizes)
                finished.append((symbols[over], part[over]))
                symbols, part, ranks, wholes = (x[~over] for x in (symbols, part, ranks, wholes))
                least, sizes = least[~ended], sizes[~ended]
                if not len(symbols):
                    break
            places = np.flatnonzero(ranks == np.repeat(least, sizes))
            # Of pairs that overlap, every second one from the left.
            run = np.maximum.accumulate(np.where(np.diff(places, prepend=-2) > 1, np.arange(len(places)), 0))
            places = places[(np.arange(len(places)) - run) % 2 == 0]
            places = places[self._not_overtaken(symbols, part, wholes, places, ranks[places])]
            symbols[places] = wholes[places]
            stays = np.ones(len(symbols), bool)
            stays[places + 1] = False
            symbols, part = symbols[stays], part[stays]
            ranks, wholes = ranks[stays], wholes[stays]
            places -= np.arange(len(places))
            touched = np.zeros(len(symbols), bool)
            touched[places] = touched[np.maximum(places - 1, 0)] = True
            changed = np.flatnonzero(touched)
            ranks[changed] = _NONE
            changed = changed[changed < len(symbols) - 1]
            changed = changed[part[changed] == part[changed + 1]]
            ranks[changed], wholes[changed] = self._ranks(symbols[changed], symbols[changed + 1])
        symbols, part = (np.concatenate(x) for x in zip(*finished))
        order = np.argsort(part, kind="stable")
        return symbols[order], part[order]

    def _not_overtaken(self, symbols, part, wholes, places, rank) -> np.ndarray:
        """Which of a round's merges go ahead: a part's from the left up to the first that brings
        up a pair which goes before those that are left, one of lower rank or of the same."""
        go = np.ones(len(places), bool)
        own = part[places]
        same = own[1:] == own[:-1]  # as the merge before; a part's only merge always goes ahead
        some = np.flatnonzero(np.append(same, False) | np.append(False, same))
        if not len(some):
            return go
        places, own, rank, end = places[some], own[some], rank[some], len(symbols) - 1
        merged = wholes[places]
        left, right = np.maximum(places - 1, 0), np.minimum(places + 2, end)
        before = symbols[left]
        touching = np.flatnonzero((np.diff(places) == 2) & (own[1:] == own[:-1])) + 1
        before[touching] = merged[touching - 1]
        has_left = (places > 0) & (part[left] == own)
        has_right = (places + 2 <= end) & (part[right] == own)
        new = np.minimum(
            np.where(has_left, self._ranks(before, merged)[0], _NONE),
            np.where(has_right, self._ranks(merged, symbols[right])[0], _NONE),
        )
        so_far = np.append(0, np.cumsum(new <= rank)[:-1])
        first = np.append(True, own[1:] != own[:-1])
        go[some] = so_far == np.maximum.accumulate(np.where(first, so_far, 0))
        return go


class _Known:
    """Words whose ids are known, and the ids end to end."""

    def __init__(self):
        self.number: dict[str, int] = {}
        self._ids = np.empty(0, np.int32)
        self._starts, self._lengths = np.empty(0, np.int64), np.empty(0, np.int64)

    def learn(self, model: Model, words: set[str]) -> None:
        new = list(words.difference(self.number))
        if not new:
            return
        if len(self.number) + len(new) > KNOWN_WORDS:
            self.__init__()  # too many to remember; begin with what is at hand
            new = list(words)
        ids, lengths = model.encoded(new)
        starts = np.cumsum(lengths) - lengths + len(self._ids)
        self.number.update(zip(new, range(len(self.number), len(self.number) + len(new))))
        self._ids = np.concatenate([self._ids, ids])
        self._starts = np.concatenate([self._starts, starts])
        self._lengths = np.concatenate([self._lengths, lengths])

    def ids_of(self, words: list[str]) -> np.ndarray:
        numbers = np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))
        return self._ids[_spread(self._starts[numbers], self._lengths[numbers])]


def _slices(texts: list[str], model: Model) -> Iterator[list[tuple[int, list[str]]]]:
    """Slices of (number of the text, words); long texts come in several of them."""
    held, size = [], 0
    for number, text in enumerate(texts):
        if len(text) <= SLICE_CHARS:
            held.append((number, _WORD.findall(model.marked(text))))
            size += len(text)
        else:
            matches = (match.group() for match in model.words(text))
            while words := list(itertools.islice(matches, _WORDS_AT_ONCE)):
                yield [(number, words)]
        if size >= SLICE_CHARS:
            yield held
            held, size = [], 0
    if held:
        yield held


def _encoded(texts: list[str], model: Model, known: _Known) -> list[np.ndarray]:
    parts: list[list[np.ndarray]] = [[] for _ in texts]
    for held in _slices(texts, model):
        known.learn(model, set().union(*(words for _, words in held)))
        for number, words in held:
            parts[number].append(known.ids_of(words))
    return [np.concatenate(p) if len(p) != 1 else p[0] for p in parts]


def encode(
    docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", round_trip: bool = False
) -> DataFrame:
    """(id, ids array<int>) for every row: the ids of the whole text, without begin and end.

    Null text is empty, an empty text has no ids. Blanks at either end, and any number
    of them, are kept. Characters that the model lacks go as bytes. Rows are independent:
    repeated ones and those with a null id are encoded like any other. Other columns are
    left out, whatever their names. No rows give no rows. The model file is read by the
    driver and broadcast; its size is fixed. With ``round_trip``, the ids are decoded where
    they are made, as ``decode`` would, into a column ``decoded``.
    """
    shared = docs.sparkSession.sparkContext.broadcast(Model.read(model_path))
    names = ["id", "ids", "decoded"] if round_trip else ["id", "ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codecs.register_error("one-byte", _one_byte)
        model, known = shared.value, _Known()
        for batch in batches:
            for start, count in bounded(batch.column(1), SLICE_CHARS):
                some = batch.slice(start, count)
                ids = _encoded([text or "" for text in some.column(1).to_pylist()], model, known)
                offsets = np.concatenate([[0], np.cumsum(list(map(len, ids)))]).astype(np.int32)
                columns = [some.column(0), pa.ListArray.from_arrays(offsets, np.concatenate(ids))]
                if round_trip:
                    columns.append(pa.array([decoded_text(model, n.tolist()) for n in ids], pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names=names)

    source = docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].alias("text"))
    found = by_batches(source, run, "id long, ids array<int>" + (", decoded string" if round_trip else ""))
    return found.withColumnRenamed("id", id_col)


def _one_byte(error: UnicodeDecodeError) -> tuple[str, int]:
    return "�", error.start + 1


codecs.register_error("one-byte", _one_byte)


def decoded_text(model: Model, ids: list[int]) -> str:
    """The text of the ids, as the library decodes them; the blank before a text goes."""
    parts, blank = [], model.prefix
    silent = model.silent
    runs = itertools.groupby(ids, silent.__contains__) if not silent.isdisjoint(ids) else [(False, ids)]
    for quiet, some in runs:
        if not quiet:  # bytes on the two sides of a control piece make no character together
            some = list(some)
            data = b"".join(map(model.bytes_of.__getitem__, some))
            # Only the first piece that gives something can bring the blank, if it is no byte or unknown.
            cut = blank and data[:1] == b" " and model.pieces[some[0]][2] == NORMAL
            parts.append(data[cut:].decode("utf-8", "one-byte"))
            blank = False
    return "".join(parts)


def decode(encoded: DataFrame, model_path: str, ids_col: str = "ids") -> DataFrame:
    """``encoded`` with a column ``decoded``: the text of the ids; null for null ids.

    Ids of control pieces give nothing, bytes that are no UTF-8 the replacement
    character. An id that the model lacks, or a null one, is an error.
    """
    if "decoded" in encoded.columns:
        raise ValueError("there is already a column decoded")
    shared = encoded.sparkSession.sparkContext.broadcast(Model.read(model_path))
    place = encoded.columns.index(ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codecs.register_error("one-byte", _one_byte)
        model = shared.value
        for batch in batches:
            for start in range(0, batch.num_rows, _ROWS):
                some = batch.slice(start, _ROWS)
                texts = [
                    decoded_text(model, ids.values.to_numpy().tolist()) if ids.is_valid else None
                    for ids in some.column(place)
                ]
                yield pa.RecordBatch.from_arrays(
                    [*some.columns, pa.array(texts, pa.string())], names=[*some.schema.names, "decoded"]
                )

    schema = StructType([*encoded.schema.fields, StructField("decoded", StringType())])
    return by_batches(encoded, run, schema)


def ids_text(ids):
    """Decimal ids joined by commas; empty for no ids."""
    return F.array_join(ids.cast("array<string>"), ",")
