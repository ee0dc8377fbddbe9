"""Vector codes: parts of a vector as numbers of codebook entries, all in integers.

A vector is cut into equal parts, and every part position has a codebook. The nearest
entry of a part is found on transformed values: parts and entries are padded with zeros
to a power of two and go through the Walsh-Hadamard transform, which needs additions
only and multiplies squared distances by the padded length. Scaled squared differences
are added up coefficient by coefficient in sequency order, where the first ones mostly
tell entries apart. The entry that leads after the first coefficient is measured to the
end; entries whose sum so far exceeds its distance are out, and what the others have left
is only added up for them.

The codebooks, of bounded size, are all that tasks share. A round of fitting adds up the
parts of each entry within every task, and shuffles those sums.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from billwright.llm.common import written
from billwright.llm.vectors import integers, matrix, usable

PARTS, ENTRIES, ROUNDS = 16, 64, 2
_ROWS = 4096
_HALF = 32  # sums travel as upper and lower bits, so that no sum of longs overflows


def sequency_order(size: int) -> np.ndarray:
    """Rows of the natural-ordered transform of a power of two, by their changes of sign."""
    rows = transformed(np.eye(size, dtype=np.int64))
    return np.argsort(np.count_nonzero(rows[:, 1:] != rows[:, :-1], axis=1), kind="stable")


def transformed(values: np.ndarray) -> np.ndarray:
    """The Walsh-Hadamard transform along the last axis, whose length is a power of two."""
    values = values.copy()
    size, half = values.shape[-1], 1
    while half < size:
        pairs = values.reshape(*values.shape[:-1], size // (2 * half), 2, half)
        left, right = pairs[..., 0, :].copy(), pairs[..., 1, :]
        pairs[..., 0, :] += right
        pairs[..., 1, :] = left - right
        half *= 2
    return values


def _padded(parts: np.ndarray) -> np.ndarray:
    """Parts filled up with zeros to a power of two, transformed, coefficients by sequency."""
    size = 1 << max(0, parts.shape[-1] - 1).bit_length()
    filled = np.zeros((*parts.shape[:-1], size), parts.dtype)
    filled[..., : parts.shape[-1]] = parts
    return transformed(filled)[..., sequency_order(size)]


def nearest(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of the nearest entry, its squared distance) for each row of ``parts``.

    Both hold integers, as int64 or as Python's; equal distances go to the lower number.
    """
    rows, books = _padded(parts), _padded(entries)
    size, count = rows.shape[1], len(books)
    sums = (rows[:, :1] - books[None, :, 0]) ** 2
    lead = sums.argmin(1)
    bound = ((rows - books[lead]) ** 2).sum(1)
    at, entry = np.nonzero(sums <= bound[:, None])
    left = sums[at, entry]
    for place in range(1, size):
        left = left + (rows[at, place] - books[entry, place]) ** 2
        stay = left <= bound[at]
        at, entry, left = at[stay], entry[stay], left[stay]
    # Pairs lie by row and entry: the first of a row's least is its lowest entry.
    begin = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
    least = np.minimum.reduceat(left, begin) if len(at) else left
    number = np.where(left == np.repeat(least, np.diff(np.append(begin, len(at)))), entry, count)
    return np.minimum.reduceat(number, begin) if len(at) else number, least // size


def _exact(values: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both as int64 if no distance can overflow, else as Python's integers."""
    width = books.shape[-1]
    most = max(int(np.abs(x.astype(np.float64)).max(initial=0.0)) + 1 for x in (values, books))
    size = 1 << max(0, width - 1).bit_length()
    if (2 * most * size) ** 2 * size < 2**62:
        return values, books
    return values.astype(object), books.astype(object)


def integer_vectors(vectors: DataFrame, id_col: str, vector_col: str, label_col: str | None, parts: int) -> DataFrame:
    """(id, label, exact array<long>) of the usable rows, written; lengths are a multiple of ``parts``."""
    label = vectors[label_col] if label_col else F.lit(None).cast("int")
    rows = usable(vectors.withColumn("_label", label), id_col, vector_col, keep="_label")
    short = F.pmod(-F.size("exact"), F.lit(parts))
    filled = F.concat("exact", F.array_repeat(F.lit(0).cast("long"), short))
    return written(
        rows.select("id", F.col("_label").alias("label"), integers("vector").alias("exact"))
        .select("id", "label", filled.alias("exact"))
    )


def first_codebooks(rows: DataFrame, parts: int, entries: int) -> np.ndarray:
    """The parts of the rows with the smallest ids, as (part, entry, component).

    Rows with equal ids come by their components, rows without id after all others. With
    fewer rows than entries, there are that many entries.
    """
    first = rows.select("id", "exact").orderBy(F.asc_nulls_last("id"), "exact").limit(entries).collect()
    if not first:
        return np.empty((parts, 0, 0), np.int64)
    values = np.array([row["exact"] for row in first], np.int64)
    return values.reshape(len(first), parts, -1).transpose(1, 0, 2)


def improved(rows: DataFrame, books: np.ndarray) -> np.ndarray:
    """Codebooks after one round: each entry is the floor of the mean of the parts it is nearest to."""
    shared = rows.sparkSession.sparkContext.broadcast(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = shared.value
        parts, entries, width = books.shape
        counts = np.zeros((parts, entries), np.int64)
        upper, lower = np.zeros((2, parts, entries, width), np.int64)
        for batch in batches:
            for start in range(0, batch.num_rows, _ROWS):
                values = matrix(batch.column(0).slice(start, _ROWS)).reshape(-1, parts, width)
                for part in range(parts):
                    number, _ = nearest(*_exact(values[:, part], books[part]))
                    number = number.astype(np.int64)
                    counts[part] += np.bincount(number, minlength=entries)
                    np.add.at(upper[part], number, values[:, part] >> _HALF)
                    np.add.at(lower[part], number, values[:, part] & (1 << _HALF) - 1)
        part, entry = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array((part * entries + entry).astype(np.int32)), pa.array(counts[part, entry]),
                *(pa.array(list(x[part, entry]), pa.list_(pa.int64())) for x in (upper, lower)),
            ],
            names=["place", "count", "upper", "lower"],
        )

    sums = rows.select("exact").mapInArrow(run, "place int, count long, upper array<long>, lower array<long>")
    by_component = sums.select("place", "count", F.posexplode(F.arrays_zip("upper", "lower")).alias("at", "s"))
    total = by_component.groupBy("place", "at").agg(
        F.sum("count").alias("count"), F.sum("s.upper").alias("upper"), F.sum("s.lower").alias("lower")
    )
    after = books.copy()
    for row in total.collect():  # as many rows as the codebooks have components
        part, entry = divmod(row["place"], books.shape[1])
        after[part, entry, row["at"]] = ((row["upper"] << _HALF) + row["lower"]) // row["count"]
    return after


def fitted(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray:
    books = first_codebooks(rows, parts, entries)
    for _ in range(rounds if books.size else 0):
        books = improved(rows, books)
    return books


def books_digest(books: np.ndarray) -> str:
    """SHA-256 of all components in decimal, by part, entry and place, joined by commas."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def coded(rows: DataFrame, books: np.ndarray) -> DataFrame:
    """(id, label, numbers array<int>, error long): the entry of each part, and the squared distances summed.

    An error that a long can't hold is null.
    """
    shared = rows.sparkSession.sparkContext.broadcast(books)
    names = ["id", "label", "numbers", "error"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = shared.value
        parts, _, width = books.shape
        for batch in batches:
            for start in range(0, batch.num_rows, _ROWS):
                some = batch.slice(start, _ROWS)
                values = matrix(some.column(2)).reshape(-1, parts, width)
                numbers, errors = np.empty((len(values), parts), np.int32), np.zeros(len(values), object)
                for part in range(parts):
                    number, error = nearest(*_exact(values[:, part], books[part]))
                    numbers[:, part] = number
                    errors += error
                offsets = np.arange(0, numbers.size + 1, parts, np.int32)
                errors = [int(e) if e < 2**63 else None for e in errors]
                yield pa.RecordBatch.from_arrays(
                    [
                        *some.columns[:2],
                        pa.ListArray.from_arrays(offsets, pa.array(numbers.ravel())), pa.array(errors, pa.int64()),
                    ],
                    names=names,
                )

    label = rows.schema["label"].dataType.simpleString()
    return rows.mapInArrow(run, f"id long, label {label}, numbers array<int>, error long")


def compress(
    vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
    id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
) -> tuple[DataFrame, np.ndarray]:
    """((id, label, numbers, error, label_error), codebooks) of all usable vectors.

    Components count as floor(256 * x), those beyond 2 ** 62 either way as that. Vectors
    are cut into ``parts`` parts; lengths that don't divide are filled up with zeros.
    Null and empty vectors and those with a null or non-finite component are left out.
    Rows with a null or repeated id are rows like any other. ``label_error`` sums the
    error of the rows with the same label, null being one label; it is null if it holds
    a null error or doesn't fit into a long. Other columns are left out, whatever their
    names. No rows give no rows and no codebooks. Vectors of different lengths are an error.

    Each round reads the written vectors once. Labels are joined back from their sums,
    which Spark broadcasts where they are small on disk.
    """
    rows = integer_vectors(vectors, id_col, vector_col, label_col, parts)
    books = fitted(rows, parts, entries, rounds)
    if not books.size:
        nothing = rows.select("id", "label", F.lit(None).cast("array<int>").alias("numbers"), F.lit(0).cast("long").alias("error"))
        return nothing.withColumn("label_error", F.col("error")).where("false"), books
    found = written(coded(rows, books))
    whole = F.when(F.count("error") == F.count(F.lit(1)), F.sum(F.col("error").cast("decimal(20,0)")))
    sums = written(found.groupBy(F.col("label").alias("_label")).agg(whole.try_cast("long").alias("label_error")))
    return found.join(sums, F.col("label").eqNullSafe(F.col("_label"))).drop("_label"), books


def code_text(numbers: str) -> Column:
    """Numbers as two hexadecimal digits each."""
    return F.array_join(F.transform(numbers, lambda n: F.lpad(F.lower(F.hex(n)), 2, "0")), "")
