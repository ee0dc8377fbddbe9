import hashlib

import numpy as np
import pytest

from billwright.llm import codes
from test_llm_vectors import ODD, _usable

SCHEMA = "vec_id long, embedding array<double>, label string, id string, exact int, numbers int, _label string, error int"


def _table(spark, rows):
    return spark.createDataFrame([(i, v, label, "x", 1, 2, "y", 3) for i, v, label in rows], SCHEMA)


def floors(v):
    most = 2**62
    return [max(-most, min(most, int(np.floor(256.0 * x)) if np.isfinite(256.0 * x) else (most if x > 0 else -most))) for x in v]


def plain_codes(rows, parts, entries, rounds):
    """(id, label, numbers, error) of each usable row, label errors and codebooks, by comparing all."""
    kept = [(i, floors(v), label) for i, v, label in rows if _usable(v)]
    width = -(-len(kept[0][1]) // parts)
    cut = lambda v: [(v + [0] * (width * parts - len(v)))[n * width : (n + 1) * width] for n in range(parts)]
    kept = [(i, cut(v), label) for i, v, label in kept]
    first = sorted(kept, key=lambda row: (row[0] is None, row[0] or 0, row[1]))[:entries]
    books = [[list(row[1][n]) for row in first] for n in range(parts)]

    def near(part, book):
        distances = [sum((x - y) ** 2 for x, y in zip(part, entry)) for entry in book]
        return distances.index(min(distances)), min(distances)

    for _ in range(rounds):
        for n in range(parts):
            of = [near(row[1][n], books[n])[0] for row in kept]
            for e in set(of):
                own = [row[1][n] for row, o in zip(kept, of) if o == e]
                books[n][e] = [sum(x) // len(own) for x in zip(*own)]
    found = []
    for i, cut_, label in kept:
        each = [near(part, book) for part, book in zip(cut_, books)]
        found.append((i, label, tuple(e for e, _ in each), sum(d for _, d in each)))
    whole = {}
    for _, label, _, error in found:
        whole[label] = whole.get(label, 0) + error
    long = lambda x: x if x < 2**63 else None
    small = all(error < 2**63 for *_, error in found)
    return [(i, label, e, long(d), long(whole[label]) if small else ...) for i, label, e, d in found], books


def key(row):
    return [(v is None, str(v)) for v in row]


def check(spark, rows, parts, entries, rounds=2):
    found, books = codes.compress(_table(spark, rows), parts, entries, rounds)
    expected, plain = plain_codes(rows, parts, entries, rounds)
    got = [(r["id"], r["label"], tuple(r["numbers"]), r["error"], r["label_error"]) for r in found.collect()]
    assert books.tolist() == plain
    return sorted(got, key=key), sorted(expected, key=key)


@pytest.mark.parametrize(("width", "parts", "entries"), [(12, 4, 8), (10, 4, 5), (5, 5, 64), (16, 2, 7)])
def test_codes_by_brute_force(spark, width, parts, entries):
    rng = np.random.default_rng(width)
    rows = [(n, rng.normal(scale=0.2, size=width).tolist(), rng.choice(["a", "b", None])) for n in range(150)]
    rows += [(200 + n, [0.25 * (n % 3)] * width, "c") for n in range(40)]  # many ties
    rows = [(i, v, None if label is None else str(label)) for i, v, label in rows]
    got, expected = check(spark, rows, parts, entries)
    assert got == expected


def test_odd_vectors(spark):
    rows = [(i, v, "a" if (i or 0) % 2 else None) for i, v in ODD]
    got, expected = check(spark, rows, 2, 4)
    assert got == expected and len(got) == sum(_usable(v) for _, v in ODD)


@pytest.mark.parametrize("size", [1e6, 1e9, 1e12, 1e300])
def test_large_components(spark, size):
    """Distances beyond a long are compared exactly; an error that doesn't fit is null."""
    rng = np.random.default_rng(1)
    rows = [(n, (rng.normal(size=6) * (size if n % 5 == 0 else 1)).tolist(), "a") for n in range(60)]
    got, expected = check(spark, rows, 3, 8)
    assert [r[:4] for r in got] == [r[:4] for r in expected]
    if expected[0][4] is ...:
        assert all(r[4] is None for r in got)
    else:
        assert got == expected


def test_empty_tables(spark):
    for rows in ([], [(1, None, "a"), (2, [float("nan")], None)]):
        found, books = codes.compress(_table(spark, rows))
        assert found.collect() == [] and not books.size
        assert found.columns == ["id", "label", "numbers", "error", "label_error"]
        assert codes.books_digest(books) == hashlib.sha256(b"").hexdigest()


@pytest.mark.parametrize("size", [1, 2, 4, 8, 16])
def test_transform(size):
    rng = np.random.default_rng(size)
    values = rng.integers(-100, 100, (20, size))
    after = codes.transformed(values)
    assert (codes.transformed(after) == size * values).all()
    assert ((after**2).sum(1) == size * (values**2).sum(1)).all()
    rows = codes.transformed(np.eye(size, dtype=np.int64))[codes.sequency_order(size)]
    assert np.count_nonzero(rows[:, 1:] != rows[:, :-1], axis=1).tolist() == list(range(size))


def test_nearest_of_nothing_and_of_one():
    number, distance = codes.nearest(np.empty((0, 3), np.int64), np.ones((4, 3), np.int64))
    assert len(number) == len(distance) == 0
    number, distance = codes.nearest(np.array([[1, 2, 3]]), np.array([[0, 0, 0]]))
    assert number.tolist() == [0] and distance.tolist() == [14]
