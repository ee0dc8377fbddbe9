import numpy as np
import pytest
from pyspark.sql import functions as F

from billwright.llm import negatives
from test_llm_codes import floors
from test_llm_vectors import ODD, _usable

SCHEMA = "vec_id long, embedding array<double>, label int, id string, exact string, score int, asks int, place string"


def _table(spark, rows):
    return spark.createDataFrame([(i, v, label, "x", "y", 1, 2, "z") for i, v, label in rows], SCHEMA)


def plain_negatives(rows, asks, positives=5, count=10, low=30, high=90):
    """All rows of the result by scoring every row for every anchor."""
    kept = [(i, floors(v), label) for i, v, label in rows if i is not None and label is not None and _usable(v)]
    fit = lambda s: max(-(2**63), min(2**63 - 1, s))
    result = []
    for a in sorted({i for i, _, _ in kept if asks(i)}):
        label, own = min((str(label), v) for i, v, label in kept if i == a)
        scored = sorted((-fit(sum(x * y for x, y in zip(own, v))), i, str(la) == label) for i, v, la in kept if i != a)
        for s, p, _ in [row for row in scored if row[2]][:positives]:
            hard = [(-n, i) for n, i, same in scored if not same and low * -s <= 100 * -n <= high * -s][:count]
            result += [(a, p, rank + 1, i, -s, n) for rank, (n, i) in enumerate(hard)]
    return sorted(result)


def mined(spark, rows, every):
    return sorted(tuple(r) for r in negatives.mine(_table(spark, rows), F.col("vec_id") % every == 0).collect())


def clustered(seed, count, width, scale=1.0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, width))
    return [
        (n, ((centres[(k := int(rng.integers(6)))] + rng.normal(scale=0.7, size=width)) * scale).tolist(), k % 4)
        for n in range(count)
    ]


@pytest.mark.parametrize(("blocks", "anchors"), [(16_384, 16_384), (40, 7)])
def test_negatives_by_brute_force(spark, monkeypatch, blocks, anchors):
    monkeypatch.setattr(negatives, "_ROWS", blocks)
    monkeypatch.setattr(negatives, "ANCHOR_BLOCK", anchors)
    rows = clustered(3, 500, 8)
    rows += [(1000 + n, rows[n % 4][1], rows[n % 3][2]) for n in range(60)]  # many ties
    found = mined(spark, rows, 20)
    assert found == plain_negatives(rows, lambda i: i % 20 == 0) and len(found) > 500


@pytest.mark.parametrize("scale", [1e5, 1e8, 1e14, 1e300])
def test_large_components(spark, scale):
    rows = clustered(4, 80, 5, scale)
    assert mined(spark, rows, 10) == plain_negatives(rows, lambda i: i % 10 == 0)


def test_odd_rows(spark):
    rows = [(i, v, n % 2) for n, (i, v) in enumerate(ODD)] + [(20, [1.0, 0.5, 0.0], None), (8, [0.5, 0.5, 0.0], 1)]
    rows += [(21 + n, [0.8, 0.1 * n, 0.0], n % 2) for n in range(8)] + [(40, [0.0, 0.0, 0.0], 0), (41, [-0.0] * 3, 1)]
    assert mined(spark, rows, 1) == plain_negatives(rows, lambda i: True) != []
    for some in ([], [(1, None, 1)], [(7, [1.0], 1)]):
        found = negatives.mine(_table(spark, some), F.col("vec_id") % 2 == 0)
        assert found.collect() == [] and len(found.columns) == 6
    found = negatives.mine(_table(spark, rows), F.lit(None).cast("boolean"))
    assert found.collect() == []


def test_lists_are_read_as_far_as_it_takes():
    """Vectors along one axis: the first places of the lists are enough for the best few."""
    values = np.zeros((5000, 4), np.int64)
    values[:, 0] = np.random.default_rng(1).permutation(5000)
    lists = negatives.SortedLists(np.arange(5000), np.zeros(5000, np.int64), values)
    best, read = negatives._Best(5), []
    for rows, scores, bound in lists.accessed(np.array([3, 0, 0, 0])):
        best.offer(scores, lists.ids[rows])
        read.append(len(rows))
        if bound is not None and bound < best.kth(None):
            break
    assert best.scores.tolist() == [3 * n for n in (4999, 4998, 4997, 4996, 4995)] and sum(read) < 50


def test_window_limits():
    assert negatives.window(10, 30, 90) == (3, 9) and negatives.window(11, 30, 90) == (4, 9)
    assert negatives.window(0, 30, 90) == (0, 0) and negatives.window(-10, 30, 90) is None
    assert negatives.window(1, 30, 90) is None
