import collections
import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from billwright.llm import maxent, queries
from conftest import DATA
from llm_cases import DOCS, docs


def plain_base(rows, held):
    tokens = [[*(text or "").encode().lower().split(), b"\n"] for _, text, *_ in rows]
    counts = collections.Counter(t for ts, out in zip(tokens, held) if not out for t in ts)
    total, kinds = sum(counts.values()), len(counts)
    return [
        (len(ts), sum(counts[t] > 0 for t in ts), total, sum(math.log10((counts[t] + 1) / (total + kinds + 1)) for t in ts))
        for ts in tokens
    ]


def test_scores_of_the_table(spark):
    """Base scores by definition; the model beats them on documents that it has not seen."""
    rows = spark.read.parquet(f"{DATA}/sf0.01/documents.parquet").collect()
    held = [zlib.crc32(str(r["doc_id"]).encode()) % 7 == 2 for r in rows]
    expected = plain_base([(r["doc_id"], r["text"]) for r in rows], held)
    found = {r["doc_id"]: r for r in queries.op7_lm_score(spark, f"{DATA}/sf0.01").collect()}
    assert len(found) == len(rows)
    for row, out, (n, known, total, base) in zip(rows, held, expected):
        r = found[row["doc_id"]]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (out, n, known, total)
        assert r["base_score"] == pytest.approx(base, rel=1e-9)
    unseen = [r for r in found.values() if r["held_out"]]
    assert sum(r["score"] for r in unseen) > sum(r["base_score"] for r in unseen)


def test_chances_add_up_to_one():
    rng = np.random.default_rng(1)
    weights = rng.normal(size=(maxent.BUCKETS + 1, maxent.CLASSES)).astype(np.float32)
    buckets = rng.integers(0, maxent.BUCKETS, (3, 50))
    assert np.allclose(np.exp(maxent.class_log_odds(weights, buckets)).sum(1), 1, atol=1e-4)
    # Within a class: its words and one place for what is unknown.
    counts = np.array([5, 2, 1])
    assert math.isclose(sum((counts + 1) / (counts.sum() + len(counts) + 1)) + 1 / (counts.sum() + len(counts) + 1), 1)


def test_histories_stop_at_the_start_of_a_text():
    hashes = np.arange(10, 20, dtype=np.uint64)
    one = maxent.features(np.array([1, 2, 3, 0]), np.array([4]), hashes)
    two = maxent.features(np.array([5, 0, 1, 2, 3, 0]), np.array([2, 4]), hashes)
    assert (one == two[:, 2:]).all() and one.shape == (3, 4)
    assert len(set(one[1, :2])) == 1  # neither has a word two before


def test_steps_lower_the_loss():
    rng = np.random.default_rng(2)
    ids = rng.integers(0, 8, 40_000)
    ids[1::2] = ids[::2]  # every second word repeats the one before
    buckets = maxent.features(ids, np.array([len(ids)]), np.arange(100, 108, dtype=np.uint64))
    weights, used = np.zeros((maxent.BUCKETS + 1, maxent.CLASSES), np.float32), np.zeros(maxent.BUCKETS + 1, np.float32)
    loss = lambda: -maxent.class_log_odds(weights, buckets)[np.arange(len(ids)), ids].mean()
    before = loss()
    maxent._descend(weights, used, buckets, ids)
    assert loss() < before - 0.5


def test_odd_rows(spark):
    rows = maxent.score(docs(spark), F.col("doc_id") == 1).collect()
    held = [row[0] is None or row[0] == 1 for row in DOCS]
    expected = plain_base(DOCS, held)
    key = lambda x: (x[0] is None, x)
    found = sorted(
        ((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in rows),
        key=key,
    )
    assert found == sorted(
        ((row[0], out, n, known, total, round(base, 6)) for row, out, (n, known, total, base) in zip(DOCS, held, expected)),
        key=key,
    )
    assert all(math.isfinite(r["score"]) for r in rows)
    assert maxent.score(docs(spark, []), F.lit(False)).collect() == []
    untaught = maxent.score(docs(spark), F.lit(True)).collect()
    assert {(r["train_tokens"], r["n_known"], r["base_score"]) for r in untaught} == {(0, 0, 0.0)}


def test_counts(spark):
    packed = maxent.pack(docs(spark), F.lit(False))
    known = maxent.totals(maxent.counted(packed))
    tokens = [t for _, text, *_ in DOCS for t in [*(text or "").encode().lower().split(), b"\n"]]
    assert (known.tokens, known.kinds) == (len(tokens), len(set(tokens)))
    classes = [maxent.word_class(t) for t in tokens]
    assert known.class_tokens.tolist() == np.bincount(classes, minlength=maxent.CLASSES).tolist()
    kinds = [maxent.word_class(t) for t in set(tokens)]
    assert known.class_kinds.tolist() == np.bincount(kinds, minlength=maxent.CLASSES).tolist()


def test_numbers_come_back():
    ids = np.array([0, 1, 255, 256, 70_000, 2**31 - 1], np.int32)
    assert (maxent._unfolded(maxent._folded(ids)) == ids).all()


def test_two_runs_give_the_same_scores(spark, monkeypatch):
    """Several rows in several tasks, so that both rounds and the sums over tasks matter."""
    monkeypatch.setattr(maxent, "TOKENS_PER_ROW", 20_000)
    table = spark.read.parquet(f"{DATA}/sf0.01/documents.parquet").repartition(6, "doc_id")
    score = lambda: {r["doc_id"]: r["score"] for r in maxent.score(table, F.col("doc_id") % 7 == 2).collect()}
    first = score()
    assert first == score() and len(set(first.values())) > 500


def test_buckets_follow_the_vocabulary():
    assert maxent.bucket_count(0) == maxent.bucket_count(100_000) == maxent.BUCKETS
    assert maxent.bucket_count(20_000_000) == 1 << 18 and maxent.bucket_count(10**12) == maxent.MOST_BUCKETS
    hashes = np.arange(10, 20, dtype=np.uint64)
    wide = maxent.features(np.array([1, 2, 3, 0]), np.array([4]), hashes, 1 << 18)
    assert wide.max() >= maxent.BUCKETS
