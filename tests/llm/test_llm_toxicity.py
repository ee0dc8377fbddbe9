import itertools
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from billwright.llm import queries, toxicity
from conftest import DATA
from llm_cases import DOCS, docs


def by_enumeration(scores, move):
    """Marginals and expected steps over all sequences of states."""
    total, chance, steps = 0.0, np.zeros(len(scores)), np.zeros((2, 2))
    for states in itertools.product((0, 1), repeat=len(scores)):
        path = list(zip((0, *states), states))
        weight = np.exp(sum(scores[n] for n, s in enumerate(states) if s) + sum(move[a, b] for a, b in path))
        total += weight
        chance += weight * np.array(states)
        for a, b in path:
            steps[a, b] += weight
    return chance / total, steps / total


@pytest.mark.parametrize("segment", [1, 2, 3, 512])
def test_marginals_by_enumeration(monkeypatch, segment):
    monkeypatch.setattr(toxicity, "_SEGMENT", segment)
    rng = np.random.default_rng(segment)
    lengths = np.array([3, 0, 7, 1, 0, 9])
    scores, move = rng.normal(0, 2, lengths.sum()), rng.normal(0, 1, (2, 2))
    chance, steps = toxicity.marginals(scores, lengths, move, pairs=True)
    expected = [by_enumeration(part, move) for part in np.split(scores, np.cumsum(lengths)[:-1])]
    assert np.allclose(chance, np.concatenate([c for c, _ in expected]))
    assert np.allclose(steps, sum(s for c, s in expected if len(c)))
    assert len(toxicity.marginals(np.zeros(0), np.zeros(2, int), move)) == 0


def test_long_texts_stay_finite():
    scores = np.tile([-25.0, -3.0, 28.0], 20_000)
    chance = toxicity.marginals(scores, np.array([len(scores)]), np.array([[0.5, -2], [-1, 1.0]]))
    assert np.isfinite(chance).all() and (chance[2::3] > 0.99).all() and (chance[::3] < 0.01).all()


def _labelled(n=120):
    rng = np.random.default_rng(5)
    plain = [f"word{c}" for c in "abcdefghijklmnopqrstuvwxyz"]
    texts, toxic = [], []
    for i in range(n):
        words = list(rng.choice(plain, 30))
        if i % 3 == 0:
            words[int(rng.integers(30))] = "nasty" + str(rng.choice(["er", "est", "ly"]))
        texts.append(" ".join(words))
        toxic.append(int(i % 3 == 0))
    return texts, toxic


def test_scores_and_offsets(spark):
    texts, toxic = _labelled()
    field = toxicity.fit(texts, toxic, 1 / 3)
    new = [(1, "worda nastyish wordb", None, None), (2, "worda wordb wordc", None, None)]
    rows = {r["doc_id"]: r for r in toxicity.score(docs(spark, new), field).collect()}
    assert rows[1]["score"] >= toxicity.REJECT > rows[2]["score"]
    assert [tuple(s) for s in rows[1]["spans"]] == [(6, 14)] and rows[2]["spans"] == []


def test_held_out_accuracy(spark):
    """On documents whose labels it did not see."""
    folder = f"{DATA}/sf0.1"
    rows = {r["doc_id"]: r for r in queries.op2_toxicity(spark, folder).collect()}
    assert len(rows) == spark.read.parquet(f"{folder}/documents.parquet").count()
    right, caught, toxic, total = 0, 0, 0, 0
    for label in spark.read.parquet(f"{folder}/labels.parquet").collect():
        row = rows[label["doc_id"]]
        assert row["held_out"] == (zlib.crc32(str(label["doc_id"]).encode()) % 3 == 1)
        assert row["predicted"] == (row["score"] >= 0.7) and 0 <= row["score"] <= 1
        if row["held_out"]:
            total += 1
            right += row["predicted"] == label["toxic"]
            toxic += label["toxic"]
            caught += row["predicted"] and label["toxic"]
    assert right / total > 0.97 and caught / toxic > 0.75


def test_odd_rows(spark):
    texts, toxic = _labelled()
    field = toxicity.fit(texts, toxic, 1 / 3)
    rows = toxicity.score(docs(spark), field).collect()
    assert len(rows) == len(DOCS) and all(0 <= r["score"] < 0.7 for r in rows)
    by_text = {r["score"] for r in rows if r["doc_id"] in (3, 4, 5)}
    assert len(by_text) == 1
    assert toxicity.score(docs(spark, []), field).collect() == []


def test_labels_that_teach_nothing(spark):
    schema = "doc_id long, quality int, toxic int"
    for labels in ([], [(1, 1, 1)], [(1, 1, None), (None, 1, 1)], [(99, 1, 1), (98, 1, 0)]):
        field = toxicity.fit_from(docs(spark), spark.createDataFrame(labels, schema))
        assert field.link is None
        assert {r["score"] for r in toxicity.score(docs(spark), field).collect()} == {0.0}


def test_a_repeated_id_is_one_text_in_the_sample(spark):
    """Very many rows with one id, and a huge text, come to the driver as one bounded text."""
    texts, toxic = _labelled()
    rows = [(n, text, None, None) for n, text in enumerate(texts)]
    labels = spark.createDataFrame([(n, 1, int(t)) for n, t in enumerate(toxic)], "doc_id long, quality int, toxic int")
    many = docs(spark, rows).unionByName(docs(spark, [(0, "", None, None)]).withColumn("_n", F.explode(F.sequence(F.lit(1), F.lit(20_000)))).drop("_n"))
    many = many.unionByName(docs(spark, [(1, rows[1][1] + " word" * 300_000, None, None)]))
    one = toxicity.fit_from(docs(spark, rows), labels, None)
    other = toxicity.fit_from(many, labels, None)
    assert one.link is not None and other.link is not None
    kept = toxicity.score(docs(spark, rows), one, keep=("doc_id", "text", "source"), below=toxicity.REJECT)
    assert kept.columns == ["doc_id", "score", "spans", "text", "source"]
    scored = {r["doc_id"]: r["score"] for r in toxicity.score(docs(spark, rows), one).collect()}
    assert {r["doc_id"]: r["text"] for r in kept.collect()} == {
        n: rows[n][1] for n, score in scored.items() if score < toxicity.REJECT
    }
