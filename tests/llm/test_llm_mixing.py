import random

import pytest

from billwright.llm import mixing
from conftest import DATA
from llm_cases import DOCS, docs


def plain_seats(weights, seats, most):
    got = [0] * len(weights)
    for _ in range(seats):
        free = [n for n in range(len(weights)) if got[n] < most[n] and weights[n] > 0]
        if not free:
            break
        got[max(free, key=lambda n: (weights[n] / (2 * got[n] + 1), -n))] += 1
    return got


@pytest.mark.parametrize("seed", range(30))
def test_seats_by_highest_quotients(seed):
    rng = random.Random(seed)
    weights = [rng.choice([0, 1, 2, 2, 7.5, rng.random() * 40]) for _ in range(rng.randrange(1, 9))]
    most = [rng.choice([0, 1, 3, 1000]) for _ in weights]
    seats = rng.choice([0, 1, 5, 40, 333])
    assert mixing.sainte_lague(weights, seats, most) == plain_seats(weights, seats, most)


def test_targets():
    assert mixing.water_fill([100, 100, 100], [5, 2, 1], 1.5, 2) == pytest.approx([200, 500 / 3, 250 / 3])
    assert mixing.water_fill([], [], 1.5, 2) == []
    assert mixing.water_fill([0, 10], [5, 2], 1.5, 2) == pytest.approx([0, 15])


def _mixed(spark, rows, **options):
    return mixing.mix(docs(spark, rows), keep=("text", "lang"), **options)


def _corpus():
    rng = random.Random(6)
    return [
        (n, " ".join(f"d{n}w{k}" for k in range(rng.choice([0, 1, 7, 50, 700]))), "en", rng.choice("aaab") if n % 9 else None)
        for n in range(300)
    ]


@pytest.mark.parametrize("shard", [7, 4096])
def test_sources_come_near_their_targets(spark, monkeypatch, shard):
    monkeypatch.setattr(mixing, "SHARD_DOCS", shard)
    rows = _corpus()
    found = _mixed(spark, rows, block_words=8).collect()
    sizes = {n: len(text.split()) for n, text, _, _ in rows}
    assert {r["doc_id"]: r["size"] for r in found} == sizes
    of = {n: source for n, _, _, source in rows}
    names = sorted({s for s in of.values() if s}) + [None]
    per_source = [sum(sizes[n] for n in of if of[n] == s) for s in names]
    targets = mixing.water_fill(per_source, [5, 2, 1], 1.5, 2)
    for name, size, target in zip(names, per_source, targets):
        own = [r for r in found if of[r["doc_id"]] == name]
        assert {r["source_size"] for r in own} == {size}
        assert own[0]["target"] == pytest.approx(target)
        assert abs(sum(r["taken"] for r in own) - target) <= 8 * (1 + -(-len(own) // shard))
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in found)
    again = _mixed(spark, random.Random(1).sample(rows, len(rows)), block_words=8).collect()
    assert {(r["doc_id"], r["taken"]) for r in found} == {(r["doc_id"], r["taken"]) for r in again}


def test_texts_hold_the_words_that_are_taken(spark):
    rows = _corpus()
    mixed = _mixed(spark, rows, block_words=8)
    taken = {r["doc_id"]: r["taken"] for r in mixed.collect()}
    texts = mixing.taken_texts(mixed)
    assert sorted(texts.columns) == ["doc_id", "lang", "text"]
    counted, own = dict.fromkeys(taken, 0), {n: text.split() for n, text, _, _ in rows}
    for row in texts.collect():
        words = row["text"].split()
        counted[row["doc_id"]] += len(words)
        assert words and set(words) <= set(own[row["doc_id"]])
        assert words == sorted(words, key=own[row["doc_id"]].index)
    assert counted == taken


def test_odd_rows(spark):
    found = _mixed(spark, DOCS).collect()
    assert len(found) == len(DOCS)
    assert all(r["taken"] == 0 for r in found if r["size"] == 0)
    assert mixing.taken_texts(_mixed(spark, DOCS)).where("text is null or trim(text) = ''").collect() == []
    assert _mixed(spark, []).collect() == []
    silent = _mixed(spark, [(1, None, None, "a"), (2, " ", None, "b")]).collect()
    assert {(r["size"], r["target"], r["taken"]) for r in silent} == {(0, 0.0, 0)}


def test_the_table(spark):
    rows = mixing.mix(spark.read.parquet(f"{DATA}/sf0.01/documents.parquet")).collect()
    assert sum(r["taken"] for r in rows) == pytest.approx(1.5 * sum(r["size"] for r in rows), rel=0.01)


def test_null_and_repeated_ids_fill_no_shard(spark, monkeypatch):
    """Half the ids are null, a third of all rows are copies of one: no shard gets more than its share."""
    monkeypatch.setattr(mixing, "SHARD_DOCS", 50)
    rows = [(None if n % 2 else n, f"text {n} of many words", "en", "a") for n in range(1000)]
    rows += [(None, "the same text again", "en", "a")] * 500
    mixed = mixing.mix(docs(spark, rows), block_words=4)
    found = mixed.collect()
    # A shard's stream ends with the words of all its rows, which are four or five each.
    assert max(r["_cut"]["end"] for r in found) <= 5 * 110
    assert len(found) == 1500 and all(0 <= r["taken"] <= 2 * r["size"] for r in found)
    assert sum(r["taken"] for r in found) == pytest.approx(found[0]["target"], rel=0.1)
