import random

import pytest

from billwright.llm import minhash
from billwright.llm.components import connected
from llm_cases import DOCS, docs


def plain_sets(rows, width):
    sets = []
    for _, text, *_ in rows:
        words = (text or "").encode().lower().split()
        sets.append({tuple(words[n : n + width]) for n in range(len(words) - width + 1)} or ({tuple(words)} if words else set()))
    return sets


def plain_components(rows, width, percent):
    """(component, n) for each row by comparing all pairs."""
    sets = plain_sets(rows, width)
    up = list(range(len(rows)))

    def root(n):
        while up[n] != n:
            n = up[n]
        return n

    for n, a in enumerate(sets):
        for m in range(n):
            both = len(a & sets[m])
            if a and sets[m] and 100 * both >= percent * len(a | sets[m]):
                up[root(n)] = root(m)
    names = {}
    for n, row in enumerate(rows):
        if row[0] is not None:
            names[root(n)] = min(row[0], names.get(root(n), row[0]))
    return [(names.get(root(n)), len(sets[n])) for n in range(len(rows))]


def _edited(words, rng, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


def corpus(seed):
    """Groups of near copies, some far from their middle, a common passage and lone texts."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(400)}"
    passage = " ".join(word() for _ in range(60))
    texts = []
    for size, length, most in ((25, 150, 9), (3, 400, 12), (2, 900, 40), (12, 40, 2), (2, 3, 1), (30, 320, 14)):
        base = [word() for _ in range(length)]
        texts += [_edited(base, rng, rng.randrange(most + 1)) for _ in range(size)]
    texts += [passage + " " + " ".join(word() for _ in range(n)) for n in (3, 5, 8, 20, 40, 60, 90, 200)]
    texts += [" ".join(word() for _ in range(rng.randrange(1, 300))) for _ in range(20)]
    texts += texts[:6] + [texts[0].upper()]
    rng.shuffle(texts)
    return [(n, text, None, None) for n, text in enumerate(texts)]


@pytest.mark.parametrize(("seed", "width", "percent"), [(1, 3, 85), (2, 5, 80), (3, 3, 85)])
def test_components_by_brute_force(spark, seed, width, percent):
    rows = corpus(seed)
    found = sorted(minhash.near_duplicates(docs(spark, rows), width, percent, block=5 if seed == 2 else 1024).collect())
    expected = plain_components(rows, width, percent)
    assert [(r["component_id"], r["n_shingles"]) for r in found] == expected
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in found)
    assert 10 < sum(r["kept"] for r in found) < len(rows) - 20


def test_sets_on_both_sides_of_a_sketch(spark):
    """Sets of single words. The first two are alike, and share what only the smaller one's
    sketch holds; their lists are centred on a third that is like neither."""
    by_hash = sorted((f"w{n}" for n in range(280)), key=lambda w: minhash.shingle_hashes(w, 1)[0])
    extra = set(by_hash[5:245:6])
    small = [w for w in by_hash if w not in extra]
    beside = [f"e{n}" for n in range(40)]
    third = [w for w in by_hash[: minhash.FINE] if w not in extra] + beside
    fourth = beside + [f"f{n}" for n in range(100)]
    texts = [small, by_hash, third, fourth, [*fourth, "g"]]
    rng = random.Random(11)
    for group in range(6):
        base = [f"g{group}-{n}" for n in range(300)]
        texts += [
            rng.sample(base, rng.randrange(220, 280)) + [f"g{group}-{text}-{n}" for n in range(rng.randrange(40))]
            for text in range(10)
        ]
    rows = [(n, " ".join(words), None, None) for n, words in enumerate(texts)]
    found = sorted(minhash.near_duplicates(docs(spark, rows), 1, 85).collect())
    assert [(r["component_id"], r["n_shingles"]) for r in found] == plain_components(rows, 1, 85)
    assert found[1]["component_id"] == 0 and found[2]["kept"]


def groups_of_near_copies(seed):
    """Groups on both sides of 56 and 256 words, of texts that each hold most of their base."""
    rng, texts = random.Random(seed), []
    for group in range(30):
        base = [f"b{group}-{n}" for n in range(rng.choice([30, 36, 60, 200, 256, 300, 400, 700]))]
        for text in range(14):
            begin = rng.randrange(len(base) * 16 // 100 + 1)
            part = base[begin : begin + len(base) * rng.randrange(84, 101) // 100]
            texts.append(part + [f"o{group}-{text}-{n}" for n in range(rng.randrange(len(base) // 14 + 1))])
    return [(n, " ".join(words), None, None) for n, words in enumerate(texts)]


@pytest.mark.parametrize(("seed", "width"), [(100, 1), (101, 1), (100, 3)])
def test_groups_around_a_centre(spark, seed, width):
    """What a member holds of its centre takes all 64 bits of a word."""
    rows = groups_of_near_copies(seed)
    found = sorted(minhash.near_duplicates(docs(spark, rows), width, 85).collect())
    assert [(r["component_id"], r["n_shingles"]) for r in found] == plain_components(rows, width, 85)


def test_odd_rows(spark):
    rows = minhash.near_duplicates(docs(spark), 3, 85).collect()
    expected = plain_components(DOCS, 3, 85)
    found = sorted(((r["doc_id"] is None, r["doc_id"] or 0, r["component_id"], r["n_shingles"], r["kept"]) for r in rows))
    assert found == sorted(
        (row[0] is None, row[0] or 0, c, n, row[0] == c) for row, (c, n) in zip(DOCS, expected)
    )
    assert minhash.near_duplicates(docs(spark, [])).collect() == []
    unnamed = [(None, "a b c d e", None, None), (None, "a b c d e", None, None)]
    assert [(r["component_id"], r["kept"]) for r in minhash.near_duplicates(docs(spark, unnamed)).collect()] == [(None, True)] * 2


def test_least_shared_bounds():
    assert minhash._least_shared(32, 85) < 32 * 0.85
    assert minhash._least_shared(32, 100) == 32
    assert len(minhash.shingle_hashes(None, 3)) == 0 and len(minhash.shingle_hashes("a b", 3)) == 1


@pytest.mark.parametrize("seed", range(3))
def test_connected_by_search(spark, seed):
    rng = random.Random(seed)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)]
    links += [(n, n + 1) for n in range(400, 480)] + [(500, n) for n in range(501, 560)] + [(7, 7), (None, 3)]
    up = {n: n for pair in links for n in pair if n is not None}

    def root(n):
        while up[n] != n:
            n = up[n]
        return n

    real = [(a, b) for a, b in links if a is not None and b is not None and a != b]
    for a, b in real:
        a, b = sorted((root(a), root(b)))
        up[b] = a
    found = {r["node"]: r["component"] for r in connected(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {n: root(n) for pair in real for n in pair}


def test_connected_without_links(spark):
    assert connected(spark.createDataFrame([], "a long, b long")).collect() == []
