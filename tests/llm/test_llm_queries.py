"""Registered queries against SQL or their contract, and the pipeline stage by stage."""

import glob
import hashlib
import os

import duckdb
import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from billwright.llm import bpe, pii, queries
from conftest import DATA, bag
from test_llm_minhash import plain_components

FOLDER = f"{DATA}/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        connection.execute(f"create view {os.path.splitext(os.path.basename(path))[0]} as select * from '{path}'")
    return connection


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_by_sql(spark, duck, name):
    ours = queries.QUERIES[name](spark, FOLDER)
    theirs = duck.execute(queries.ORACLE_SQL[name])
    columns = [column[0] for column in theirs.description]
    assert sorted(ours.columns) == sorted(columns)
    expected = sorted(theirs.fetchall(), key=lambda row: [(v is None, str(v)) for v in row])
    assert bag(ours.select(*columns)) == expected and expected


def test_one_query_per_operator():
    numbers = sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES)
    assert numbers == list(range(1, 14))


def test_near_duplicates_of_the_table(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    rows = {r["doc_id"]: r for r in queries.op6_minhash(spark, FOLDER).collect()}
    expected = plain_components([(r["doc_id"], r["text"]) for r in docs], 3, 85)
    assert [(rows[r["doc_id"]]["component_id"], rows[r["doc_id"]]["n_shingles"]) for r in docs] == expected


def test_tokens_of_the_table(spark):
    vocabulary = bpe.Vocabulary.read(public_tokenizers.path(queries.RANKS))
    library = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=vocabulary.ranks, special_tokens={}
    )
    digest = lambda data: hashlib.sha256(data).hexdigest()
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    rows = queries.op3_byte_bpe(spark, FOLDER).collect()
    assert len(rows) == len(texts)
    for row in rows:
        ids = library.encode_ordinary(texts[row["doc_id"]])
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == digest(",".join(map(str, ids)).encode())
        assert row["decoded_sha256"] == digest(texts[row["doc_id"]].encode())


def test_personal_data_of_the_table(spark):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    for row in queries.op1_pii(spark, FOLDER).collect():
        spans = pii.base_spans(texts[row["doc_id"]])
        joined = ",".join(f"{kind}:{start}:{end}" for start, kind, end in spans)
        assert row["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert [row[f"n_{kind}"] for kind in pii.KINDS] == [sum(k == kind for _, k, _ in spans) for kind in pii.KINDS]
        assert [s for s in row["spans"].split(",") if s and not s.startswith("term")] == joined.split(",") * bool(spans)


def test_pipeline(spark):
    """Each stage's decisions take effect on what the stage before kept."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        rows = stage(spark, docs, FOLDER)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert rows.columns == COLUMNS
            docs = spark.createDataFrame(rows.collect(), rows.schema)
        kept[name] = rows.collect()
    by_id = {name: {r["doc_id"] for r in rows} for name, rows in kept.items()}

    scores = {r["doc_id"]: r["predicted"] for r in queries.op2_toxicity(spark, FOLDER).collect()}
    assert by_id["toxicity"] == {i for i, toxic in scores.items() if not toxic}
    rows = [(r["doc_id"], r["text"]) for r in kept["toxicity"]]
    assert by_id["minhash near-dedup"] == {i for (i, _), (c, _) in zip(rows, plain_components(rows, 5, 80)) if i == c}
    assert by_id["pii"] == by_id["minhash near-dedup"]
    assert all(not pii.base_spans(r["text"]) for r in kept["pii"])
    sizes = sum(len(r["text"].split()) for r in kept["pii"])
    assert sum(len(r["text"].split()) for r in kept["source mix"]) == pytest.approx(1.5 * sizes, rel=0.05)
    assert by_id["source mix"] <= by_id["pii"]
    vocabulary = bpe.Vocabulary.read(public_tokenizers.path(queries.RANKS))
    texts = sorted(b"".join(vocabulary.bytes_of[i] for i in r["ids"]).decode() for r in kept["byte-level bpe"])
    assert texts == sorted(r["text"] for r in kept["source mix"])
    assert sorted(bytes(r["decoded"]).decode() for r in kept["byte-level bpe"]) == texts


def test_stages_take_odd_rows(spark):
    from llm_cases import docs as odd

    for rows in (None, []):
        docs = odd(spark) if rows is None else odd(spark, rows)
        for name, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, FOLDER)
            if name != corpus_pipeline.STAGES[-1][0]:
                docs = spark.createDataFrame(docs.collect(), docs.schema)
        assert (docs.count() == 0) == (rows == [])


def test_one_row_of_a_group_stays_whatever_its_ids(spark):
    near = lambda n: " ".join(["word%d" % k for k in range(100)] + [f"own{n}"])
    rows = [(5, near(1), "en", "a", 1), (5, near(2), "en", "a", 1), (5, near(3), "en", "b", 1), (5, near(3), "en", "c", 1)]
    rows += [(7, "", "en", "a", 1), (7, "", "en", "b", 1), (None, "  ", "en", "a", 1)]
    rows += [(None, near(4), "en", "a", 1), (5, "quite another text with words of its own", "en", "a", 1), (9, None, None, None, 1)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    found = corpus_pipeline.drop_near_copies(spark, table, FOLDER).collect()
    assert sum("word1 " in r["text"] for r in found) == 1 and len(found) == 6
    assert sorted(str(r["doc_id"]) for r in found if not r["text"].strip()) == ["7", "7", "9", "None"]
