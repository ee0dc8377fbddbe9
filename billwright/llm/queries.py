"""One query per operator over its whole table, with the parameters of production."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from billwright.llm import (
    bpe, codes, embeddings, licences, maxent, minhash, mixing, negatives, pieces, pii, topk, toxicity, warc,
)
from billwright.llm.common import crc_remainder, table

RANKS = "byte_bpe_multi_50k.tiktoken"
PIECES = "piece_bpe_32k.model"


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document, and the terms that give it away."""
    found = pii.sanitise(table(spark, sf_dir, "documents"), with_text=False)
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", *[count(kind).alias(f"n_{kind}") for kind in pii.KINDS],
        F.sha2(pii.spans_text(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        pii.spans_text(F.col("spans")).alias("spans"),
    )


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How toxic every document is, and where."""
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.score(docs, toxicity.fit_from(docs, table(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id", (crc_remainder(F.col("doc_id"), 3) == 1).alias("held_out"), "score",
        (F.col("score") >= toxicity.REJECT).cast("int").alias("predicted"),
        F.array_join(F.transform("spans", lambda s: F.concat_ws(
            ":", s["start"].cast("string"), s["end"].cast("string"))), ",").alias("spans"),
    )


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document and the bytes that they stand for, as digests."""
    path = public_tokenizers.path(RANKS)
    docs = table(spark, sf_dir, "documents")
    return bpe.encode(docs, path, public_tokenizers.PATTERN, round_trip=True).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(bpe.ids_text(F.col("ids")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op4_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest vectors to every fiftieth, by integer inner product."""
    vectors = table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, vectors.where(F.col("vec_id") % 50 == 0), k=5)


def op5_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The canonical digest of every document, and the licence that it is."""
    return licences.scan(table(spark, sf_dir, "documents"), licences.known_digests(spark))


def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicates of all documents: three-word shingles, similarity 0.85."""
    found = minhash.near_duplicates(table(spark, sf_dir, "documents"), width=3, percent=85)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op7_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents, learned from six in seven of them."""
    docs = table(spark, sf_dir, "documents")
    return maxent.score(docs, crc_remainder(docs["doc_id"], 7) == 2)


def op8_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of every document the mix takes."""
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op9_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicates of all vectors: cosine 0.9."""
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"), least=0.9)


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the archives of all pages hold, read back."""
    manifest = warc.write_archives(warc.plan_records(table(spark, sf_dir, "pages")))
    return warc.read_archives(manifest).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op11_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document and the text that they stand for, as digests."""
    path = public_tokenizers.path(PIECES)
    return pieces.encode(table(spark, sf_dir, "documents"), path, round_trip=True).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(pieces.ids_text(F.col("ids")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten hardest negatives for each of five positives of every hundredth vector."""
    vectors = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(vectors.withColumn("label", moved), F.col("vec_id") % 100 == 0)


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sixteen numbers of codebook entries for every vector, and what they leave out."""
    found, books = codes.compress(table(spark, sf_dir, "embeddings"))
    return found.select(
        F.col("id").alias("vec_id"), codes.code_text("numbers").alias("code"), "error", "label_error",
        F.lit(codes.books_digest(books)).alias("codebooks_sha256"),
    )


QUERIES = {
    "op1_pii": op1_pii,
    "op2_toxicity": op2_toxicity,
    "op3_byte_bpe": op3_byte_bpe,
    "op4_topk": op4_topk,
    "op5_licences": op5_licences,
    "op6_minhash": op6_minhash,
    "op7_lm_score": op7_lm_score,
    "op8_source_mix": op8_source_mix,
    "op9_embeddings": op9_embeddings,
    "op10_warc": op10_warc,
    "op11_sentencepiece": op11_sentencepiece,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_vector_codes": op13_vector_codes,
}


def _codes_sql(parts: int = 16, entries: int = 64, rounds: int = 2) -> str:
    """The codes with each round of fitting as a query of its own."""
    nearest = """
        SELECT p.vec_id, p.part, min((list_sum(list_transform(list_zip(p.y, b.y), lambda z: (z[1] - z[2]) * (z[1] - z[2])))) * {entries} + b.entry) AS best
        FROM p JOIN b{n} b ON p.part = b.part GROUP BY p.vec_id, p.part"""
    fit = """
        a{n} AS ({nearest}
        ), m{n} AS (
            SELECT part, entry, place, sum(y)::HUGEINT AS total, count(*) AS c
            FROM (SELECT p.part, a.best % {entries} AS entry, unnest(p.y) AS y, unnest(range(len(p.y))) AS place
                  FROM p JOIN a{n} a ON p.vec_id = a.vec_id AND p.part = a.part)
            GROUP BY part, entry, place
        ), f{n} AS (
            SELECT part, entry, list(((total - ((total % c) + c) % c) // c)::BIGINT ORDER BY place) AS y FROM m{n} GROUP BY part, entry
        ), b{next} AS (
            SELECT b.part, b.entry, coalesce(f.y, b.y) AS y
            FROM b{n} b LEFT JOIN f{n} f ON b.part = f.part AND b.entry = f.entry
        ),"""
    steps = "".join(
        fit.format(n=n, next=n + 1, entries=entries, nearest=nearest.format(n=n, entries=entries)) for n in range(rounds)
    )
    return f"""
        WITH v AS (
            SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
            FROM embeddings
            WHERE embedding IS NOT NULL AND len(embedding) > 0
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), p AS (
            SELECT vec_id, part, e[part * len(e) // {parts} + 1 : (part + 1) * len(e) // {parts}] AS y
            FROM v, range({parts}) AS r(part)
        ), b0 AS (
            SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry, y
            FROM p WHERE vec_id IN (SELECT vec_id FROM v ORDER BY vec_id LIMIT {entries})
        ), {steps} last AS ({nearest.format(n=rounds, entries=entries)}
        ), c AS (
            SELECT vec_id, string_agg(printf('%02x', best % {entries}), '' ORDER BY part) AS code,
                   CAST(sum(best // {entries}) AS BIGINT) AS error
            FROM last GROUP BY vec_id
        ), books AS (
            SELECT sha256(string_agg(y, ',' ORDER BY part, entry, place)) AS codebooks_sha256
            FROM (SELECT part, entry, unnest(y)::VARCHAR AS y, unnest(range(len(y))) AS place FROM b{rounds})
        )
        SELECT c.vec_id, c.code, c.error,
               CAST(sum(c.error) OVER (PARTITION BY v.label) AS BIGINT) AS label_error, codebooks_sha256
        FROM c JOIN v ON c.vec_id = v.vec_id CROSS JOIN books
    """

#: The same results as DuckDB SQL, where SQL can express them.
ORACLE_SQL: dict[str, str] = {
    "op5_licences": licences.oracle_sql(),
    "op4_topk": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
            FROM embeddings
            WHERE embedding IS NOT NULL AND len(embedding) > 0
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), s AS (
            SELECT q.vec_id AS query_id, c.vec_id,
                   CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda z: z[1] * z[2])) AS BIGINT) AS score
            FROM v q JOIN v c ON q.vec_id <> c.vec_id
            WHERE q.vec_id % 50 = 0
        ), r AS (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
        )
        SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
    """,
    "op10_warc": """
        WITH p AS (
            SELECT page_id, coalesce(html, '') AS html FROM pages
        ), d AS (
            SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes,
                   sha256(html) AS payload_digest
            FROM p
        ), f AS (
            SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM d
        )
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN payload_bytes >= 100 AND page_id > first THEN 'revisit'
                    ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= 100 AND page_id > first THEN first END AS refers_to
        FROM f
    """,
    "op12_hard_negatives": """
        WITH v AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
            FROM embeddings
            WHERE label IS NOT NULL AND vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), s AS (
            SELECT a.vec_id AS anchor_id, c.vec_id AS other_id, a.label = c.label AS same,
                   CAST(list_sum(list_transform(list_zip(a.e, c.e), lambda z: z[1] * z[2])) AS BIGINT) AS score
            FROM v a JOIN v c ON a.vec_id <> c.vec_id
            WHERE a.vec_id % 100 = 0
        ), p AS (
            SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) AS place
            FROM s WHERE same
        ), n AS (
            SELECT p.anchor_id, p.other_id AS positive_id, p.score AS positive_score,
                   s.other_id AS negative_id, s.score AS negative_score,
                   row_number() OVER (PARTITION BY p.anchor_id, p.other_id ORDER BY s.score DESC, s.other_id) AS rank
            FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT s.same
             AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score
            WHERE p.place <= 5
        )
        SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
        FROM n WHERE rank <= 10
    """,
    "op13_vector_codes": _codes_sql(),
}
