"""From raw documents to ids of tokens, in stages that each read what the last one kept.

A stage takes (spark, docs, sf_dir). All but the last return the columns of documents:
doc_id, text, lang, source, n_chars. Other columns of the input are left out.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from billwright.llm import bpe, minhash, mixing, pii, toxicity
from billwright.llm.common import WORD_PATTERN, table, written
from billwright.llm.queries import RANKS


def _documents(docs: DataFrame) -> DataFrame:
    """The columns of documents, n_chars made anew from the text."""
    text = F.coalesce(docs["text"], F.lit(""))
    return docs.select(
        docs["doc_id"].cast("long").alias("doc_id"), text.alias("text"), docs["lang"], docs["source"],
        F.length(text).cast("long").alias("n_chars"),
    )


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold of rejection."""
    docs = _documents(docs)
    field = toxicity.fit_from(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, field, keep=docs.columns, below=toxicity.REJECT).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies; rows without words are no copies and all stay.

    A group's row is the one with the smallest id, whether or not others share that id.
    """
    docs = _documents(docs)
    found = minhash.near_duplicates(docs).where("chosen and n_shingles > 0")
    kept = written(
        found.groupBy(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"))
        .agg(F.count(F.lit(1)).alias("_copies"))
    )
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_key"))
    single = docs.join(kept.where("_copies = 1"), same, "left_semi")
    several = docs.join(kept.where("_copies > 1"), same).dropDuplicates(["_id", "_key"]).select(*docs.columns)
    wordless = docs.where(~F.col("text").rlike(WORD_PATTERN))
    return single.unionByName(several).unionByName(wordless)


def clean_private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without personal data and the terms that give it away."""
    return _documents(pii.sanitise(_documents(docs), keep=("lang", "source")))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes of each document, as often as it takes it."""
    mixed = mixing.mix(_documents(docs), keep=("text", "lang", "source"))
    return _documents(mixing.taken_texts(mixed))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, ids, decoded) of everything that the mix takes; decoded are the bytes of the ids again."""
    return bpe.encode(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN, round_trip=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("minhash near-dedup", drop_near_copies),
    ("pii", clean_private),
    ("source mix", mix_sources),
    ("byte-level bpe", encode),
]

#: The field, the merges and the texts of the mix go beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = written(docs)
    return docs
