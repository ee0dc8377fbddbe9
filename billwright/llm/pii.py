"""Personal data by fixed patterns, and the terms around it that give it away.

A value that the patterns find is a protected entity. The corpus says how strongly a term
reveals it: pointwise mutual information of term and entity, over documents, as a share
of the entity's own information. At 1 the term always comes with the entity. Terms of a
document that reach the threshold for a value in it are generalised to their first letters,
if those by themselves stay below it, and removed otherwise, wherever the document has them.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from billwright.llm.common import by_batches, written

KINDS = ("email", "ip", "card", "phone")
LABELS = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]"}
REMOVED = "[REMOVED]"

_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
#: A match can only begin where a run of digits does, since it takes runs to their end.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_TERM = re.compile(r"[^\W\d_]{3,}")
#: Pairs of an entity and a term that a row makes in one task.
PAIRS_AT_ONCE = 1_000_000


@dataclass(frozen=True)
class Disclosure:
    """When a term gives a value away.

    ``share`` is the least part of the entity's information, ``together`` the fewest
    documents with both (for an entity of a single document, that one is enough), ``stem``
    the letters that a generalised term keeps.
    """

    share: float = 0.9
    together: int = 2
    stem: int = 4


def _luhn(digits: str) -> bool:
    values = [int(d) for d in reversed(digits)]
    return (sum(values[::2]) + sum(sum(divmod(2 * v, 10)) for v in values[1::2])) % 10 == 0


def base_spans(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) in code points by start, then kind as in KINDS; leftmost, per kind."""
    found = []
    after = at = 0
    while (at := text.find("@", at)) >= 0:
        start = at
        while start > after and text[start - 1] in _LOCAL:
            start -= 1
        match = _DOMAIN.match(text, at + 1) if start < at else None
        at += 1
        if match:
            found.append((start, 0, match.end()))
            after = at = match.end()
    for match in _IP.finditer(text):
        parts = [part.lstrip("0") or "0" for part in match[0].split(".")]
        if all(len(part) <= 3 and int(part) <= 255 for part in parts):
            found.append((match.start(), 1, match.end()))
    for match in _CARD.finditer(text):
        digits = match[0].replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and _luhn(digits):
            found.append((match.start(), 2, match.end()))
    if "+" in text:
        for match in _PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in match[0]) <= 15:
                found.append((match.start(), 3, match.end()))
    return [(start, KINDS[kind], end) for start, kind, end in sorted(found)]


def _entity(kind: str, value: str) -> int:
    plain = value.lower() if kind in ("email", "ip") else re.sub(r"[^0-9]", "", value)
    return xxhash.xxh3_64_intdigest(f"{kind}:{plain}".encode()) - 2**63


def _term(word: str) -> str:
    """A word as terms are counted, compared and looked up."""
    return word.lower()


def _feature(term: str) -> int:
    return xxhash.xxh3_64_intdigest(term.encode()) - 2**63


def _clear_terms(text: str, spans: list[tuple[int, str, int]]) -> list[tuple[int, int]]:
    """Where the text has terms, beside those that touch a span; one merge of two sorted lists."""
    found, n, reach = [], 0, 0
    for match in _TERM.finditer(text):
        while n < len(spans) and spans[n][0] < match.end():
            reach = max(reach, spans[n][2])
            n += 1
        if match.start() >= reach:
            found.append(match.span())
    return found


def _beside(text: str, spans: list[tuple[int, str, int]]) -> tuple[list[int], list[str]]:
    """The distinct entities of a text, and its distinct terms beside them."""
    entities = {_entity(kind, text[start:end]) for start, kind, end in spans}
    return sorted(entities), sorted({_term(text[low:high]) for low, high in _clear_terms(text, spans)})


SPAN = "struct<start:int,kind:string,end:int>"
FOUND = (
    f"row_key long, doc_id long, text string, spans array<{SPAN}>, "
    "entities array<long>, terms array<string>"
)


def _parse(docs: DataFrame, schema: str) -> StructType:
    return docs.sparkSession.createDataFrame([], schema).schema


def find(docs: DataFrame, rule: Disclosure, with_text: bool, keep: Sequence[str] = ()) -> DataFrame:
    """Base spans of every row, with the entities and terms of rows that have any; text of those, or always."""
    source = docs.select(
        docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text"),
        *[docs[name].alias(f"_kept_{name}") for name in keep],
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, texts, spans, entities, terms = [], [], [], [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                text = text or ""
                base = base_spans(text)
                keys.append(xxhash.xxh3_64_intdigest(f"{doc_id}:{text}".encode()) - 2**63)
                texts.append(text if base or with_text else None)
                spans.append([{"start": s, "kind": k, "end": e} for s, k, e in base])
                values, words = _beside(text, base) if base else ([], [])
                entities.append(values)
                terms.append(words)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(keys, pa.int64()), batch.column(0), pa.array(texts, pa.string()),
                    pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.string()), ("end", pa.int32())]))),
                    pa.array(entities, pa.list_(pa.int64())), pa.array(terms, pa.list_(pa.string())),
                    *batch.columns[2:],
                ],
                names=["row_key", "doc_id", "text", "spans", "entities", "terms", *batch.schema.names[2:]],
            )

    return by_batches(source, run, StructType([*_parse(docs, FOUND).fields, *source.schema.fields[2:]]))


def document_counts(docs: DataFrame, stem: int) -> DataFrame:
    """(feature, docs): in how many rows each term, and each stem, occurs. Added up per batch first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: Counter[str] = Counter()
            for text in batch.column(0).to_pylist():
                terms = set(map(_term, set(_TERM.findall(text or ""))))
                terms.update([term[:stem] + "*" for term in terms if len(term) > stem])
                seen.update(terms)
            if seen:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([_feature(t) for t in seen], pa.int64()),
                        pa.array(list(seen.values()), pa.int64()),
                    ],
                    names=["feature", "docs"],
                )

    return (
        by_batches(docs.select("text"), run, "feature long, docs long")
        .groupBy("feature").agg(F.sum("docs").alias("docs"))
    )


def disclosing(docs: DataFrame, found: DataFrame, rule: Disclosure) -> DataFrame:
    """(entity, term, stem) for the terms that give an entity away; stem is null if it does, too.

    With n rows, information of an entity is log2(n / rows with it), and a term's share
    is log2(together * n / (rows with it * rows with the term)) of that. An entity in
    every row tells nothing and has no disclosing terms. All rows count, repeated ones as
    often as they occur. Every entity of a row is paired with all of the row's terms; pairs
    are counted before they are shuffled, and those of a row with very many are dealt out
    over several tasks by its entities.
    """
    rows = docs.count()
    once = written(
        found.where(F.size("entities") > 0).groupBy("row_key").agg(
            F.first("entities").alias("entities"), F.first("terms").alias("terms"), F.count(F.lit(1)).alias("copies")
        )
    )
    short = lambda term: F.concat(F.substring(term, 1, rule.stem), F.lit("*"))
    stem = F.when(F.length("term") > rule.stem, short(F.col("term")))
    stems_too = F.array_distinct(F.concat(
        "terms", F.transform(F.filter("terms", lambda t: F.length(t) > rule.stem), short)
    ))
    entities = once.select(F.explode("entities").alias("entity"), "copies").groupBy("entity").agg(
        F.sum("copies").alias("with_entity")
    )
    at_once = F.greatest(F.lit(1), F.floor(F.lit(PAIRS_AT_ONCE) / F.greatest(F.size("terms"), F.lit(1))).cast("int"))
    starts = F.sequence(F.lit(1), F.size("entities"), at_once)
    large = F.size("entities").cast("long") * F.size("terms") > PAIRS_AT_ONCE
    dealt = (
        once.where(large).select("row_key", "entities", "terms", "copies", at_once.alias("n"), F.explode(starts).alias("at"))
        .select("row_key", "at", F.slice("entities", F.col("at"), F.col("n")).alias("entities"), "terms", "copies")
        .repartition("row_key", "at").select("entities", "terms", "copies")
    )
    both = (
        once.where(~large).select("entities", "terms", "copies").unionByName(dealt)
        .select("entities", "copies", F.explode(stems_too).alias("term"))
        .select(F.explode("entities").alias("entity"), "term", "copies")
        .groupBy("entity", "term").agg(F.sum("copies").alias("both"))
    )
    named_both = written(
        both.join(entities, "entity").where((F.col("both") >= rule.together) | (F.col("with_entity") == 1))
    )
    wanted = named_both.select("term").distinct()
    key = _feature_column(wanted)
    counts = document_counts(docs, rule.stem).join(key, "feature").select("term", "docs")
    scored = named_both.join(counts, "term").where(F.col("with_entity") < rows)
    share = F.log2(F.col("both") * rows / (F.col("with_entity") * F.col("docs"))) / F.log2(rows / F.col("with_entity"))
    telling = written(scored.where(share >= rule.share).select("entity", "term"))
    stems = telling.where(F.col("term").endswith("*")).select(
        F.col("entity").alias("_entity"), F.col("term").alias("_stem")
    )
    return (
        telling.where(~F.col("term").endswith("*")).withColumn("stem", stem)
        .join(stems, (F.col("entity") == F.col("_entity")) & (F.col("stem") == F.col("_stem")), "left")
        .select("entity", "term", F.when(F.col("_stem").isNull(), F.col("stem")).alias("stem"))
    )


def _feature_column(terms: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = [_feature(t) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(hashes, pa.int64()), batch.column(0)], names=["feature", "term"])

    return terms.mapInArrow(run, "feature long, term string")


def _cleaned(text: str, spans: list[tuple[int, str, int]], told: dict[str, str | None]):
    """All spans, and the text without them."""
    added = [
        (low, "term", high, told[word])
        for low, high in _clear_terms(text, spans)
        if (word := _term(text[low:high])) in told
    ]
    both = sorted([(s, KINDS.index(k), e, LABELS[k]) for s, k, e in spans] + [(s, len(KINDS), e, g or REMOVED) for s, _, e, g in added])
    parts, at = [], 0
    for start, _, end, instead in both:
        if start >= at:
            parts += [text[at:start], instead]
        at = max(at, end)
    parts.append(text[at:])
    names = [*KINDS, "term"]
    return [{"start": s, "kind": names[k], "end": e} for s, k, e, _ in both], "".join(parts)


def sanitise(
    docs: DataFrame, rule: Disclosure = Disclosure(), with_text: bool = True, keep: Sequence[str] = ()
) -> DataFrame:
    """(doc_id, base array<span>, spans array<span>, text) and ``keep`` for every row of ``docs``.

    ``base`` are the spans of the patterns, ``spans`` these and the disclosing terms, both
    by start and then kind; offsets are code points, end exclusive. ``text`` has every
    span replaced by its label, by the term's first letters or by a mark; spans that
    overlap are replaced by the first one's label. With ``with_text`` off, the texts of
    rows without spans are left out.

    Null text is empty and has no spans. Rows with a null id and repeated rows are rows
    like others, and every row counts, so that copies of a document change nothing about
    what its terms disclose. Counts cover all rows.
    """
    found = written(find(docs, rule, with_text, keep))
    kept = [f"_kept_{name}" for name in keep]
    told = disclosing(docs, found, rule)
    with_spans = found.where(F.size("spans") > 0)
    per_row = (
        with_spans.dropDuplicates(["row_key"]).select("row_key", "terms", F.explode("entities").alias("entity"))
        .select("row_key", "entity", F.explode("terms").alias("term"))
        .join(told, ["entity", "term"])
        .groupBy("row_key", "term").agg(
            F.when(F.bool_and(F.col("stem").isNotNull()), F.first("stem")).alias("stem")
        )
        .groupBy(F.col("row_key").alias("_key")).agg(F.collect_list(F.struct("term", "stem")).alias("told"))
    )
    schema = StructType([
        *_parse(docs, f"doc_id long, base array<{SPAN}>, spans array<{SPAN}>, text string").fields,
        *[found.schema[name] for name in kept],
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int64(), *[pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.string()), ("end", pa.int32())]))] * 2, pa.string()]
        for batch in batches:
            rows = []
            for row in batch.select(["doc_id", "text", "spans", "told"]).to_pylist():
                base = [(s["start"], s["kind"], s["end"]) for s in row["spans"]]
                terms = {t["term"]: t["stem"] for t in row["told"] or ()}
                spans, text = _cleaned(row["text"], base, terms)
                rows.append((row["doc_id"], row["spans"], spans, text))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(list(c), t) for c, t in zip(zip(*rows), types)), *batch.columns[4:]],
                    names=schema.names,
                )

    joined = with_spans.join(per_row, F.col("row_key") == F.col("_key"), "left")
    touched = by_batches(joined.select("doc_id", "text", "spans", "told", *kept), run, schema)
    clear = found.where(F.size("spans") == 0).select("doc_id", F.col("spans").alias("base"), "spans", "text", *kept)
    return touched.unionByName(clear).select(
        "doc_id", "base", "spans", "text", *[F.col(f"_kept_{name}").alias(name) for name in keep]
    )


def spans_text(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )
