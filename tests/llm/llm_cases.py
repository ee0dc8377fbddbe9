"""Small tables with everything that may be odd, for all operators on documents."""

from pyspark.sql import types as T

LONG = "palabra " * 60_000

#: Extra columns whose names the operators might use themselves.
EXTRA = ("id", "ids", "words", "node", "kept", "score", "spans", "size", "target", "value", "_id", "told", "row")

DOCS = [
    (1, "The quick brown fox jumps over the lazy dog again and again", "en", "b"),
    (2, "The quick brown fox jumps over the lazy dog again and again", "en", "b"),
    (2, "The quick brown fox jumps over the lazy dog again and again", "en", "b"),
    (3, None, None, None),
    (4, "", "en", "a"),
    (5, " \n\t ", "en", "a"),
    (6, LONG, "es", "a"),
    (7, "word", "en", None),
    (None, "no id here at all", "en", "c"),
    (8, "ÀÉ ß 日本語 '\" \\ \u0000   end", "fr", "c"),
]


def docs(spark, rows=DOCS, extra=True):
    schema = T.StructType(
        [T.StructField("doc_id", T.LongType())]
        + [T.StructField(name, T.StringType()) for name in ("text", "lang", "source")]
    )
    df = spark.createDataFrame(rows, schema)
    if extra:
        for name in EXTRA:
            df = df.selectExpr("*", f"cast(null as string) as `{name}`")
    return df
