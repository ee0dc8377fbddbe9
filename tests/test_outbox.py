"""What the outbox costs: long texts are made late, and not one file or stored row for each."""

import datetime

from billwright import sinks
from billwright.checks import queries as Q
from billwright.functions import text as X
from billwright.operators import storage
from billwright.plans import message as M
from billwright.plans import report as P
from conftest import bag
from pyspark.sql import functions as F

D = datetime.date


def test_no_bodies_are_stored_for_the_second_write(spark, tables, monkeypatch):
    """A batch of thousands of bodies, read from Parquet at once, was more than an executor held."""
    monkeypatch.setattr(storage, "_made", [])
    monkeypatch.setattr(Q, "star_tables", lambda *_: tables)
    found = bag(Q.s5_outbox_again(spark, "").select("to", "subject", "as_of", "part", "parts", "html_body"))
    made = [path for path in storage._made if "/stored-" in path]
    assert made and not any("html_body" in spark.read.parquet(path).columns for path in made)
    expected = M.outbox(Q._daily_bodies(tables), Q.RECIPIENTS, X.subject(F.col("as_of")))
    assert found == bag(expected.select("to", "subject", "as_of", "part", "parts", "html_body")) != []


def test_parts_share_files(spark, tables, tmp_path):
    inputs = P.report_inputs(tables, since=D(2026, 5, 1))
    messages = M.report_message(inputs, D(2026, 5, 11), "a@x; b@y", rows_per_part=1)
    sinks.write_outboxes(messages.withColumn("as_of", F.lit(D(2026, 5, 11))), str(tmp_path), "as_of", compression="gzip")
    files = list(tmp_path.glob("*/*/part-*"))
    assert 2 <= len(files) <= 2 * 2 and all(file.name.endswith(".json.gz") for file in files)
    assert bag(sinks.read_outbox(spark, str(tmp_path), D(2026, 5, 11)).drop("day")) == bag(messages)
    assert messages.count() == 2 * 17


def test_rows_become_html_after_they_are_dealt_out(spark, tables):
    """Neither HTML nor lists of it are shuffled, and rows meet their day without a shuffle."""
    text = Q._daily_bodies(tables)._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    inputs = [
        block.split("Input [", 1)[1].split("\n")[0] for block in text.split("\n\n")
        if ") Exchange\n" in block and "Input [" in block
    ]
    assert inputs and any("cliente#" in line for line in inputs)
    assert not any("html" in line or "buf" in line for line in inputs)
    assert "hashpartitioning(data_emissao#" not in "".join(
        block for block in text.split("\n\n") if ") Exchange\n" in block and "cliente#" in block
    )


def test_rows_and_their_html_make_the_same_parts(spark, tables):
    positioned = P.sorted_report(P.report_rows(P.report_inputs(tables)))
    totals = spark.sql("select cast(5 as decimal(38,4)) as total")
    for size in (1, 4, 100):
        html = M.html_rows(P.formatted_report(positioned), True)
        expected = bag(M.message_parts(html, totals, size))
        assert bag(M.parts_of_rows(positioned, totals, size, literal_cleanup=True)) == expected != []
