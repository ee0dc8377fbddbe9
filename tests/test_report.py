"""Report rows, totals and the backfill."""

import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from billwright import InvoiceTables, Rules
from billwright.operators import calendar as C
from billwright.plans import report as P
from billwright.plans.view import invoice_view
from billwright.rules import PROJECT_CFOPS
from billwright.sources.star import star_tables
from conftest import DATA, bag

D = datetime.date


@pytest.fixture(scope="module")
def star(spark):
    return star_tables(spark, f"{DATA}/sf0.001")


@pytest.mark.parametrize(
    ("since", "rows", "total", "text"),
    [
        (D(2026, 5, 1), 17, "7528", "R$7,528.00"),
        (D(2026, 4, 1), 18, "7638", "R$7,638.00"),
        (D(2026, 6, 1), 0, "0", "R$0.00"),
    ],
)
def test_fixture_report(tables, since, rows, total, text):
    report = P.report_rows(P.report_inputs(tables, since=since))
    assert report.count() == rows
    assert P.total_of_rows(report).first()["total"] == Decimal(total)
    row = P.monthly_total(P.report_inputs(tables, since=since)).first()
    assert (row["total"], row["total_text"]) == (Decimal(total), text)


def test_monthly_detail(tables):
    rows = sorted(P.monthly_detail(P.report_inputs(tables, since=D(2026, 5, 1))).collect(), key=lambda row: row["idx"])
    assert [row["idx"] for row in rows] == list(range(17))
    assert rows[0]["data_emissao"] == "11/05/2026" and rows[-1]["data_emissao"] == "04/05/2026"
    assert rows[0]["valor"] == "R$\u00a02.000,00"
    assert {row["valor"] for row in rows if row["nf"] in (12, 13)} == {None}


def test_upper_bound(tables):
    total = P.report_total(
        P.report_inputs(tables, since=D(2026, 5, 1), until=D(2026, 5, 6))
    ).first()["total"]
    assert total == Decimal(400 + 770)


def test_known_star_report(star):
    july = P.report_inputs(star, since=D(2001, 7, 1))
    rows = P.report_rows(july)
    assert rows.count() == 69
    assert rows.select("nf").distinct().count() == 16
    assert P.report_total(july).first()["total"] == Decimal("1853024.7352")


def test_windowed_report_equals_filtered_view(spark, star):
    since = D(2001, 5, 1)
    expected = bag(
        invoice_view(star)
        .where((F.col("saida") == "X") & F.col("cfop").isin(*PROJECT_CFOPS))
        .where(F.col("data_emissao") >= F.lit(since))
        .select(*P.REPORT_COLUMNS)
    )
    assert bag(P.report_rows(P.report_inputs(star, since=since))) == expected
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert bag(P.report_rows(P.report_inputs(star, since=since))) == expected
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_copies_of_lines_without_a_guid_stay_in_their_tasks(spark, star):
    goods = star["tnota_fiscal_item"]
    copies = goods.where("guid_orcamento is null").limit(1).crossJoin(spark.range(0, 20_000, 1, 8)).drop("id")
    many = InvoiceTables(lambda name: copies if name == "tnota_fiscal_item" else star[name])
    plan = P._goods_per_invoice(P.report_inputs(many), {"goods.guid": {}, "quote_lines.quote": {}})
    assert plan.count() == 1


def test_totals_equal_the_sum_over_rows(star):
    rows = P.report_rows(P.report_inputs(star))
    assert P.report_total(P.report_inputs(star)).first()["total"] == P.total_of_rows(rows).first()["total"]
    assert P.total_of_rows(rows).first()["total"] <= rows.agg(F.sum("valor")).first()[0]


def test_statuses_partition_the_rows(star):
    kinds = invoice_view(star).groupBy(F.substring("status", 1, 9).alias("kind")).count()
    counts = {row["kind"]: row["count"] for row in kinds.collect()}
    assert set(counts) == {"Autorizad", "Aguardand", "Devolvida", "Cancelada"}
    assert sum(counts.values()) == 4296


@pytest.mark.parametrize("mode", [C.COMPAT, C.STRICT])
def test_backfill_equals_each_days_report(spark, star, mode):
    days = C.day_spine(star["tnota_fiscal"].select(F.to_date("dt_emissao").alias("d")), "d")
    holidays = C.holidays_around(days)
    backfill = P.backfill_totals(P.daily_totals(P.report_inputs(star)), days, holidays, mode).cache()
    assert backfill.count() == days.count() == 2405
    daily = {row["data_emissao"]: row["total"] for row in P.daily_totals(P.report_inputs(star)).collect()}
    for row in backfill.collect():
        inside = [v for day, v in daily.items() if row["window_start"] <= day <= row["as_of"]]
        assert row["total"] == sum(inside, Decimal(0)), row
    some = D(1998, 5, 2)
    start = C.window_start_on(spark, some, holidays, mode)
    assert start == (D(1998, 4, 1) if mode == C.COMPAT else D(1998, 5, 1))
    total = P.report_total(P.report_inputs(star, since=start, until=some)).first()["total"]
    assert backfill.where(F.col("as_of") == F.lit(some)).first()["total"] == total


def test_rules_are_parameters(tables):
    only = P.report_rows(
        P.report_inputs(tables, Rules(cfops=("5910",)), since=D(2026, 5, 1))
    )
    assert [row["nf"] for row in only.collect()] == [18]
