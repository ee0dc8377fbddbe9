"""Tables laid out by month and in buckets: same reports, less read or shuffled."""

import datetime
import glob
import os

import pytest
from pyspark.sql import functions as F

from billwright import InvoiceTables, Rules
from billwright.operators import storage
from billwright.plans import report as P
from billwright.plans.inputs import Inputs
from billwright.plans.view import invoice_view
from billwright.schemas import BASE_TABLES
from billwright.sources import landing
from billwright.sources.setaside import conform_or_set_aside
from billwright.sources.tables import MONTH, NUMBER_KEYS
from conftest import bag
from test_plans import plan
from test_random import random_rows

SINCE = datetime.date(2001, 6, 1)


@pytest.fixture(scope="module")
def given(spark, tmp_path_factory):
    """Random tables as Parquet; invoice numbers repeat over months, dates and numbers may be null."""
    rows = random_rows(5)
    made = InvoiceTables(lambda name: spark.createDataFrame(rows[name], BASE_TABLES[name]))
    return made.land(spark, str(tmp_path_factory.mktemp("plain")))


@pytest.fixture(scope="module")
def months(spark, given, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("months"))
    return landing.land_by_month(given, spark, folder), folder


def test_by_month_nothing_is_lost(given, months):
    by_month, folder = months
    for name, schema in BASE_TABLES.items():
        assert by_month[name].dtypes == [(f.name, f.dataType.simpleString()) for f in schema]
        assert bag(by_month[name]) == bag(given[name])
    assert len(glob.glob(f"{folder}/tnota_fiscal/{MONTH}=*")) > 3
    assert bag(invoice_view(by_month)) == bag(invoice_view(given))


@pytest.mark.parametrize("until", [None, datetime.date(2001, 7, 9)])
@pytest.mark.parametrize("rows_per_task", [3, 10**9])
def test_by_month_reports_are_the_same(given, months, until, rows_per_task):
    rules = Rules(rows_per_task=rows_per_task)
    reports = [P.report_inputs(tables, rules, since=SINCE, until=until) for tables in (given, months[0])]
    assert bag(P.report_rows(reports[0])) == bag(P.report_rows(reports[1])) != []
    assert bag(P.monthly_total(reports[0])) == bag(P.monthly_total(reports[1]))
    assert bag(P.daily_totals(P.report_inputs(given, rules))) == bag(P.daily_totals(P.report_inputs(months[0], rules)))


def test_a_month_opens_no_other_folders(spark, given, tmp_path):
    """The files of all other months are unreadable, and the report doesn't notice."""
    numbers = F.col("numero") + 100 * F.month("dt_emissao")
    once = InvoiceTables(lambda name: given[name].withColumn("numero", numbers) if name == "tnota_fiscal" else given[name])
    folder = str(tmp_path)
    landing.land_by_month(once, spark, folder)
    since, until = datetime.date(2001, 6, 1), datetime.date(2001, 6, 30)
    expected = bag(P.monthly_total(P.report_inputs(once, since=since, until=until)))
    spoiled = 0
    for name in NUMBER_KEYS:
        for path in glob.glob(f"{folder}/{name}/{MONTH}=*/*.parquet"):
            if "2001-06-01" not in path:
                with open(path, "r+b") as file:
                    file.write(b"nothing")
                    file.seek(-8, 2)
                    file.write(b"spoiled!")
                spoiled += 1
    for path in glob.glob(f"{folder}/*/{MONTH}=*/.*.crc"):
        open(path, "wb").close() if "2001-06-01" not in path else None
    inputs = P.report_inputs(landing.from_months(spark, folder), since=since, until=until)
    assert bag(P.monthly_total(inputs)) == expected and spoiled > 5
    with pytest.raises(Exception):
        landing.from_months(spark, folder)["tnota_fiscal"].collect()


def test_month_filters_are_on_folders(spark, months):
    name = "spark.sql.maxMetadataStringLength"
    before = spark.conf.get(name)
    spark.conf.set(name, "3000")
    try:
        inputs = P.report_inputs(months[0], since=SINCE)
        headers = plan(Inputs(months[0], header_filter=P.in_report(Rules(), SINCE), issued=(SINCE, None)).headers())
        lines = [plan(rows) for rows in (inputs.services(), inputs.returns(), inputs.billing_orders())]
    finally:
        spark.conf.set(name, before)
    filters = lambda text: text[text.index("PartitionFilters"):].split("], ")[0]
    assert MONTH in filters(headers) and all(MONTH in filters(text) for text in lines)


def test_by_month_without_rows(spark, tmp_path):
    empty = InvoiceTables(lambda name: spark.createDataFrame([], BASE_TABLES[name]))
    by_month = landing.land_by_month(empty, spark, str(tmp_path))
    assert invoice_view(by_month).collect() == []
    assert P.monthly_total(P.report_inputs(by_month, since=SINCE)).first()["total"] == 0


@pytest.fixture(scope="module")
def buckets(spark, given, tmp_path_factory):
    return landing.land_in_buckets(given, spark, "bucketed", 8, str(tmp_path_factory.mktemp("buckets")))


def test_buckets_hold_the_same_rows(given, buckets):
    for name in BASE_TABLES:
        assert bag(buckets[name]) == bag(given[name])
    assert bag(invoice_view(buckets)) == bag(invoice_view(given))


def _without_broadcasts(spark, make):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    try:
        return plan(make())
    finally:
        spark.conf.set(name, before)


def _shuffles(text):
    """Shuffles of one side of a join on the invoice number, or of the grouping before it."""
    keys = ("nf#", "goods_nf#", "service_nf#", "returned_nf#", "billed_nf#", "numero", "nfref_numero_nf#")
    return [line for line in text.splitlines() if any(f"Exchange hashpartitioning({key}" in line for key in keys)]


def test_joins_on_the_number_need_no_shuffle(spark, given, buckets):
    view = lambda tables: lambda: invoice_view(tables, Rules(rows_per_task=10**9))
    assert _shuffles(_without_broadcasts(spark, view(given)))
    text = _without_broadcasts(spark, view(buckets))
    assert not _shuffles(text)
    assert text.count("Bucketed: true") == 5


def test_rows_set_aside(spark):
    rows = [("1", "2026-05-04 10:00:00", "5.5"), ("x", "2026-02-31", "1"), (None, None, None), ("3", "soon", "y")]
    df = spark.createDataFrame(rows, "numero string, dt_emissao string, qtde string")
    schema = BASE_TABLES["tnota_fiscal"]
    wanted = type(schema)([schema["numero"], schema["dt_emissao"], BASE_TABLES["tnota_fiscal_item"]["qtde"]])
    good, aside = conform_or_set_aside(df, wanted)
    assert good.schema.simpleString() == wanted.simpleString()
    assert bag(good) == [(1, datetime.datetime(2026, 5, 4, 10), 5.5), (None, None, None)]
    reasons = {row["numero"]: row["reason"] for row in aside.collect()}
    assert reasons == {"x": "numero: x; dt_emissao: 2026-02-31", "3": "dt_emissao: soon; qtde: y"}
    assert good.count() + aside.count() == df.count()
    good, aside = conform_or_set_aside(df.where("false"), wanted)
    assert good.count() == aside.count() == 0


def test_intermediate_results_are_removed(spark, given, monkeypatch):
    monkeypatch.setattr(storage, "_made", [])
    rows = P.report_rows(P.report_inputs(given, since=SINCE))
    assert rows.count() and (made := list(storage._made))
    assert all(os.path.isdir(path.removeprefix("file:")) for path in made)
    assert storage.discard_stored(spark) == len(made) and storage.discard_stored(spark) == 0
    assert not any(os.path.exists(path.removeprefix("file:")) for path in made)


def test_buckets_follow_the_rows(spark, given, tmp_path, monkeypatch):
    """As many as the largest table wants, the same for all five, so that none outgrows a task."""
    monkeypatch.setattr(landing, "ROWS_PER_BUCKET", 7)
    dealt = landing.land_in_buckets(given, spark, "many", 2, str(tmp_path))
    wanted = -(-max(given[name].count() for name in NUMBER_KEYS) // 7)
    assert wanted > 2
    for name in NUMBER_KEYS:
        found = {row[0]: row[1] for row in spark.sql(f"describe formatted many_{name}").collect()}
        assert int(found["Num Buckets"]) == wanted
        assert bag(dealt[name]) == bag(given[name])
    assert bag(invoice_view(dealt)) == bag(invoice_view(given))
