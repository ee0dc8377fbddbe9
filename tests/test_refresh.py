"""Changes to the base tables against building everything anew."""

import random
import time

import pytest
from pyspark.sql import functions as F

from billwright import InvoiceTables, Rules
from billwright.operators import calendar as C
from billwright.operators import storage
from billwright.plans import refresh
from billwright.plans import report as P
from billwright.plans.ledger import CHANGE, LEDGERS, DailyLedger
from billwright.plans.refresh import affected_invoices, refresh_view, store_view, stored_view
from billwright.plans.inputs import Inputs
from billwright.plans.view import invoice_view, view_of
from billwright.schemas import BASE_TABLES
from conftest import bag
from test_random import random_rows

RULES = Rules(rows_per_task=10**9)


def _changed(rows, seed, names=tuple(BASE_TABLES), most=6):
    """(rows after, rows that went, rows that came) by table."""
    rng, fresh = random.Random(seed), random_rows(1000 + seed)
    after, went, came = {}, {}, {}
    for name, own in rows.items():
        gone, new = [], []
        if name in names:
            gone = rng.sample(own, min(len(own), rng.randrange(most)))
            new = rng.sample(fresh[name], rng.randrange(most))
        left = list(own)
        for row in gone:
            left.remove(row)
        after[name], went[name], came[name] = left + new, gone, new
    return after, went, came


def _tables(spark, rows):
    return InvoiceTables(lambda name: spark.createDataFrame(rows[name], BASE_TABLES[name]))


def _frames(spark, *images):
    """By table, the rows of all images; with their change if there are two."""
    found = {}
    for name, schema in BASE_TABLES.items():
        parts = [
            spark.createDataFrame(rows[name], schema).withColumn(CHANGE, F.lit(change))
            for rows, change in zip(images, (-1, 1))
        ]
        if any(rows[name] for rows in images):
            found[name] = parts[0].unionByName(parts[1])
    return found


@pytest.mark.parametrize("seed", range(2))
def test_refreshed_view_is_the_view_made_anew(spark, tmp_path, seed):
    folder, rows = str(tmp_path / "view"), random_rows(seed)
    store_view(_tables(spark, rows), folder, RULES)
    assert bag(stored_view(spark, _tables(spark, rows), folder, RULES)) == bag(invoice_view(_tables(spark, rows), RULES))
    for step in range(2):
        rows, went, came = _changed(rows, 10 * seed + step)
        tables, changes = _tables(spark, rows), _frames(spark, went, came)
        refresh_view(tables, changes, folder, RULES)
        expected = bag(invoice_view(tables, RULES))
        assert bag(stored_view(spark, tables, folder, RULES)) == expected
    refresh_view(tables, changes, folder, RULES)  # as after a run that broke off
    assert bag(stored_view(spark, tables, folder, RULES)) == expected


@pytest.mark.parametrize("name", BASE_TABLES)
def test_each_table_alone(spark, name):
    """Numbers outside the affected ones have the same rows before and after."""
    rows = random_rows(4)
    after, went, came = _changed(rows, 77, (name,), most=9)
    before_view, view = bag(invoice_view(_tables(spark, rows), RULES)), bag(invoice_view(_tables(spark, after), RULES))
    found = affected_invoices(_tables(spark, after), _frames(spark, went, came), RULES)
    numbers = {row["wanted_nf"] for row in found.collect()}
    others = lambda rows: [row for row in rows if row[1] not in numbers]
    assert others(before_view) == others(view)
    assert len(numbers) < 60


def test_other_months_stay_as_they_are(spark, tmp_path):
    folder, rows = str(tmp_path / "view"), random_rows(6)
    store_view(_tables(spark, rows), folder, RULES)
    files = lambda: {row[0] for row in spark.read.parquet(folder).select(F.input_file_name()).distinct().collect()}
    before = files()
    header = next(row for row in rows["tnota_fiscal"] if row[2] and row[0] == 1 and row[6] == "30D" and row[7] == 0)
    changes = {"tnota_fiscal": spark.createDataFrame([header], BASE_TABLES["tnota_fiscal"])}
    months = refresh_view(_tables(spark, rows), changes, folder, RULES)
    new = {row[0] for row in months.collect()}
    assert 0 < len(new) < 5
    kept = {path for path in before if not any(str(month or "__HIVE") in path for month in new)}
    assert kept and kept <= files()


def test_a_month_that_loses_all_rows(spark, tmp_path):
    folder, rows = str(tmp_path / "view"), random_rows(7)
    store_view(_tables(spark, rows), folder, RULES)
    month = min(row[2] for row in rows["tnota_fiscal"] if row[2])
    gone = [row for row in rows["tnota_fiscal"] if row[2] and (row[2].year, row[2].month) == (month.year, month.month)]
    after = rows | {"tnota_fiscal": [row for row in rows["tnota_fiscal"] if row not in gone]}
    changes = {"tnota_fiscal": spark.createDataFrame(gone, BASE_TABLES["tnota_fiscal"])}
    refresh_view(_tables(spark, after), changes, folder, RULES)
    assert bag(stored_view(spark, _tables(spark, after), folder, RULES)) == bag(invoice_view(_tables(spark, after), RULES))


def test_changes_must_be_of_known_tables(spark):
    tables = _tables(spark, random_rows(1))
    with pytest.raises(ValueError, match="no table"):
        affected_invoices(tables, {})
    with pytest.raises(ValueError, match="other"):
        affected_invoices(tables, {"other": tables["tos"]})


@pytest.mark.parametrize("seed", range(2))
def test_ledger_after_changes_in_any_order(spark, tmp_path, seed):
    """Batches of changes, added in an order that isn't theirs, give the totals of the last tables."""
    rng, rows = random.Random(seed), random_rows(20 + seed)
    ledger = DailyLedger(spark, str(tmp_path / "ledger"), RULES)
    batches = [("start", _frames(spark, {name: [] for name in rows}, rows))]
    for step in range(3):
        rows, went, came = _changed(rows, 30 + 10 * seed + step, most=12)
        batches.append((str(step), _frames(spark, went, came)))
    rng.shuffle(batches)
    for name, changes in batches:
        ledger.add(changes, name)
    ledger.add(*reversed(batches[1]))  # a batch that is added again counts once
    tables = _tables(spark, rows)
    expected = bag(P.daily_totals(P.report_inputs(tables, RULES)))
    found = ledger.daily_totals()
    assert bag(found) == expected and len(expected) > 3
    assert bag(ledger.compact(str(tmp_path / "compact")).daily_totals()) == expected
    days = spark.sql("select explode(sequence(date'2001-05-01', date'2001-08-01')) as as_of")
    holidays = C.holidays_around(days)
    assert bag(P.backfill_totals(found, days, holidays)) == bag(
        P.backfill_totals(P.daily_totals(P.report_inputs(tables, RULES)), days, holidays)
    )


def test_ledger_starts_from_tables_and_takes_late_cancellations(spark, tables, tmp_path):
    ledger = DailyLedger(spark, str(tmp_path))
    assert ledger.daily_totals().collect() == []
    ledger.start(tables)
    assert bag(ledger.daily_totals()) == bag(P.daily_totals(P.report_inputs(tables)))
    header = tables["tnota_fiscal"].where("numero = 15")
    late = header.withColumn(CHANGE, F.lit(-1)).unionByName(
        header.withColumn("cancelada", F.lit(1)).withColumn(CHANGE, F.lit(1))
    )
    ledger.add({"tnota_fiscal": late, "tordem_fat": tables["tordem_fat"]}, "late")
    without = InvoiceTables(lambda name: tables[name].where("numero != 15") if name == "tnota_fiscal" else tables[name])
    assert bag(ledger.daily_totals()) == bag(P.daily_totals(P.report_inputs(without)))
    day = lambda column: column >= F.lit("2026-05-08").cast("date")
    assert {row[0].day for row in ledger.daily_totals(day).collect()} <= {8, 11}
    ledger.add({"tnota_fiscal": late.where("false")}, "late")  # the batch again, with nothing in it
    assert bag(ledger.daily_totals()) == bag(P.daily_totals(P.report_inputs(tables)))
    with pytest.raises(ValueError, match="name a batch"):
        ledger.add({}, "../x")
    assert set(base for base, _, _ in LEDGERS.values()) == set(BASE_TABLES) - {"tordem_fat"}


@pytest.mark.parametrize("few", [0, 10**9])
def test_refresh_stores_no_month_twice(spark, tmp_path, monkeypatch, few):
    """Whether the changed invoices are few or many; rows that stay go from the old months into the new ones."""
    monkeypatch.setattr(refresh, "FEW", few)
    folder, rows = str(tmp_path / "view"), random_rows(8)
    store_view(_tables(spark, rows), folder, RULES)
    rows, went, came = _changed(rows, 81)
    monkeypatch.setattr(storage, "_made", [])
    refresh_view(_tables(spark, rows), _frames(spark, went, came), folder, RULES)
    expected = invoice_view(_tables(spark, rows), RULES)
    stored = [spark.read.parquet(path) for path in storage._made]
    views = [df for df in stored if "valor" in df.columns]
    assert len(views) == 1 and 0 < views[0].count() < expected.count()
    assert any("guid_orcamento" in df.columns for df in stored) == (few == 0)
    assert bag(stored_view(spark, _tables(spark, rows), folder, RULES)) == bag(expected)


def _shuffles(spark):
    """Ids of the shuffles that have files."""
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks().mkString(" ")
    return {block.split("_")[1] for block in blocks.split() if block.startswith("shuffle_")}


def _are_gone(spark, but, seconds=20):
    """Whether no other shuffle has files, which go a moment after their query."""
    until = time.time() + seconds
    while _shuffles(spark) - but and time.time() < until:
        time.sleep(0.2)
    return not _shuffles(spark) - but


def test_spans_of_numbers_and_few_months_at_a_time(spark, tmp_path, monkeypatch):
    """Null is a number, and neither shuffles nor rows of the view are left behind."""
    writes = []
    monkeypatch.setattr(refresh, "INVOICES_AT_A_TIME", 40)
    monkeypatch.setattr(refresh, "ROWS_AT_A_TIME", 20)
    monkeypatch.setattr(refresh, "_by_month", lambda rows, write=refresh._by_month: writes.append(rows) or write(rows))
    monkeypatch.setattr(storage, "_made", [])
    folder, rows = str(tmp_path / "view"), random_rows(9)
    rows["tnota_fiscal"] += [(row[0], None, *row[2:]) for row in rows["tnota_fiscal"][:9]]
    after, went, came = _changed(rows, 91)
    shuffles = _shuffles(spark)
    store_view(_tables(spark, rows), folder, RULES)
    assert _are_gone(spark, shuffles) and len(writes) > 1
    assert bag(stored_view(spark, _tables(spark, rows), folder, RULES)) == bag(invoice_view(_tables(spark, rows), RULES))
    monkeypatch.setattr(refresh, "INVOICES_AT_A_TIME", 20)
    shuffles, writes[:] = _shuffles(spark), []
    refresh_view(_tables(spark, after), _frames(spark, went, came), folder, RULES)
    assert _are_gone(spark, shuffles) and len(writes) > 1
    assert bag(stored_view(spark, _tables(spark, after), folder, RULES)) == bag(invoice_view(_tables(spark, after), RULES))
    assert not any("valor" in spark.read.parquet(path).columns for path in storage._made)


def test_spans_part_all_numbers(spark, monkeypatch):
    numbers = [None, None, 7, 7, 7, 7, *range(50), 2**40, -5]
    rows = spark.createDataFrame([(number,) for number in numbers], "number long")
    for at_a_time, least, most in ((10**6, 1, 1), (10, 3, 7), (1, 20, 60)):
        monkeypatch.setattr(refresh, "INVOICES_AT_A_TIME", at_a_time)
        spans = refresh._spans(F.col("number"), rows)
        assert least <= len(spans) <= most
        found = [rows.where(span(F.col("number"))).collect() for span in spans]
        assert sorted((row[0] is not None, row[0] or 0) for part in found for row in part) == sorted(
            (number is not None, number or 0) for number in numbers
        )
        assert sum(any(row[0] == 7 for row in part) for part in found) == 1
    assert len(refresh._spans(F.col("number"), rows.where("number is null"))) == 1
    assert len(refresh._spans(F.col("number"), rows.where("false"))) == 1


@pytest.mark.parametrize("rules", [RULES, Rules(rows_per_task=5, join_tasks=8)])
def test_goods_first_gives_the_same_view(spark, rules):
    """Where keys are hot as well."""
    tables = _tables(spark, random_rows(10))
    view = view_of(Inputs(tables, rules), goods_first=True)
    assert bag(view) == bag(invoice_view(tables, RULES))
