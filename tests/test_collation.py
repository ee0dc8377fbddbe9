"""Text compared by Spark's collations: case, trailing blanks and, by choice, accents."""

import random

import pytest

from billwright import InvoiceTables, Rules
from billwright.plans import report as P
from billwright.plans.ledger import DailyLedger
from billwright.plans.refresh import refresh_view, store_view, stored_view
from billwright.plans.view import invoice_view
from billwright.schemas import BASE_TABLES
from conftest import bag
from test_random import random_rows

CASE, ACCENTS = "UTF8_LCASE_RTRIM", "UNICODE_CI_AI_RTRIM"
GUIDS = {"tnota_fiscal_item": 8, "torcamento_itens": 1, "tos": 2}


def _respelt(rows, seed, accents):
    """The same rows with guids, stages and order prefixes in spellings that compare as equal."""
    rng = random.Random(seed)

    def spelt(text):
        if text is None:
            return None
        text = "".join(rng.choice([c.lower(), c.upper()]) for c in text) + " " * rng.randrange(3)
        return text.replace("a", "á").replace("E", "É") if accents and rng.random() < 0.5 else text

    found = {}
    for name, own in rows.items():
        found[name] = [list(row) for row in own]
        for row in found[name]:
            if name in GUIDS:
                row[GUIDS[name]] = spelt(row[GUIDS[name]])
            if name == "torcamento":
                row[2] = spelt(row[2])
    return {name: [tuple(row) for row in own] for name, own in found.items()}


def _tables(spark, rows):
    return InvoiceTables(lambda name: spark.createDataFrame(rows[name], BASE_TABLES[name]))


def _plain(seed):
    """Guids with letters that can carry accents."""
    rows = random_rows(seed)
    for name, at in GUIDS.items():
        rows[name] = [tuple(v.replace("G", "GAE") if n == at and v else v for n, v in enumerate(row)) for row in rows[name]]
    return rows


@pytest.mark.parametrize("rows_per_task", [3, 10**9])
@pytest.mark.parametrize("collation", [CASE, ACCENTS])
def test_spellings_that_are_equal(spark, collation, rows_per_task):
    rows = _plain(12)
    plain = _tables(spark, rows)
    other = _tables(spark, _respelt(rows, 3, collation == ACCENTS))
    rules = Rules(collation=collation, rows_per_task=rows_per_task)
    assert bag(invoice_view(other, rules)) == bag(invoice_view(plain, Rules(rows_per_task=10**9)))
    assert bag(P.daily_totals(P.report_inputs(other, rules))) == bag(P.daily_totals(P.report_inputs(plain)))


def test_accents_differ_where_they_count(spark):
    rows = _plain(12)
    accented = _tables(spark, _respelt(rows, 3, True))
    rules = [Rules(collation=name, rows_per_task=10**9) for name in (CASE, ACCENTS)]
    assert bag(invoice_view(accented, rules[0])) != bag(invoice_view(accented, rules[1]))


def test_order_prefixes(spark, tables):
    rows = {name: [tuple(r) for r in tables[name].collect()] for name in BASE_TABLES}
    rows["tos"] = [(1, "É5", "GE", 999), (1, "E6", "GE", 999), (1, "OS1", "GA", 50)]
    orders = lambda collation: {
        row["os"] for row in invoice_view(_tables(spark, rows), Rules(collation=collation)).collect()
    }
    assert orders(CASE) == {None, "É5", "OS1"} and orders(ACCENTS) == {None, "OS1"}


def test_refresh_and_ledger_by_a_collation(spark, tmp_path):
    rows = _plain(13)
    spelt, rules = _respelt(rows, 5, True), Rules(collation=ACCENTS, rows_per_task=10**9)
    early = {name: own[::2] for name, own in spelt.items()}
    late = {name: spark.createDataFrame(own[1::2], BASE_TABLES[name]) for name, own in spelt.items()}
    expected = _tables(spark, rows)
    store_view(_tables(spark, early), str(tmp_path / "view"), rules)
    refresh_view(_tables(spark, spelt), late, str(tmp_path / "view"), rules)
    assert bag(stored_view(spark, expected, str(tmp_path / "view"))) == bag(invoice_view(expected))
    ledger = DailyLedger(spark, str(tmp_path / "ledger"), rules)
    ledger.start(_tables(spark, early))
    ledger.add(late)
    assert bag(ledger.daily_totals()) == bag(P.daily_totals(P.report_inputs(expected)))
