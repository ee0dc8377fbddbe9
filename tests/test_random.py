"""View and totals against DuckDB on random tables full of nulls, blanks and repeated keys."""

import datetime
import random
from decimal import Decimal

import duckdb
import pytest

from billwright import InvoiceTables, Rules
from billwright.checks import queries as Q
from billwright.checks.oracle import over_base_tables
from billwright.plans import report as P
from billwright.rules import PROJECT_CFOPS
from billwright.schemas import BASE_TABLES
from conftest import bag

DAYS = [datetime.datetime(2001, 5, 1) + datetime.timedelta(hours=7 * i) for i in range(300)]


def random_rows(seed):
    rng = random.Random(seed)
    pick, chance = rng.choice, rng.random

    def few(value, share=0.15):
        """Mostly the value, sometimes null."""
        return None if chance() < share else value

    def company():
        return 1 if chance() < 0.85 else 2

    def number():
        # A third of all rows belong to one invoice.
        return 7 if chance() < 0.33 else rng.randint(1, 60)

    def guid():
        return few("G1" if chance() < 0.33 else f"G{rng.randint(1, 30)}", 0.4)

    def money():
        return Decimal(rng.randint(-10_000, 1_000_000)) / 100

    return {
        "tnota_fiscal": [
            (company(), rng.randint(1, 60), few(pick(DAYS), 0.02), few(pick([0, 0, 1])),
             few(pick([0, 0, 0, 1])), few(pick(["AUT", "AUT", "", "  "])),
             few(pick(["30D", "30D", "  ", ""])), pick([0, 0, 0, 1]), pick(PROJECT_CFOPS + ("5910",)),
             few("VENDA"), few("X"), few("X"), few(pick(["Alfa & <Co>", "Fernando"])))
            for _ in range(80)
        ],
        "tnota_fiscal_item": [
            (company(), few(number(), 0.05), few(rng.randint(1, 40)), few(pick(["Cabo", "Painel"])),
             float(rng.randint(1, 9)), few("UN"), few(money()), few(Decimal(rng.randint(0, 99999)) / 10000),
             guid())
            for _ in range(150)
        ],
        "tnota_fiscal_servico": [
            (company(), few(number(), 0.05), few(1.0), few("HR"), few(money())) for _ in range(60)
        ],
        "torcamento_itens": [(company(), guid(), few(rng.randint(1, 10))) for _ in range(60)],
        "torcamento": [
            (company(), few(rng.randint(1, 10)), pick(["GANHOU", "GANHOU", "PERDIDO"]), pick([0, 1, 1]))
            for _ in range(30)
        ],
        "tos": [
            (company(), few(pick(["OS", "e", "E"]) + str(rng.randint(1, 99))), guid(),
             few(rng.randint(1, 40)))
            for _ in range(60)
        ],
        "tnota_fiscal_nfref": [
            (company(), few(rng.randint(1, 200)), few(rng.randint(900, 999))) for _ in range(30)
        ],
        "tordem_fat": [
            (company(), few(rng.randint(1, 99)), pick([0, 1]), few(rng.randint(1, 60))) for _ in range(60)
        ],
    }


@pytest.fixture(scope="module", params=[1, 2])
def engines(spark, request, tmp_path_factory):
    rows = random_rows(request.param)
    folder = str(tmp_path_factory.mktemp("random"))
    tables = InvoiceTables(lambda name: spark.createDataFrame(rows[name], BASE_TABLES[name]))
    stored = tables.land(spark, folder)
    duck = duckdb.connect()
    for name in BASE_TABLES:
        duck.execute(f"create view {name} as select * from '{folder}/{name}/*.parquet'")
    return stored, duck


def expected(duck, name, columns):
    result = duck.execute(over_base_tables(name))
    at = {column[0]: i for i, column in enumerate(result.description)}
    rows = [tuple(row[at[column]] for column in columns) for row in result.fetchall()]
    return sorted(rows, key=lambda row: [(v is None, str(v)) for v in row])


@pytest.mark.parametrize("rows_per_task", [3, 10**9])
@pytest.mark.parametrize("name", ["s3_invoice_view", "a1_month_total", "o1_sorted_report", "r2_monthly_total"])
def test_random_tables(engines, name, rows_per_task):
    tables, duck = engines
    rules = Rules(rows_per_task=rows_per_task)
    if name == "s3_invoice_view":
        ours = Q.invoice_view(tables, rules)
    elif name == "r2_monthly_total":
        ours = P.monthly_total(P.report_inputs(tables, rules, since=Q.SINCE))
    elif name == "a1_month_total":
        ours = Q.monthly_totals(P.report_inputs(tables, rules))
    else:
        ours = P.sorted_report(P.report_rows(P.report_inputs(tables, rules)))
    assert bag(ours) == expected(duck, name, ours.columns)
    assert ours.count()
