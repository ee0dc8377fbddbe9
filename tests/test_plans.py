"""What the plans must and must not contain."""

import datetime

import pytest

from billwright import InvoiceTables, Rules
from billwright.checks.queries import QUERIES
from billwright.plans import report as P
from billwright.plans.inputs import Inputs
from billwright.plans.view import invoice_view
from billwright.schemas import BASE_TABLES
from billwright.sources.star import star_tables
from conftest import DATA

FORBIDDEN = ("BroadcastNestedLoopJoin", "CartesianProduct", "PythonUDF", "ArrowEvalPython", "BatchEvalPython")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_nested_loops_or_python(spark, name):
    text = plan(QUERIES[name](spark, f"{DATA}/sf0.001"))
    assert not [node for node in FORBIDDEN if node in text]


@pytest.fixture(scope="module")
def stored(spark, tables, tmp_path_factory):
    """The fixture as Parquet files, so that plans have real scans."""
    folder = tmp_path_factory.mktemp("tables")
    for name in BASE_TABLES:
        tables[name].write.parquet(str(folder / name))
    return InvoiceTables.from_parquet(spark, str(folder))


def scans(text, column):
    return [line for line in text.splitlines() if "FileScan" in line and column in line]


@pytest.fixture
def whole_filters(spark):
    """Plans that spell out all filters of a scan."""
    name = "spark.sql.maxMetadataStringLength"
    before = spark.conf.get(name)
    spark.conf.set(name, "2000")
    yield
    spark.conf.set(name, before)


def pushed(line):
    return line[line.index("PushedFilters"):line.index("ReadSchema")]


def test_report_conditions_reach_the_header_scan(stored, whole_filters):
    text = plan(P.report_rows(Inputs(stored, header_filter=P.in_report(Rules(), datetime.date(2026, 5, 1)))))
    header = scans(text, "dt_emissao")
    assert header
    for line in header:
        for condition in (
            "GreaterThanOrEqual(dt_emissao", "EqualTo(cod_empresa,1)", "EqualTo(saida,X)",
            "EqualTo(cli_for,0)", "In(cfop",
        ):
            assert condition in pushed(line)


def test_month_report_skips_lines_outside_its_numbers(stored, whole_filters):
    inputs = P.report_inputs(stored, since=datetime.date(2026, 5, 7))
    for rows, key in (
        (inputs.services(), "numero_nf"), (inputs.returns(), "nfref_numero_nf"),
        (inputs.billing_orders(), "numero_nf"),
    ):
        line = scans(plan(rows), key)[0]
        assert f"GreaterThanOrEqual({key},12)" in pushed(line)
        assert f"LessThanOrEqual({key},20)" in pushed(line)


def test_scans_read_only_used_columns(stored):
    line = scans(plan(P.daily_totals(P.report_inputs(stored))), "guid_orcamento")
    goods = [text for text in line if "vl_ipi" in text]
    assert goods and all("produto" not in text and "unidade" not in text for text in goods)


def test_view_reads_no_columns_that_are_not_asked_for(stored):
    text = plan(invoice_view(stored).select("nf", "valor"))
    assert not scans(text, "natureza_op") and not scans(text, "razao_social")
    assert not scans(text, "unidade") and not scans(text, "qtde")


def test_month_lines_are_cut_before_the_shuffle(stored):
    text = plan(P.report_rows(P.report_inputs(stored, since=datetime.date(2026, 5, 1))))
    assert text.count("LeftSemi") >= 2 and "BroadcastHashJoin" in text


def test_view_shuffles_headers_once_for_all_joins_on_the_number(spark):
    tables = star_tables(spark, f"{DATA}/sf0.001")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(invoice_view(tables))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    on_number = [
        line for line in text.splitlines() if "Exchange hashpartitioning(nf#" in line
    ]
    assert len(on_number) == 1


def test_totals_shuffle_no_goods_by_guid_when_few_are_repeated(stored):
    text = plan(P.daily_totals(P.report_inputs(stored)))
    assert "Exchange hashpartitioning(guid_orcamento" not in text
    assert "Exchange hashpartitioning(goods_nf" in text
