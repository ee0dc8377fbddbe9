"""The view, row by row, on the small fixture."""

from decimal import Decimal

from pyspark.sql import functions as F

from billwright import InvoiceTables, Rules
from billwright.plans.inputs import Inputs
from billwright.plans.view import ViewSteps, invoice_view, register_invoice_view, with_headings
from billwright.schemas import VIEW_HEADINGS

AUT, WAIT = "Autorizada", "Aguardando Aprovação"
RETURNED = "Devolvida pela NF 90" + " " * 28

EXPECTED = [
    (1, "NF", AUT, None, "Painel", 1, "UN", 110, 8001),
    (2, "NF", "Cancelada", None, "Painel", 1, "UN", 200, None),
    (3, "NF", RETURNED, None, "SERVIÇO", 1, "UN", 300, 8000),
    (4, "NFSe", AUT, None, "SERVIÇO", 3, "HR", 400, None),
    (5, "NF", WAIT, None, "Painel", 1, "UN", 500, None),
    (6, "NF", WAIT, None, "Painel", 1, "UN", 600, None),
    (7, "NF", AUT, None, "Painel", 2, "UN", 770, None),
    (12, "NF", AUT, None, "SERVIÇO", None, None, None, None),
    (13, "NF", AUT, None, "Painel", 1, "UN", None, None),
    (14, "NFSe", AUT, None, "Cabo", 1, "MT", 15, None),
    (14, "NFSe", AUT, None, "Cabo", 1, "MT", 15, None),
    (14, "NFSe", AUT, None, "Painel", 1, "UN", 14, None),
    (14, "NFSe", AUT, None, "Painel", 1, "UN", 14, None),
    (15, "NF", AUT, "OS1", "Painel", 1, "UN", 1500, None),
    (15, "NF", AUT, "OS2", "Painel", 1, "UN", 1500, None),
    (16, "NF", AUT, "OS7", "Bananal", 1, "UN", 1600, None),
    (17, "NF", AUT, None, "Painel", 1, "UN", 1700, None),
    (18, "NF", AUT, None, "Painel", 1, "UN", 1800, None),
    (19, "NF", AUT, None, "Painel", 1, "UN", 1900, None),
    (20, "NF", None, None, "Painel", 1, "UN", 2000, None),
]


def lines(view):
    picked = view.select("nf", "tipo", "status", "os", "produto", "qtd", "un", "valor", "of")
    rows = [tuple(int(v) if isinstance(v, (Decimal, float)) else v for v in row) for row in picked.collect()]
    return sorted(rows, key=lambda row: (row[0], row[4], str(row[3])))


def test_rows(tables):
    assert lines(invoice_view(tables)) == EXPECTED
    assert len(RETURNED) == 48


def test_rows_are_the_same_when_every_key_is_hot(tables):
    assert lines(invoice_view(tables, Rules(rows_per_task=1))) == EXPECTED


def test_case_sensitive_orders(tables):
    view = invoice_view(tables, Rules(case_sensitive=True))
    assert [row["os"] for row in view.where("nf = 16").collect()] == ["E3"]


def test_other_company(tables):
    assert [row["nf"] for row in invoice_view(tables, Rules(company=2)).collect()] == [11]


def test_time_of_day_is_dropped(tables):
    view = invoice_view(tables)
    assert dict(view.dtypes)["data_emissao"] == "date"
    assert str(view.where("nf = 1").first()["data_emissao"]) == "2026-04-30"


def test_headings_and_sql(spark, tables):
    view = register_invoice_view(tables, "invoices")
    assert view.columns == list(VIEW_HEADINGS.values())
    found = spark.sql("select NF from invoices where `Saída` = 'X' and CFOP = '5910'")
    assert [row["NF"] for row in found.collect()] == [18]
    assert with_headings(invoice_view(tables).select("of", "un")).columns == ["OF", "Un"]


def test_base_tables_in_sql(spark, tables):
    found = tables.query(spark, "select count(*) as n from tos where n_os like 'OS%'")
    assert found.first()["n"] == 4


def test_every_header_is_preserved(tables):
    view = invoice_view(tables)
    kept = {1, 2, 3, 4, 5, 6, 7, 12, 13, 14, 15, 16, 17, 18, 19, 20}
    assert {row["nf"] for row in view.select("nf").distinct().collect()} == kept
    assert view.where(F.col("valor").isNull()).count() == 2


def test_text_compares_as_in_the_database(tables):
    """Case and trailing blanks make no difference, unless the collation says so."""
    quotes = tables["torcamento"].withColumn("estagio_orc", F.lit("ganhou "))
    lines = tables["torcamento_itens"].withColumn("guid_linha", F.lit("ga  "))
    other = InvoiceTables(
        lambda name: {"torcamento": quotes, "torcamento_itens": lines}.get(name, tables[name])
    )
    joined = lambda rules: ViewSteps(Inputs(other, rules)).quotes().where("won_quote is not null").count()
    assert joined(Rules()) == 1 and joined(Rules(case_sensitive=True)) == 0
    steps = ViewSteps(Inputs(other))
    met = steps.join_quotes(steps.goods_over_guids()).result().where("guid_linha is not null")
    assert [row["goods_nf"] for row in met.collect()] == [15]
