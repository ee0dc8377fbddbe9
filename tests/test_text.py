"""Texts, styles, HTML and messages."""

import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from billwright import sinks
from billwright.functions import text as X
from billwright.plans import message as M
from billwright.plans import report as P
from billwright.rules import PROJECT_CFOPS
from conftest import bag

D = datetime.date


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def money(text):
    return F.lit(Decimal(text)).cast("decimal(21,4)")


@pytest.mark.parametrize(
    ("amount", "total", "brl"),
    [
        ("1234.50", "R$1,234.50", "R$\u00a01.234,50"),
        ("-1234567.89", "R$-1,234,567.89", "-R$\u00a01.234.567,89"),
        ("0.125", "R$0.12", "R$\u00a00,12"),
        ("2.675", "R$2.68", "R$\u00a02,68"),
        ("0", "R$0.00", "R$\u00a00,00"),
    ],
)
def test_money(spark, amount, total, brl):
    assert value(spark, X.total_text(money(amount))) == total
    assert value(spark, X.brl_text(money(amount))) == brl


def test_null_money_stays_null(spark):
    assert value(spark, X.brl_text(F.lit(None).cast("decimal(21,4)"))) is None


def test_dates(spark):
    day = F.lit(D(2024, 3, 1))
    assert value(spark, X.date_text(day)) == "01/03/2024"
    assert value(spark, X.subject(day)) == "Faturamento 1-3-2024"
    assert value(spark, X.parse_timestamp(F.lit("2024-03-01 10:00:00"))) == datetime.datetime(2024, 3, 1, 10)


def test_text_that_is_no_date_fails(spark):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        value(spark, X.parse_timestamp(F.concat(F.lit("no date "), F.col("id").cast("string"))))


@pytest.mark.parametrize(
    ("status", "style"),
    [
        ("Cancelada", X.RED), ("Devolvida pela NF 90", X.YELLOW), ("Autorizada", X.BORDER),
        (None, X.BORDER), ("cancelada", X.BORDER), ("Cancelada ", X.BORDER),
    ],
)
def test_style(spark, status, style):
    assert value(spark, X.cell_style(F.lit(status).cast("string"))) == style


def test_recipients(spark):
    assert value(spark, X.recipients(F.lit("a@x;;b@y; c@z"))) == ["a@x", "b@y", "c@z"]


def test_cleanup(spark):
    assert value(spark, X.blank_if_null(F.lit(None).cast("string"))) == ""
    assert value(spark, X.drop_empty_tokens(F.lit("Fernando None nan"))) == "Ferdo  "


def test_cells_are_escaped(spark):
    assert value(spark, X.cell(F.lit('a<b & "c"'))).endswith(">a&lt;b &amp; &quot;c&quot;</td>")


ADDRESSES = "a@x; b@y"


def message(tables, **options):
    inputs = P.report_inputs(tables, since=D(2026, 5, 1))
    df = M.report_message(inputs, D(2026, 5, 11), ADDRESSES, **options)
    return sorted(df.collect(), key=lambda row: (row["to"], row["part"]))


def test_message(tables):
    rows = message(tables)
    assert [(r["to"], r["subject"], r["part"], r["parts"]) for r in rows] == [
        ("a@x", "Faturamento 11-5-2026", 0, 1), ("b@y", "Faturamento 11-5-2026", 0, 1),
    ]
    html = rows[0]["html_body"]
    assert html.startswith("\n Bom dia,<br><br>\n O faturamento do mês está em <b>R$7,528.00</b>.<br>")
    assert html.count("<tr>") == 18 and "Fernando ME" in html and "None" not in html
    assert html.index("<th>0</th>") < html.index("<th>9</th>") < html.index("<th>10</th>")
    assert html.count(X.RED) == 1 and html.count(X.YELLOW) == 1


def test_message_in_parts_holds_every_row_once(tables):
    rows = [r for r in message(tables, rows_per_part=5) if r["to"] == "a@x"]
    assert [(r["part"], r["parts"]) for r in rows] == [(0, 4), (1, 4), (2, 4), (3, 4)]
    text = "".join(r["html_body"] for r in rows)
    assert all(text.count(f"<th>{i}</th>") == 1 for i in range(17))


def test_parts_make_one_text_of_any_size(tables):
    whole = [
        "".join(r["html_body"] for r in message(tables, rows_per_part=size) if r["to"] == "a@x")
        for size in (1, 5, 250, 10_000)
    ]
    assert len(set(whole)) == 1 and whole[0].count("Bom dia") == whole[0].count("</table>") == 1


def test_fixed_texts():
    """Literals, so that a change of any constant is noticed."""
    assert X.BODY_OPENING + "R$0.00" + X.BODY_LIST + "TABLE" + X.BODY_CLOSING == """
 Bom dia,<br><br>
 O faturamento do mês está em <b>R$0.00</b>.<br>
 Abaixo, a lista detalhada:<br>
 
 TABLE

 <br>OBS: Notas fiscais canceladas ou devolvidas <b>NÃO</b> contabilizam faturamento.<br>
 <br><br>Em caso de dúvidas ou sugestões, favor entrar em contato.<br>
 Este é um e-mail automático, mas sinta-se livre para respondê-lo.
 """
    assert X.SUBJECT_START == "Faturamento " and X.EMPTY_TOKENS == ("None", "nan")
    assert (X.RED, X.YELLOW, X.BORDER) == (
        "background-color: red", "background-color: yellow", "border: 1px solid black",
    )
    assert sorted(PROJECT_CFOPS) == "5101 5102 5124 5933 6101 6102 6118 6123 6124 6933".split()


def test_message_without_rows(tables):
    df = M.report_message(P.report_inputs(tables, since=D(2026, 7, 1)), D(2026, 7, 2), "a@x")
    row = df.first()
    assert df.count() == 1 and "<b>R$0.00</b>" in row["html_body"] and "<td" not in row["html_body"]


def test_literal_cleanup(tables):
    assert "Ferdo ME" in message(tables, literal_cleanup=True)[0]["html_body"]


def test_sinks(spark, tables, tmp_path):
    inputs = P.report_inputs(tables, since=D(2026, 5, 1))
    formatted = P.monthly_detail(inputs)
    sinks.write_html_rows(M.html_rows(formatted), str(tmp_path / "rows"))
    files = sorted((tmp_path / "rows").glob("part-*"))
    lines = [line for file in files for line in file.read_text().splitlines()]
    assert [line.split("</th>")[0] for line in lines[1:-1]] == [f"<tr><th>{i}" for i in range(17)]
    assert lines[0].startswith("<table><thead>") and lines[-1] == "</tbody></table>"
    sinks.write_outbox(M.report_message(inputs, D(2026, 5, 11), ADDRESSES), str(tmp_path / "out"), D(2026, 5, 11))
    assert {r["to"] for r in spark.read.json(str(tmp_path / "out")).collect()} == {"a@x", "b@y"}


def test_outbox_that_is_written_again(spark, tables, tmp_path):
    """Two days and a rerun of one with fewer parts: nothing of the other is lost, nothing is there twice."""
    folder, inputs = str(tmp_path), P.report_inputs(tables, since=D(2026, 5, 1))
    days = [D(2026, 5, 11), D(2026, 5, 12)]
    wanted = {}
    for day, size in ((days[0], 3), (days[1], 4), (days[0], 5)):
        messages = M.report_message(inputs, day, "a@x; b/ö=%@y", rows_per_part=size)
        sinks.write_outbox(messages, folder, day)
        wanted[day] = bag(messages)
    for day in days:
        found = sinks.read_outbox(spark, folder, day)
        assert {r["day"] for r in found.collect()} == {day}
        assert bag(found.drop("day")) == wanted[day]
    assert sinks.read_outbox(spark, folder).count() == sum(map(len, wanted.values()))
    sinks.write_outbox(M.report_message(inputs, days[0], "c@z", rows_per_part=9), folder, days[0])
    assert {r["to"] for r in sinks.read_outbox(spark, folder, days[0]).collect()} == {"a@x", "b/ö=%@y", "c@z"}
