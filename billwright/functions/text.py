"""Column expressions that turn typed report columns into the texts people read."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from billwright.rules import CANCELLED

# Cell styles.
RED = "background-color: red"
YELLOW = "background-color: yellow"
BORDER = "border: 1px solid black"

# Fixed value: start of the statuses shown in yellow.
RETURNED_START = "Devolvida"

# Tokens that the literal clean-up removes wherever they occur.
EMPTY_TOKENS = ("None", "nan")

# Subject and body of the message.
SUBJECT_START = "Faturamento "
BODY_OPENING = "\n Bom dia,<br><br>\n O faturamento do mês está em <b>"
BODY_LIST = "</b>.<br>\n Abaixo, a lista detalhada:<br>\n \n "
BODY_CLOSING = (
    "\n\n <br>OBS: Notas fiscais canceladas ou devolvidas <b>NÃO</b> contabilizam faturamento.<br>\n"
    " <br><br>Em caso de dúvidas ou sugestões, favor entrar em contato.<br>\n"
    " Este é um e-mail automático, mas sinta-se livre para respondê-lo.\n "
)


def parse_timestamp(text: Column) -> Column:
    """Text to timestamp; text that is no date fails the job rather than turning null."""
    return text.cast("timestamp_ntz")


def date_text(date: Column) -> Column:
    return F.date_format(date, "dd/MM/yyyy")


def total_text(amount: Column) -> Column:
    """``R$1,234.56``. Give it a decimal: doubles round differently."""
    return F.concat(F.lit("R$"), F.format_number(amount, 2))


def brl_text(amount: Column) -> Column:
    """``R$ 1.234,56`` with a no-break space, the minus sign in front; null stays null."""
    digits = F.translate(F.format_number(F.abs(amount), 2), ",.", ".,")
    return F.concat(F.when(amount < 0, "-").otherwise(""), F.lit("R$\u00a0"), digits)


def cell_style(text: Column) -> Column:
    return (
        F.when(text == CANCELLED, RED).when(text.startswith(RETURNED_START), YELLOW).otherwise(BORDER)
    )


def blank_if_null(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def drop_empty_tokens(html: Column) -> Column:
    """Remove the empty tokens even inside words, as the first report did."""
    for token in EMPTY_TOKENS:
        html = F.replace(html, F.lit(token), F.lit(""))
    return html


def escape_html(text: Column) -> Column:
    for mark, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        text = F.replace(text, F.lit(mark), F.lit(entity))
    return text


def cell(text: Column) -> Column:
    """One table cell with its style; the style looks at the text before escaping."""
    return F.concat(
        F.lit('<td style="'), cell_style(text), F.lit('">'),
        blank_if_null(escape_html(text)), F.lit("</td>"),
    )


def subject(date: Column) -> Column:
    return F.concat(F.lit(SUBJECT_START), F.date_format(date, "d-M-yyyy"))


def body_opening(total: Column) -> Column:
    return F.concat(F.lit(BODY_OPENING), total, F.lit(BODY_LIST))


def recipients(addresses: Column) -> Column:
    """The addresses of a list separated by ``;``, without blanks and empty entries."""
    trimmed = F.transform(F.split(addresses, ";"), lambda address: F.trim(address))
    return F.filter(trimmed, lambda address: address != "")
