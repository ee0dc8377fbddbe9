"""Column expressions of one invoice line: type, status, value and the row predicates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from billwright import rules as R
from billwright.schemas import LINE_VALUE

# Fixed value: the note number inside a status is padded with blanks to this width.
RETURN_NUMBER_WIDTH = 30


def is_blank(text: Column) -> Column:
    """True for null and for text of blanks only (trailing blanks do not count in comparisons)."""
    return text.isNull() | (F.rtrim(text) == "")


def has_text(text: Column) -> Column:
    """True where there is text other than blanks; null and blank rows drop out of a filter."""
    return F.rtrim(text) != ""


def is_kept_order(order_number: Column, case_sensitive: bool, collation: str | None = None) -> Column:
    """Service orders whose number does not start with the excluded prefix; null drops out."""
    if collation:
        return ~F.startswith(F.collate(order_number, collation), F.collate(F.lit(R.EXCLUDED_ORDER_PREFIX), collation))
    compared = order_number if case_sensitive else F.lower(order_number)
    return ~compared.like(f"{R.EXCLUDED_ORDER_PREFIX}%")


def compared_text(text: Column, case_sensitive: bool, collation: str | None = None) -> Column:
    """Text as the database compares it: without trailing blanks, and mostly without case.

    By a collation the text stays as it is and its type says how it compares.
    """
    if collation:
        return F.collate(text, collation)
    trimmed = F.rtrim(text)
    return trimmed if case_sensitive else F.upper(trimmed)


def is_won(stage: Column, active: Column, case_sensitive: bool = False, collation: str | None = None) -> Column:
    return (compared_text(stage, case_sensitive, collation) == R.WON) & (active == 1)


def document_type(is_service: Column) -> Column:
    return F.when(is_service == 1, R.SERVICE_DOCUMENT).otherwise(R.GOODS_DOCUMENT)


def return_label(return_number: Column) -> Column:
    """Text naming the return note; null when its number is."""
    padded = F.rpad(return_number.cast("string"), RETURN_NUMBER_WIDTH, " ")
    return F.concat(F.lit(R.RETURNED_BY), padded)


def status(
    cancelled: Column,
    returned: Column,
    return_number: Column,
    is_service: Column,
    approval: Column,
) -> Column:
    """First match wins: cancelled, returned, service (always authorised), awaiting."""
    return (
        F.when(cancelled == 1, R.CANCELLED)
        .when(returned, return_label(return_number))
        .when(is_service == 1, R.AUTHORISED)
        .when(is_blank(approval), R.AWAITING)
        .otherwise(R.AUTHORISED)
    )


def may_be_authorised(cancelled: Column, is_service: Column, approval: Column) -> Column:
    """What ``status`` asks of a header, apart from it not having been returned."""
    not_cancelled = F.coalesce(cancelled != 1, F.lit(True))
    approved = F.coalesce(is_service == 1, F.lit(False)) | ~is_blank(approval)
    return not_cancelled & approved


def goods_value(total: Column, tax: Column) -> Column:
    """Goods value with tax; null as soon as either part is."""
    return (total + tax).cast(LINE_VALUE)


def line_value(total: Column, tax: Column, service_total: Column) -> Column:
    return F.coalesce(goods_value(total, tax), service_total.cast(LINE_VALUE))


def product_name(product: Column) -> Column:
    return F.coalesce(product, F.lit(R.SERVICE_PRODUCT))


def is_outgoing(flag: Column) -> Column:
    return flag == R.YES


def is_project_sale(cfop: Column, cfops: tuple[str, ...] = R.PROJECT_CFOPS) -> Column:
    return cfop.isin(*cfops)


def is_authorised(line_status: Column) -> Column:
    return line_status == R.AUTHORISED
