"""One value per key, for the columns that take "the first" matching row.

Any matching row would be legal; the smallest value is taken, so a run can be
repeated. Grouping combines before the shuffle, so no key is too large.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_per_key(rows: DataFrame, key: str, value: str, key_name: str, value_name: str) -> DataFrame:
    """One row per key that is not null, with the smallest value (null if it has none)."""
    return (
        rows.where(F.col(key).isNotNull())
        .groupBy(F.col(key).alias(key_name))
        .agg(F.min(value).alias(value_name))
    )


def return_notes(references: DataFrame) -> DataFrame:
    """Returned invoice -> number of the return note, possibly null."""
    return first_per_key(references, "nfref_numero_nf", "numero_nf", "returned_nf", "return_number")


def returned_invoices(references: DataFrame) -> DataFrame:
    return references.select("nfref_numero_nf").distinct()


def billing_orders(orders: DataFrame) -> DataFrame:
    """Invoice -> active billing order it came from."""
    return first_per_key(orders, "numero_nf", "codigo", "billed_nf", "of")


def product_orders(orders: DataFrame) -> DataFrame:
    """Product code -> service order, for lines that have no order of their own."""
    return first_per_key(orders, "cod_pecas", "n_os", "product_code", "product_order")
