"""The authorised value of every day, kept by adding up changes.

A ledger holds sums that can be added to in any order: a row that comes counts once, one
that goes counts minus once. There is one for the invoices of a report by number and day,
and one each for goods, services, returns, quote lines, won quotes and service orders by
the keys they meet on. A batch of changes is summed by key and appended; the history is
not read. Cancelled or returned late, an invoice leaves the total of its own day.

``daily_totals`` folds the ledgers into the totals that a report over all tables gives.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from billwright.functions import lines as L
from billwright.operators.storage import stored
from billwright.plans.report import in_report, invoice_total
from billwright.rules import Rules
from billwright.schemas import BASE_TABLES, TOTAL_VALUE
from billwright.sources.tables import InvoiceTables, conform

#: The column of a table of changes that says how often a row came (1) or went (-1).
CHANGE = "change"
_BATCH = "batch"

_LONG, _TEXT, _DAY = T.LongType(), T.StringType(), T.DateType()
# Ledger -> its base table, its keys and its sums. Every ledger also counts its rows.
LEDGERS: dict[str, tuple[str, dict[str, T.DataType], dict[str, T.DataType]]] = {
    "invoices": ("tnota_fiscal", {"nf": _LONG, "data_emissao": _DAY}, {}),
    "goods": ("tnota_fiscal_item", {"nf": _LONG, "guid": _TEXT}, {"value": TOTAL_VALUE, "valueless": _LONG}),
    "services": ("tnota_fiscal_servico", {"nf": _LONG}, {"value": TOTAL_VALUE}),
    "returns": ("tnota_fiscal_nfref", {"nf": _LONG}, {}),
    "quote_lines": ("torcamento_itens", {"guid": _TEXT, "quote": _LONG}, {}),
    "won_quotes": ("torcamento", {"quote": _LONG}, {}),
    "orders": ("tos", {"guid": _TEXT}, {}),
}


def _schema(name: str) -> T.StructType:
    _, keys, sums = LEDGERS[name]
    columns = {**keys, "rows": _LONG, **sums, _BATCH: _TEXT}
    return T.StructType([T.StructField(column, kind) for column, kind in columns.items()])


def _entries(name: str, rows: DataFrame, rules: Rules) -> DataFrame:
    """Rows of a base table, with their change, as entries of a ledger that aren't summed yet."""
    c, change = F.col, F.col(CHANGE)
    rows = rows.where(c("cod_empresa") == rules.company)
    guid = lambda column: L.compared_text(c(column), rules.case_sensitive, rules.collation).alias("guid")
    if name == "invoices":
        reported = (
            L.has_text(c("condicao_pagamento")) & (c("cli_for") == 0) & in_report(rules)
            & L.may_be_authorised(c("cancelada"), c("nfse"), c("nfe_desc_status"))
        )
        keys = [c("numero").alias("nf"), F.to_date("dt_emissao").alias("data_emissao")]
        return rows.where(reported).select(*keys, change.alias("rows"))
    if name == "goods":
        value = L.goods_value(c("vl_total"), c("vl_ipi"))
        return rows.where("numero_nf is not null").select(
            c("numero_nf").alias("nf"), guid("guid_orcamento"), change.alias("rows"),
            (F.coalesce(value, F.lit(0)) * change).cast(TOTAL_VALUE).alias("value"),
            F.when(value.isNull(), change).otherwise(0).alias("valueless"),
        )
    if name == "services":
        value = (F.coalesce("vl_total", F.lit(0)) * change).cast(TOTAL_VALUE)
        return rows.where("numero_nf is not null").select(
            c("numero_nf").alias("nf"), change.alias("rows"), value.alias("value")
        )
    if name == "returns":
        return rows.where("nfref_numero_nf is not null").select(c("nfref_numero_nf").alias("nf"), change.alias("rows"))
    if name == "quote_lines":
        return rows.where("guid_linha is not null").select(
            guid("guid_linha"), c("cod_orcamento").alias("quote"), change.alias("rows")
        )
    if name == "won_quotes":
        won = L.is_won(c("estagio_orc"), c("status"), rules.case_sensitive, rules.collation)
        return rows.where(won & c("codigo").isNotNull()).select(c("codigo").alias("quote"), change.alias("rows"))
    kept = L.is_kept_order(c("n_os"), rules.case_sensitive, rules.collation)
    return rows.where(kept & c("guid_orcamento").isNotNull()).select(guid("guid_orcamento"), change.alias("rows"))


def _summed(name: str, entries: DataFrame) -> DataFrame:
    """Entries added up by key; those that cancel out are left out."""
    _, keys, sums = LEDGERS[name]
    kinds = {"rows": _LONG, **sums}
    totals = [F.sum(column).cast(kind).alias(column) for column, kind in kinds.items()]
    some = F.lit(False)
    for column in kinds:
        some = some | (F.col(column) != 0)
    return entries.groupBy(*keys).agg(*totals).where(some)


def _signed(changes: DataFrame, name: str) -> DataFrame:
    change = F.col(CHANGE) if CHANGE in changes.columns else F.lit(1)
    schema = T.StructType([*BASE_TABLES[name].fields, T.StructField(CHANGE, T.LongType())])
    return conform(changes.withColumn(CHANGE, change), schema)


class DailyLedger:
    """The ledgers in a folder, one Parquet dataset each, of appended batches.

    ``rules`` must be the same for all batches: they decide what is counted.
    """

    def __init__(self, spark: SparkSession, folder: str, rules: Rules | None = None):
        self.spark, self.folder, self.rules = spark, folder, rules or Rules()

    def add(self, changes: Mapping[str, DataFrame], batch: str | None = None) -> None:
        """Append a batch: by table, the rows that came and went, told by the column ``change``.

        A table of changes without that column has rows that came. ``batch`` names the
        batch; adding it again replaces what it had added, so that a run that broke off
        can be repeated. Only the changes are read. Tables that no total depends on are
        passed over.
        """
        batch = batch or uuid.uuid4().hex
        if not re.fullmatch(r"[\w-]+", batch, re.ASCII):
            raise ValueError(f"{batch!r} can't name a batch: letters, digits, - and _ can")
        for name, (base, _, _) in LEDGERS.items():
            if base in changes:
                entries = _entries(name, _signed(changes[base], base), self.rules)
                _summed(name, entries).write.mode("overwrite").parquet(f"{self.folder}/{name}/{_BATCH}={batch}")

    def start(self, tables: InvoiceTables) -> None:
        """Begin with tables as they are."""
        tables.check_landed()
        self.add({base: tables[base] for base, _, _ in LEDGERS.values()}, batch="start")

    def sums(self, name: str) -> DataFrame:
        """One row per key of a ledger, over all batches. A ledger without batches has none."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
        there = path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)
        schema = _schema(name)
        entries = self.spark.read.schema(schema).parquet(f"{self.folder}/{name}") if there else (
            self.spark.createDataFrame([], schema)
        )
        if self.rules.collation and "guid" in entries.columns:  # files hold plain text
            entries = entries.withColumn("guid", F.collate("guid", self.rules.collation))
        return _summed(name, entries.drop(_BATCH))

    def compact(self, folder: str) -> DailyLedger:
        """The same sums as a single batch in another folder."""
        for name in LEDGERS:
            self.sums(name).write.parquet(f"{folder}/{name}/{_BATCH}=start")
        return DailyLedger(self.spark, folder, self.rules)

    def _repeats(self) -> DataFrame:
        """(guid, times) for the guids that repeat a goods line in the view."""
        many = lambda name, key, count: (
            self.sums(name).where("rows > 1").select(F.col(key).alias(f"_{key}"), F.col("rows").alias(count))
        )
        lines = self.sums("quote_lines").where("rows > 0").withColumnRenamed("rows", "line_rows")
        quotes = (
            lines.join(many("won_quotes", "quote", "won_rows"), F.col("quote") == F.col("_quote"), "left")
            .groupBy("guid").agg(F.sum(F.col("line_rows") * F.coalesce("won_rows", F.lit(1))).alias("quote_rows"))
            .where("quote_rows > 1")
        )
        orders = many("orders", "guid", "order_rows")
        times = F.coalesce("quote_rows", F.lit(1)) * F.coalesce("order_rows", F.lit(1))
        joined = quotes.join(orders, F.col("guid") == F.col("_guid"), "full")
        return stored(joined.select(F.coalesce("guid", "_guid").alias("_guid"), times.alias("times")))

    def daily_totals(self, days: Callable[[Column], Column] | None = None) -> DataFrame:
        """(data_emissao, total), as ``report.daily_totals`` over the tables after all changes.

        ``days`` is a condition on the day of issue, for a report on some of them.
        """
        invoices = self.sums("invoices").where("rows > 0")
        if days is not None:
            invoices = invoices.where(days(F.col("data_emissao")))
        times = F.coalesce("times", F.lit(1))
        goods = (
            self.sums("goods").where("rows > 0")
            .join(self._repeats(), F.col("guid") == F.col("_guid"), "left")
            .groupBy(F.col("nf").alias("goods_nf")).agg(
                F.sum((F.col("value") * times).cast(TOTAL_VALUE)).alias("goods_value"),
                F.sum(F.col("valueless") * times).alias("valueless_rows"),
            )
        )
        services = self.sums("services").where("rows > 0").select(
            F.col("nf").alias("service_nf"), F.col("rows").alias("service_rows"), F.col("value").alias("service_value")
        )
        returned = self.sums("returns").where("rows > 0").select(F.col("nf").alias("returned_nf"))
        joined = (
            invoices.join(returned, F.col("nf") == F.col("returned_nf"), "left_anti")
            .join(goods, F.col("nf") == F.col("goods_nf"), "left")
            .join(services, F.col("nf") == F.col("service_nf"), "left")
        )
        total = (invoice_total() * F.col("rows")).cast(TOTAL_VALUE)
        return joined.groupBy("data_emissao").agg(F.sum(total).cast(TOTAL_VALUE).alias("total"))
