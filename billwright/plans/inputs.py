"""The rows that enter the joins: each base table after its own filters."""

from __future__ import annotations

import datetime
from dataclasses import dataclass
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from billwright.functions import lines as L
from billwright.operators.skew import Cells, Side, fan_out, find_hot_keys, merged
from billwright.operators.storage import stored
from billwright.rules import Rules
from billwright.sources.tables import LINE_MONTH, MONTH, InvoiceTables


@dataclass(frozen=True)
class Inputs:
    """Filtered base tables, optionally cut to the invoices a report is about.

    ``header_filter`` is a condition on the columns of the invoice header, and ``wanted``
    a table of invoice numbers (``wanted_nf``, null being one) that it leaves.
    ``issued`` are the first and last day of issue that the filter lets pass, where it
    has such limits: tables that lie by month are read for these months only, and lines
    for the months that the numbers of their headers lie under.
    ``narrow`` says that it leaves few invoices, for instance those of a month.
    Their headers are then stored once. Rows outside the range of their numbers are
    skipped by the scans; with numbers given out over time, that is most of the
    history. A semi join on the numbers drops the rows of all other invoices, while
    the tables are read if the numbers are small enough to broadcast. The goods lines
    that remain are stored, and their guids and products cut the quote lines and
    service orders in the same way.

    All reads must see the same rows: tables of a live database are landed first.
    """

    tables: InvoiceTables
    rules: Rules = Rules()
    header_filter: Column | None = None
    narrow: bool = False
    issued: tuple[datetime.date | None, datetime.date | None] = (None, None)
    wanted: DataFrame | None = None

    def _of_company(self, name: str, months: Column | None = None) -> DataFrame:
        """Rows of the company, with guids as the database compares them."""
        df = self.tables.of_company(name, self.rules.company, months)
        guids = [column for column in ("guid_orcamento", "guid_linha") if column in df.columns]
        return df.withColumns({
            column: L.compared_text(F.col(column), self.rules.case_sensitive, self.rules.collation) for column in guids
        })

    @cached_property
    def _headers(self) -> DataFrame:
        df = self._of_company("tnota_fiscal", self._issue_months()).where(
            L.has_text(F.col("condicao_pagamento")) & (F.col("cli_for") == 0)
        )
        df = df if self.header_filter is None else df.where(self.header_filter)
        if self.wanted is not None:
            df = df.join(self.wanted, F.col("numero").eqNullSafe(F.col("wanted_nf")), "left_semi")
        return stored(df) if self.narrow else df

    def headers(self) -> DataFrame:
        """Invoices of the company to customers, with terms of payment."""
        return self._headers

    def _issue_months(self) -> Column | None:
        """Condition on the month that headers lie under."""
        month = lambda day: F.trunc(F.lit(day), "month")
        since, until = self.issued
        limits = [F.col(MONTH) >= month(since)] if since else []
        limits += [F.col(MONTH) <= month(until)] if until else []
        return reduce(Column.__and__, limits) if limits else None

    @cached_property
    def _span(self) -> Row | None:
        """In a narrow report: lowest and highest invoice number, and the months of their lines."""
        if not self.narrow:
            return None
        number = F.col("numero")
        # One date for each month of the report.
        months = F.collect_set(LINE_MONTH) if self.tables.by_month else F.lit(None)
        return self.headers().agg(
            F.min(number).alias("low"), F.max(number).alias("high"), months.alias("months")
        ).first()

    def _of_invoices(self, name: str, key: str) -> DataFrame:
        """Rows of a table whose invoice number may be wanted, as far as that is known."""
        if not self.narrow:
            return self._of_company(name)
        months = None if self._span["months"] is None else F.col(MONTH).isin(self._span["months"])
        inside = F.col(key).between(self._span["low"], self._span["high"])
        return _cut(self._of_company(name, months).where(inside), key, self.headers(), "numero")

    @cached_property
    def _goods(self) -> DataFrame:
        lines = self._of_invoices("tnota_fiscal_item", "numero_nf")
        return stored(lines) if self.narrow else lines

    def goods(self) -> DataFrame:
        return self._goods

    def _of_goods(self, rows: DataFrame, key: str, goods_key: str) -> DataFrame:
        return _cut(rows, key, self._goods, goods_key) if self.narrow else rows

    def services(self) -> DataFrame:
        return self._of_invoices("tnota_fiscal_servico", "numero_nf")

    def returns(self) -> DataFrame:
        """Which invoice a return note refers to."""
        return self._of_invoices("tnota_fiscal_nfref", "nfref_numero_nf")

    def billing_orders(self) -> DataFrame:
        return self._of_invoices("tordem_fat", "numero_nf").where(F.col("status") == 1)

    def quote_lines(self) -> DataFrame:
        return self._of_goods(self._of_company("torcamento_itens"), "guid_linha", "guid_orcamento")

    def won_quotes(self) -> DataFrame:
        return self._of_company("torcamento").where(
            L.is_won(F.col("estagio_orc"), F.col("status"), self.rules.case_sensitive, self.rules.collation)
        )

    def kept_orders(self) -> DataFrame:
        """Service orders of the company without the excluded prefix."""
        kept = L.is_kept_order(F.col("n_os"), self.rules.case_sensitive, self.rules.collation)
        return self._of_company("tos").where(kept)

    def orders_by_guid(self) -> DataFrame:
        return self._of_goods(self.kept_orders(), "guid_orcamento", "guid_orcamento")

    def orders_by_product(self) -> DataFrame:
        return self._of_goods(self.kept_orders(), "cod_pecas", "codigo")

    def hot_keys(self, *names: str) -> dict[str, Cells]:
        """The hot values of the named join keys, counted on the very rows that are joined."""
        if "hot_keys_of_view" in self.__dict__:
            return self.hot_keys_of_view
        sides = []
        for rows, keys in _JOIN_KEYS.items():
            asked = {name: key for name, key in keys.items() if name in names}
            if asked:
                sides.append(Side(getattr(self, rows)(), asked))
        return self._found(sides)

    def _found(self, sides: list[Side]) -> dict[str, Cells]:
        return find_hot_keys(sides, self.rules.rows_per_task, self.rules.join_tasks)

    @cached_property
    def hot_keys_of_view(self) -> dict[str, Cells]:
        """All hot values, with rows counted as often as earlier joins repeat them.

        One invoice with very many service lines makes the guids and products of
        its few goods lines hot as well; the same goes for a guid with very many
        quote lines or service orders, and for a quote kept many times.
        """
        hot = self.hot_keys(*[name for keys in _JOIN_KEYS.values() for name in keys])

        def repeats(**hot_by_column: list[Cells]) -> Column | None:
            factors = [
                fan_out(F.col(column), cells, self.rules.rows_per_task)
                for column, sides in hot_by_column.items()
                for cells in sides
                if cells
            ]
            return reduce(Column.__mul__, factors) if factors else None

        def add(rows: DataFrame, name: str, key: str, times: Column | None) -> None:
            if times is not None:
                found = self._found([Side(rows, {name: key}, times)])
                hot[name] = merged(hot[name], found[name])

        add(
            self.quote_lines(), "quote_lines.guid", "guid_linha",
            repeats(cod_orcamento=[hot["quotes.quote"]]),
        )
        by_invoice = [hot["headers.nf"], hot["services.nf"]]
        by_guid = [hot["quote_lines.guid"], hot["orders.guid"]]
        add(self.goods(), "goods.nf", "numero_nf", repeats(guid_orcamento=by_guid))
        add(self.goods(), "goods.guid", "guid_orcamento", repeats(numero_nf=by_invoice))
        add(
            self.goods(), "goods.product", "codigo",
            repeats(numero_nf=by_invoice, guid_orcamento=by_guid),
        )
        return hot


def _cut(rows: DataFrame, key: str, wanted: DataFrame, wanted_key: str) -> DataFrame:
    """The rows whose key is among the wanted ones, whatever their number."""
    keys = wanted.select(F.col(wanted_key).alias("wanted")).distinct()
    return rows.join(keys, F.col(key) == F.col("wanted"), "left_semi")


# Join keys that are checked for hot values, by the rows they belong to.
_JOIN_KEYS: dict[str, dict[str, str]] = {
    "headers": {"headers.nf": "numero"},
    "goods": {
        "goods.nf": "numero_nf", "goods.guid": "guid_orcamento", "goods.product": "codigo",
    },
    "services": {"services.nf": "numero_nf"},
    "quote_lines": {"quote_lines.guid": "guid_linha", "quote_lines.quote": "cod_orcamento"},
    "won_quotes": {"quotes.quote": "codigo"},
    "orders_by_guid": {"orders.guid": "guid_orcamento"},
}
