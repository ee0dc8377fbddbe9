"""The invoice view: one row per invoice and matching goods, service, quote and order line."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from billwright.functions import lines as L
from billwright.operators import lookups
from billwright.operators.skew import Spread, with_row_id
from billwright.plans.inputs import Inputs
from billwright.rules import Rules
from billwright.schemas import VIEW_HEADINGS
from billwright.sources.tables import InvoiceTables


# Row ids, each with the join keys for whose sake the table gets it if they are hot.
_ROW_IDS = {
    "header_row": ("headers.nf",),
    "goods_row": ("goods.nf", "goods.guid", "goods.product"),
    "service_row": ("services.nf",),
    "quote_line_row": ("quote_lines.guid", "quote_lines.quote"),
    "quote_row": ("quotes.quote",),
    "order_row": ("orders.guid",),
}


class ViewSteps:
    """The joins of the view, one method per step, each building on the one before.

    Hot keys are counted when a step first needs them; beyond that, all is lazy. Steps on the invoice number come first, so that a filter
    on the headers cuts everything after it, and so that headers, goods, services
    and both per-invoice lookups meet in one partitioning; then the two joins on
    the quote line's guid, which share a second one.
    """

    def __init__(self, inputs: Inputs):
        self.inputs = inputs

    @property
    def hot(self) -> dict:
        return self.inputs.hot_keys_of_view

    def _ids(self, *names: str) -> list[str]:
        """Those of the row ids that are needed."""
        return [name for name in names if any(self.hot[key] for key in _ROW_IDS[name])]

    def _with_id(self, df: DataFrame, name: str) -> DataFrame:
        return with_row_id(df, name) if self._ids(name) else df

    def _line(self, *ids: str) -> list[str]:
        """Columns that tell joined lines apart."""
        return ["nf", "codigo", "goods_total", "service_total", *self._ids(*ids)]

    def headers(self) -> DataFrame:
        hot = self.inputs.hot_keys("headers.nf")["headers.nf"]
        df = self.inputs.headers().select(
            F.col("numero").alias("nf"), "dt_emissao", "nfse", "cancelada", "nfe_desc_status",
            "cfop", "natureza_op", "entrada", "saida", "razao_social",
        )
        return with_row_id(df, "header_row") if hot else df

    def goods(self) -> DataFrame:
        df = self.inputs.goods().select(
            F.col("numero_nf").alias("goods_nf"), "codigo", "produto",
            F.col("qtde").alias("goods_qty"), F.col("unidade").alias("goods_unit"),
            F.col("vl_total").alias("goods_total"), F.col("vl_ipi").alias("goods_tax"),
            "guid_orcamento",
        )
        return self._with_id(df, "goods_row")

    def services(self) -> DataFrame:
        df = self.inputs.services().select(
            F.col("numero_nf").alias("service_nf"), F.col("qtde").alias("service_qty"),
            F.col("unidade").alias("service_unit"), F.col("vl_total").alias("service_total"),
        )
        return self._with_id(df, "service_row")

    def quote_lines(self) -> DataFrame:
        df = self.inputs.quote_lines().select("guid_linha", "cod_orcamento")
        return self._with_id(df, "quote_line_row")

    def quotes(self) -> DataFrame:
        """Quote lines with the won quotes they belong to; a line without one stays."""
        quotes = self.inputs.won_quotes().select(F.col("codigo").alias("won_quote"))
        by = ["guid_linha", *self._ids("quote_line_row")]
        hot = self.hot["quote_lines.quote"]
        return (
            Spread.over(self.quote_lines(), "cod_orcamento", hot, by, nullable=True)
            .left_join(
                self._with_id(quotes, "quote_row"), "won_quote",
                self.hot["quotes.quote"], self._ids("quote_row"),
            )
            .result()
        )

    def orders(self) -> DataFrame:
        df = self.inputs.orders_by_guid().select(
            F.col("guid_orcamento").alias("order_guid"), "n_os"
        )
        return self._with_id(df, "order_row")

    def with_lookups(self) -> Spread:
        """Headers with their return note and billing order."""
        hot = self.inputs.hot_keys("headers.nf")["headers.nf"]
        return (
            Spread.over(self.headers(), "nf", hot, ["nf", "header_row"] if hot else ["nf"])
            .left_join(lookups.return_notes(self.inputs.returns()), "returned_nf")
            .left_join(lookups.billing_orders(self.inputs.billing_orders()), "billed_nf")
        )

    def with_goods(self) -> Spread:
        hot = self.hot  # all at once, before the first step asks for its own
        return self.with_lookups().left_join(
            self.goods(), "goods_nf", hot["goods.nf"], self._ids("goods_row")
        )

    def with_services(self) -> Spread:
        """Goods and service lines of one invoice multiply, as both hang on its number."""
        return self.with_goods().left_join(
            self.services(), "service_nf", self.hot["services.nf"], self._ids("service_row")
        )

    def join_quotes(self, lines: Spread) -> Spread:
        """Quote lines add no column, but a line appears once per match."""
        return lines.left_join(
            self.quotes(), "guid_linha", self.hot["quote_lines.guid"],
            self._ids("quote_line_row", "quote_row"),
        )

    def join_orders(self, lines: Spread) -> Spread:
        return lines.left_join(
            self.orders(), "order_guid", self.hot["orders.guid"], self._ids("order_row")
        )

    def over_guids(self, lines: DataFrame, by: list[str]) -> Spread:
        """Goods lines, alone or joined to their invoices, ready for joins on the guid."""
        return Spread.over(lines, "guid_orcamento", self.hot["goods.guid"], by, nullable=True)

    def goods_over_guids(self) -> Spread:
        return self.over_guids(self.goods(), ["goods_nf", "codigo", *self._ids("goods_row")])

    def with_orders(self) -> Spread:
        by = self._line("header_row", "goods_row", "service_row")
        lines = self.over_guids(self.with_services().result(), by)
        return self.join_orders(self.join_quotes(lines))

    def with_product_orders(self) -> DataFrame:
        """Lines without a service order of their own look one up by product code."""
        return self._over_missing_orders(self.with_orders().result(), self._line(*_ROW_IDS))

    def goods_first(self) -> DataFrame:
        """The same lines with the invoices joined last.

        For whole tables: goods lines are narrow as long as they have no header, and those
        of one invoice end up beside each other. Filters on the headers cut nothing here.
        """
        ids = self._ids("goods_row", "quote_line_row", "quote_row", "order_row")
        goods = self.join_orders(self.join_quotes(self.goods_over_guids())).result()
        goods = self._over_missing_orders(goods.drop("guid_linha", "won_quote", "order_guid"), ["goods_nf", "codigo", *ids])
        lines = self.with_lookups().left_join(
            goods.drop("missing_order_product", "product_code"), "goods_nf", self.hot["goods.nf"], ids
        )
        return lines.left_join(self.services(), "service_nf", self.hot["services.nf"], self._ids("service_row")).result()

    def _over_missing_orders(self, lines: DataFrame, by: list[str]) -> DataFrame:
        lines = lines.withColumn("missing_order_product", F.when(F.col("n_os").isNull(), F.col("codigo")))
        spread = Spread.over(lines, "missing_order_product", self.hot["goods.product"], by, nullable=True)
        return self.join_product_orders(spread).result()

    def join_product_orders(self, lines: Spread) -> Spread:
        """The smallest service order of a product, for lines spread over the product."""
        orders = self.inputs.orders_by_product().select(
            F.col("cod_pecas").alias("product_code"), "n_os"
        )
        return lines.left_join(orders, "product_code", per_key=F.min("n_os").alias("product_order"))


def invoice_view(tables: InvoiceTables, rules: Rules | None = None) -> DataFrame:
    """All 17 columns of the view, under the plain names of ``VIEW_HEADINGS``."""
    return view_of(Inputs(tables, rules or Rules()))


def view_of(inputs: Inputs, goods_first: bool = False) -> DataFrame:
    """The view over inputs that may be cut to some invoices."""
    c, steps = F.col, ViewSteps(inputs)
    return (steps.goods_first() if goods_first else steps.with_product_orders()).select(
        L.document_type(c("nfse")).alias("tipo"),
        "nf",
        F.to_date("dt_emissao").alias("data_emissao"),
        "cancelada",
        L.status(
            c("cancelada"), c("returned_nf").isNotNull(), c("return_number"), c("nfse"),
            c("nfe_desc_status"),
        ).alias("status"),
        "cfop",
        c("natureza_op").alias("natureza_operacao"),
        "entrada",
        "saida",
        c("codigo").alias("cod_interno"),
        F.coalesce("n_os", "product_order").alias("os"),
        c("razao_social").alias("cliente"),
        L.product_name(c("produto")).alias("produto"),
        F.coalesce("goods_qty", "service_qty").alias("qtd"),
        F.coalesce("goods_unit", "service_unit").alias("un"),
        L.line_value(c("goods_total"), c("goods_tax"), c("service_total")).alias("valor"),
        "of",
    )


def with_headings(df: DataFrame) -> DataFrame:
    """The same columns under the headings people know them by."""
    return df.select(*[F.col(f"`{name}`").alias(VIEW_HEADINGS[name]) for name in df.columns])


def register_invoice_view(
    tables: InvoiceTables, name: str, rules: Rules | None = None
) -> DataFrame:
    """Offer the view, with its headings, to SQL under ``name``; over landed tables only."""
    tables.check_landed()
    view = with_headings(invoice_view(tables, rules))
    view.createOrReplaceTempView(name)
    return view
