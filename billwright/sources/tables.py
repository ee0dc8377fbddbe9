"""Reading the base tables: from Parquet folders or over JDBC, behind one interface."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from billwright.schemas import BASE_TABLES
from billwright.sources.jdbc import Depths, JdbcDatabase, Single, Split


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the columns of ``schema`` from ``df``, cast to its types.

    Casts to a column's own type vanish from the plan, so filters on it still
    reach the scan. Flags that the source holds as booleans become 0/1 here.
    """
    return df.select(
        *[F.col(field.name).cast(field.dataType).alias(field.name) for field in schema]
    )


# The column by whose order a table lies after landing.
_LANDED_BY = {
    "tnota_fiscal": "dt_emissao",
    "tnota_fiscal_item": "numero_nf",
    "tnota_fiscal_servico": "numero_nf",
    "tnota_fiscal_nfref": "nfref_numero_nf",
    "tordem_fat": "numero_nf",
}


# The column with the invoice number, in the tables that hang on it.
NUMBER_KEYS = {
    "tnota_fiscal": "numero",
    "tnota_fiscal_item": "numero_nf",
    "tnota_fiscal_servico": "numero_nf",
    "tnota_fiscal_nfref": "nfref_numero_nf",
    "tordem_fat": "numero_nf",
}

# In tables landed by month: the month a row lies under, and in headers the month under
# which the lines of their number do.
MONTH = "issue_month"
LINE_MONTH = "line_month"


class InvoiceTables:
    """The eight base tables by name, each read when first asked for."""

    def __init__(self, read: Callable[[str], DataFrame], live: bool = False, by_month: bool = False):
        self._read = read
        self._live = live
        self.by_month = by_month
        self._frames: dict[str, DataFrame] = {}

    @classmethod
    def from_parquet(cls, spark: SparkSession, folder: str) -> InvoiceTables:
        """``folder/<table>``, one Parquet dataset per table."""
        return cls(lambda name: spark.read.parquet(f"{folder}/{name}"))

    @classmethod
    def from_database(
        cls, spark: SparkSession, database: JdbcDatabase, splits: Mapping[str, Split | Single | Depths]
    ) -> InvoiceTables:
        """Tables of a database that goes on changing; ``splits`` says for each how to read it.

        Reports read their tables several times, so they want the tables landed first.
        """
        return cls(lambda name: database.read(spark, name, splits[name]), live=True)

    def check_landed(self) -> None:
        if self._live:
            raise ValueError("land the tables first: the database may change between two reads")

    def land(self, spark: SparkSession, folder: str) -> InvoiceTables:
        """Copy all tables to Parquet and go on with the copies.

        Each job, and each repeated task, then reads the same rows again, and leaves the
        database alone. Headers lie by issue date and lines by invoice number, so that
        the statistics of the files skip what a report does not cover.
        """
        for name in BASE_TABLES:
            df, order = self[name], _LANDED_BY.get(name)
            if order:
                df = df.repartitionByRange(order).sortWithinPartitions(order)
            df.write.parquet(f"{folder}/{name}")
        return InvoiceTables.from_parquet(spark, folder)

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames:
            self._frames[name] = conform(self._read(name), BASE_TABLES[name])
        return self._frames[name]

    def of_company(self, name: str, company: int, months: Column | None = None) -> DataFrame:
        """The rows of one company, filtered at the scan.

        ``months`` is a condition on ``MONTH`` and chooses the folders that are opened,
        where the table lies by month; headers come with ``LINE_MONTH`` there.
        """
        if not self.by_month or name not in NUMBER_KEYS:
            return self[name].where(F.col("cod_empresa") == company)
        raw = self._read(name)
        rows = raw if months is None else raw.where(months)
        added = [LINE_MONTH] if LINE_MONTH in raw.columns else []
        return conform(rows, T.StructType([
            *BASE_TABLES[name].fields, *[raw.schema[column] for column in added]
        ])).where(F.col("cod_empresa") == company)

    def of_numbers(self, inside: Callable[[Column], Column]) -> InvoiceTables:
        """The same tables with only those rows of an invoice number that ``inside`` lets pass; filtered at the scan."""

        def read(name: str) -> DataFrame:
            key = NUMBER_KEYS.get(name)
            if key is None:
                return self._read(name)
            return self._read(name).where(inside(F.col(key).cast(BASE_TABLES[name][key].dataType)))

        return InvoiceTables(read, self._live, self.by_month)

    def query(self, spark: SparkSession, sql: str) -> DataFrame:
        """Run SQL over the base tables under their own names."""
        self.register(spark)
        return spark.sql(sql)

    def register(self, spark: SparkSession) -> None:
        """Offer the base tables as temporary views of the session."""
        for name in BASE_TABLES:
            self[name].createOrReplaceTempView(name)
