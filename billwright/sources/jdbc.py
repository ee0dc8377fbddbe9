"""Reading tables and queries from the invoicing database with Spark's JDBC source.

The database, user and password come from the deployment; nothing is kept here.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Split:
    """How one read is cut into parallel range reads over a numeric column.

    The bounds only shape the ranges: rows outside them are read by the first
    and last range.
    """

    column: str
    lower: int
    upper: int
    parts: int


@dataclass(frozen=True)
class Depths:
    """How one read is cut into parallel reads of about as many rows each.

    ``bounds`` are quantiles of a column, in order, with repeats where one value fills
    several of them. Such a value is a read of its own or, with ``within``, a whole-number
    column that tells its rows apart, as many reads as quantiles it fills.
    """

    column: str
    bounds: tuple[int | str, ...]
    within: str | None = None

    def predicates(self) -> list[str]:
        """Conditions of which every row meets exactly one."""
        values = sorted(set(self.bounds))
        fills = {value: self.bounds.count(value) for value in values}
        column, found, below = self.column, [], None
        for value in values:
            low = f"{column} >= {_literal(value)}"
            if below is None:
                found.append(f"{column} < {_literal(value)} or {column} is null")
            elif below:
                found.append(f"{' and '.join(below)} and {column} < {_literal(value)}")
            if fills[value] > 1:
                found += [f"{column} = {_literal(value)}{part}" for part in self._parts(fills[value])]
                low = f"{column} > {_literal(value)}"
            below = [low]
        return [*found, *below] if below else ["1 = 1"]

    def _parts(self, count: int) -> list[str]:
        if not self.within:
            return [""]
        rest = f"abs({self.within} % {count})"
        return [f" and ({rest} = 0 or {self.within} is null)", *(f" and {rest} = {n}" for n in range(1, count))]


def _literal(value: int | str) -> str:
    return str(value) if isinstance(value, int) else "'" + value.replace("'", "''") + "'"


class Single:
    """A read by one task, for a table known to be small."""


def depths_query(table: str, column: str, parts: int) -> str:
    """(tile, value): the first value of each part but the first, of parts of equal size."""
    return (
        f"select tile, min({column}) as value from (select {column}, ntile({parts}) over (order by {column}) as tile"
        f" from {table} where {column} is not null) as ranked where tile > 1 group by tile"
    )


@dataclass(frozen=True)
class JdbcDatabase:
    server: str
    database: str
    username: str
    password: str
    driver: str = "com.microsoft.sqlserver.jdbc.SQLServerDriver"
    fetch_size: int = 10_000

    @property
    def url(self) -> str:
        return f"jdbc:sqlserver://{self.server};databaseName={self.database}"

    def split(self, spark: SparkSession, table: str, column: str, parts: int) -> Split:
        """A split of ``table`` between the least and the largest value of ``column``."""
        bounds = f"select min({column}) as low, max({column}) as high from {table}"
        row = spark.read.format("jdbc").options(**self.options(bounds, Single())).load().first()
        low, high = (0 if value is None else int(value) for value in row)
        return Split(column, low, high + 1, parts)

    def depths(
        self, spark: SparkSession, table: str, column: str, parts: int, within: str | None = None
    ) -> Depths:
        """A split of ``table`` at the values that cut it into ``parts`` parts of equal size.

        The database ranks the column's values by how many rows lie before them; a few
        numbers come back. Unlike ranges between the least and the greatest value, gaps
        and values with very many rows don't make some reads much longer than others.
        """
        rows = spark.read.format("jdbc").options(**self.options(depths_query(table, column, parts), Single())).load()
        values = sorted((row["tile"], row["value"]) for row in rows.collect())
        return Depths(column, tuple(value if isinstance(value, str) else int(value) for _, value in values), within)

    def options(self, source: str, split: Split | Single | Depths) -> dict[str, str]:
        """Reader options for a table name or a ``select`` statement.

        A statement is passed as a derived table, because Spark's ``query``
        option cannot be combined with range reads; it is one ``select`` without
        ``order by`` or a leading ``with``.
        """
        is_query = source.lstrip().lower().startswith("select")
        options = {
            "url": self.url,
            "user": self.username,
            "password": self.password,
            "driver": self.driver,
            "fetchsize": str(self.fetch_size),
            "preferTimestampNTZ": "true",
            "dbtable": f"({source}) as source_query" if is_query else source,
        }
        if isinstance(split, Split):
            options |= {
                "partitionColumn": split.column,
                "lowerBound": str(split.lower),
                "upperBound": str(split.upper),
                "numPartitions": str(split.parts),
            }
        return options

    def read(self, spark: SparkSession, source: str, split: Split | Single | Depths) -> DataFrame:
        if isinstance(split, Depths):
            options = self.options(source, split)
            login = {name: options.pop(name) for name in ("user", "password", "driver")}
            reader = spark.read.options(**{name: options[name] for name in ("fetchsize", "preferTimestampNTZ")})
            return reader.jdbc(options["url"], options["dbtable"], predicates=split.predicates(), properties=login)
        return spark.read.format("jdbc").options(**self.options(source, split)).load()
