"""Left joins that stay balanced when one key holds a large part of the rows.

A key is *hot* when it has more rows than a task's even share of its table, and more
than a task should bother to split. So no more keys are hot than there are tasks. Rows
of a hot key are dealt out over numbered cells, and the rows of the other side are
repeated in each of these cells, so every pair still meets exactly once. Rows whose key
is null meet nobody; they are dealt out as well, because a plain join would send them
all to one task.

Cells are computed from a row's content alone, so a task that runs again after a
lost executor deals its rows out as before. Where a key is hot, its table gets a
row id (``with_row_id``), which tells identical copies apart.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from functools import reduce
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Rows of a barely hot key that a count should see to be sure of it.
ROWS_SEEN = 1_000

# Cells that rows with a null key are dealt out over: many times the tasks of a join.
NULL_CELLS = 1 << 16
SEED = 20_260_511

# A hot key and the number of cells its rows are dealt out over.
Cells = Mapping[object, int]


@dataclass(frozen=True)
class Side:
    """Rows about to be joined, and the columns of their join keys by name.

    ``repeats`` is how often each row will have been repeated by then. With it,
    only the rows that are repeated count; without it, all of them, once each.
    """

    df: DataFrame
    keys: Mapping[str, str]
    repeats: Column | None = None

    def counted(self, fraction: float) -> DataFrame:
        """``(name, key, weight)`` per key; of rows that count once a sample is enough."""
        if self.repeats is not None:
            rows = self.df.withColumn("_weight", self.repeats).where(F.col("_weight") > 1)
        else:
            sample = self.df.sample(fraction, seed=SEED) if fraction < 1 else self.df
            rows = sample.withColumn("_weight", F.lit(1 / fraction))
        keys = [
            F.struct(F.lit(name).alias("name"), F.col(key).cast("string").alias("key"))
            for name, key in self.keys.items()
        ]
        return rows.select(F.array(*keys).alias("keys"), F.col("_weight").alias("weight")).select(
            F.inline("keys"), "weight"
        )

    def value(self, name: str, text: str) -> object:
        is_number = isinstance(self.df.schema[self.keys[name]].dataType, T.IntegralType)
        return int(text) if is_number else text


def find_hot_keys(sides: Iterable[Side], rows_per_task: int, tasks: int | None = None) -> dict[str, Cells]:
    """The keys, on every side, with more rows than ``rows_per_task`` and than an even share.

    An even share is the side's rows over ``tasks``, by default the session's shuffle
    partitions, so that less than ``tasks`` keys of a side can be found. One query for all
    sides, and another if any key is large, which read the key columns only. They count on a sample, the same on each run,
    that still holds ``ROWS_SEEN`` rows of any hot key. What is found decides how the
    work is dealt out and nothing else.
    """
    side_of = {name: side for side in sides for name in side.keys}
    distinct_sides = {id(side): side for side in side_of.values()}.values()
    spark = next(iter(distinct_sides)).df.sparkSession
    tasks = tasks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    fraction = min(1.0, ROWS_SEEN / rows_per_task)
    counts = (
        reduce(DataFrame.unionByName, [side.counted(fraction) for side in distinct_sides])
        .where(F.col("key").isNotNull())
        .groupBy("name", "key")
        .agg(F.sum("weight").alias("rows"))
    )
    hot: dict[str, dict] = {name: {} for name in side_of}
    large = counts.where(F.col("rows") > rows_per_task)
    if large.isEmpty():  # as a rule; even shares are only worth a job where they matter
        return hot
    shares = counts.groupBy(F.col("name").alias("_name")).agg(
        F.greatest(F.lit(float(rows_per_task)), F.sum("rows") / tasks).alias("share")
    )
    largest = large.join(shares, (F.col("name") == F.col("_name")) & (F.col("rows") > F.col("share")))
    for row in largest.collect():
        hot[row["name"]][side_of[row["name"]].value(row["name"], row["key"])] = math.ceil(
            row["rows"] / row["share"]
        )
    return hot


def merged(one: Cells, other: Cells) -> Cells:
    """The hot keys of both, each with the larger number of cells."""
    return {key: max(one.get(key, 1), other.get(key, 1)) for key in {**one, **other}}


def fan_out(key: Column, hot: Cells, rows_per_task: int) -> Column:
    """At least how many rows a join with the hot side makes of one row with this key."""
    if not hot:
        return F.lit(1.0)
    by_text = chain.from_iterable((F.lit(str(value)), F.lit(count)) for value, count in hot.items())
    cells = F.element_at(F.create_map(*by_text), key.cast("string"))
    return F.coalesce(cells * float(rows_per_task), F.lit(1.0))


def with_row_id(df: DataFrame, name: str) -> DataFrame:
    """Number the rows of a scan.

    To be applied to a table as read (filtered or not): there the number depends
    on the files alone.
    """
    return df.withColumn(name, F.monotonically_increasing_id())


def _table(df: DataFrame, key: str, cells: Cells) -> DataFrame:
    """``(_hot, _cells)``: the hot keys as a table of less rows than there are tasks."""
    schema = T.StructType([
        T.StructField("_hot", df.schema[key].dataType), T.StructField("_cells", T.IntegerType())
    ])
    table = df.sparkSession.createDataFrame(list(cells.items()), schema)
    if _is_collated(df, key):  # keys were counted by their text, and several may be equal
        table = table.groupBy("_hot").agg(F.sum("_cells").cast("int").alias("_cells"))
    return F.broadcast(table)


def _is_collated(df: DataFrame, key: str) -> bool:
    kind = df.schema[key].dataType
    return isinstance(kind, T.StringType) and kind != T.StringType()


def _with_cells(df: DataFrame, key: str, table: DataFrame) -> DataFrame:
    """``df`` with the number of cells of its key; null for keys that aren't split."""
    return df.join(table, F.col(key) == F.col("_hot"), "left").drop("_hot")


def _dealt(df: DataFrame, key: str, cells: Cells, by: list[str], name: str) -> DataFrame:
    """Each row in the one cell it goes to."""
    cell = F.pmod(F.xxhash64(*by), F.coalesce("_cells", F.lit(1))).cast("int")
    return _with_cells(df, key, _table(df, key, cells)).withColumn(name, cell).drop("_cells")


def _repeated(df: DataFrame, name: str) -> DataFrame:
    """Each row in all cells of its key."""
    return df.withColumn(name, F.explode(F.sequence(F.lit(0), F.coalesce("_cells", F.lit(1)) - 1)))


def _hash_of(df: DataFrame, key: str) -> Column:
    """A hash that whole numbers of all widths share, and that is the same for keys that are equal."""
    if _is_collated(df, key):  # equal texts may differ, and hashes are of the text
        return F.when(F.col(key).isNotNull(), F.lit(0))
    kind = df.schema[key].dataType
    return _null_cell(F.col(key).cast("long") if isinstance(kind, T.IntegralType) else F.col(key))


def _null_cell(*by: Column | str) -> Column:
    """One of ``NULL_CELLS``: it is shuffled with every row, and all bits of a hash can't be compressed."""
    return F.pmod(F.xxhash64(*by), F.lit(NULL_CELLS)).cast("int")


def _check_kinds(left: DataFrame, key: str, right: DataFrame, right_key: str) -> None:
    one, other = left.schema[key].dataType, right.schema[right_key].dataType
    if one != other and not (isinstance(one, T.IntegralType) and isinstance(other, T.IntegralType)):
        raise TypeError(f"{key} is {one.simpleString()}, {right_key} is {other.simpleString()}: cast one")


@dataclass(frozen=True)
class Spread:
    """A left side that is about to be joined on ``key``, possibly several times.

    ``null_cell`` names the column that keeps rows with a null key apart;
    ``cells`` pairs each cell column with the hot keys it splits. Joins that
    split nothing further keep the partitioning, so a chain of them shuffles the
    left side once.
    """

    df: DataFrame
    key: str
    null_cell: str | None = None
    cells: tuple[tuple[str, Cells], ...] = ()

    @classmethod
    def over(
        cls, df: DataFrame, key: str, hot: Cells, by: list[str], nullable: bool = False
    ) -> Spread:
        """Deal out the rows of the hot keys and, if there may be any, of the null key.

        ``by`` are the columns that decide where a row goes; for a hot key they
        must tell its copies apart.
        """
        null_cell, cells = None, ()
        if nullable:
            null_cell = f"_{key}_null_cell"
            row_or_key = F.when(F.col(key).isNull(), _null_cell(*by)).otherwise(_hash_of(df, key))
            df = df.withColumn(null_cell, row_or_key)
        if hot:
            name = f"_{key}_cell"
            df = _dealt(df, key, hot, by, name)
            cells = ((name, hot),)
        return cls(df, key, null_cell, cells)

    def left_join(
        self,
        right: DataFrame,
        right_key: str,
        hot: Cells | None = None,
        by: list[str] | None = None,
        per_key: Column | None = None,
    ) -> Spread:
        """Left outer join; ``hot`` are keys of ``right`` to split.

        ``by`` are the columns that tell the rows of a hot key of ``right`` apart.
        The other column names of the two sides must differ. ``right_key`` stays
        in the result, so that its null tells rows without a match. With the
        aggregate ``per_key`` the right side is grouped by its key first, in the
        partitioning that the join needs. Whole numbers of different widths are
        equal as numbers; other keys must be of one type.

        A left row is repeated only for keys that ``right`` has when the join runs,
        so one without a match stays a single row, whatever ``hot`` says.
        """
        _check_kinds(self.df, self.key, right, right_key)
        left, on = self.df, F.col(self.key) == F.col(right_key)
        null_cell = f"{self.null_cell}_right"
        if self.null_cell:
            right = right.withColumn(null_cell, _hash_of(right, right_key))
        if per_key is not None:
            keys = [right_key, null_cell] if self.null_cell else [right_key]
            right = right.where(F.col(right_key).isNotNull()).groupBy(*keys).agg(per_key)
        cells, added = self.cells, []
        if hot:
            name = f"_{right_key}_cell"
            table = _table(right, right_key, hot)
            there = right.select(F.col(right_key).alias("_there")).distinct()
            there = F.broadcast(table.join(there, F.col("_hot") == F.col("_there"), "left_semi"))
            left = _repeated(_with_cells(left, self.key, there), name).withColumnRenamed("_cells", f"{name}_split")
            right = _dealt(right, right_key, hot, by, f"{name}_right")
            on &= F.col(name) == F.col(f"{name}_right")
            added += [f"{name}_right", f"{name}_split"]
            cells = (*cells, (name, hot))
        for name, split in self.cells:
            counted = _with_cells(right, right_key, _table(right, right_key, split))
            right = _repeated(counted, f"{name}_right").drop("_cells")
            on &= F.col(name) == F.col(f"{name}_right")
            added.append(f"{name}_right")
        if self.null_cell:
            on &= F.col(self.null_cell) == F.col(null_cell)
            added.append(null_cell)
        joined = left.join(right, on, "left")
        if hot:
            # A key that was split is there, so it has its matches in some of the cells.
            whole = F.col(f"_{right_key}_cell_split").isNull()
            joined = joined.where(F.col(right_key).isNotNull() | whole)
        return Spread(joined.drop(*added), self.key, self.null_cell, cells)

    def result(self) -> DataFrame:
        """The joined rows without the cell columns."""
        names = [name for name, _ in self.cells]
        return self.df.drop(*names, *([self.null_cell] if self.null_cell else []))
