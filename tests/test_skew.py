"""Joins and numbering stay complete and balanced when one key holds much of the data."""

from pyspark.sql import functions as F

import pytest

from billwright import InvoiceTables, Rules
from billwright.operators.position import with_position
from billwright.operators.skew import Side, Spread, find_hot_keys
from billwright.plans import report as P
from billwright.plans.inputs import Inputs
from billwright.plans.view import invoice_view
from billwright.schemas import BASE_TABLES
from billwright.sources.star import star_tables
from conftest import DATA, bag

# Rules under which no key is ever split.
WHOLE = Rules(rows_per_task=10**9)

HOT_NF, HOT_GUID, HOT_PRODUCT, HOT_QUOTE, HOT_HEADER = 3, "G5", 5, 3, 15


@pytest.fixture(scope="module")
def skewed(spark):
    """The star tables with a third of every table's rows moved to one key each."""
    star = star_tables(spark, f"{DATA}/sf0.001")

    def moved(name, **hot):
        df = star[name]
        third = F.pmod(F.xxhash64(*df.columns), F.lit(3)) == 0
        return df.withColumns(
            {key: F.when(third, F.lit(value)).otherwise(F.col(key)) for key, value in hot.items()}
        )

    frames = {name: star[name] for name in BASE_TABLES}
    frames["tnota_fiscal"] = moved("tnota_fiscal", numero=HOT_HEADER)
    frames["tnota_fiscal_item"] = moved(
        "tnota_fiscal_item", numero_nf=HOT_NF, guid_orcamento=HOT_GUID, codigo=HOT_PRODUCT
    )
    frames["tnota_fiscal_servico"] = moved("tnota_fiscal_servico", numero_nf=HOT_NF)
    frames["torcamento_itens"] = moved("torcamento_itens", cod_orcamento=HOT_QUOTE).union(
        spark.range(3).select(F.lit(1), F.lit(HOT_GUID), F.lit(HOT_QUOTE))
    )
    frames["tos"] = star["tos"].union(
        spark.range(2).select(F.lit(1), F.concat(F.lit("OY"), "id"), F.lit(HOT_GUID), F.lit(None))
    )
    cached = {name: df.cache() for name, df in frames.items()}
    return InvoiceTables(cached.__getitem__)


def counted(df):
    return bag(df.groupBy(*df.columns).count())


@pytest.mark.parametrize("rows_per_task", [7, 60])
def test_view_is_the_same_however_keys_are_split(skewed, rows_per_task):
    plain = invoice_view(skewed, WHOLE)
    assert plain.count() > 100_000
    assert counted(invoice_view(skewed, Rules(rows_per_task=rows_per_task, join_tasks=10_000))) == counted(plain)


@pytest.mark.parametrize("rows_per_task", [7, 60])
def test_totals_are_the_same_however_keys_are_split(skewed, rows_per_task):
    plain = bag(P.daily_totals(P.report_inputs(skewed, WHOLE)))
    assert bag(P.daily_totals(P.report_inputs(skewed, Rules(rows_per_task=rows_per_task, join_tasks=10_000)))) == plain
    rows = P.report_rows(P.report_inputs(skewed, WHOLE))
    assert P.total_of_rows(rows).first() == P.report_total(P.report_inputs(skewed)).first()


def test_hot_keys_are_found(skewed):
    hot = Inputs(skewed, Rules(rows_per_task=100, join_tasks=10_000)).hot_keys_of_view
    assert set(hot["goods.nf"]) == {HOT_NF}
    assert HOT_GUID in hot["goods.guid"] and HOT_PRODUCT in hot["goods.product"]
    assert hot["goods.nf"][HOT_NF] == pytest.approx(17, abs=3)
    assert set(hot["headers.nf"]) == {HOT_HEADER}


def test_repeated_rows_count(skewed):
    """A few goods lines become many by the service lines of their invoice."""
    one = skewed["tnota_fiscal_item"].where(F.col("numero_nf") == HOT_NF).limit(1)
    services = skewed["tnota_fiscal_servico"]
    one = one.withColumn("cod_empresa", F.lit(1))
    few = InvoiceTables(lambda name: one if name == "tnota_fiscal_item" else skewed[name])
    hot = Inputs(few, Rules(rows_per_task=20, join_tasks=10_000)).hot_keys_of_view
    assert services.where(f"numero_nf = {HOT_NF}").count() > 40
    assert hot["goods.nf"] == {} and HOT_NF in hot["services.nf"]
    assert len(hot["goods.guid"]) + len(hot["goods.product"]) >= 1


def test_sampled_count_finds_hot_keys(spark):
    rows = spark.range(400_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("key")
    )
    hot = find_hot_keys([Side(rows, {"side": "key"})], 20_000, tasks=1000)["side"]
    assert set(hot) == {-1}
    assert hot[-1] == pytest.approx(7, abs=2)


def largest_share(df):
    sizes = [row["count"] for row in df.groupBy(F.spark_partition_id()).count().collect()]
    return max(sizes) / sum(sizes)


@pytest.fixture
def shuffled_joins(spark):
    """Plan joins as for large tables: no broadcast, and partitions as they fall."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.shuffle.partitions": "32",
    }
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def test_rows_with_a_hot_key_are_spread(spark, shuffled_joins):
    left = spark.range(100_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("key"), "id"
    )
    right = spark.range(100_000).select(F.col("id").alias("other"))
    plain = Spread.over(left, "key", {}, []).left_join(right, "other").result()
    hot = find_hot_keys([Side(left, {"left": "key"})], 500, tasks=1000)["left"]
    spread = Spread.over(left, "key", hot, ["id"]).left_join(right, "other").result()
    assert largest_share(plain) > 0.33
    assert largest_share(spread) < 0.08
    assert spread.count() == plain.count() == 100_000


def test_rows_with_a_null_key_are_spread(spark, shuffled_joins):
    left = spark.range(100_000).select(
        F.when(F.col("id") % 3 > 0, F.col("id")).alias("key"), "id"
    )
    right = spark.range(100_000).select(F.col("id").alias("other"))
    joined = Spread.over(left, "key", {}, ["id"], nullable=True).left_join(right, "other").result()
    assert largest_share(joined) < 0.08
    assert joined.count() == 100_000
    assert joined.where(F.col("other").isNull()).count() == 33_334


def test_hot_right_side_keeps_unmatched_rows(spark):
    left = spark.createDataFrame([(1,), (1,), (2,), (3,), (None,)], "key long")
    right = spark.createDataFrame([(1, n) for n in range(50)] + [(2, 99)], "other long, n long")
    hot = {1: 13}
    joined = Spread.over(left, "key", {1: 4}, ["key"], nullable=True).left_join(
        right, "other", hot, ["n"]
    )
    rows = joined.result()
    assert rows.columns == ["key", "other", "n"]
    counts = {row["key"]: row["count"] for row in rows.groupBy("key").count().collect()}
    assert counts == {1: 100, 2: 1, 3: 1, None: 1}
    assert rows.where("key = 1").select("n").distinct().count() == 50
    assert rows.where("other is null").count() == 2


def test_joins_on_one_key_shuffle_the_left_side_once(spark, shuffled_joins):
    left = spark.range(1000).select(F.col("id").alias("key"))
    rights = [spark.range(1000).select(F.col("id").alias(name)) for name in ("a", "b")]
    spread = Spread.over(left, "key", {1: 3}, ["key"], nullable=True)
    joined = spread.left_join(rights[0], "a").left_join(rights[1], "b").result()
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 3


def test_a_hot_key_that_the_right_side_lacks(spark):
    """Counts decide how rows are dealt out, never whether they are in the result."""
    left = spark.createDataFrame([(5,), (6,), (6,)], "key long")
    right = spark.createDataFrame([(6, 1)], "other long, n long")
    for hot in ({5: 3}, {5: 3, 6: 2, 99: 4}):
        rows = Spread.over(left, "key", hot, ["key"]).left_join(right, "other", hot, ["n"]).result()
        assert bag(rows) == [(5, None, None), (6, 6, 1), (6, 6, 1)]


def test_more_hot_keys_than_a_thousand(spark):
    rows = spark.range(150_000).select((F.col("id") % 1500).alias("key"), "id")
    hot = find_hot_keys([Side(rows, {"side": "key"})], 50, tasks=10_000)["side"]
    assert len(hot) == 1500
    right = spark.range(1500).select(F.col("id").alias("other"))
    joined = Spread.over(rows, "key", hot, ["id"]).left_join(right, "other", {1: 2}, ["other"]).result()
    assert joined.count() == joined.where("key = other").count() == 150_000


def test_no_more_hot_keys_than_tasks(spark):
    """Keys that all have the same share are not hot, however large the table."""
    rows = spark.range(100_000).select((F.col("id") % 100).alias("key"))
    assert find_hot_keys([Side(rows, {"side": "key"})], 10, tasks=8)["side"] == {}


def test_keys_of_other_widths(spark):
    left = spark.createDataFrame([(1,), (2,), (None,)], "key long")
    right = spark.createDataFrame([(1,), (3,)], "other int")
    for nullable in (True, False):
        rows = Spread.over(left, "key", {}, ["key"], nullable).left_join(right, "other").result()
        assert bag(rows) == [(1, 1), (2, None), (None, None)]
    with pytest.raises(TypeError, match="cast"):
        Spread.over(left, "key", {}, ["key"]).left_join(right.select(F.col("other").cast("string")), "other")


def test_copies_are_numbered_by_all_tasks(spark):
    """Equal rows are cut anywhere, also where Spark joins small partitions."""
    df = spark.range(0, 400_000, 1, 8).select(F.lit(1).alias("a"), F.lit("x").alias("b"))
    small = ("advisoryPartitionSizeInBytes", "coalescePartitions.minPartitionSize")
    for name in small:
        spark.conf.set(f"spark.sql.adaptive.{name}", "64KB")
    try:
        numbered = with_position(df, [F.asc("a"), F.asc("b")])
    finally:
        for name in small:
            spark.conf.unset(f"spark.sql.adaptive.{name}")
    sizes = [spark.read.parquet(file).count() for file in set(numbered.inputFiles())]
    assert sum(sizes) == 400_000 and max(sizes) < 160_000
    row = numbered.agg(F.min("idx"), F.max("idx"), F.count_distinct("idx")).first()
    assert tuple(row) == (0, 399_999, 400_000)


def test_positions(spark):
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id") % 100).alias("a"),
        F.when(F.col("id") % 7 > 0, F.col("id") % 11).alias("b"),
    )
    numbered = with_position(df, [F.desc_nulls_last("a"), F.asc_nulls_first("b")])
    rows = sorted((r["idx"], r["a"], r["b"]) for r in numbered.collect())
    expected = sorted(
        ((r["a"], r["b"]) for r in df.collect()), key=lambda r: (-r[0], r[1] is not None, r[1] or 0)
    )
    assert rows == [(i, *row) for i, row in enumerate(expected)]


def test_positions_of_nothing(spark):
    assert with_position(spark.range(0), [F.col("id")]).collect() == []


def test_positions_of_copies_and_of_rows_of_one_key(spark):
    """A third of the rows are copies of one, another third share all but the last column."""
    df = spark.range(9000).select(
        F.when(F.col("id") % 3 < 2, F.lit(5)).otherwise(F.col("id") % 10).alias("a"),
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id")).alias("b"),
    )
    numbered = with_position(df, [F.desc("a"), F.asc("b")])
    rows = sorted((r["idx"], r["a"], r["b"]) for r in numbered.collect())
    expected = sorted(((r["a"], r["b"]) for r in df.collect()), key=lambda r: (-r[0], r[1]))
    assert rows == [(i, *row) for i, row in enumerate(expected)]
