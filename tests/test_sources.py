"""Reading tables from Parquet and the options for reading them over JDBC."""

import random

import duckdb
import pytest
from pyspark.sql import functions as F

from billwright import InvoiceTables
from billwright.plans import report
from billwright.plans.view import invoice_view, register_invoice_view
from billwright.schemas import BASE_TABLES
from billwright.sources.jdbc import Depths, JdbcDatabase, Single, Split, depths_query
from conftest import bag

DB = JdbcDatabase("host:1433", "invoices", "reader", "secret")


def test_landed_tables(spark, tables, tmp_path):
    back = tables.land(spark, str(tmp_path))
    for name, schema in BASE_TABLES.items():
        assert back[name].dtypes == [(f.name, f.dataType.simpleString()) for f in schema]
    assert bag(back["tos"]) == bag(tables["tos"])
    assert invoice_view(back).count() == 20


def test_landed_rows_lie_in_order(spark, tables, tmp_path):
    back = tables.land(spark, str(tmp_path))
    numbers = [row["numero_nf"] for row in back["tnota_fiscal_item"].collect()]
    assert numbers == sorted(numbers)
    days = [row["dt_emissao"] for row in back["tnota_fiscal"].collect()]
    assert days == sorted(days)


def test_database_tables_are_read_as_asked(spark, tables, monkeypatch):
    asked = []

    def read(self, session, source, split=None):
        asked.append((source, split))
        return tables[source]

    monkeypatch.setattr(JdbcDatabase, "read", read)
    split = Split("numero", 1, 1000, 16)
    loaded = InvoiceTables.from_database(spark, DB, {"tnota_fiscal": split, "tos": Single()})
    assert loaded["tnota_fiscal"].count() == 20 and loaded["tos"].count() == 7
    assert [(name, kind if kind is split else type(kind)) for name, kind in asked] == [
        ("tnota_fiscal", split), ("tos", Single)
    ]
    with pytest.raises(KeyError):
        loaded["torcamento"]
    for wanted in (report.report_inputs, lambda tables: register_invoice_view(tables, "live")):
        with pytest.raises(ValueError, match="land"):
            wanted(loaded)


def test_flags_and_codes_of_other_types(spark, tables):
    header = tables["tnota_fiscal"]
    other = header.withColumns(
        {"nfse": F.col("nfse") == 1, "cancelada": F.col("cancelada") == 1,
         "cfop": F.col("cfop").cast("int")}
    ).withColumn("extra", F.lit(0))
    loaded = InvoiceTables(lambda name: other)
    assert loaded["tnota_fiscal"].schema.names == header.schema.names
    assert sorted(map(str, loaded["tnota_fiscal"].collect())) == sorted(map(str, header.collect()))


def test_missing_column_fails(spark, tables):
    loaded = InvoiceTables(lambda name: tables[name].drop("n_os"))
    with pytest.raises(Exception, match="n_os"):
        loaded["tos"]


def test_unknown_table_fails(tables):
    with pytest.raises(KeyError):
        tables["other"]


def test_table_options():
    options = DB.options("tnota_fiscal", Single())
    assert options["url"] == "jdbc:sqlserver://host:1433;databaseName=invoices"
    assert options["dbtable"] == "tnota_fiscal"
    assert (options["user"], options["password"]) == ("reader", "secret")
    assert "partitionColumn" not in options


def test_query_options_with_split():
    options = DB.options(" select * from invoices", Split("numero", 1, 1000, 16))
    assert options["dbtable"] == "( select * from invoices) as source_query"
    assert [options[o] for o in ("partitionColumn", "lowerBound", "upperBound", "numPartitions")] == [
        "numero", "1", "1000", "16",
    ]
    assert "query" not in options


def _depths(rows, parts, within=None):
    """A split of (numero, linha) rows, from the bounds that another engine finds for it."""
    duck = duckdb.connect()
    kind = "varchar" if any(isinstance(value, str) for value, _ in rows) else "bigint"
    duck.execute(f"create table lines (numero {kind}, linha bigint)")
    if rows:
        duck.executemany("insert into lines values (?, ?)", rows)
    bounds = sorted(duck.execute(depths_query("lines", "numero", parts)).fetchall())
    split = Depths("numero", tuple(value for _, value in bounds), within)
    counts = [duck.execute(f"select count(*) from lines where {p}").fetchone()[0] for p in split.predicates()]
    once = duck.execute("select count(*) from lines where " + " + ".join(
        f"(case when {p} then 1 else 0 end)" for p in split.predicates()) + " = 1").fetchone()[0]
    assert once == len(rows) == sum(counts)
    return counts


def test_reads_of_equal_depth():
    """Numbers with gaps and a number that holds a third of all rows."""
    rng = random.Random(3)
    rows = [(rng.choice([rng.randrange(100), 10**9 + rng.randrange(100)]), n) for n in range(4000)]
    counts = _depths(rows, 20)
    assert len(counts) == 20 and max(counts) < 2 * 4000 / 20
    hot = [(7, n) for n in range(2000)] + [(None, n) for n in range(30)]
    assert max(_depths(rows + hot, 20)) >= 2000
    counts = _depths(rows + hot, 20, within="linha")
    assert max(counts) < 2.5 * 6000 / 20 and len(counts) >= 20


@pytest.mark.parametrize("seed", range(6))
def test_every_row_is_read_once(seed):
    rng = random.Random(seed)
    pick = lambda: rng.choice([None, rng.randrange(-5, 6), 3, rng.randrange(1000)])
    rows = [(pick(), rng.choice([None, -rng.randrange(9), rng.randrange(9)])) for _ in range(rng.randrange(1, 200))]
    _depths(rows, rng.randrange(1, 12), rng.choice([None, "linha"]))


def test_reads_of_text_keys_and_of_nothing():
    assert len(_depths([(f"G{n % 50}'s", n) for n in range(500)], 5)) >= 5
    assert Depths("numero", ()).predicates() == ["1 = 1"] and _depths([], 4) == [0]


def test_depths_come_from_the_database(spark, monkeypatch):
    """The quantiles are asked for in one statement, and each predicate is a read of its own."""
    asked = {}

    class Reader:
        def format(self, kind):
            return self

        def options(self, **options):
            asked.setdefault("options", []).append(options)
            return self

        def load(self):
            return spark.createDataFrame([(3, 20), (2, 10)], "tile int, value long")

        def jdbc(self, url, table, **more):
            asked["read"] = (url, table, more)
            return "rows"

    class Session:
        read = Reader()

    split = DB.depths(Session(), "tnota_fiscal_item", "numero_nf", 3, within="codigo")
    assert split == Depths("numero_nf", (10, 20), "codigo")
    assert asked["options"][0]["dbtable"].startswith("(select tile, min(numero_nf)")
    assert DB.read(Session(), "tnota_fiscal_item", split) == "rows"
    url, table, more = asked["read"]
    assert (url, table) == (DB.url, "tnota_fiscal_item")
    assert more["predicates"] == [
        "numero_nf < 10 or numero_nf is null", "numero_nf >= 10 and numero_nf < 20", "numero_nf >= 20"
    ]
    assert more["properties"] == {"user": "reader", "password": "secret", "driver": DB.driver}
