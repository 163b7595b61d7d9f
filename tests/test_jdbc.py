"""The JDBC source without a database: its settings, its statements, its calls of Spark.

The statements run in DuckDB, which knows the same catalog views. Reading from a real
PostgreSQL is not tested here.
"""

import re
from types import SimpleNamespace

import duckdb
import pytest
from pyspark.sql import types as T

from typeferry import (
    ByBlocks,
    ByPredicates,
    ByRange,
    JdbcSource,
    MappedColumn,
    SingleTask,
    map_types,
    mapped_columns,
)
from typeferry.operators.mapping import DESCRIPTOR
from typeferry.sources.jdbc import block_predicates, leaf_predicates, qualified, range_options


class Recorder:
    """Stands in for ``spark.read``: keeps the calls, answers with given first rows."""

    def __init__(self, answers=()):
        self.calls, self.set, self.answers = [], {}, list(answers)

    def format(self, name):
        self.set = {"format": name}
        return self

    def options(self, **options):
        self.set.update(options)
        return self

    def option(self, name, value):
        self.set[name] = value
        return self

    def load(self):
        self.calls.append(self.set)
        row = self.answers.pop(0) if self.answers and "query" in self.set else None
        return SimpleNamespace(first=lambda: row, collect=lambda: row)

    def jdbc(self, url, table, predicates, properties):
        call = {"url": url, "dbtable": table, "predicates": predicates, **properties}
        self.calls.append(call)
        return SimpleNamespace(coalesce=lambda n: call.update(coalesced=n))


def recorded(*answers):
    return SimpleNamespace(read=Recorder(answers))


SOURCE = JdbcSource("db.example", 5433, "shop", "reader", "secret")


@pytest.fixture(scope="module")
def shop():
    duck = duckdb.connect()
    duck.execute("CREATE SCHEMA public")
    duck.execute(
        """CREATE TABLE public."o'dd ""name" (id INTEGER NOT NULL, price DECIMAL(10,2), note TEXT)"""
    )
    duck.execute("CREATE TABLE public.orders (k BIGINT, v VARCHAR)")
    duck.execute("CREATE SCHEMA other")
    duck.execute("CREATE TABLE other.orders (x DATE)")
    duck.execute("INSERT INTO public.orders VALUES (3, 'a'), (-4, 'b'), (NULL, 'c')")
    return duck


def test_settings():
    assert SOURCE.url == "jdbc:postgresql://db.example:5433/shop?sslmode=require"
    options = SOURCE.reader_options()
    assert (options["user"], options["password"]) == ("reader", "secret")
    assert options["driver"] == "org.postgresql.Driver"
    assert options["fetchsize"] == "10000"
    assert "secret" not in repr(SOURCE)
    own = JdbcSource(options={"fetchsize": "5", "queryTimeout": "60"}).reader_options()
    assert (own["fetchsize"], own["queryTimeout"]) == ("5", "60")
    assert JdbcSource().url == "jdbc:postgresql://localhost:5432/source_db?sslmode=require"


def test_quoting():
    assert qualified("public", "orders") == '"public"."orders"'
    assert qualified('a"b', "T x") == '"a""b"."T x"'


def run(duck, sql):
    result = duck.execute(sql)
    names = [d[0] for d in result.description]
    return [dict(zip(names, row)) for row in result.fetchall()]


def available(sql):
    """DuckDB has no udt_name; everything else runs as it stands."""
    return sql.replace("c.udt_name", "NULL AS udt_name")


def test_columns_statement(shop):
    rows = run(shop, available(SOURCE.columns_sql("public", "o'dd \"name")))
    rows.sort(key=lambda r: r["ordinal_position"])
    assert [r["column_name"] for r in rows] == ["id", "price", "note"]
    assert [r["is_nullable"] for r in rows] == ["NO", "YES", "YES"]
    assert (rows[1]["numeric_precision"], rows[1]["numeric_scale"]) == (10, 2)
    assert set(rows[0]) == set(DESCRIPTOR.names)

    def tables(*args):
        found = run(shop, available(SOURCE.columns_sql(*args)))
        return sorted({(r["table_schema"], r["table_name"]) for r in found}), len(found)

    odd = ("public", "o'dd \"name")
    assert tables() == ([("other", "orders"), odd, ("public", "orders")], 6)
    assert tables("public") == ([odd, ("public", "orders")], 5)
    assert tables(None, "orders") == ([("other", "orders"), ("public", "orders")], 3)
    assert tables("public", "x' OR '1'='1") == ([], 0)


def test_count_and_bounds_statements(shop):
    assert run(shop, SOURCE.count_sql("public", "orders")) == [{"n_rows": 3}]
    assert run(shop, SOURCE.bounds_sql("public", "orders", "k")) == [{"lo": -4, "hi": 3}]
    assert run(shop, SOURCE.count_sql("public", "o'dd \"name")) == [{"n_rows": 0}]
    statement = SOURCE.blocks_sql("public", "o'dd")
    assert """r.oid = '"public"."o''dd"'::regclass""" in statement


def test_catalog_rows_become_a_schema(spark, shop):
    rows = run(shop, available(SOURCE.columns_sql("public", "o'dd \"name")))
    frame = spark.createDataFrame(
        [tuple(r[n] for n in DESCRIPTOR.names) for r in rows], DESCRIPTOR
    )
    columns = mapped_columns(map_types(frame), "o'dd \"name")
    # DuckDB spells decimal(10,2) in the type, PostgreSQL does not.
    assert [c.spark_type for c in columns] == ["int", "string", "string"]
    assert [c.nullable for c in columns] == [False, True, True]


def test_discovery_calls():
    spark = recorded()
    SOURCE.columns(spark, "public", "orders")
    SOURCE.count(spark, "public", "orders")
    first, second = spark.read.calls
    assert first["format"] == "jdbc" and first["url"] == SOURCE.url
    assert first["query"] == SOURCE.columns_sql("public", "orders")
    assert second["query"] == 'SELECT count(*) AS n_rows FROM "public"."orders"'
    assert not {"dbtable", "partitionColumn"} & set(first)


COLUMNS = [
    MappedColumn("id", "integer", "integer", "int", False, "ok"),
    MappedColumn("at", "time", "time", "string", True, "ok"),
    MappedColumn("a`b", "numeric", "numeric", "string", True, "invalid_decimal"),
    MappedColumn("tags", "ARRAY", "text", "array<string>", True, "ok"),
    MappedColumn("cost", "money", "money", "double", True, "ok"),
]


def test_columns_fetched_as_text():
    ddl = SOURCE.text_schema(COLUMNS)
    assert T.StructType.fromDDL(ddl) == T.StructType(
        [T.StructField("at", T.StringType()), T.StructField("a`b", T.StringType())]
    )
    assert SOURCE.text_schema(COLUMNS[:1]) == ""


def test_single_task_read():
    spark = recorded()
    SOURCE.read(spark, "public", "orders", COLUMNS, SingleTask())
    (call,) = spark.read.calls
    assert call["dbtable"] == '"public"."orders"'
    assert call["customSchema"] == SOURCE.text_schema(COLUMNS)
    SOURCE.read(spark, "public", "orders", partitioning=SingleTask())
    assert "customSchema" not in spark.read.calls[1]


def storage(kind, *leaves):
    return [{"kind": kind, "oid": o, "blocks": b, "block_size": 8192} for o, b in leaves]


def test_read_by_default():
    """By blocks: one task for 256 MB, that is 32,768 blocks of 8 kB."""
    spark = recorded(storage("r", (7, 100_000)))
    SOURCE.read(spark, "public", "orders", COLUMNS)
    lookup, call = spark.read.calls
    assert lookup["query"] == SOURCE.blocks_sql("public", "orders")
    assert call["predicates"] == block_predicates(100_000, 4)
    assert call["customSchema"] == SOURCE.text_schema(COLUMNS)
    spark = recorded(storage("r", (7, 0)))
    SOURCE.read(spark, "public", "orders")
    assert spark.read.calls[1]["predicates"] == ["ctid >= '(0,0)'::tid"]


def test_read_of_a_partitioned_table():
    spark = recorded(storage("p", (7, 70_000), (8, 0), (9, 10)))
    SOURCE.read(spark, "public", "orders")
    found = spark.read.calls[1]["predicates"]
    assert len(found) == 5 and len(set(found)) == 5
    spark = recorded(storage("p", (7, 60), (8, 40)))
    SOURCE.read(spark, "public", "orders", partitioning=ByBlocks(10))
    assert len(spark.read.calls[1]["predicates"]) == 10
    spark = recorded(storage("p", (None, None)))
    SOURCE.read(spark, "public", "orders")
    assert spark.read.calls[1]["predicates"] == ["false"]


@pytest.mark.parametrize("kind", ["v", "f"])
def test_relations_without_blocks(kind):
    for by in (None, ByBlocks(4)):
        with pytest.raises(ValueError, match="ByRange, ByPredicates or SingleTask"):
            SOURCE.read(recorded(storage(kind, (7, 0))), "public", "orders", partitioning=by)


def test_connections_are_bounded_apart_from_partitions():
    source = JdbcSource(max_connections=3)
    spark = recorded(storage("r", (7, 100)))
    source.read(spark, "public", "orders", partitioning=ByBlocks(10))
    call = spark.read.calls[1]
    assert len(call["predicates"]) == 10 and call["coalesced"] == 3
    spark = recorded(storage("r", (7, 100)))
    source.read(spark, "public", "orders", partitioning=ByBlocks(2))
    assert "coalesced" not in spark.read.calls[1]


@pytest.mark.parametrize("leaves, each", [([(7, 10), (8, 0), (9, 25)], 4), ([(5, 1)], 100)])
def test_leaves_are_covered_once(leaves, each):
    conditions = leaf_predicates(leaves, each)

    def holds(condition, oid, block):
        own = re.match(r"tableoid = (\d+) AND (.*)", condition)
        bounds = re.findall(r"ctid (>=|<) '\((\d+),0\)'::tid", own[2])
        inside = all(block >= int(n) if op == ">=" else block < int(n) for op, n in bounds)
        return int(own[1]) == oid and inside

    for oid, blocks in leaves:
        for block in range(blocks + 5):  # five blocks appended meanwhile
            assert sum(holds(c, oid, block) for c in conditions) == 1


def test_range_read():
    spark = recorded()
    SOURCE.read(spark, "public", "orders", COLUMNS, ByRange("id", 8, 1, 1000))
    (call,) = spark.read.calls
    assert [call[o] for o in ("partitionColumn", "lowerBound", "upperBound", "numPartitions")] == [
        "id", "1", "1000", "8",
    ]
    # Bounds looked up at the source.
    spark = recorded((-4, 3))
    SOURCE.read(spark, "public", "orders", COLUMNS, ByRange("id", 2))
    lookup, call = spark.read.calls
    assert lookup["query"] == SOURCE.bounds_sql("public", "orders", "id")
    assert (call["lowerBound"], call["upperBound"]) == ("-4", "3")
    spark = recorded((-4, 3))
    SOURCE.read(spark, "public", "orders", COLUMNS, ByRange("id", 2, lower=0))
    assert (spark.read.calls[1]["lowerBound"], spark.read.calls[1]["upperBound"]) == ("0", "3")
    # An empty table has no bounds, and needs no partitions.
    assert range_options("id", 8, None, None) == {}


def test_predicate_read():
    spark = recorded()
    SOURCE.read(spark, "public", "orders", COLUMNS, ByPredicates(["a < 1", "a >= 1 OR a IS NULL"]))
    (call,) = spark.read.calls
    assert call["url"] == SOURCE.url and call["dbtable"] == '"public"."orders"'
    assert call["predicates"] == ["a < 1", "a >= 1 OR a IS NULL"]
    assert call["customSchema"] == SOURCE.text_schema(COLUMNS)


def test_block_read():
    spark = recorded(storage("r", (7, 10)))
    SOURCE.read(spark, "public", "orders", COLUMNS, ByBlocks(4))
    lookup, call = spark.read.calls
    assert lookup["query"] == SOURCE.blocks_sql("public", "orders")
    assert len(call["predicates"]) == 4


@pytest.mark.parametrize("blocks, partitions", [(0, 8), (1, 8), (7, 3), (100, 100), (1001, 10)])
def test_blocks_are_covered_once(blocks, partitions):
    conditions = block_predicates(blocks, partitions)
    assert len(conditions) == max(1, min(blocks, partitions))

    def holds(condition, block):
        bounds = re.findall(r"ctid (>=|<) '\((\d+),0\)'::tid", condition)
        return all(block >= int(n) if op == ">=" else block < int(n) for op, n in bounds)

    # Ten blocks more than were counted: appended while the read runs.
    sizes = [0] * len(conditions)
    for block in range(blocks + 10):
        reading = [i for i, c in enumerate(conditions) if holds(c, block)]
        assert len(reading) == 1
        sizes[reading[0]] += block < blocks
    assert max(sizes) - min(sizes) <= 1


def test_spark_takes_the_text_schema(spark):
    """Spark's own merge of the setting with the types it found, called without a database."""
    found = T.StructType.fromDDL(
        "id INT, at TIMESTAMP, `a``b` DECIMAL(38,0), tags ARRAY<STRING>, cost STRING"
    )
    jvm = spark._jvm.org.apache.spark.sql
    merged = jvm.execution.datasources.jdbc.JdbcUtils.getCustomSchema(
        jvm.types.DataType.fromJson(found.json()),
        SOURCE.text_schema(COLUMNS),
        spark._jsparkSession.sessionState().conf().resolver(),
    )
    assert merged.simpleString() == "struct<id:int,at:string,a`b:string,tags:array<string>,cost:string>"
