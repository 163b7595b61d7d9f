"""Rows along a curve, and files left out by the zone map."""

import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from typeferry import in_zones, merge_table, write_clustered, write_table, write_zones
from typeferry.operators.cluster import clustered, curve, step_of, zones_of

N = 40_000


def opened(df):
    """Files that the scan of a frame opens, and its rows."""
    plan = df._jdf.queryExecution().executedPlan()
    rows = df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    leaves = plan.collectLeaves()
    return leaves.head().metrics().apply("numFiles").value(), rows


def made(spark):
    """Two columns that have nothing to do with each other, one of them skewed."""
    i = F.col("id")
    return spark.range(N).select(
        "id", F.pmod(F.xxhash64(i), F.lit(1000)).cast("int").alias("a"),
        F.floor(F.pow(F.pmod(F.xxhash64(i, F.lit(1)), F.lit(1000)) / 100, 4)).cast("long").alias("b"),
    )


def test_two_column_range_opens_few_files(spark, fresh):
    t = fresh()
    df = made(spark)
    write_clustered(df, t, ["a", "b"], 64)
    table = spark.table(t)
    assert spark.table(zones_of(t)).count() == 64
    low, high = 400, 460
    b_low, b_high = [r[0] for r in df.selectExpr("percentile_approx(b, array(0.3, 0.36)) as p").select(F.explode("p")).collect()]
    wanted = F.col("a").between(low, high) & F.col("b").between(b_low, b_high)
    files, rows = opened(table.filter(in_zones(spark, t, {"a": (low, high), "b": (b_low, b_high)}) & wanted))
    assert sorted(r.id for r in rows) == sorted(r.id for r in df.filter(wanted).collect())
    assert 1 <= files <= 8
    for one in ({"a": (low, high)}, {"b": (b_low, b_high)}):
        column, (x, y) = next(iter(one.items()))
        files, rows = opened(table.filter(in_zones(spark, t, one) & F.col(column).between(x, y)))
        assert files <= 24 and len(rows) == df.filter(F.col(column).between(x, y)).count()


def test_files_of_other_writes_are_always_read(spark, fresh):
    t = fresh()
    write_clustered(made(spark), t, ["a", "b"], 16)
    write_table(spark.createDataFrame([(-1, 5, 7)], "id long, a int, b long"), t, "append")
    where = in_zones(spark, t, {"a": (5, 5)}) & (F.col("a") == 5)
    assert -1 in {r.id for r in spark.table(t).filter(where).collect()}
    merge_table(spark.createDataFrame([(-2, 5, 7)], "id long, a int, b long"), t, ["id"])
    assert {-1, -2} <= {r.id for r in spark.table(t).filter(where).collect()}
    write_zones(spark, t, ["a"])
    where = in_zones(spark, t, {"a": (5, 5), "b": (0, 0)}) & (F.col("a") == 5)
    assert {-1, -2} <= {r.id for r in spark.table(t).filter(where).collect()}


VALUES = {
    "int": ("int", list(range(100))),
    "string": ("string", [f"{'ab' * (i % 3)}{i:03d}é" for i in range(100)]),
    "date": ("date", [datetime.date(1969, 12, 1) + datetime.timedelta(i) for i in range(100)]),
    "double": ("double", [float("nan"), float("inf"), -float("inf"), *np.linspace(-5, 5, 97).tolist()]),
    "boolean": ("boolean", [True, False]),
}


@pytest.mark.parametrize("kind", VALUES)
def test_any_type_with_nulls_and_one_heavy_value(spark, fresh, kind):
    type_, values = VALUES[kind]
    rng = np.random.default_rng(2)
    some = [values[i] for i in rng.integers(0, len(values), 900)]
    rows = [(i, v if i % 3 else values[0]) for i, v in enumerate(some)] + [(i, None) for i in range(900, 1000)]
    df = spark.createDataFrame(rows, f"id int, `odd ``name` {type_}")
    t = fresh()
    write_clustered(df, t, ["odd `name", "id"], 8)
    assert sorted(r.id for r in spark.table(t).collect()) == list(range(1000))
    value = sorted(v for v in values if v == v)[len(values) // 2]
    same = F.col("`odd ``name`") == F.lit(value)
    where = in_zones(spark, t, {"odd `name": (value, value)}) & same
    assert spark.table(t).filter(where).count() == df.filter(same).count()


def test_steps_are_even_and_the_curve_interleaves(spark):
    df = spark.range(8000).select(F.floor(F.exp(F.col("id") / 900)).cast("long").alias("v"))
    sizes = df.groupBy(step_of(df, "v", 3).alias("s")).count().collect()
    assert len(sizes) >= 7 and max(r["count"] for r in sizes) < 2400
    row = spark.range(1).select(curve([F.lit(0b101), F.lit(0b011)], 3).alias("c")).first()
    assert row.c == 0b100111


def test_a_heavy_cell_is_divided(spark):
    """A third of the rows are equal in the columns; they are not one task's."""
    df = spark.range(9000).select("id", F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("a"))
    sizes = clustered(df, ["a"], 12).groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in sizes) < 2000 and len(sizes) == 12


def test_refusals_and_no_rows(spark, fresh):
    df = spark.range(3)
    for columns, files in (([], 4), (["id"], 0)):
        with pytest.raises(ValueError, match="clustering needs"):
            write_clustered(df, fresh(), columns, files)
    t = fresh()
    write_clustered(df.limit(0), t, ["id"], 4)
    assert spark.table(t).filter(in_zones(spark, t, {"id": (1, 2)})).count() == 0
