"""Rows that two tables do not share, against Python's multisets."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from typeferry.operators import diff
from typeferry.operators.diff import diff_rows

SCHEMA = "k int, v string, x double"


def expected(source, target, keyed=True):
    s, t = Counter(source), Counter(target)
    sides = [("source", s - t, "missing"), ("target", t - s, "extra")]
    keys = [{r[0] for r in side if r[0] is not None} for _, side, _ in sides]
    both = keys[0] & keys[1] if keyed else set()
    return sorted(
        ((*r, side, n, "changed" if r[0] in both else kind) for side, c, kind in sides for r, n in c.items()),
        key=str,
    )


def found(df):
    columns = ["k", "v", "x", "side", "copies", "kind"]
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def made(seed, n=600):
    rng = np.random.default_rng(seed)
    rows = [(int(k) if k % 7 else None, f"v{v}", float(x)) for k, v, x in
            zip(rng.integers(0, 200, n), rng.integers(0, 3, n), rng.integers(0, 2, n))]
    other = [r for r in rows if rng.random() > 0.03]
    other += [(r[0], r[1], r[2] + 5) for r in rows if rng.random() < 0.02]
    other += [r for r in rows if rng.random() < 0.02]
    return rows, other


@pytest.mark.parametrize("bits, levels, at_once", [(12, 4, 1000), (2, 6, 10), (1, 3, 0), (12, 1, 0)])
def test_random_rows(spark, bits, levels, at_once):
    for seed in range(2):
        rows, other = made(seed)
        source, target = (spark.createDataFrame(r, SCHEMA).repartition(3) for r in (rows, other))
        got = diff_rows(source, target.select("x", "v", "k"), ["K"], bits, levels, at_once)
        assert found(got) == expected(rows, other)


def test_no_keys_and_no_difference(spark):
    rows, other = made(5)
    source, target = (spark.createDataFrame(r, SCHEMA) for r in (rows, other))
    assert found(diff_rows(source, target)) == expected(rows, other, keyed=False)
    assert diff_rows(source, source.orderBy("v"), ["k"]).count() == 0
    empty = source.limit(0)
    assert found(diff_rows(empty, source, ["k"])) == expected([], rows)
    assert found(diff_rows(source, empty, ["k"])) == expected(rows, [])
    assert diff_rows(empty, empty, ["k"]).count() == 0


def test_equal_buckets_are_done_with(spark):
    """One changed row: the rows compared at the end are those of its bucket."""
    source = spark.range(100_000).select("id", (F.col("id") % 7).alias("v"))
    target = source.withColumn("v", F.when(F.col("id") == 77, 9).otherwise(F.col("v")))
    sides = [diff._side(df, ["id", "v"], ["id"], s) for df, s in ((source, 1), (target, -1))]
    left = diff.differing_buckets(sides[0].unionAll(sides[1]), 1).collect()
    assert len(left) == 1 and left[0].n_rows < 200
    got = diff_rows(source, target, ["id"], rows_at_once=10).collect()
    assert sorted((r.id, r.v, r.side, r.copies, r.kind) for r in got) == [
        (77, 0, "source", 1, "changed"), (77, 9, "target", 1, "changed")
    ]


def test_one_key_and_nulls_with_a_third_each(spark):
    """Their rows are summed where they are; null keys do not meet in one bucket."""
    k = F.when(F.col("id") % 3 == 0, 1).when(F.col("id") % 3 == 1, F.col("id") + 10).cast("int")
    source = spark.range(9000).select(k.alias("k"), F.col("id").alias("v"))
    target = source.filter("v <> 5 and v <> 6")
    side = diff._side(source, ["k", "v"], ["k"], 1)
    nulls = side.filter("k is null").select(diff._bucket(1, 12).alias("at")).distinct().count()
    assert nulls > 1000
    got = diff_rows(source, target, ["k"], rows_at_once=100).collect()
    assert sorted((str(r.k), r.v, r.side, r.copies, r.kind) for r in got) == [
        ("1", 6, "source", 1, "missing"), ("None", 5, "source", 1, "missing")
    ]


def test_values_that_are_equal(spark):
    """NaN, zeros of either sign, maps in any order, arrays and structs."""
    rows = "select 1 as k, {x} as x, {m} as m, array(1, null) as a, named_struct('p', 2) as s"
    one = spark.sql(rows.format(x="double('nan')", m="map('a', 1, 'b', 2)")).unionAll(
        spark.sql(rows.format(x="0.0d", m="map()").replace("map()", "cast(map() as map<string,int>)"))
    )
    two = spark.sql(rows.format(x="-0.0d", m="cast(map() as map<string,int>)")).unionAll(
        spark.sql(rows.format(x="double('nan')", m="map('b', 2, 'a', 1)"))
    )
    assert diff_rows(one, two, ["k"]).count() == 0
    assert diff_rows(one, two.limit(1), ["k"]).count() == 1


def test_refusals(spark):
    a = spark.createDataFrame([(1, "x")], "k int, v string")
    with pytest.raises(ValueError, match="differ in columns"):
        diff_rows(a, a.select("k"), ["k"])
    with pytest.raises(ValueError, match="types of .'k'"):
        diff_rows(a, a.withColumn("k", F.col("k").cast("long")), ["k"])
    with pytest.raises(ValueError, match="no columns"):
        diff_rows(a, a, ["z"])


def test_many_differences_are_compared_at_once(spark, monkeypatch):
    """Where nearly all buckets differ, dividing them again would exchange more than the rows."""
    source = spark.range(5_000).select("id", (F.col("id") % 7).alias("v"))
    target = source.withColumn("v", F.when(F.col("id") % 2 == 0, 9).otherwise(F.col("v")))
    levels, real = [], diff._descend
    monkeypatch.setattr(diff, "_descend", lambda *a: levels.append(a[3]) or real(*a))
    monkeypatch.setattr(diff, "BROADCAST", 1_000)
    got = diff_rows(source, target, ["id"], bits=4, rows_at_once=10)
    assert got.count() == 2 * 2_500 and levels == [1, 2]
    assert got.where("kind = 'changed'").count() == 5_000
