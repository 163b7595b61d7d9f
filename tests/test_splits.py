"""Equi-depth splits: every row in one, none over twice the mean, heavy values and nulls apart."""

import datetime
import decimal
import math
import re
from collections import Counter
from types import SimpleNamespace

import duckdb
import pytest
from pyspark.sql import functions as F

from typeferry import ByDepth, JdbcSource, equi_depth, split_of, spread
from typeferry.operators import splits as splitting
from typeferry.operators.splits import Split, conditions

N = 20_000
CASES = {
    "even": "id",
    "a third under one value": "if(id % 3 = 0, 7, id)",
    "a third without": "if(id % 3 <> 0, id, null)",
    "most without": "if(id % 10 = 0, id, null)",
    "two heavy neighbours": "case id % 3 when 0 then 7 when 1 then 8 else id end",
    "one value": "5L",
    "few values": "id % 5",
    "skewed": "cast(floor(exp(id / 2000)) as bigint)",
    "beyond doubles": "id + 4611686018427387904",
    "heavy last": f"greatest(id, {N // 2}) - {N}",
    "dates": "date_add(date'1969-01-01', cast(id % 900 as int))",
    "instants": "timestamp_micros(id * 1000003 - 10000000000)",
    "local times": "cast(timestamp_micros(id * 1000003 - 10000000000) as timestamp_ntz)",
    "decimals": "cast(id / 7 as decimal(12,3))",
    "doubles": "case id % 4 when 0 then double('nan') when 1 then double('-inf') else id / 3 end",
    "mostly nan": "if(id % 9 <> 0, double('nan'), id / 3)",
    "all nan": "double('nan')",
    "only nulls": "cast(null as int)",
}


@pytest.mark.parametrize("case", CASES)
def test_every_row_in_one_split_of_even_size(spark, case):
    df = spark.range(N).select("id", F.expr(CASES[case]).alias("c"))
    found = equi_depth(df, "c", 12)
    sizes = df.groupBy(split_of(df, "c", found).alias("split")).count().collect()
    assert all(r.split is not None and 0 <= r.split < len(found) for r in sizes)
    assert sum(r["count"] for r in sizes) == N
    assert max(r["count"] for r in sizes) <= 2 * N / len(sizes) * 1.05
    assert 10 <= len(sizes) <= 24 or case == "few values"


def test_no_rows(spark):
    df = spark.range(0).select(F.col("id").alias("c"))
    found = equi_depth(df, "c", 4)
    assert df.select(split_of(df, "c", found)).count() == 0
    assert [s.kind for s in found] == ["range", "null"]


def test_refusals(spark):
    with pytest.raises(ValueError, match="type string"):
        equi_depth(spark.range(1).select(F.col("id").cast("string").alias("c")), "c", 2)
    with pytest.raises(ValueError, match="1 to"):
        equi_depth(spark.range(1), "id", 0)


def test_rows_are_dealt_evenly(spark):
    df = spark.range(N).select("id", F.expr("if(id % 3 = 0, 7, id)").alias("odd name`s"))
    dealt = spread(df, "odd name`s", 10)
    assert dealt.count() == N
    sizes = dealt.groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in sizes) < N / 2


def test_sketches_are_merged_and_not_values(spark):
    """Partial sketches before the only exchange: its rows are sketches."""
    df = spark.range(0, N, 1, 16).select(F.col("id").alias("c"))
    rows = df.agg(F.kll_sketch_agg_bigint("c", splitting.SKETCH).alias("s"))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("partial_kll") == 1 and plan.count("Exchange") == 1


@pytest.mark.parametrize("case", ["even", "a third under one value", "a third without", "one value",
                                  "dates", "local times", "decimals", "doubles"])
def test_conditions_hold_each_row_once(spark, case):
    """The conditions for a database, in DuckDB; a block there is a run of row numbers."""
    df = spark.range(N).select("id", F.expr(CASES[case]).alias("c"))
    found = equi_depth(df, "c", 9)

    def blocks(parts):
        bounds = [N * i // parts for i in range(parts)] + [N]
        return [f"id >= {a} AND id < {b}" for a, b in zip(bounds, bounds[1:])]

    texts = conditions('"c"', found, blocks)
    con = duckdb.connect()
    given = df.toArrow()  # noqa: F841
    con.execute("create table t as select * from given")
    counts = [con.execute(f"select count(*) from t where {t}").fetchone()[0] for t in texts]
    once = " + ".join(f"coalesce(({t})::int, 0)" for t in texts)
    assert con.execute(f"select min({once}), max({once}) from t").fetchone() == (1, 1)
    assert sum(counts) == N and max(counts) <= 2.1 * N / 9


def test_literals():
    found = conditions('"c"', [
        Split("range", None, datetime.date(2024, 2, 1), (datetime.date(2024, 1, 1),)),
        Split("range", decimal.Decimal("1.50")), Split("range"), Split("null"),
        Split("value", datetime.datetime(2024, 1, 2, 3, 4, 5, 6, datetime.timezone.utc)),
        Split("value", math.nan),
    ], None)
    assert found == [
        "\"c\" < date '2024-02-01' AND \"c\" NOT IN (date '2024-01-01')",
        '"c" >= 1.50', '"c" IS NOT NULL', '"c" IS NULL',
        "\"c\" = timestamptz '2024-01-02 03:04:05.000006+00:00'", "\"c\" = 'NaN'::float8",
    ]


def test_jdbc_read_by_depth(spark, monkeypatch):
    """The column is read by blocks, the table by conditions on it; heavy values by blocks too."""
    values = spark.range(3000).select(F.expr("case when id % 2 = 0 then 7 when id % 3 = 0 then null else id end").alias("odd`c"))
    calls = []

    class Source(JdbcSource):
        def _block_predicates(self, spark, schema, table, by):
            return [f"block {i} of {by.partitions}" for i in range(by.partitions or 4)]

    def jdbc(url, table, predicates, properties):
        calls.append((table, predicates))
        return values

    fake = SimpleNamespace(read=SimpleNamespace(jdbc=jdbc))
    Source().read(fake, "public", "t", partitioning=ByDepth("odd`c", 10))
    (first, by_block), (second, found) = calls
    assert first == second == '"public"."t"' and by_block[0] == "block 0 of None"
    assert sum(t.startswith('"odd`c" = 7 AND block') for t in found) == 5
    assert Counter(bool(re.search("block", t)) for t in found)[False] >= 3
    assert sum("IS NULL" in t for t in found) == 2
