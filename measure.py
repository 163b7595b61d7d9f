"""

Median of five runs after one to warm up. BENCH_SF_DIR and BENCH_CPUS as for bench.py.
"""

from __future__ import annotations

import os
import statistics
import sys
import time
from collections.abc import Callable
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from checks.queries import lineitem_columns, read, source  # noqa: E402
from typeferry import (  # noqa: E402
    conform,
    discover_columns,
    map_types,
    merge_table,
    reconcile,
    row_count,
    write_table,
)
from typeferry.operators.scratch import clear_scratch, scratch_table  # noqa: E402


def median(work: Callable[[], None], runs: int = 5) -> float:
    seconds = []
    for _ in range(runs + 1):
        start = time.perf_counter()
        work()
        seconds.append(time.perf_counter() - start)
    return statistics.median(seconds[1:])


def noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def row(metric: str, seconds: float, config: str) -> None:
        print(f"| {metric} | {seconds:.2f} | {config} |", flush=True)

    descriptors = discover_columns(spark, source(spark, sf_dir))
    width = descriptors.count()
    for millions in (1, 10, 100):
        copies = F.explode(F.sequence(F.lit(1), F.lit(millions * 1_000_000 // width)))
        stored = scratch_table(spark, "descriptors")
        descriptors.repartition(int(cpus) * 2).select("*", copies.alias("copy")).write.saveAsTable(
            stored
        )
        many = spark.table(stored)
        seconds = median(lambda: noop(map_types(many)), 5 if millions < 100 else 3)
        rate = millions / seconds
        row("`map_types`, seconds", seconds, f"{millions} million rows: {rate:.1f} million/s")
        spark.sql(f"DROP TABLE {stored}")

    lineitem = read(spark, sf_dir, "lineitem")
    columns = lineitem_columns(spark)
    row("`conform` lineitem, seconds", median(lambda: noop(conform(lineitem, columns))), "noop sink")

    target = scratch_table(spark, "written")
    row("`write_table` overwrite, seconds", median(lambda: write_table(lineitem, target)), "plain")
    source_count = row_count(lineitem)
    checked = [c._replace(nullable=False) for c in columns]
    row(
        "`reconcile`, seconds",
        median(lambda: reconcile(source_count, spark.table(target), checked).collect()),
        "lineitem, ten columns NOT NULL",
    )
    target = scratch_table(spark, "partitioned")
    row(
        "`write_table` overwrite, seconds",
        median(lambda: write_table(lineitem, target, partition_by=["l_returnflag"])),
        "partitioned by `l_returnflag`",
    )

    orders = read(spark, sf_dir, "orders")
    target = scratch_table(spark, "merged")
    write_table(orders, target)
    fifth = orders.filter(F.col("o_orderkey") % 5 == 0).withColumn("o_totalprice", F.lit(0.0))
    row(
        "`merge_table` orders, seconds",
        median(lambda: merge_table(fifth, target, ["o_orderkey"])),
        "20 % of the keys in the source",
    )
    clear_scratch(spark)
    spark.stop()


if __name__ == "__main__":
    main()
