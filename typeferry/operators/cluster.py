"""Rows laid out along a curve through several columns, and what each file holds of them.

A file of a table sorted by one column says much about that column and nothing about others. Here
each column's values become one of a few equally frequent steps (by a mergeable quantile
sketch, so uneven values make even steps), the steps' bits are interleaved, highest first, and
rows are dealt to files by ranges of that number. Rows that are near in all columns are in
few files then. A cell of equal numbers, however many rows it has, is divided by a hash.

The zone map is a table beside it: for each file the smallest and the largest value of the
columns, and whether it has nulls. ``in_zones`` turns a range of some columns into a condition on
the files' names, by which Spark leaves files out as it plans the scan. Only files that the
zone map knows are ever left out: rows appended or merged later are in files of other names.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from math import ceil, log2

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from typeferry.functions.casts import quoted
from typeferry.operators.buckets import hashable
from typeferry.operators.splits import equi_depth
from typeferry.operators.write import _suffixed, write_table

ZONES = "__zones"

MOST_BITS = 10  # steps of a column: two to that


def _ordered(df: DataFrame, column: str) -> Column:
    """The column, or for text a number in the order of its first seven bytes."""
    value = F.col(quoted(column))
    if isinstance(df.schema[column].dataType, T.StringType):
        start = F.rpad(F.hex(F.substring(value.cast("binary"), 1, 7)), 14, "0")
        return F.conv(start, 16, 10).cast("long")
    if isinstance(df.schema[column].dataType, T.BooleanType):
        return value.cast("int")
    return value


def step_of(df: DataFrame, column: str, bits: int) -> Column:
    """The step of each row's value, from 0 to below two to the ``bits``; nulls are in the first."""
    if bits == 0:
        return F.lit(0)
    value = _ordered(df, column)
    found = df.select(value.alias("v"))
    kind = found.schema["v"].dataType
    lower = {s.lower for s in equi_depth(found, "v", 2**bits) if s.kind != "null"}
    # Each bound begins a step, a heavy value's too. NaN, the largest, needs none.
    bounds = sorted(x for x in lower if x is not None and x == x)[: 2**bits - 1]

    def tree(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(value < F.lit(bounds[middle]).cast(kind), tree(low, middle)).otherwise(
            tree(middle + 1, high)
        )

    return F.when(value.isNull(), 0).otherwise(tree(0, len(bounds)))


def curve(steps: Sequence[Column], bits: int) -> Column:
    """The bits of all steps, interleaved, the highest of each first."""
    out = F.lit(0).cast("long")
    for bit in reversed(range(bits)):
        for step in steps:
            one = F.shiftright(step, bit).bitwiseAND(F.lit(1)).cast("long")
            out = F.shiftleft(out, 1).bitwiseOR(one)
    return out


def clustered(df: DataFrame, columns: Sequence[str], files: int) -> DataFrame:
    """The rows dealt to ``files`` tasks along the curve, and sorted along it there."""
    if not columns or files < 1:
        raise ValueError("clustering needs columns and a number of files")
    bits = min(MOST_BITS, 62 // len(columns), ceil(log2(files) / len(columns)) + 2)
    # The steps are columns first, so that the curve does not repeat their trees.
    steps = [f"step{i}_" for i in range(len(columns))]
    rows = df.select("*", *[step_of(df, c, bits).alias(s) for c, s in zip(columns, steps)])
    rows = rows.withColumn("curve_", curve([F.col(s) for s in steps], bits)).drop(*steps)
    hashed = F.xxhash64(*[F.col(quoted(f.name)) for f in df.schema.fields if hashable(f.dataType)])
    return (
        rows.repartitionByRange(files, "curve_", hashed).sortWithinPartitions("curve_").drop("curve_")
    )


def zone_map(table: DataFrame, columns: Sequence[str]) -> DataFrame:
    """A row for each file: its name, its rows, and of each column ``low_i``, ``high_i`` and
    ``nulls_i``."""
    measures = []
    for i, c in enumerate(columns):
        value = F.col(quoted(c))
        measures += [F.min(value).alias(f"low_{i}"), F.max(value).alias(f"high_{i}"),
                     F.count_if(value.isNull()).alias(f"nulls_{i}")]
    rows = table.select(F.col("_metadata.file_path").alias("file"), *[F.col(quoted(c)) for c in columns])
    return rows.groupBy("file").agg(F.count(F.lit(1)).alias("n_rows"), *measures)


def zones_of(target: str) -> str:
    return _suffixed(target, ZONES)


def write_clustered(
    df: DataFrame, target: str, columns: Sequence[str], files: int, fmt: str | None = None
) -> None:
    """Overwrites ``target``, clustered by ``columns`` into ``files`` files, and its zone map.

    The zone map is written last: until then it knows files that are gone, and leaves out none.
    """
    spark = df.sparkSession
    write_table(clustered(df, columns, files), target, partition_by=[], fmt=fmt)
    write_zones(spark, target, columns)


def write_zones(spark: SparkSession, target: str, columns: Sequence[str]) -> None:
    """The zone map of a table as it is now, however it was written."""
    comments = {c: f"low_{i}" for i, c in enumerate(columns)}
    zones = zone_map(spark.table(target), columns)
    named = [
        F.col(f"low_{i}").alias(f"low_{i}", metadata={"comment": c}) for i, c in enumerate(comments)
    ]
    others = [F.col(c) for c in zones.columns if c not in comments.values()]
    write_table(zones.select(*named, *others).coalesce(1), zones_of(target))


def in_zones(
    spark: SparkSession, target: str, ranges: Mapping[str, tuple[object, object]]
) -> Column:
    """A condition on the rows of ``spark.table(target)`` by which files without any value in
    one of the ``ranges`` are not opened. A range is (lowest, highest), both included; None is
    no bound. It goes with the condition on the values; nulls are in no range."""
    zones = spark.table(zones_of(target))
    number = {
        f.metadata["comment"]: f.name.removeprefix("low_")
        for f in zones.schema.fields
        if f.name.startswith("low_") and "comment" in f.metadata
    }
    misses = [F.lit(False)]
    for column, (low, high) in ranges.items():
        if column not in number:
            continue
        i = number[column]
        kind = zones.schema[f"low_{i}"].dataType
        misses.append(F.col(f"low_{i}").isNull())  # nulls alone
        if low is not None:
            misses.append(F.col(f"high_{i}") < F.lit(low).cast(kind))
        if high is not None:
            misses.append(F.col(f"low_{i}") > F.lit(high).cast(kind))
    out = zones.filter(reduce(lambda a, b: a | b, misses)).select("file").collect()
    if not out:
        return F.lit(True)
    return ~F.col("_metadata.file_path").isin([r["file"] for r in out])
