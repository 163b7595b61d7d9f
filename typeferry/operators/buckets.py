"""A hidden bucket of the merge key: the layout of tables without partitions of their own.

A table that is merged by key, and has no partition column to go by, would be rewritten whole
for one row. With buckets it is stored by the hash of its key, in one more partition column
that this library adds and takes away, and the key and the number are kept in the table's
properties. A merge then rewrites the buckets its keys fall into, each exchanged on its own.

The hash is taken of the values in the table's own types. Rows with a null in the key never
match, so they are spread by the hash of the whole row and not put in one bucket.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from typeferry.functions.casts import quoted
from typeferry.functions.typenames import same_name

BUCKET = "typeferry_bucket"

KEYS, COUNT = "typeferry.bucket.keys", "typeferry.bucket.count"


@dataclass(frozen=True)
class Buckets:
    """How many, by the hash of which columns.

    A merge reads and writes the buckets it hits as a whole, so a bucket should be what one
    task may write (some hundred megabytes), and a table's files are at least as many.
    """

    keys: Sequence[str]
    count: int

    def properties(self) -> dict[str, str]:
        return {KEYS: json.dumps(list(self.keys)), COUNT: str(self.count)}

    @classmethod
    def of(cls, properties: Mapping[str, str]) -> Buckets | None:
        if KEYS not in properties:
            return None
        return cls(tuple(json.loads(properties[KEYS])), int(properties[COUNT]))


def without(properties: Mapping[str, str]) -> dict[str, str]:
    return {k: v for k, v in properties.items() if k not in (KEYS, COUNT)}


def hashable(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return hashable(kind.elementType)
    if isinstance(kind, T.StructType):
        return all(hashable(f.dataType) for f in kind.fields)
    return not isinstance(kind, (T.MapType, T.VariantType))


def with_bucket(df: DataFrame, buckets: Buckets) -> DataFrame:
    """The rows with their bucket as the last column."""
    same = same_name(df.sparkSession)
    if any(same(c, BUCKET) for c in df.columns):
        raise ValueError(f"{BUCKET} is the name of the hidden column")
    keys = [next((c for c in df.columns if same(c, k)), None) for k in buckets.keys]
    if None in keys or not keys or buckets.count < 1:
        raise ValueError(f"buckets need key columns and a number of 1 or more; got {buckets}")
    all_set = reduce(lambda a, b: a & b, [F.col(quoted(k)).isNotNull() for k in keys])
    row = [F.col(quoted(f.name)) for f in df.schema.fields if hashable(f.dataType)]
    by_key = F.xxhash64(*[F.col(quoted(k)) for k in keys])
    number = F.pmod(F.when(all_set, by_key).otherwise(F.xxhash64(*row)), F.lit(buckets.count))
    return df.withColumn(BUCKET, number.cast("int"))


def visible(df: DataFrame) -> DataFrame:
    return df.drop(BUCKET)


def read_table(spark: SparkSession, table: str) -> DataFrame:
    """The rows of a table, without the hidden column if it has one."""
    return visible(spark.table(table))


def bucket_of(values: Mapping[str, object], spark: SparkSession, table: str) -> Column:
    """A condition that reads only the bucket of one key, to go with one on the key itself."""
    found = spark.sql(f"SHOW TBLPROPERTIES {table}").collect()
    buckets = Buckets.of({r["key"]: r["value"] for r in found})
    if buckets is None:
        return F.lit(True)
    kinds = {f.name: f.dataType for f in spark.table(table).schema.fields}
    same = same_name(spark)
    hashed = []
    for k in buckets.keys:
        name = next(c for c in kinds if same(c, k))
        value = next(v for c, v in values.items() if same(c, k))
        hashed.append(F.lit(value).cast(kinds[name]))
    number = F.pmod(F.xxhash64(*hashed), F.lit(buckets.count)).cast("int")
    return F.col(BUCKET) == number
