"""A log of changes brought into a table: inserts, updates and deletes, in any order.

Each change names a key, a sequence number, and new values or a deletion. The table keeps, in two
hidden columns, the number of the change that each row last came from, and whether that was a
deletion: a deleted row stays as a tombstone. So a change that comes late, after a newer one
of its key has been applied, is known and ignored, a deletion too; the same log, applied
twice or in parts or out of order, gives the same table.

Of the log only the last change of each key counts. Changes are collapsed by an aggregate
that keeps one row per key, so a key with a third of the log is combined where it is read. What
is left meets the numbers of the table in a join on the key, which reads the key and number
columns alone, and then ``merge_table``, into hidden buckets of the key: only buckets that
hold changed keys are rewritten, and a run that is cut off can be run again.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from typeferry.functions.casts import quoted
from typeferry.functions.typenames import same_name
from typeferry.operators.buckets import Buckets, hashable, read_table
from typeferry.operators.scratch import landed
from typeferry.operators.write import finish_writes, merge_table, write_table

SEQUENCE, DELETED = "typeferry_sequence", "typeferry_deleted"

BUCKETS = 64  # of a new table


def collapse(changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The last of the changes of each key, and whether two different ones are last.

    ``changes`` have their number and whether they delete as ``SEQUENCE`` and ``DELETED``.
    """
    columns = [F.col(quoted(c)) for c in changes.columns]
    order = F.col(SEQUENCE)
    # Of the changes with the highest number, the highest and the lowest hash.
    hashed = F.xxhash64(*[F.col(quoted(f.name)) for f in changes.schema.fields if hashable(f.dataType)])
    high = F.max(F.struct(order, hashed.cast("decimal(20,0)").alias("hash")))
    low = F.max(F.struct(order, (-hashed.cast("decimal(20,0)")).alias("hash")))
    return (
        changes.groupBy(*[F.col(quoted(k)).alias(f"key{i}_") for i, k in enumerate(keys)])
        .agg(F.max_by(F.struct(*columns), order).alias("row_"), high.alias("high_"), low.alias("low_"))
        .select("row_.*", (F.col("high_.hash") + F.col("low_.hash") != 0).alias("ambiguous_"))
    )


def apply_changes(
    log: DataFrame,
    target: str,
    keys: Sequence[str],
    sequence: str | Column,
    deleted: Column | None = None,
    columns: Sequence[str] | None = None,
    buckets: int = BUCKETS,
) -> None:
    """Applies a log to ``target``, which is created if it is missing.

    ``sequence`` orders the changes of a key: a column, or an expression of any ordered type, a
    struct say. ``deleted`` tells deletions. ``columns`` are what the table holds; by
    default all of the log's. Read the table with ``current_rows``.
    """
    spark = log.sparkSession
    same = same_name(spark)
    wanted = list(columns or log.columns)
    absent = [k for k in keys if not any(same(k, c) for c in wanted)]
    if not keys or absent:
        raise ValueError(f"changes need key columns among {wanted}; got {list(keys)}")
    order = F.col(quoted(sequence)) if isinstance(sequence, str) else sequence
    gone = F.lit(False) if deleted is None else deleted
    named = [F.col(quoted(c)) for c in wanted]
    deletes = F.coalesce(gone, F.lit(False))
    changes = log.select(*named, order.alias(SEQUENCE), deletes.alias(DELETED))
    finish_writes(spark, target)
    with landed(changes, "changes") as changes:
        needed = [F.col(quoted(k)) for k in keys] + [F.col(SEQUENCE)]
        if not changes.filter(reduce(lambda a, b: a | b, [c.isNull() for c in needed])).isEmpty():
            raise ValueError("a change without a key or a sequence number")
        with landed(collapse(changes, keys), "last") as last:
            doubtful = last.filter("ambiguous_").first()
            if doubtful is not None:
                found = {k: doubtful[k] for k in keys}
                raise ValueError(f"two changes with one sequence number for the key {found}")
            last = last.drop("ambiguous_")
            if not spark.catalog.tableExists(target):
                write_table(last, target, "error", buckets=Buckets(list(keys), buckets))
                return
            with landed(_newer(last, read_table(spark, target), keys), "newer") as newer:
                merge_table(newer, target, keys, stable=True)


def _newer(last: DataFrame, present: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The changes with a higher number than the table has for their key."""
    known = present.select(
        *[F.col(quoted(k)).alias(f"key{i}_") for i, k in enumerate(keys)],
        F.col(SEQUENCE).alias("known_"),
    )
    match = reduce(
        lambda a, b: a & b, [F.col(quoted(k)) == F.col(f"key{i}_") for i, k in enumerate(keys)]
    )
    joined = last.join(known, match, "left")
    return joined.filter(F.col("known_").isNull() | (F.col(SEQUENCE) > F.col("known_"))).select(
        *[F.col(quoted(c)) for c in last.columns]
    )


def current_rows(spark: SparkSession, target: str) -> DataFrame:
    """The rows of a table that changes are applied to, without the deleted ones."""
    return read_table(spark, target).filter(~F.col(DELETED)).drop(SEQUENCE, DELETED)


def forget_deleted(spark: SparkSession, target: str, before: Column) -> None:
    """Drops tombstones whose number is below ``before``: no change that old may come any more."""
    rows = read_table(spark, target)
    write_table(rows.filter(~(F.col(DELETED) & (F.col(SEQUENCE) < before))), target)
