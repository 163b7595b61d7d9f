"""Looking at a written table, and checking it against its source."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from typeferry.functions.casts import quoted
from typeferry.operators.buckets import read_table
from typeferry.operators.conform import altered_values, lost_values
from typeferry.operators.mapping import MappedColumn


def preview(
    spark: SparkSession, table: str, order_by: Sequence[str], n: int = 10
) -> DataFrame:
    """The first ``n`` rows of a table in a stated order."""
    return read_table(spark, table).orderBy(*[F.col(quoted(c)) for c in order_by]).limit(n)


def row_count(df: DataFrame) -> DataFrame:
    """One row with ``n_rows``."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"))


MEASURES = ("nulls", "lost", "altered")


def column_counts(
    df: DataFrame, columns: Sequence[MappedColumn], measures: Sequence[str] = MEASURES
) -> dict[str, Column]:
    """The aggregates behind ``column_checks``, by name: ``n_rows``, and ``nulls_3``,
    ``lost_3`` or ``altered_3`` of the fourth column where they can be other than 0."""
    unknown = set(measures) - set(MEASURES)
    if unknown:
        raise ValueError(f"unknown measures {sorted(unknown)}; there are {', '.join(MEASURES)}")
    counts = {"n_rows": F.count(F.lit(1))}
    flags = {
        "nulls": lambda: [F.col(quoted(c.column_name)).isNull() for c in columns],
        "lost": lambda: lost_values(df, columns),
        "altered": lambda: altered_values(df, columns),
    }
    for measure in measures:
        for i, flag in enumerate(flags[measure]()):
            if flag is not None:
                counts[f"{measure}_{i}"] = F.count_if(flag)
    return counts


def column_checks(
    df: DataFrame, columns: Sequence[MappedColumn], measures: Sequence[str] = MEASURES
) -> DataFrame:
    """Per column of a table as read: ``n_rows`` and, as ``measures`` name them, ``n_nulls``,
    ``n_lost``, the values its mapped type cannot hold, and ``n_altered``, those it holds as
    other ones.

    One pass, partial counts before the only exchange. Only the columns that a measure
    needs are read: none for row counts, and for lost and altered values those whose cast
    can have any.
    """
    counts = column_counts(df, columns, measures)
    # One expression for each measure, not one per column: a table may have 1,600.
    arrays = {
        m: ", ".join(f"{m}_{i}" if f"{m}_{i}" in counts else "0L" for i in range(len(columns)))
        for m in measures
    }
    names = F.lit([column.column_name for column in columns])
    return (
        df.agg(*[value.alias(name) for name, value in counts.items()])
        .select(
            "n_rows",
            *[F.expr(f"array({of_all})").alias(m) for m, of_all in arrays.items()],
            F.posexplode(names).alias("at", "column_name"),
        )
        .select(
            "column_name",
            "n_rows",
            *[F.element_at(m, F.col("at") + 1).alias(f"n_{m}") for m in measures],
        )
    )


def reconcile(
    source_count: DataFrame,
    target: DataFrame,
    columns: Sequence[MappedColumn] = (),
    rows_before: int = 0,
) -> DataFrame:
    """One row: are all source rows in the target, and does NOT NULL hold there.

    ``source_count`` is one row with ``n_rows``, ``rows_before`` what an append found.
    Columns are compared by name: partition columns move to the end of a table.
    """
    zero = F.lit(0).cast("bigint")
    null_cells = zero
    for column in columns:
        if not column.nullable:
            value = F.col(quoted(column.column_name))
            null_cells = null_cells + F.count(F.lit(1)) - F.count(value)
    expected = source_count.select(
        F.col("n_rows").cast("bigint").alias("source_rows"),
        zero.alias("target_rows"),
        zero.alias("null_violations"),
    )
    found = target.agg(
        zero.alias("source_rows"),
        F.count(F.lit(1)).alias("target_rows"),
        null_cells.alias("null_violations"),
    )
    return (
        expected.unionByName(found)
        .agg(
            F.sum("source_rows").alias("source_rows"),
            F.sum("target_rows").alias("target_rows"),
            F.sum("null_violations").alias("null_violations"),
        )
        .select(
            "source_rows",
            "target_rows",
            (F.col("target_rows") - F.lit(rows_before) == F.col("source_rows")).alias(
                "rows_match"
            ),
            "null_violations",
        )
    )
