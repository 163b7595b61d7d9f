"""Discovery of the columns of a source."""

from __future__ import annotations

from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from typeferry.operators.mapping import MappedColumn
from typeferry.sources.jdbc import Partitioning


class Source(Protocol):
    """What a source of tables offers."""

    def columns(
        self, spark: SparkSession, schema: str | None = None, table: str | None = None
    ) -> DataFrame:
        """One descriptor per column of, at least, that schema and table."""

    def read(
        self,
        spark: SparkSession,
        schema: str,
        table: str,
        columns: list[MappedColumn],
        partitioning: Partitioning | None = None,
    ) -> DataFrame:
        """All rows of one table."""

    def count(self, spark: SparkSession, schema: str, table: str) -> DataFrame:
        """One row with ``n_rows``."""


def discover_columns(
    spark: SparkSession, source: Source, schema: str | None = None, table: str | None = None
) -> DataFrame:
    """Descriptors of one table in column order, or of all tables in one pass."""
    columns = source.columns(spark, schema, table)
    if schema is not None:
        columns = columns.filter(F.col("table_schema") == schema)
    if table is not None:
        columns = columns.filter(F.col("table_name") == table)
    return columns if table is None else columns.orderBy("ordinal_position")
