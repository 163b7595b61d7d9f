"""Tables that are Spark frames already, described as a database would describe them."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from typeferry.functions.typenames import innermost, postgres_spelling
from typeferry.operators.mapping import DESCRIPTOR, MappedColumn
from typeferry.sources.jdbc import Partitioning


@dataclass(frozen=True)
class FrameSource:
    """Named frames under one schema name."""

    tables: Mapping[str, DataFrame]
    schema: str = "public"

    def columns(
        self, spark: SparkSession, schema: str | None = None, table: str | None = None
    ) -> DataFrame:
        """All descriptors; ``discover_columns`` keeps those of the schema and table."""
        rows = []
        for name, frame in self.tables.items():
            rows += _descriptors(self.schema, name, frame.schema)
        return spark.createDataFrame(rows, DESCRIPTOR)

    def read(
        self,
        spark: SparkSession,
        schema: str,
        table: str,
        columns: list[MappedColumn],
        partitioning: Partitioning | None = None,
    ) -> DataFrame:
        return self._frame(schema, table)

    def count(self, spark: SparkSession, schema: str, table: str) -> DataFrame:
        return self._frame(schema, table).agg(F.count(F.lit(1)).alias("n_rows"))

    def _frame(self, schema: str, table: str) -> DataFrame:
        if schema != self.schema or table not in self.tables:
            raise ValueError(f"no table {schema}.{table}")
        return self.tables[table]


def _descriptors(schema: str, table: str, struct: T.StructType) -> list[tuple]:
    rows = []
    for position, field in enumerate(struct.fields, start=1):
        inner = innermost(field.dataType)
        exact = isinstance(inner, T.DecimalType)
        rows.append(
            (
                schema,
                table,
                field.name,
                postgres_spelling(field.dataType),
                None,
                inner.precision if exact else None,
                inner.scale if exact else None,
                "YES" if field.nullable else "NO",
                0,
                position,
            )
        )
    return rows
