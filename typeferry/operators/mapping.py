"""Mapping of column descriptors to Spark types, for any number of columns at once."""

from __future__ import annotations

import warnings
from collections.abc import Sequence
from typing import Any, NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from typeferry.functions import rules
from typeferry.functions import typenames as names

DESCRIPTOR = T.StructType(
    [
        T.StructField("table_schema", T.StringType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("column_name", T.StringType()),
        T.StructField("data_type", T.StringType()),
        T.StructField("udt_name", T.StringType()),
        T.StructField("numeric_precision", T.IntegerType()),
        T.StructField("numeric_scale", T.IntegerType()),
        T.StructField("is_nullable", T.StringType()),
        T.StructField("array_dimensions", T.IntegerType()),
        T.StructField("ordinal_position", T.IntegerType()),
    ]
)


class MappedColumn(NamedTuple):
    """One column of one table, after mapping."""

    column_name: str
    data_type: str | None
    base_type: str | None
    spark_type: str | None
    nullable: bool
    status: str

    def type(self) -> T.DataType:
        if self.spark_type is None:
            raise ValueError(f"column {self.column_name} states no data type")
        return T.DataType.fromDDL(self.spark_type)


def _has(descriptors: DataFrame, field: str) -> bool:
    # Some drivers give the names of catalog columns in upper case.
    return field in (name.lower() for name in descriptors.columns)


def _optional(descriptors: DataFrame, field: str) -> Column:
    if _has(descriptors, field):
        return F.col(field).cast(DESCRIPTOR[field].dataType)
    return F.lit(None).cast(DESCRIPTOR[field].dataType)


def map_types(descriptors: DataFrame) -> DataFrame:
    """Adds ``base_type``, ``spark_type``, ``nullable`` and ``status`` to descriptors.

    Only ``data_type`` must be there. ``status`` is ``ok``; ``unknown`` for a name
    without a rule and ``invalid_decimal`` for a precision or scale Spark cannot hold,
    both mapped to string; ``missing`` where the data type is null.

    Projections, and one broadcast join with the 68 rules: descriptors are never shuffled.
    """
    name = names.normalised(F.col("data_type"))
    shaped = (
        descriptors.withColumn("_name", name)
        .withColumn("_bare", names.without_suffix(F.col("_name")))
        .withColumn("_unnamed_array", F.col("_bare") == "array")
        .withColumn(
            "_dims",
            F.coalesce(_optional(descriptors, "array_dimensions"), F.lit(0))
            + names.suffix_dimensions(F.col("_name"), F.col("_bare")),
        )
        .withColumn(
            "_dims",
            F.when(F.col("_unnamed_array") & (F.col("_dims") == 0), F.lit(1)).otherwise(
                F.col("_dims")
            ),
        )
    )

    # The catalog says just ARRAY; the element is in udt_name, with an underscore before it.
    udt_name = _optional(descriptors, "udt_name")
    element = (
        F.when(F.col("_unnamed_array").isNull() | ~F.col("_unnamed_array"), F.col("_bare"))
        .when(udt_name.startswith("_"), F.lower(F.substr(udt_name, F.lit(2))))
        .otherwise(F.lit("text"))
    )
    found = shaped.withColumn("base_type", element).join(
        F.broadcast(rules.rules_frame(descriptors.sparkSession)),
        F.col("base_type") == F.col("_name_ruled"),
        "left",
    )

    precision = F.coalesce(
        _optional(descriptors, "numeric_precision"), F.lit(rules.DEFAULT_PRECISION)
    )
    scale = F.coalesce(_optional(descriptors, "numeric_scale"), F.lit(rules.DEFAULT_SCALE))
    is_decimal = F.col("_rule") == "decimal"
    fits = precision.between(1, rules.MAX_PRECISION) & (scale >= 0) & (scale <= precision)
    found = found.withColumn(
        "_scalar",
        F.when(F.col("_rule").isNull() | (is_decimal & ~fits), F.lit(rules.FALLBACK_TYPE))
        .when(is_decimal, F.concat(F.lit("decimal("), precision, F.lit(","), scale, F.lit(")")))
        .otherwise(F.col("_rule")),
    )
    status = (
        F.when(F.col("data_type").isNull(), "missing")
        .when(F.col("_rule").isNull(), "unknown")
        .when(is_decimal & ~fits, "invalid_decimal")
        .otherwise("ok")
    )
    nullable = F.upper(F.coalesce(_optional(descriptors, "is_nullable"), F.lit("YES"))) != "NO"

    return found.select(
        *descriptors.columns,
        "base_type",
        F.when(
            F.col("data_type").isNotNull(), names.array_of(F.col("_scalar"), F.col("_dims"))
        ).alias("spark_type"),
        nullable.alias("nullable"),
        status.alias("status"),
    )


def mapping_audit(mapped: DataFrame, *more: str) -> DataFrame:
    """What each column was, and what it becomes; with ``more`` columns of the frame."""
    return mapped.select("table_name", "column_name", "data_type", "spark_type", "status", *more)


def _one_table(mapped: DataFrame, schema: str | None, tables: Sequence[str] | None) -> DataFrame:
    """The descriptors of the named tables; an error if a name stands for several tables."""
    if schema is not None:
        mapped = mapped.filter(F.col("table_schema") == schema)
    if tables is not None:
        mapped = mapped.filter(F.col("table_name").isin(list(tables)))
    if schema is None and _has(mapped, "table_schema"):
        by = ["table_name"] if tables is not None else []
        schemas = F.collect_set(F.coalesce("table_schema", F.lit("")))
        several = mapped.groupBy(*by).agg(F.sort_array(schemas).alias("schemas"))
        found = several.filter(F.size("schemas") > 1).first()
        if found is not None:
            what = found["table_name"] if by else "the descriptors"
            raise ValueError(f"{what}: in the schemas {', '.join(found['schemas'])}; name one")
    return mapped


def mapped_columns(
    mapped: DataFrame, table: str | None = None, schema: str | None = None
) -> list[MappedColumn]:
    """The mapped columns of one table, in order, on the driver.

    Raises ``ValueError`` when there are none, as for a table that does not exist, and
    when a table of that name is in more than one schema and none is given, or
    descriptors of several tables are given and none is named.
    """
    mapped = _one_table(mapped, schema, None if table is None else [table])
    if table is None and _has(mapped, "table_name"):
        names = [r[0] for r in mapped.select("table_name").distinct().limit(2).collect()]
        if len(names) > 1:
            raise ValueError(f"descriptors of several tables, {', '.join(map(str, names))}; name one")
    if _has(mapped, "ordinal_position"):
        mapped = mapped.orderBy("ordinal_position")
    # A table has at most 1,600 columns.
    rows = mapped.select(*MappedColumn._fields).collect()
    if not rows:
        where = ".".join(part for part in (schema, table) if part) or "the descriptors"
        raise ValueError(
            f"no columns found for {where}: the table does not exist, "
            "or the user may not see its columns"
        )
    return [MappedColumn(*row) for row in rows]


def mapped_tables(
    mapped: DataFrame, tables: Sequence[str], schema: str | None = None
) -> dict[str, list[MappedColumn]]:
    """``mapped_columns`` of several tables of one schema, in one job.

    The schema must be given where one of the names is in several.
    """
    found: dict[str, list[MappedColumn]] = {table: [] for table in tables}
    rows = (
        _one_table(mapped, schema, tables)
        .orderBy("table_name", "ordinal_position")
        .select("table_name", *MappedColumn._fields)
        .collect()
    )
    for table, *fields in rows:
        found[table].append(MappedColumn(*fields))
    absent = [table for table, columns in found.items() if not columns]
    if absent:
        raise ValueError(f"no columns found for {', '.join(absent)}")
    return found


def build_schema(
    mapped: DataFrame | list[MappedColumn], table: str | None = None, schema: str | None = None
) -> T.StructType:
    """The ``StructType`` of one table; warns of the columns that fell back to string."""
    columns = mapped if isinstance(mapped, list) else mapped_columns(mapped, table, schema)
    for column in columns:
        if column.status in ("unknown", "invalid_decimal"):
            warnings.warn(
                f"column {column.column_name}: type {column.data_type!r} "
                f"({column.status}) is kept as string",
                stacklevel=2,
            )
    return T.StructType([T.StructField(c.column_name, c.type(), c.nullable) for c in columns])


def map_one(
    data_type: str | None,
    udt_name: str | None = None,
    precision: int | None = None,
    scale: int | None = None,
    dimensions: int | None = None,
) -> tuple[str | None, str | None, str]:
    """``base_type``, ``spark_type`` and ``status`` of one type, as ``map_types`` has them.

    Needs no session: a lookup in the same rules.
    """
    if data_type is None:
        return None, None, "missing"
    bare, suffix = names.split_suffix(data_type)
    depth = (dimensions or 0) + suffix
    element = bare
    if bare == "array":
        depth = max(depth, 1)
        named = udt_name is not None and udt_name.startswith("_")
        element = udt_name[1:].lower() if named else "text"
    rule = dict(rules.TYPE_RULES).get(element)
    status = "ok" if rule else "unknown"
    if rule == "decimal":
        p = rules.DEFAULT_PRECISION if precision is None else precision
        s = rules.DEFAULT_SCALE if scale is None else scale
        fits = 1 <= p <= rules.MAX_PRECISION and 0 <= s <= p
        rule, status = (f"decimal({p},{s})", "ok") if fits else (None, "invalid_decimal")
    return element, "array<" * depth + (rule or rules.FALLBACK_TYPE) + ">" * depth, status


def build_spark_schema(
    columns: list[dict[str, Any]], spark: SparkSession | None = None
) -> T.StructType:
    """The ``StructType`` for a list of descriptors given as dictionaries.

    ``column_name`` and ``data_type`` are needed in each, the other fields of
    ``DESCRIPTOR`` are optional. No session is needed; ``spark`` is taken and not used.
    """
    found = []
    for column in columns:
        base, spark_type, status = map_one(
            column["data_type"],
            column.get("udt_name"),
            column.get("numeric_precision"),
            column.get("numeric_scale"),
            column.get("array_dimensions"),
        )
        nullable = (column.get("is_nullable") or "YES").upper() != "NO"
        found.append(
            MappedColumn(column["column_name"], column["data_type"], base, spark_type, nullable, status)
        )
    return build_schema(found)


def map_pgsql_type_to_spark(
    pg_type: str,
    precision: int | None = None,
    scale: int | None = None,
    array_dimensions: int = 0,
    spark: SparkSession | None = None,
) -> T.DataType:
    """The Spark type of one PostgreSQL type, without a session; ``map_types`` is for many."""
    column = {
        "column_name": pg_type,
        "data_type": pg_type,
        "numeric_precision": precision,
        "numeric_scale": scale,
        "array_dimensions": array_dimensions,
    }
    return build_spark_schema([column])[0].dataType
