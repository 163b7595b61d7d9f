"""Casting a table, as read, to its mapped types."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from typeferry.functions import casts
from typeferry.functions.typenames import same_name
from typeferry.operators.mapping import MappedColumn


def _read_types(df: DataFrame, columns: Sequence[MappedColumn]) -> dict[str, T.DataType]:
    """The type read for each column; names are compared as the session does."""
    same = same_name(df.sparkSession)
    types = {field.name: field.dataType for field in df.schema.fields}
    for c in columns:
        if c.column_name not in types:
            types.update(
                {c.column_name: f.dataType for f in df.schema.fields if same(f.name, c.column_name)}
            )
    missing = [c.column_name for c in columns if c.column_name not in types]
    if missing:
        raise ValueError(f"the table has no columns {missing}")
    return types


def _readable(
    column: MappedColumn, read_types: dict[str, T.DataType]
) -> tuple[Column, T.DataType, T.DataType]:
    value = F.col(casts.quoted(column.column_name))
    formed, formed_type = casts.castable(value, read_types[column.column_name], column.base_type)
    return formed, formed_type, column.type()


def conform(
    df: DataFrame,
    columns: Sequence[MappedColumn],
    strict: bool = True,
    rounding: bool = False,
) -> DataFrame:
    """Exactly the mapped columns, in mapped order, with the mapped types.

    ``strict`` fails the job on a value its type cannot hold, or can hold only as another
    value: a fraction in an integer, more decimal places than there are, a time of day in
    a date, an integer beyond the digits of a double. ``rounding`` lets the latter pass.
    Not strict, a value that cannot be held becomes null and one that is altered stays so;
    ``column_checks`` counts both. NOT NULL is counted there too, not enforced here. One
    projection, no shuffle.
    """
    ansi = df.sparkSession.conf.get("spark.sql.ansi.enabled").lower() == "true"
    read_types = _read_types(df, columns)
    selected = []
    for column in columns:
        value, read_as, target = _readable(column, read_types)
        if strict:
            cast = casts.strict_cast(
                value, read_as, target, column.column_name, ansi, rounding
            )
        else:
            cast = casts.lenient_cast(value, read_as, target)
        selected.append(cast.alias(column.column_name))
    return df.select(*selected)


def lossy_columns(df: DataFrame, columns: Sequence[MappedColumn]) -> list[MappedColumn]:
    """The columns whose cast can lose or alter some value."""
    lost, altered = lost_values(df, columns), altered_values(df, columns)
    return [c for c, a, b in zip(columns, lost, altered) if a is not None or b is not None]


def lost_values(df: DataFrame, columns: Sequence[MappedColumn]) -> list[Column | None]:
    """Per column, true on the rows whose value the mapped type cannot hold; ``None`` for
    a column where that cannot be."""
    return _flags(df, columns, casts.can_lose, casts.is_lost)


def altered_values(df: DataFrame, columns: Sequence[MappedColumn]) -> list[Column | None]:
    """Per column, true on the rows whose value the mapped type holds as another one."""
    return _flags(df, columns, casts.can_alter, casts.is_altered)


def _flags(
    df: DataFrame,
    columns: Sequence[MappedColumn],
    may: Callable[[T.DataType, T.DataType], bool],
    does: Callable[[Column, T.DataType, T.DataType], Column],
) -> list[Column | None]:
    read_types = _read_types(df, columns)
    readable = [_readable(c, read_types) for c in columns]
    return [does(v, read_as, t) if may(read_as, t) else None for v, read_as, t in readable]
