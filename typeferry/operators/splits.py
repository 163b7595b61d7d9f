"""Splits of a column's values that hold about as many rows each, however they are spread.

One aggregate makes a mergeable quantile sketch (KLL) of the column and counts its nulls: tasks
send sketches of bounded size, never values. Of the sketch a fine grid of quantiles is asked. A
value that fills several steps of the grid is heavy and becomes splits of its own, and so do
the nulls; the steps between are put together until a split is full. Splits of a heavy value
or of nulls are told apart by a hash of the whole row, in Spark, or by the row's block, in a
database, since its values say nothing.

Every row is in exactly one split whatever the bounds are: they are ranges that meet, without the
heavy values, plus these, plus the nulls. The sketch only decides how even they are: within
twice the mean unless one block, or many equal rows, hold more. The bounds of another run may
differ, as the sketch's choices are random.

Columns may be integers, floats, dates, timestamps, or decimals of up to 18 digits.
"""

from __future__ import annotations

import datetime
import decimal
import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from typeferry.functions.casts import quoted
from typeferry.operators.buckets import hashable

STEPS = 16  # of the grid, for each split
SKETCH = 4096  # of the sketch: the error of a rank is about a thousandth
MOST = 4096  # splits

EPOCH = datetime.datetime(1970, 1, 1)


@dataclass(frozen=True)
class Split:
    """A range ``lower <= value < upper`` without the values ``but``, open where a bound is
    none; or one value; or the nulls. ``part`` of ``parts`` of a value or the nulls."""

    kind: str  # range, value, null
    lower: object = None
    upper: object = None
    but: tuple = ()
    part: int = 0
    parts: int = 1


def _code(kind: T.DataType, value: Column) -> Column:
    """A value as the number that the sketch takes."""
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return value.cast("long")
    if isinstance(kind, T.DateType):
        return F.unix_date(value).cast("long")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(value)
    if isinstance(kind, T.TimestampNTZType):
        # Difference to the epoch, not a cast: no time zone comes in.
        return F.expr("timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01', value_)")
    if isinstance(kind, T.DecimalType) and kind.precision <= 18:
        return (value * F.lit(10**kind.scale).cast("decimal(19,0)")).cast("long")
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return value.cast("double")
    raise ValueError(f"no splits by a column of type {kind.simpleString()}")


def _value(kind: T.DataType, code: int | float) -> object:
    """The value a number stands for."""
    if isinstance(kind, T.DateType):
        return EPOCH.date() + datetime.timedelta(days=code)
    if isinstance(kind, T.TimestampType):
        return EPOCH.replace(tzinfo=datetime.timezone.utc) + datetime.timedelta(microseconds=code)
    if isinstance(kind, T.TimestampNTZType):
        return EPOCH + datetime.timedelta(microseconds=code)
    if isinstance(kind, T.DecimalType):
        return decimal.Decimal(code).scaleb(-kind.scale)
    return code


def equi_depth(df: DataFrame, column: str, splits: int, sketch: int = SKETCH) -> list[Split]:
    """About ``splits`` splits of ``df`` by one of its columns; one aggregate reads it."""
    if not 1 <= splits <= MOST:
        raise ValueError(f"1 to {MOST} splits; got {splits}")
    kind = df.schema[column].dataType
    of_double = isinstance(kind, (T.FloatType, T.DoubleType))
    rows = df.select(F.col(quoted(column)).alias("value_")).select(
        "value_", _code(kind, F.col("value_")).alias("code_")
    )
    aggregate = F.kll_sketch_agg_double if of_double else F.kll_sketch_agg_bigint
    quantiles = F.kll_sketch_get_quantile_double if of_double else F.kll_sketch_get_quantile_bigint
    code = F.col("code_")
    odd = F.lit(False)
    if of_double:  # NaN sorts above all in Spark and nowhere in a sketch
        odd = F.isnan(code)
        code = F.when(~odd, code)
    grid = [i / (splits * STEPS) for i in range(splits * STEPS + 1)]
    found = rows.agg(
        F.count(F.lit(1)).alias("n"),
        F.count("value_").alias("n_set"),
        F.count_if(odd).alias("n_odd"),
        aggregate(code, sketch).alias("sketch"),
    ).select(
        "n", "n_set", "n_odd",
        F.when(F.col("n_set") > F.col("n_odd"), quantiles("sketch", F.lit(grid))).alias("grid"),
    ).first()
    return _from_grid(found["grid"] or [], found["n"], found["n_set"], found["n_odd"], splits, kind)


def _from_grid(
    grid: Sequence, n: int, n_set: int, n_odd: int, splits: int, kind: T.DataType
) -> list[Split]:
    full = max(1, math.ceil(n / splits))
    out: list[Split] = []
    if grid:
        step = (n_set - n_odd) / (len(grid) - 1)  # rows between two points
        times: dict = {}
        for point in grid[:-1]:  # each point stands for the step that begins with it
            times[point] = times.get(point, 0) + 1
        # A value at several points fills the steps between them, and more or less of two others.
        heavy = {p: c * step for p, c in times.items() if c > 2 and c * step > full / 2}
        lower, held, but = None, 0.0, []
        for point, count in sorted(times.items()):
            weight = step if point in heavy else count * step
            if held and held + weight > full:
                out.append(Split("range", lower, _value(kind, point), tuple(but)))
                lower, held, but = _value(kind, point), 0.0, []
            held += weight
            if point in heavy:
                but.append(_value(kind, point))
        out.append(Split("range", lower, None, tuple(but)))
        for point, rows in sorted(heavy.items()):
            parts = math.ceil(rows / full)
            out += [Split("value", _value(kind, point), part=i, parts=parts) for i in range(parts)]
    elif n_odd or not n:
        out.append(Split("range"))
    if grid and n_odd > full:
        # NaN lies above every number: the last range has all of them, a hash divides it.
        parts = math.ceil(n_odd / full)
        last = max(i for i, s in enumerate(out) if s.kind == "range")
        out[last] = Split("range", out[last].lower, None, (*out[last].but, math.nan))
        out += [Split("value", math.nan, part=i, parts=parts) for i in range(parts)]
    elif not grid and n_odd:
        parts = math.ceil(n_odd / full)
        out = [Split("value", math.nan, part=i, parts=parts) for i in range(parts)]
        out.append(Split("range", but=(math.nan,)))
    parts = max(1, math.ceil((n - n_set) / full))
    return out + [Split("null", part=i, parts=parts) for i in range(parts)]


def split_of(df: DataFrame, column: str, splits: Sequence[Split]) -> Column:
    """The number of each row's split, for a select over ``df``: a comparison tree, then a
    look-up of the heavy values, then a hash of the row within these."""
    kind = df.schema[column].dataType
    value = F.col(quoted(column))
    ranges = [(i, s) for i, s in enumerate(splits) if s.kind == "range"]
    first = {
        (s.kind, _key(s.lower)): (i, s) for i, s in enumerate(splits) if s.kind != "range" and s.part == 0
    }
    row = F.xxhash64(*[F.col(quoted(f.name)) for f in df.schema.fields if hashable(f.dataType)])

    def among(i: int, split: Split) -> Column:
        if split.parts == 1:
            return F.lit(i)
        return F.lit(i) + F.pmod(row, F.lit(split.parts)).cast("int")

    def tree(low: int, high: int) -> Column:
        if high - low == 1:
            return F.lit(ranges[low][0])
        middle = (low + high) // 2
        bound = F.lit(ranges[middle][1].lower).cast(kind)
        return F.when(value < bound, tree(low, middle)).otherwise(tree(middle, high))

    out = tree(0, len(ranges)) if ranges else F.lit(None).cast("int")
    for (what, _), (i, split) in first.items():
        if what == "value":
            out = F.when(value == F.lit(split.lower).cast(kind), among(i, split)).otherwise(out)
    nulls = next((among(i, s) for (what, _), (i, s) in first.items() if what == "null"), F.lit(None))
    return F.when(value.isNull(), nulls).otherwise(out).cast("int")


def _key(value: object) -> object:
    return "nan" if isinstance(value, float) and math.isnan(value) else value


def spread(df: DataFrame, column: str, splits: int) -> DataFrame:
    """The rows dealt by their split: sorted into as many tasks as ``repartitionByRange``
    would make, but with heavy values and nulls divided."""
    found = equi_depth(df, column, splits)
    return df.repartition(len(found), split_of(df, column, found))


# -- conditions for a database -----------------------------------------------------------


def sql_literal(value: object) -> str:
    if isinstance(value, float):
        return "'NaN'::float8" if math.isnan(value) else f"'{value!r}'::float8"
    if isinstance(value, datetime.datetime):
        zone = "timestamptz" if value.tzinfo else "timestamp"
        return f"{zone} '{value.isoformat(sep=' ')}'"
    if isinstance(value, datetime.date):
        return f"date '{value.isoformat()}'"
    return str(value)


def conditions(column: str, splits: Sequence[Split], blocks) -> list[str]:
    """Splits as conditions in the database's SQL, which together hold each row once.

    ``column`` is its quoted name. ``blocks(n)`` gives about ``n`` conditions on the row's
    address that divide the table: heavy values and nulls are divided by these.
    """
    out = []
    for split in splits:
        if split.part:
            continue  # of its first part come all
        if split.kind == "null":
            text = f"{column} IS NULL"
        elif split.kind == "value":
            text = f"{column} = {sql_literal(split.lower)}"
        else:
            bounds = [f"{column} >= {sql_literal(split.lower)}"] if split.lower is not None else []
            bounds += [f"{column} < {sql_literal(split.upper)}"] if split.upper is not None else []
            if split.but:
                bounds.append(f"{column} NOT IN ({', '.join(map(sql_literal, split.but))})")
            text = " AND ".join(bounds) or f"{column} IS NOT NULL"
        if split.parts == 1:
            out.append(text)
        else:
            out += [f"{text} AND {address}" for address in blocks(split.parts)]
    return out
