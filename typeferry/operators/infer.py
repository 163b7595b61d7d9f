"""The narrowest type a text column could have had, with nothing lost and nothing altered.

For columns that fell back to ``string`` because their source type has no rule, and for files
whose columns are all text. A type fits a column if every value, cast to it and back, gives the
same text: so ``007`` is no number, ``1.50`` beside ``1.5`` no decimal, and a date keeps
its form. What is kept of a column is an element of a lattice, one bit for each type that still
fits, with the range of its numbers, and two such elements have a join. So all columns of a table
are inferred in one aggregate: each task joins its rows, the exchange carries one line per
task, and rows that come later can be joined to what was found before (``join``).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from typeferry.functions.casts import quoted
from typeferry.functions.typenames import same_name
from typeferry.operators.mapping import MappedColumn

# Largest numbers of the integer types, narrowest first.
INTEGERS = (("smallint", 2**15 - 1), ("int", 2**31 - 1), ("bigint", 2**63 - 1))

_INTEGER = r"\A(0|-?[1-9][0-9]{0,18})\z"
_DECIMAL = r"\A-?(0|[1-9][0-9]*)\.[0-9]+\z"
DIGITS = 38


@dataclass(frozen=True)
class Evidence:
    """What the values of a column have shown. Joined, it is what both have shown.

    ``n`` values that are set; whether all of them are texts of booleans, integers, decimals,
    doubles, dates, timestamps; the largest and the smallest integer; the digits before the
    point, and the fewest and the most after it.
    """

    n: int = 0
    boolean: bool = True
    integer: bool = True
    decimal: bool = True
    double: bool = True
    date: bool = True
    timestamp: bool = True
    low: int = 0
    high: int = 0
    whole: int = 0
    least_scale: int = DIGITS + 1
    most_scale: int = 0

    def join(self, other: Evidence) -> Evidence:
        return Evidence(
            self.n + other.n,
            self.boolean and other.boolean,
            self.integer and other.integer,
            self.decimal and other.decimal,
            self.double and other.double,
            self.date and other.date,
            self.timestamp and other.timestamp,
            min(self.low, other.low),
            max(self.high, other.high),
            max(self.whole, other.whole),
            min(self.least_scale, other.least_scale),
            max(self.most_scale, other.most_scale),
        )

    @property
    def type(self) -> str:
        """The narrowest type that fits; ``string`` where no value has been seen."""
        if not self.n:
            return "string"
        if self.boolean:
            return "boolean"
        if self.integer:
            return next(t for t, most in INTEGERS if -most - 1 <= self.low and self.high <= most)
        if (
            self.decimal
            and self.least_scale == self.most_scale
            and self.whole + self.most_scale <= DIGITS
        ):
            return f"decimal({self.whole + self.most_scale},{self.most_scale})"
        for fits, name in ((self.double, "double"), (self.date, "date"), (self.timestamp, "timestamp")):
            if fits:
                return name
        return "string"


def _round_trip(value: Column, kind: str) -> Column:
    return value.try_cast(kind).cast("string").eqNullSafe(value)


def _all(fits: Column, value: Column) -> Column:
    return F.coalesce(F.min(F.when(value.isNotNull(), fits)), F.lit(True))


def _any_of(value: Column, first: str) -> Column:
    return F.substring(value, 1, 1).isin(list(first))


def _shown(value: Column) -> Column:
    """What a value shows, each test made once; casts there and back only of texts that could
    come out of them: numbers, dates and times of day have their first letters and marks."""
    timed, signed = F.contains(value, F.lit(":")), _any_of(value, "+-0123456789")
    integer = F.when(value.rlike(_INTEGER), value.try_cast("bigint"))
    point = F.when(F.contains(value, F.lit(".")), value.rlike(_DECIMAL)).otherwise(False)
    return F.struct(
        value.alias("value"),
        integer.alias("integer"),
        point.alias("point"),
        _tried(_any_of(value, "-0123456789NI") & ~timed, value, "double").alias("double"),
        _tried(signed & ~timed & (F.locate("-", value, 2) > 0), value, "date").alias("date"),
        _tried(signed & timed, value, "timestamp_ntz").alias("timestamp"),
    )


def _tried(could: Column, value: Column, kind: str) -> Column:
    return F.when(could, _round_trip(value, kind)).otherwise(False)


def _aggregates(shown: Column) -> list[Column]:
    """One for each field of the evidence, in its order, of what values have shown."""
    value, number, decimal = shown["value"], shown["integer"], shown["point"]
    point = F.instr(value, ".")
    whole = F.when(decimal, point - 1 - value.startswith("-").cast("int"))
    scale = F.when(decimal, F.length(value) - point)
    zero = F.lit(0)
    # A whole part of 0 needs no digit of a decimal's precision.
    whole = F.when(value.startswith("0.") | value.startswith("-0."), zero).otherwise(whole)
    # -0.00 would come back as 0.00.
    is_decimal = decimal & ~(value.startswith("-0.") & value.rlike(r"\A-0\.0+\z"))
    return [
        F.count(value),
        _all(value.isin("true", "false"), value),
        _all(number.isNotNull(), value),
        _all(is_decimal, value),
        _all(shown["double"], value),
        _all(shown["date"], value),
        _all(shown["timestamp"], value),
        F.least(F.min(number), F.lit(0).cast("bigint")),
        F.greatest(F.max(number), F.lit(0).cast("bigint")),
        F.coalesce(F.max(whole), zero),
        F.coalesce(F.min(scale), F.lit(DIGITS + 1)),
        F.coalesce(F.max(scale), zero),
    ]


def evidence(df: DataFrame, columns: Sequence[str] | None = None) -> dict[str, Evidence]:
    """What the text columns of ``df`` show, in one pass over those columns."""
    names = [
        f.name for f in df.schema.fields
        if isinstance(f.dataType, T.StringType) and (columns is None or f.name in columns)
    ]
    if not names:
        return {}
    row = _summary(df, names).first()
    return {name: Evidence(*found) for name, found in zip(names, row)}


def _summary(df: DataFrame, names: Sequence[str]) -> DataFrame:
    shown = df.select(*[_shown(F.col(quoted(c))).alias(f"c{i}") for i, c in enumerate(names)])
    return shown.agg(*[F.struct(*_aggregates(F.col(f"c{i}"))) for i in range(len(names))])


def infer_types(df: DataFrame, known: dict[str, Evidence] | None = None) -> DataFrame:
    """``column_name``, ``spark_type``, ``n_set`` for each column of ``df``; columns that are no
    text keep their type. ``known`` is evidence of rows seen before."""
    found = evidence(df)
    rows = []
    for f in df.schema.fields:
        here = found.get(f.name)
        if here is None:
            rows.append((f.name, f.dataType.simpleString(), None))
            continue
        here = here.join((known or {}).get(f.name, Evidence()))
        rows.append((f.name, here.type, here.n))
    return df.sparkSession.createDataFrame(
        rows, "column_name string, spark_type string, n_set long"
    )


def inferred_columns(df: DataFrame, columns: Sequence[MappedColumn]) -> list[MappedColumn]:
    """The mapped columns of ``df``, those that no rule knew with the type their text shows.

    Only columns of status ``unknown`` are read; one that shows a type gets the status
    ``inferred``, any other stays a string.
    """
    same = same_name(df.sparkSession)
    unknown = {
        c.column_name: next((n for n in df.columns if same(n, c.column_name)), c.column_name)
        for c in columns
        if c.status == "unknown" and c.spark_type == "string"
    }
    found = evidence(df, list(unknown.values())) if unknown else {}
    out = []
    for c in columns:
        shown = found.get(unknown.get(c.column_name, ""))
        if shown is not None and shown.type != "string":
            c = c._replace(spark_type=shown.type, status="inferred")
        out.append(c)
    return out


def narrowed(df: DataFrame, found: dict[str, Evidence] | None = None) -> DataFrame:
    """``df`` with its text columns cast to what they show; strict, as nothing can be lost."""
    found = evidence(df) if found is None else found
    columns = []
    for f in df.schema.fields:
        value = F.col(quoted(f.name))
        if f.name in found:
            value = value.cast(found[f.name].type).alias(f.name)
        columns.append(value)
    return df.select(*columns)

