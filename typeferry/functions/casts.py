"""Casts from the type a value was read with to the type its column was mapped to."""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TIMESTAMPS = (T.TimestampType, T.TimestampNTZType)
_TIMES = {"time", "time without time zone", "time with time zone", "timetz"}
_INTEGRALS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_NUMBERS = (*_INTEGRALS, T.FloatType, T.DoubleType, T.DecimalType)


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def text_literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _form(
    read_as: T.DataType, base_type: str | None
) -> tuple[Callable[[Column], Column], T.DataType] | None:
    if isinstance(read_as, T.ArrayType):
        element = _form(read_as.elementType, base_type)
        if element is None:
            return None
        change, element_type = element
        return (lambda v: F.transform(v, change)), T.ArrayType(element_type)
    if base_type == "money" and isinstance(read_as, T.StringType):
        return (lambda v: F.regexp_replace(v, r"[$,]", "")), read_as
    if base_type in _TIMES and isinstance(read_as, _TIMESTAMPS):
        return (lambda v: F.date_format(v, "HH:mm:ss.SSSSSS")), T.StringType()
    if base_type == "bit" and isinstance(read_as, T.BooleanType):
        return (lambda v: v.cast("int").cast("string")), T.StringType()
    return None


def castable(
    value: Column, read_as: T.DataType, base_type: str | None
) -> tuple[Column, T.DataType]:
    """The value in a form Spark's cast understands, and the type of that form.

    Only three PostgreSQL types need it: money text, times of day read as
    timestamps, and single bits read as booleans.
    """
    form = _form(read_as, base_type)
    if form is None:
        return value, read_as
    change, formed_type = form
    return change(value), formed_type


def same_type(read_as: T.DataType, target: T.DataType) -> bool:
    return read_as.simpleString() == target.simpleString()


def can_lose(read_as: T.DataType, target: T.DataType) -> bool:
    """Whether some value of ``read_as`` has no value in ``target``."""
    if isinstance(read_as, T.ArrayType) and isinstance(target, T.ArrayType):
        return can_lose(read_as.elementType, target.elementType)
    if same_type(read_as, target) or isinstance(target, T.StringType):
        return False
    if isinstance(read_as, _INTEGRALS) and isinstance(target, _INTEGRALS):
        return _INTEGRALS.index(type(read_as)) > _INTEGRALS.index(type(target))
    if isinstance(read_as, (*_INTEGRALS, T.FloatType)) and isinstance(
        target, (T.FloatType, T.DoubleType)
    ):
        return False
    if isinstance(read_as, (*_TIMESTAMPS, T.DateType)) and isinstance(
        target, (*_TIMESTAMPS, T.DateType)
    ):
        return False
    return True


def is_lost(value: Column, read_as: T.DataType, target: T.DataType) -> Column:
    """True where a value, or any element of an array, becomes null in the cast."""
    return _lost_pair(value, lenient_cast(value, read_as, target), target)


def _lost_pair(value: Column, tried: Column, target: T.DataType) -> Column:
    gone = value.isNotNull() & tried.isNull()
    if not isinstance(target, T.ArrayType):
        return gone
    pairs = F.zip_with(value, tried, lambda a, b: _lost_pair(a, b, target.elementType))
    return gone | F.coalesce(F.exists(pairs, lambda lost: lost), F.lit(False))


def can_alter(read_as: T.DataType, target: T.DataType) -> bool:
    """Whether some value of ``read_as`` becomes another value in ``target``, not null.

    Text is not a number or a time: what it spells may be spelt otherwise. Only what the
    target drops of it, decimal places or a time of day, is an altered value.
    """
    if isinstance(read_as, T.ArrayType) and isinstance(target, T.ArrayType):
        return can_alter(read_as.elementType, target.elementType)
    if same_type(read_as, target) or isinstance(target, T.StringType):
        return False
    if isinstance(read_as, T.StringType):
        return isinstance(target, (T.DecimalType, T.DateType))
    if isinstance(target, T.DateType):
        return isinstance(read_as, _TIMESTAMPS)
    if not isinstance(read_as, _NUMBERS):
        return False
    if isinstance(target, T.BooleanType):
        return True
    if isinstance(read_as, _INTEGRALS):
        if isinstance(target, T.FloatType):
            return not isinstance(read_as, (T.ByteType, T.ShortType))
        return isinstance(target, T.DoubleType) and isinstance(read_as, T.LongType)
    if isinstance(read_as, T.DecimalType):
        if isinstance(target, T.DecimalType):
            return target.scale < read_as.scale
        if isinstance(target, (T.FloatType, T.DoubleType)):
            return read_as.precision > (6 if isinstance(target, T.FloatType) else 15)
        return read_as.scale > 0
    return not (isinstance(read_as, T.FloatType) and isinstance(target, T.DoubleType))


def is_altered(value: Column, read_as: T.DataType, target: T.DataType) -> Column:
    """True where a value, or any element of an array, is another one after the cast."""
    return F.coalesce(
        _altered_pair(value, lenient_cast(value, read_as, target), read_as, target), F.lit(False)
    )


def _altered_pair(
    value: Column, tried: Column, read_as: T.DataType, target: T.DataType
) -> Column:
    if isinstance(target, T.ArrayType):
        inner = read_as.elementType, target.elementType
        pairs = F.zip_with(value, tried, lambda a, b: _altered_pair(a, b, *inner))
        return F.exists(pairs, lambda altered: F.coalesce(altered, F.lit(False)))
    if isinstance(read_as, T.StringType):
        if isinstance(target, T.DecimalType):
            # All digits before the point that the target has, and the most after it.
            wide = T.DecimalType(38, 38 - (target.precision - target.scale))
            return value.try_cast(wide) != tried
        return value.try_cast(T.TimestampType()) != tried.cast(T.TimestampType())
    if isinstance(read_as, _INTEGRALS) and not isinstance(target, T.BooleanType):
        # As integers of any size: a cast back to a long would cut 2**63 to fit.
        whole = T.DecimalType(38, 0)
        return tried.isNotNull() & ~tried.try_cast(whole).eqNullSafe(value.cast(whole))
    return tried.isNotNull() & ~tried.try_cast(read_as).eqNullSafe(value)


def strict_cast(
    value: Column,
    read_as: T.DataType,
    target: T.DataType,
    name: str,
    ansi: bool,
    rounding: bool = False,
) -> Column:
    """A cast that fails the job rather than losing a value, in either ANSI mode, or, but
    for ``rounding``, altering one."""
    if same_type(read_as, target):
        return value
    kind = target.simpleString()
    if ansi or not can_lose(read_as, target):
        cast = value.cast(target)
    else:
        message = f"column {name}: a value does not fit {kind}"
        cast = F.when(
            is_lost(value, read_as, target), F.raise_error(F.lit(message))
        ).otherwise(lenient_cast(value, read_as, target))
    if rounding or not can_alter(read_as, target):
        return cast
    message = f"column {name}: a value would be altered as {kind}"
    altered = is_altered(value, read_as, target)
    return F.when(altered, F.raise_error(F.lit(message))).otherwise(cast)


def lenient_cast(value: Column, read_as: T.DataType, target: T.DataType) -> Column:
    """A cast that gives null for a value the target cannot hold.

    Spark raises and catches an exception for each such value, which costs some twenty
    times the cast itself. A test that only such values can meet goes before it.
    """
    if same_type(read_as, target):
        return value
    hopeless = _hopeless(value, read_as, target)
    tried = value.try_cast(target)
    return tried if hopeless is None else F.when(hopeless, F.lit(None)).otherwise(tried)


_RANGES = {
    T.ByteType: (-(2**7), 2**7 - 1),
    T.ShortType: (-(2**15), 2**15 - 1),
    T.IntegerType: (-(2**31), 2**31 - 1),
    T.LongType: (-(2**63), 2**63 - 1),
}
_CONTROLS = r"[\x00-\x20\x7f]*"
_TRUTH_WORDS = rf"(?i)\A{_CONTROLS}(?:t|true|y|yes|1|f|false|n|no|0){_CONTROLS}\z"


def _hopeless(value: Column, read_as: T.DataType, target: T.DataType) -> Column | None:
    if isinstance(read_as, T.StringType):
        if isinstance(target, T.BooleanType):
            return ~value.rlike(_TRUTH_WORDS)
        if isinstance(target, (T.FloatType, T.DoubleType)):
            return ~value.rlike(r"\p{Nd}|(?i:inf|nan)")
        if isinstance(target, (*_INTEGRALS, T.DecimalType)):
            return ~value.rlike(r"\p{Nd}")
        return None
    if isinstance(target, T.DecimalType) and isinstance(read_as, _NUMBERS):
        limit = 10 ** (target.precision - target.scale)
        if isinstance(read_as, _INTEGRALS):
            if limit > _RANGES[type(read_as)][1]:
                return None
            return (value >= limit) | (value <= -limit)
        if isinstance(read_as, T.DecimalType):
            return F.abs(value) >= F.lit(Decimal(limit)) if limit < 10**38 else None
        return F.abs(value) >= F.lit(float(limit))
    if isinstance(target, _INTEGRALS) and isinstance(read_as, _NUMBERS):
        low, high = _RANGES[type(target)]
        if isinstance(read_as, _INTEGRALS):
            return (value < low) | (value > high)
        if isinstance(read_as, T.DecimalType):
            return (value <= F.lit(Decimal(low - 1))) | (value >= F.lit(Decimal(high + 1)))
        # As floats, low - 1 may round to low, which fits: leave that edge to the cast.
        return (value < F.lit(float(low - 1))) | (value > F.lit(float(high + 1)))
    return None
