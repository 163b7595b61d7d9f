"""Tables whose columns and types grow with what comes in.

Two schemas are joined in a lattice of types: the join holds every value of either side exactly.
New columns are null in the rows there are. A table that only gains columns is altered in the
catalog, its files stay; where a type has to widen, the rows are written once in the wider type
and the table is swapped, as an overwrite does. A join that would need ``string`` for what
is no text is refused: text in the place of numbers is a decision, not a widening.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from typeferry.functions.casts import quoted
from typeferry.functions.typenames import same_name

_INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}
# The integers that a float and a double hold exactly.
_IN_FLOAT, _IN_DOUBLE = (T.ByteType, T.ShortType), (T.ByteType, T.ShortType, T.IntegerType)
MOST_DIGITS = 38


def _as_decimal(kind: T.DataType) -> tuple[int, int] | None:
    """Digits before and after the point."""
    if isinstance(kind, T.DecimalType):
        return kind.precision - kind.scale, kind.scale
    return (_DIGITS[type(kind)], 0) if isinstance(kind, _INTEGERS) else None


def wider(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The narrowest type that holds all values of both; none if there is no such type."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        element = wider(a.elementType, b.elementType)
        return element and T.ArrayType(element, a.containsNull or b.containsNull)
    if isinstance(a, T.MapType) and isinstance(b, T.MapType):
        key, value = wider(a.keyType, b.keyType), wider(a.valueType, b.valueType)
        both = key is not None and value is not None
        return T.MapType(key, value, a.valueContainsNull or b.valueContainsNull) if both else None
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return _wider_struct(a, b)
    if isinstance(a, _INTEGERS) and isinstance(b, _INTEGERS):
        return max(a, b, key=lambda t: _INTEGERS.index(type(t)))
    one, two = _as_decimal(a), _as_decimal(b)
    if one and two:
        whole, scale = max(one[0], two[0]), max(one[1], two[1])
        return T.DecimalType(whole + scale, scale) if whole + scale <= MOST_DIGITS else None
    return _wider_approximate(a, b) or _wider_approximate(b, a)


def _wider_approximate(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """Of a floating number or a time and something else."""
    if isinstance(a, T.DoubleType) and isinstance(b, (T.FloatType, *_IN_DOUBLE)):
        return a
    if isinstance(a, T.FloatType) and isinstance(b, _IN_DOUBLE):
        return a if isinstance(b, _IN_FLOAT) else T.DoubleType()
    if isinstance(a, (T.TimestampType, T.TimestampNTZType)) and isinstance(b, T.DateType):
        return a
    return None


def _wider_struct(a: T.StructType, b: T.StructType) -> T.StructType | None:
    """Fields by name: those of ``a``, then the new ones of ``b``; what is missing may be null."""
    theirs = {f.name: f for f in b.fields}
    fields = []
    for f in a.fields:
        other = theirs.pop(f.name, None)
        kind = wider(f.dataType, other.dataType) if other else f.dataType
        if kind is None:
            return None
        fields.append(T.StructField(f.name, kind, True))
    return T.StructType([*fields, *(T.StructField(f.name, f.dataType, True) for f in theirs.values())])


def joined_schema(
    present: T.StructType, incoming: T.StructType, same: Callable[[str, str], bool]
) -> T.StructType:
    """The columns of ``present``, widened, then those that only ``incoming`` has."""
    left = list(incoming.fields)
    fields = []
    for f in present.fields:
        found = [x for x in left if same(x.name, f.name)]
        if len(found) > 1:
            raise ValueError(f"two columns {[x.name for x in found]} for {f.name}")
        kind = f.dataType
        if found:
            left.remove(found[0])
            kind = wider(f.dataType, found[0].dataType)
            if kind is None:
                raise ValueError(
                    f"{f.name}: no type holds {f.dataType.simpleString()} "
                    f"and {found[0].dataType.simpleString()}"
                )
        fields.append(T.StructField(f.name, kind, f.nullable or not found, f.metadata))
    return T.StructType([*fields, *(T.StructField(f.name, f.dataType, True) for f in left)])


def fitted(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` with the columns and types of ``schema``, which must be wider; nulls for what is
    missing, also within structs."""
    same = same_name(df.sparkSession)
    columns = []
    for f in schema.fields:
        found = [x for x in df.schema.fields if same(x.name, f.name)]
        value = F.col(quoted(found[0].name)) if found else F.lit(None)
        kind = found[0].dataType if found else T.NullType()
        columns.append(_widened(value, kind, f.dataType).alias(f.name))
    return df.select(*columns)


def _widened(value: Column, kind: T.DataType, to: T.DataType) -> Column:
    if kind == to:
        return value
    if isinstance(kind, T.StructType) and isinstance(to, T.StructType):
        names = {f.name: f.dataType for f in kind.fields}
        fields = [
            _widened(value[f.name], names[f.name], f.dataType).alias(f.name)
            if f.name in names
            else F.lit(None).cast(f.dataType).alias(f.name)
            for f in to.fields
        ]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(kind, T.ArrayType) and isinstance(to, T.ArrayType):
        return F.transform(value, lambda v: _widened(v, kind.elementType, to.elementType))
    return value.cast(to)
