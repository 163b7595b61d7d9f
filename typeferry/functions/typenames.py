"""Column expressions over PostgreSQL type names, and the way back from Spark types."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Everything Unicode calls white space, and the four ASCII separators.
_BLANK = r"[\s\x1c-\x1f]"
_OUTER_BLANKS = rf"(?U)\A{_BLANK}+|{_BLANK}+\z"
_ARRAY_SUFFIX = rf"(?U)(?:{_BLANK}*\[\])+\z"


def normalised(type_name: Column) -> Column:
    """Lower case, no blanks around."""
    # Spaces are quick to trim. The slow pattern is for names that still begin or end
    # with something else than a visible ASCII character.
    trimmed = F.trim(type_name)
    clean = F.ascii(trimmed).between(33, 126) & F.ascii(F.right(trimmed, F.lit(1))).between(33, 126)
    return F.lower(
        F.when(clean, trimmed).otherwise(F.regexp_replace(type_name, _OUTER_BLANKS, ""))
    )


def without_suffix(name: Column) -> Column:
    """``integer [][]`` -> ``integer``."""
    # Few names have a suffix: here and below, test before working on it.
    cut = F.regexp_replace(name, _ARRAY_SUFFIX, "")
    return F.when(name.endswith("[]"), cut).otherwise(name)


def suffix_dimensions(name: Column, bare: Column) -> Column:
    """How many ``[]`` were cut from ``name`` to leave ``bare``."""
    suffix = F.substr(name, F.length(bare) + 1)
    pairs = F.length(suffix) - F.length(F.replace(suffix, F.lit("["), F.lit("")))
    return F.when(name.endswith("[]"), pairs).otherwise(F.lit(0))


def split_suffix(type_name: str) -> tuple[str, int]:
    """One name, normalised, without its ``[]``; and how many there were."""
    name = type_name.strip().lower()
    bare = re.sub(r"(?:\s*\[\])+\Z", "", name)
    return bare, name[len(bare) :].count("[")


def array_of(element: Column, dimensions: Column) -> Column:
    """``int``, 2 -> ``array<array<int>>``."""
    nested = F.concat(
        F.repeat(F.lit("array<"), dimensions), element, F.repeat(F.lit(">"), dimensions)
    )
    return F.when(dimensions > 0, nested).otherwise(element)


_SPELLING = {
    T.ByteType: "smallint",
    T.ShortType: "smallint",
    T.IntegerType: "integer",
    T.LongType: "bigint",
    T.FloatType: "real",
    T.DoubleType: "double precision",
    T.DecimalType: "numeric",
    T.StringType: "text",
    T.VarcharType: "character varying",
    T.CharType: "character",
    T.BinaryType: "bytea",
    T.BooleanType: "boolean",
    T.DateType: "date",
    T.TimestampType: "timestamp without time zone",
    T.TimestampNTZType: "timestamp without time zone",
}


def postgres_spelling(data_type: T.DataType) -> str:
    """The PostgreSQL name of a Spark type; ``USER-DEFINED`` where there is none."""
    if isinstance(data_type, T.ArrayType):
        return postgres_spelling(data_type.elementType) + "[]"
    return _SPELLING.get(type(data_type), "USER-DEFINED")


def innermost(data_type: T.DataType) -> T.DataType:
    while isinstance(data_type, T.ArrayType):
        data_type = data_type.elementType
    return data_type


def same_name(spark: SparkSession) -> Callable[[str, str], bool]:
    """Whether two column names are one, by the session's ``spark.sql.caseSensitive``."""
    if spark.conf.get("spark.sql.caseSensitive").lower() == "true":
        return lambda a, b: a == b
    return lambda a, b: a.lower() == b.lower()
