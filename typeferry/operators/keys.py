"""Which columns can be the key of a merge: the smallest sets that no two rows share.

The search goes up level by level, from single columns to pairs and so on, and leaves out every
set that holds a key found before. Most sets are ruled out without looking at them: as many
different values as there are rows are needed, and a set has at most the product of its
columns'. The rest of a level is estimated in one pass, by a HyperLogLog sketch for each set,
and only sets whose estimate comes near the number of rows are counted exactly. A set that is
ruled out wrongly would need an estimate ``MARGIN`` standard errors too low.

Columns that have nulls are no part of a key, since a null equals nothing in a merge.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import batched, combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from typeferry.functions.casts import quoted

ERROR = 0.02  # standard error of a sketch
MARGIN = 6  # standard errors
SKETCHES = 100  # in one pass

KEYS = "columns array<string>, n_rows long"


def _can_be_key(kind: T.DataType) -> bool:
    return not isinstance(kind, (T.MapType, T.VariantType))


def _estimates(df: DataFrame, sets: Sequence[tuple[str, ...]]) -> dict[tuple[str, ...], int]:
    found = {}
    for some in batched(sets, SKETCHES):
        sketches = [
            F.approx_count_distinct(F.xxhash64(*[F.col(quoted(c)) for c in columns]), ERROR)
            for columns in some
        ]
        found |= dict(zip(some, df.agg(*sketches).first()))
    return found


def is_unique(df: DataFrame, columns: Sequence[str]) -> bool:
    """Exactly: no two rows have the same values there. Partial counts come before the exchange."""
    repeated = (
        df.groupBy(*[F.col(quoted(c)) for c in columns])
        .agg(F.count(F.lit(1)).alias("n_rows_"))
        .where("n_rows_ > 1")
    )
    return repeated.isEmpty()


def find_keys(df: DataFrame, width: int = 3) -> list[tuple[str, ...]]:
    """All minimal keys of up to ``width`` columns, narrow ones first, in the table's order.

    Of a table without rows nothing can be said: it has none.
    """
    fields = [f.name for f in df.schema.fields if _can_be_key(f.dataType)]
    if not fields:
        return []
    counts = df.agg(F.count(F.lit(1)), *[F.count(quoted(c)) for c in fields]).first()
    n = counts[0]
    columns = [c for c, full in zip(fields, counts[1:]) if full == n]
    if not n:
        return []
    least = n * (1 - MARGIN * ERROR)
    keys: list[tuple[str, ...]] = []
    about: dict[tuple[str, ...], int] = {}
    for size in range(1, width + 1):
        candidates = [
            s
            for s in combinations(columns, size)
            if not any(set(k) <= set(s) for k in keys) and _product(about, s) >= least
        ]
        if not candidates:
            continue
        found = _estimates(df, candidates)
        about |= found
        keys += [s for s in candidates if found[s] >= least and is_unique(df, s)]
    return keys


def _product(about: dict[tuple[str, ...], int], columns: tuple[str, ...]) -> float:
    """At most so many different values, by the sketches of narrower sets, read high."""
    high = 1 + MARGIN * ERROR
    if len(columns) == 1:
        return float("inf")
    most = float("inf")
    for i, column in enumerate(columns):
        rest = columns[:i] + columns[i + 1 :]
        if rest in about and (column,) in about:
            most = min(most, about[rest] * high * about[column,] * high)
        elif rest not in about:
            # The rest was ruled out itself: its own bound goes on.
            most = min(most, _product(about, rest) * about[column,] * high)
    return most


def keys_of_tables(tables: dict[str, DataFrame], width: int = 3) -> DataFrame:
    """``table_name``, ``columns``, of every minimal key of every table."""
    rows = [(name, list(k)) for name, df in tables.items() for k in find_keys(df, width)]
    spark = next(iter(tables.values())).sparkSession
    return spark.createDataFrame(rows, "table_name string, columns array<string>")
