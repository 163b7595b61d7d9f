"""Which rows two tables do not share, found by checksums of ever smaller buckets.

Rows go into buckets by the hash of their key. A bucket's checksum is the number of its rows
and two sums of their hashes: it does not depend on order, counts repeated rows, and adds up over
tasks, so both sides are summed in one aggregate and only a line per bucket is shuffled. Equal
buckets are done with. Those that differ are divided again, by further bits of the same hash,
until they hold few enough rows, or differences are so many that dividing tells little; these
rows alone are then compared, as a multiset.

Two tables with a difference that no checksum shows would need two 64-bit sums to agree by
chance. Rows with a null in the key are put into buckets by the hash of the whole row, so
however many there are, they do not meet in one. Maps are compared by their sorted entries.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from typeferry.functions.casts import quoted
from typeferry.functions.typenames import same_name
from typeferry.operators.scratch import landed, scratch_table

BITS = 12  # of the hash, for each level
LEVELS = 4
ROWS = 1_000_000  # compared directly
BROADCAST = 100_000  # buckets, two numbers each

# Names that no column of the tables should have.
PATH, ONE, TWO, SIGN = "diff_path_", "diff_one_", "diff_two_", "diff_sign_"


def _comparable(field: T.StructField) -> Column:
    column = F.col(quoted(field.name))
    if isinstance(field.dataType, T.MapType):
        return F.array_sort(F.map_entries(column)).alias(field.name)
    if isinstance(field.dataType, T.VariantType):
        return F.to_json(column).alias(field.name)
    return column


def _same_columns(source: DataFrame, target: DataFrame) -> list[str]:
    """The target's names in the order of the source."""
    same = same_name(source.sparkSession)
    found = {
        s.name: [t for t in target.schema.fields if same(s.name, t.name)]
        for s in source.schema.fields
    }
    if len(found) != len(target.columns) or any(len(f) != 1 for f in found.values()):
        raise ValueError(
            f"the tables differ in columns: {sorted(source.columns)}, {sorted(target.columns)}"
        )
    kinds = {s.name: s.dataType for s in source.schema.fields}
    other = [n for n, (f,) in found.items() if f.dataType != kinds[n]]
    if other:
        raise ValueError(f"the tables differ in the types of {other}")
    return [f.name for (f,) in found.values()]


def _side(df: DataFrame, names: Sequence[str], keys: Sequence[str], sign: int) -> DataFrame:
    rows = df.select(*[_comparable(f) for f in df.schema.fields]).toDF(*names)
    row = [F.col(quoted(c)) for c in names]
    at = F.xxhash64(*row)
    if keys:
        named = [F.col(quoted(k)) for k in keys]
        all_set = reduce(lambda a, b: a & b, [k.isNotNull() for k in named])
        at = F.when(all_set, F.xxhash64(*named)).otherwise(at)
    return rows.select(
        *row, at.alias(PATH), F.xxhash64(*row).alias(ONE),
        F.xxhash64(F.lit("second"), *row).alias(TWO), F.lit(sign).alias(SIGN),
    )


def _bucket(level: int, bits: int) -> Column:
    return F.shiftrightunsigned(PATH, 64 - min(63, level * bits))


def differing_buckets(both: DataFrame, level: int, bits: int = BITS) -> DataFrame:
    """``at`` and ``n_rows`` (of both sides) of the buckets whose checksums differ."""

    def total(column: Column) -> Column:
        return F.sum((column * F.col(SIGN)).cast("decimal(38,0)"))

    wide = [F.col(c).cast("decimal(20,0)") for c in (ONE, TWO)]
    return (
        both.groupBy(_bucket(level, bits).alias("at"))
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.sum(F.col(SIGN).cast("long")).alias("n"),
            *[total(w).alias(f"sum{i}") for i, w in enumerate(wide)],
        )
        .where("n <> 0 or sum0 <> 0 or sum1 <> 0")
        .select("at", "n_rows")
    )


def diff_rows(
    source: DataFrame,
    target: DataFrame,
    keys: Sequence[str] = (),
    bits: int = BITS,
    levels: int = LEVELS,
    rows_at_once: int = ROWS,
) -> DataFrame:
    """The rows that one side has more often than the other, in a scratch table.

    The columns of ``source``, and ``side`` (``source`` or ``target``: who has more),
    ``copies`` (how many more) and ``kind``: ``changed`` if the key has rows on either side
    here, else ``missing`` (from the target) or ``extra`` (in it). Without ``keys``, and for
    keys with a null, nothing is ever ``changed``.

    Both tables are read once for each level, once to see whether another pays, and a last
    time for the rows of the buckets that are left. They must not change meanwhile.
    """
    same = same_name(source.sparkSession)
    order = _same_columns(source, target)
    names = source.columns
    keys = [next((c for c in names if same(c, k)), k) for k in keys]
    unknown = [k for k in keys if k not in names]
    if unknown:
        raise ValueError(f"no columns {unknown}")
    aligned = target.select(*[F.col(quoted(c)) for c in order])
    both = _side(source, names, keys, 1).unionAll(_side(aligned, names, keys, -1))
    return _descend(both, names, keys, 1, bits, levels, rows_at_once)


def _descend(
    both: DataFrame,
    names: Sequence[str],
    keys: Sequence[str],
    level: int,
    bits: int,
    levels: int,
    rows_at_once: int,
) -> DataFrame:
    with landed(differing_buckets(both, level, bits), "buckets") as buckets:
        size, rows = buckets.agg(F.count(F.lit(1)), F.coalesce(F.sum("n_rows"), F.lit(0))).first()
        wanted = buckets.select("at")
        if size <= BROADCAST:
            wanted = F.broadcast(wanted)
        left = both.join(wanted, _bucket(level, bits) == F.col("at"), "left_semi")
        if rows > rows_at_once and level < levels and _pays(both, buckets, size, level, bits):
            return _descend(left, names, keys, level + 1, bits, levels, rows_at_once)
        out = scratch_table(both.sparkSession, "diff")
        with landed(_surplus(left, names), "surplus") as surplus:  # it is used twice
            _kinds(surplus, names, keys).write.saveAsTable(out)
    return both.sparkSession.table(out)


def _pays(both: DataFrame, buckets: DataFrame, size: int, level: int, bits: int) -> bool:
    """Whether the next level leaves so few buckets that they can be broadcast.

    Else a line for nearly each row would be exchanged to find them, and all rows to pick
    theirs: more than the rows themselves. One bucket, divided, stands for the others.
    """
    one = buckets.agg(F.min("at")).first()[0]
    part = both.where(_bucket(level, bits) == one)
    return differing_buckets(part, level + 1, bits).count() * size <= BROADCAST


def _surplus(rows: DataFrame, names: Sequence[str]) -> DataFrame:
    """Multiset difference, both ways: the copies of each row that one side has more."""
    row = [F.col(quoted(c)) for c in names]
    return (
        rows.groupBy(*row)
        .agg(F.sum(F.col(SIGN).cast("long")).alias("diff_n_"))
        .where("diff_n_ <> 0")
        .select(
            *row,
            F.when(F.col("diff_n_") > 0, "source").otherwise("target").alias("side"),
            F.abs("diff_n_").alias("copies"),
        )
    )


def _kinds(surplus: DataFrame, names: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """The surplus with the ``kind`` of each row."""
    row = [F.col(quoted(c)) for c in names]
    alone = F.when(F.col("side") == "source", "missing").otherwise("extra")
    if not keys:
        return surplus.withColumn("kind", alone)
    named = [F.col(quoted(k)).alias(f"key{i}_") for i, k in enumerate(keys)]
    changed = (
        surplus.groupBy(*named)
        .agg(F.count_distinct("side").alias("sides_"))
        .where("sides_ = 2")
        .drop("sides_")
    )
    match = reduce(
        lambda a, b: a & b, [F.col(quoted(k)) == F.col(f"key{i}_") for i, k in enumerate(keys)]
    )
    found = surplus.join(changed, match, "left")
    is_changed = F.col("key0_").isNotNull()
    return found.select(
        *row, "side", "copies", F.when(is_changed, "changed").otherwise(alone).alias("kind")
    )
