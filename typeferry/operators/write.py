"""Writing tables: replace, add, merge by key."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager, nullcontext
from dataclasses import dataclass, field
from datetime import datetime, timezone
from functools import reduce
from threading import Lock

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from typeferry.functions.casts import quoted, strict_cast, text_literal
from typeferry.functions.typenames import same_name
from typeferry.operators import exchange, once
from typeferry.operators.buckets import BUCKET, Buckets, read_table, visible, with_bucket, without
from typeferry.operators.evolve import fitted, joined_schema
from typeferry.operators.scratch import landed

MODES = ("overwrite", "append", "merge", "ignore", "error", "errorifexists", "default")

# Formats whose own commit replaces or merges a table in one step.
TRANSACTIONAL = ("delta", "iceberg")

# Stores that rename a folder by copying every byte of it.
COPYING = ("s3", "s3a", "s3n", "gs", "oss", "cos", "cosn", "obs", "swift")

STAGED, OLD = "__staged_", "__old_"

OVERWRITE_SETTING = "spark.sql.sources.partitionOverwriteMode"

# Properties that Spark or a metastore keeps for itself.
OWN_PROPERTIES = ("transient_lastDdlTime", "numFiles", "numRows", "totalSize", "rawDataSize",
                  "COLUMN_STATS_ACCURATE", "bucketing_version")


@dataclass(frozen=True)
class Layout:
    """What a table is besides its rows."""

    partition_by: Sequence[str] = ()
    fmt: str = "parquet"
    comment: str | None = None
    properties: dict[str, str] = field(default_factory=dict)
    column_comments: dict[str, str] = field(default_factory=dict)

    @property
    def buckets(self) -> Buckets | None:
        return Buckets.of(self.properties)


def layout_of(spark: SparkSession, table: str) -> Layout:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()
    # After the last such line: a column may have any name.
    start = max(i for i, r in enumerate(rows) if r["col_name"].startswith("# Detailed Table"))
    details = {r["col_name"]: r["data_type"] for r in rows[start:]}
    found = spark.sql(f"SHOW TBLPROPERTIES {table}").collect()
    properties = {
        r["key"]: r["value"]
        for r in found
        if r["key"] not in (*OWN_PROPERTIES, exchange.RELOCATING)
        and not r["key"].startswith("spark.sql.")
    }
    columns = spark.catalog.listColumns(table)
    return Layout(
        [c.name for c in columns if c.isPartition],
        details["Provider"].lower(),
        details.get("Comment"),
        properties,
        {c.name: c.description for c in columns if c.description},
    )


def write_table(
    df: DataFrame,
    target: str,
    mode: str = "overwrite",
    partition_by: Sequence[str] | None = None,
    fmt: str | None = None,
    keys: Sequence[str] = (),
    stable: bool = False,
    buckets: Buckets | None = None,
    evolve: bool = False,
) -> None:
    """Saves ``df`` as the table ``target``.

    ``overwrite`` builds the new table beside the old one and then puts it in its place:
    at every moment there is the old table, the new one, or (for a moment between two
    renames) both under other names, and the next run puts one back; it may read the
    table it replaces. The table keeps its partitioning, format, comments and properties,
    unless ``partition_by`` or ``fmt`` are given; rights stay with the catalog. A new
    table is parquet without partitions, unless they say otherwise.
    ``append`` and ``merge`` keep the format and the partitioning the table has; ``merge``
    needs ``keys``, and ``merge_table`` explains ``stable``.
    ``buckets`` stores a new or overwritten table by the hash of its merge key, in a column
    that ``read_table`` leaves out; an overwrite keeps them, unless it is given
    ``partition_by`` (none are an empty list). With ``evolve`` an append or a merge may bring
    new columns and wider types, and may lack columns (``evolve_table``).

    On stores that rename by copying, an existing table is not overwritten: use a
    transactional format there.
    """
    if mode not in MODES:
        raise ValueError(f"unknown write mode {mode!r}; use one of {', '.join(MODES)}")
    if mode == "merge":
        merge_table(df, target, keys, partition_by, fmt, stable, buckets, evolve)
        return
    if buckets and (partition_by or fmt in TRANSACTIONAL):
        raise ValueError("buckets are for tables without partitions, in a format without merge")
    spark = df.sparkSession
    finish_writes(spark, target)
    exists = spark.catalog.tableExists(target)
    if not exists:
        if buckets:
            df, partition_by = with_bucket(df, buckets), [BUCKET]
        _create(df, target, partition_by or (), fmt or "parquet", mode, buckets)
        return
    if mode not in ("overwrite", "append"):
        _save(df, target, mode, partition_by or (), fmt or "parquet")
        return
    if mode == "append" and evolve:
        df = fitted(df, evolve_table(spark, target, df.schema))
    layout = layout_of(spark, target)
    if mode == "append":
        if layout.buckets:
            rows = _aligned(df, read_table(spark, target))
            df, partition_by = with_bucket(rows, layout.buckets), [BUCKET]
        _save(df, target, mode, partition_by or layout.partition_by, layout.fmt)
        return
    if partition_by is None:
        buckets = buckets or layout.buckets
    if buckets:
        df, partition_by = with_bucket(df, buckets), [BUCKET]
    new = Layout(
        layout.partition_by if partition_by is None else partition_by,
        fmt or layout.fmt,
        layout.comment,
        without(layout.properties) | (buckets.properties() if buckets else {}),
        layout.column_comments,
    )
    if new.fmt in TRANSACTIONAL:
        _save(df, target, mode, new.partition_by, new.fmt)
    else:
        _replace(df, target, new)


def append_once(
    df: DataFrame,
    target: str,
    batch: str,
    partition_by: Sequence[str] | None = None,
    fmt: str | None = None,
) -> bool:
    """Appends the rows of a batch unless one of its name has been; whether these were added.

    Cut off and run again, or run by two writers at a time, a batch is in the table once
    (``once``). A missing target is created. An overwrite starts anew: it forgets the batches.
    """
    spark = df.sparkSession
    finish_writes(spark, target)
    if not spark.catalog.tableExists(target):
        # Not of the rows: nothing of theirs may run before they are written.
        write_table(spark.createDataFrame([], df.schema), target, "error", partition_by, fmt)
    layout = layout_of(spark, target)
    if layout.fmt in TRANSACTIONAL:
        raise ValueError(f"{layout.fmt} has its own transactions: name the batch there")
    if once.is_committed(spark, target, batch):
        return False
    rows = _aligned(df, read_table(spark, target))
    if layout.buckets:
        rows = with_bucket(rows, layout.buckets)
    rows = rows.select(*[F.col(quoted(c)) for c in spark.table(target).columns])
    run = _run_name()
    staged = _suffixed(target, STAGED + run)
    once.stage_batch(spark, _spread(rows, layout.partition_by), target, batch, run, staged)
    added = once.commit_batch(spark, exchange.location_of(spark, target), batch, run)
    once.finish_batches(spark, target, layout.partition_by)
    return added


def evolve_table(spark: SparkSession, target: str, incoming: T.StructType) -> T.StructType:
    """Makes ``target`` hold rows of ``incoming`` too, and returns its schema then.

    New columns are a change of the catalog alone. Where types have to be wider, the table is
    written once more and swapped.
    """
    present = read_table(spark, target)
    schema = joined_schema(present.schema, incoming, same_name(spark))
    kinds = {f.name: f.dataType for f in present.schema.fields}
    if any(f.name in kinds and f.dataType != kinds[f.name] for f in schema.fields):
        layout, rows = layout_of(spark, target), fitted(present, schema)
        if layout.buckets:
            rows = with_bucket(rows, layout.buckets)
        if layout.fmt in TRANSACTIONAL:
            _save(rows, target, "overwrite", layout.partition_by, layout.fmt)
        else:
            _replace(rows, target, layout, carry=True)
    elif len(schema.fields) > len(kinds):
        added = [f for f in schema.fields if f.name not in kinds]
        columns = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in added)
        spark.sql(f"ALTER TABLE {target} ADD COLUMNS ({columns})")
        spark.catalog.refreshTable(target)
    return schema


def _spread(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Rows of a partition brought together, in files of the advisory size.

    The rebalance hint lets Spark split a heavy partition over many tasks, which a
    plain repartition by the columns would give to one. It does so only in adaptive
    execution: without it rows stay where they are, and each task writes its own files.
    """
    adaptive = df.sparkSession.conf.get("spark.sql.adaptive.enabled").lower() == "true"
    if not partition_by or not adaptive:
        return df
    return df.hint("rebalance", *[F.col(quoted(c)) for c in partition_by])


def _save(df: DataFrame, target: str, mode: str, partition_by: Sequence[str], fmt: str) -> None:
    writer = _spread(df, partition_by).write.format(fmt).mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(target)


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


# -- replacing a table ---------------------------------------------------------------


def _suffixed(target: str, suffix: str) -> str:
    return f"{target[:-1]}{suffix}`" if target.endswith("`") else f"{target}{suffix}"


def _run_name() -> str:
    """A name of its own for each run: tasks of a failed one may still leave files behind."""
    stamp = datetime.now(timezone.utc).strftime("%Y%m%d%H%M%S")
    return f"{stamp}_{uuid.uuid4().hex}"


def _store(spark: SparkSession, table: str | None = None) -> str:
    """The kind of store a table is in, or would be in."""
    if table is None:
        return spark.conf.get("spark.sql.warehouse.dir").partition(":")[0]
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'Location'")
    return described.collect()[-1]["data_type"].partition(":")[0]


def _create(
    df: DataFrame,
    target: str,
    partition_by: Sequence[str],
    fmt: str,
    mode: str,
    buckets: Buckets | None = None,
) -> None:
    """A new table. Spark names it in the catalog when all its rows are written."""
    spark = df.sparkSession
    bucketed = Layout(properties=buckets.properties() if buckets else {})
    if fmt in TRANSACTIONAL or _store(spark) in COPYING:
        _save(df, target, mode, partition_by, fmt)
        _dress(spark, target, bucketed)
        return
    staged = _suffixed(target, STAGED + _run_name())
    _save(df, staged, "error", partition_by, fmt)
    if buckets:
        _dress(spark, staged, bucketed)
    _rename(spark, staged, target)


def _replace(df: DataFrame, target: str, layout: Layout, carry: bool = False) -> None:
    """Overwrites a table. With ``carry`` it is the same table still: its batches count."""
    spark = df.sparkSession
    managed = spark.catalog.getTable(target).tableType != "EXTERNAL"
    if managed and _store(spark, target) in COPYING:
        raise ValueError(
            f"{target}: this store renames a table by copying it; "
            f"use one of the formats {', '.join(TRANSACTIONAL)} to overwrite or merge"
        )
    same = same_name(spark)
    absent = [c for c in layout.partition_by if not any(same(c, d) for d in df.columns)]
    if absent:
        raise ValueError(f"{target} is partitioned by {absent}, which the new rows lack")
    run = _run_name()
    staged, old = _suffixed(target, STAGED + run), _suffixed(target, OLD + run)
    _save(_commented(df, layout), staged, "error", layout.partition_by, layout.fmt)
    if carry:
        once.carry_batches(spark, target, staged)
    if not managed:
        # Its folder is not ours to move: copy into it.
        rows = spark.table(staged).select(*[F.col(quoted(c)) for c in spark.table(target).columns])
        with _setting(spark, OVERWRITE_SETTING, "static"):
            rows.write.insertInto(target, overwrite=True)
        if carry:
            once.carry_batches(spark, staged, target)
        spark.sql(f"DROP TABLE {staged}")
        return
    _dress(spark, staged, layout)
    _rename(spark, target, old)
    _put(spark, staged, target)
    spark.sql(f"DROP TABLE IF EXISTS {old}")


def _commented(df: DataFrame, layout: Layout) -> DataFrame:
    same = same_name(df.sparkSession)
    comments = {
        f.name: c for f in df.schema.fields for n, c in layout.column_comments.items()
        if same(f.name, n) and "comment" not in f.metadata
    }
    if not comments:
        return df
    columns = []
    for f in df.schema.fields:
        value = F.col(quoted(f.name))
        if f.name in comments:
            value = value.alias(f.name, metadata={**f.metadata, "comment": comments[f.name]})
        columns.append(value)
    return df.select(*columns)


def _dress(spark: SparkSession, table: str, layout: Layout) -> None:
    """Gives a table the comment and the properties of a layout."""
    if layout.comment is not None:
        spark.sql(f"COMMENT ON TABLE {table} IS {text_literal(layout.comment)}")
    if layout.properties:
        pairs = [f"{text_literal(k)} = {text_literal(v)}" for k, v in layout.properties.items()]
        spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({', '.join(pairs)})")


def _rename(spark: SparkSession, table: str, to: str) -> None:
    spark.sql(f"ALTER TABLE {table} RENAME TO {to}")
    _find_partitions(spark, to)
    spark.catalog.refreshTable(to)


def _find_partitions(spark: SparkSession, table: str) -> None:
    """The catalog may still hold the folders of a table's old name."""
    partitions = partition_columns(spark, table)
    if partitions:
        spark.sql(f"MSCK REPAIR TABLE {table} SYNC PARTITIONS")
        exchange.relocate(spark, table, partitions)


def _put(spark: SparkSession, staged: str, target: str) -> None:
    """The staged table in the place of the target; another run may have done so already."""
    try:
        _rename(spark, staged, target)
    except AnalysisException:
        if spark.catalog.tableExists(staged) or not spark.catalog.tableExists(target):
            raise


def _beside(spark: SparkSession, target: str, mark: str) -> dict[str, str]:
    """Tables that runs have put beside the target, by run."""
    database, _, name = target.replace("`", "").rpartition(".")
    found = spark.catalog.listTables(database or None, f"{name}{mark}*")
    start = len(name) + len(mark)
    return {t.name[start:]: _suffixed(target, t.name[len(name) :]) for t in found}


def finish_swap(spark: SparkSession, target: str) -> None:
    """Finishes the swap of a run that was cut off in it, its driver lost.

    The old table, renamed, is the proof that a swap began. Where the target is gone, the
    staged table of that run takes its place, or else the old one takes it back. Where it
    is there, an old table whose staged one is gone has been replaced, and goes. Nothing
    is done about staged tables of other runs: they may be at work.
    """
    old = _beside(spark, target, OLD)
    if not old:
        return
    staged = _beside(spark, target, STAGED)
    if not spark.catalog.tableExists(target):
        run = max(old)
        back = staged.pop(run, old[run])
        # Its partitions may have to be found anew under the old name, cut off or not.
        exchange.set_relocating(spark, back, True)
        _put(spark, back, target)
    for run, table in old.items():
        if run not in staged:
            spark.sql(f"DROP TABLE IF EXISTS {table}")


def finish_writes(spark: SparkSession, target: str) -> None:
    """Finishes what runs that were cut off have begun: swaps, and exchanges of partitions."""
    finish_swap(spark, target)
    if not spark.catalog.tableExists(target):
        return
    # One statement and two looks for a folder, as every write begins with this.
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {target}").collect()
    details = {r["col_name"]: r["data_type"] for r in described}
    if exchange.RELOCATING in details.get("Table Properties", ""):
        _find_partitions(spark, target)
        exchange.set_relocating(spark, target, False)
    location = details.get("Location", "").rstrip("/")
    exchanged, batches = (
        bool(location) and exchange.path_exists(spark, f"{location}/{folder}")
        for folder in (exchange.FOLDER, f"{once.FOLDER}/runs")
    )
    if exchanged or batches:
        partitions = partition_columns(spark, target)
        if exchanged:
            exchange.finish_exchanges(spark, target, partitions)
        once.finish_batches(spark, target, partitions)


def clean_staged(spark: SparkSession, target: str) -> int:
    """Drops what failed runs have left beside the target and in its folder; none may be at
    work. How many."""
    finish_writes(spark, target)
    left = [*_beside(spark, target, STAGED).values(), *_beside(spark, target, OLD).values()]
    for table in left:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
    exists = spark.catalog.tableExists(target)
    if exists and layout_of(spark, target).fmt not in TRANSACTIONAL:
        runs = exchange.clean_runs(spark, target) + once.clean_batches(spark, target)
        return len(left) + runs
    return len(left)


_one_setting = Lock()


@contextmanager
def _setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A session setting for a while; threads that need one take turns."""
    with _one_setting:
        before = spark.conf.get(name)
        spark.conf.set(name, value)
        try:
            yield
        finally:
            spark.conf.set(name, before)


# -- merging by key ------------------------------------------------------------------


def merge_table(
    df: DataFrame,
    target: str,
    keys: Sequence[str],
    partition_by: Sequence[str] | None = None,
    fmt: str | None = None,
    stable: bool = False,
    buckets: Buckets | None = None,
    evolve: bool = False,
) -> None:
    """Rows of ``df`` replace the rows of ``target`` with equal keys, or are added.

    Null keys equal nothing, so such rows of both sides stay. Two rows of ``df`` with
    one key are an error. A missing target is created. Of a partitioned table only the
    partitions that lose or gain rows are rewritten, however many they are, and those left
    without rows are dropped: new rows are written beside the old ones and exchanged with
    them (``exchange``). A merge that is cut off anywhere loses no row; run again, it gives
    what it would have given. A table with buckets is merged by the key it is stored by, and
    only the buckets with keys of ``df`` are rewritten; ``buckets`` gives them to a missing
    target. Any other table is rewritten whole. ``evolve`` is that of ``write_table``.

    ``df`` is read for the check, for its keys and for its rows, and all must agree: it
    is written to a scratch table first, unless it is ``stable``, that is, gives the same
    rows cheaply each time.
    """
    same = same_name(df.sparkSession)
    unknown = [k for k in keys if not any(same(k, c) for c in df.columns)]
    if not keys or unknown:
        raise ValueError(f"merge needs key columns of the source; got {keys}, unknown {unknown}")
    finish_writes(df.sparkSession, target)
    with nullcontext(df) if stable else landed(df, "incoming") as source:
        if evolve and df.sparkSession.catalog.tableExists(target):
            source = fitted(source, evolve_table(df.sparkSession, target, source.schema))
        _merge(source, target, keys, partition_by, fmt, buckets)


def _merge(
    source: DataFrame,
    target: str,
    keys: Sequence[str],
    partition_by: Sequence[str] | None,
    fmt: str | None,
    buckets: Buckets | None,
) -> None:
    spark = source.sparkSession
    if not spark.catalog.tableExists(target):
        _reject_repeated_keys(source, keys)
        write_table(source, target, "error", partition_by, fmt, buckets=buckets)
        return
    present = spark.table(target)
    layout = layout_of(spark, target)
    # In the types of the target two keys may be one; and its names are used from here on.
    source = _aligned(source, visible(present) if layout.buckets else present)
    same = same_name(spark)
    keys = [next(c for c in present.columns if same(k, c)) for k in keys]
    _reject_repeated_keys(source, keys)
    if layout.buckets:
        stored = sorted(next(c for c in present.columns if same(k, c)) for k in layout.buckets.keys)
        if sorted(keys) != stored:
            raise ValueError(f"{target} is stored in buckets of {stored}; it is merged by these")
        source = with_bucket(source, layout.buckets)
        _merge_partitions(source, present, target, keys, [BUCKET], moving=False)
        return
    if layout.fmt in TRANSACTIONAL:
        merge = source.alias("s").mergeInto(target, _equal("s", target, keys))
        merge.whenMatched().updateAll().whenNotMatched().insertAll().merge()
    elif layout.partition_by:
        moving = not set(layout.partition_by) <= set(keys)
        _merge_partitions(source, present, target, keys, layout.partition_by, moving)
    else:
        _replace(_unmatched(present, source, keys).unionByName(source), target, layout, carry=True)


def _all_set(columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(quoted(c)).isNotNull() for c in columns])


def _equal(left: str, right: str, columns: Sequence[str], others: Sequence[str] = ()) -> Column:
    pairs = [
        F.col(f"{left}.{quoted(a)}") == F.col(f"{right}.{quoted(b)}")
        for a, b in zip(columns, others or columns)
    ]
    return reduce(lambda a, b: a & b, pairs)


def _reject_repeated_keys(source: DataFrame, keys: Sequence[str]) -> None:
    repeated = (
        source.filter(_all_set(keys))
        .groupBy(*[F.col(quoted(k)) for k in keys])
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .filter(F.col("n_rows") > 1)
        .first()
    )
    if repeated is not None:
        raise ValueError(f"more than one source row for the key {repeated.asDict()}")


def _aligned(source: DataFrame, target: DataFrame) -> DataFrame:
    """The source with the names, the order and the types of the target."""
    spark = source.sparkSession
    same = same_name(spark)
    found = {
        t.name: [s for s in source.schema.fields if same(s.name, t.name)]
        for t in target.schema.fields
    }
    if len(source.columns) != len(found) or any(len(f) != 1 for f in found.values()):
        raise ValueError(
            f"source and target differ in columns: {sorted(source.columns)}, "
            f"{sorted(target.columns)}"
        )
    ansi = spark.conf.get("spark.sql.ansi.enabled").lower() == "true"
    return source.select(
        *[
            strict_cast(
                F.col(quoted(found[t.name][0].name)), found[t.name][0].dataType, t.dataType,
                t.name, ansi,
            ).alias(t.name)
            for t in target.schema.fields
        ]
    )


def _unmatched(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The target rows without a source row of the same key.

    Rows with a null key go round the join: however many there are, they would all
    meet in one of its partitions. The filter on nulls reaches the scan, which skips
    row groups without any.
    """
    new_keys = source.select(*[F.col(quoted(k)) for k in keys]).filter(_all_set(keys))
    keyed = target.filter(_all_set(keys))
    kept = keyed.alias("t").join(new_keys.alias("s"), _equal("t", "s", keys), "left_anti")
    return kept.unionByName(target.filter(~_all_set(keys)))


def _merge_partitions(
    source: DataFrame,
    present: DataFrame,
    target: str,
    keys: Sequence[str],
    partitions: Sequence[str],
    moving: bool,
) -> None:
    """Merges by rewriting the touched partitions, those that lose or gain rows.

    Unless they are ``moving``, the rows of a key are all in the partition of its new row.
    """
    spark = source.sparkSession
    names = [f"p{i}" for i in range(len(partitions))]
    found = _touched(source, present, keys, partitions, names, moving)
    with landed(found, "touched") as touched:
        affected = _rows_of(present, touched, partitions, names)
        merged = _unmatched(affected, source, keys).unionByName(source)
        merged = merged.select(*[F.col(quoted(c)) for c in present.columns])
        replaced = _rows_of(exchange.with_file(present, partitions), touched, partitions, names)
        run = _run_name()
        exchange.exchange_partitions(
            spark, target, run, _spread(merged, partitions), replaced, partitions,
            _suffixed(target, STAGED + run),
        )


def _touched(
    source: DataFrame,
    present: DataFrame,
    keys: Sequence[str],
    partitions: Sequence[str],
    names: Sequence[str],
    moving: bool,
) -> DataFrame:
    """Partitions that gain rows (``n_in`` above 0) or lose some, under plain names.

    Where rows may move, the partitions they leave are found by a semi join that reads the
    key and partition columns of the target only, and lets Spark skip the keys that cannot
    be hit before they are shuffled.
    """
    plain = [F.col(quoted(p)).alias(n) for p, n in zip(partitions, names)]
    gaining = source.select(*plain, F.lit(1).alias("n"))
    if moving:
        new_keys = source.select(*[F.col(quoted(k)) for k in keys]).filter(_all_set(keys))
        located = present.filter(_all_set(keys)).select(
            *[F.col(quoted(c)) for c in dict.fromkeys([*keys, *partitions])]
        )
        hit = located.alias("t").join(new_keys.alias("s"), _equal("t", "s", keys), "left_semi")
        gaining = gaining.unionAll(hit.select(*plain, F.lit(0).alias("n")))
    return gaining.groupBy(*names).agg(F.sum("n").alias("n_in"), F.count("n").alias("n_rows"))


def _rows_of(
    present: DataFrame, touched: DataFrame, partitions: Sequence[str], names: Sequence[str]
) -> DataFrame:
    """The rows of the touched partitions, the others not read.

    Equality on the partition columns lets Spark prune by the touched ones as it runs, if
    the join's other side is broadcast and filtered; nulls are equal to nothing, so each
    set of null columns has a join of its own. There are at most two to the number of
    partition columns of them.
    """
    masks = touched.select(*[F.col(n).isNull().alias(n) for n in names]).distinct().collect()
    out = present.limit(0)
    for mask in masks:
        rows, wanted, set_ = present, touched.filter("n_rows > 0"), []
        for p, n in zip(partitions, names):
            if mask[n]:
                rows, wanted = rows.filter(F.col(quoted(p)).isNull()), wanted.filter(F.col(n).isNull())
            else:
                set_.append((p, n))
                wanted = wanted.filter(F.col(n).isNotNull())
        if set_:
            columns, others = zip(*set_)
            match = _equal("t", "w", columns, others)
            rows = rows.alias("t").join(wanted.select(*others).alias("w"), match, "left_semi")
        out = out.unionByName(rows)
    return out
