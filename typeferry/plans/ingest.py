"""Tables from source to target: discover, map, read, cast, write, check."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from typeferry.functions.casts import quoted
from typeferry.operators.buckets import Buckets
from typeferry.operators.buckets import read_table
from typeferry.operators.conform import conform, lossy_columns, lost_values
from typeferry.operators.diff import diff_rows
from typeferry.operators.discover import Source, discover_columns
from typeferry.operators.infer import inferred_columns
from typeferry.operators.mapping import MappedColumn, build_schema, map_types, mapped_columns
from typeferry.operators.verify import column_counts, preview, row_count
from typeferry.operators.write import append_once, write_table
from typeferry.sources.jdbc import Partitioning


@dataclass(frozen=True)
class IngestConfig:
    """What to bring where. A blank target takes the name of the source table; partition
    columns and a format left out are those the target has, or none and parquet. A new or
    overwritten target without partitions is stored in ``merge_buckets`` of its merge keys.
    ``infer_unknown`` gives columns of types without a rule the type their text shows, at the
    price of one more reading of those columns. ``evolve`` lets an append or a merge bring new
    columns and wider types. An append with a ``batch`` happens once, however often it is run."""

    source: Source
    table: str
    schema: str = "public"
    target_table: str = ""
    write_mode: str = "overwrite"
    partition_cols: Sequence[str] | None = None
    merge_keys: Sequence[str] = ()
    merge_buckets: int = 0
    fmt: str | None = None
    strict: bool = True
    rounding: bool = False
    partitioning: Partitioning | None = None
    infer_unknown: bool = False
    evolve: bool = False
    batch: str | None = None

    @property
    def target(self) -> str:
        return self.target_table or self.table


class IngestReport(NamedTuple):
    """``counts`` has ``source_rows``, ``target_rows``, ``rows_match`` and
    ``null_violations``, the nulls written to NOT NULL columns. ``lossy`` has a row like
    those of ``column_checks`` for each column whose cast may lose or alter values.
    ``preview`` shows ten rows of the target, ``audit`` what each column was and became."""

    target: str
    columns: list[MappedColumn]
    schema: T.StructType
    counts: Row
    lossy: list[Row]
    preview: DataFrame
    audit: DataFrame


def ingest(
    spark: SparkSession, config: IngestConfig, columns: list[MappedColumn] | None = None
) -> IngestReport:
    """Runs one ingest. The source is read once: its rows, nulls, lost and altered values
    are counted as they are written.

    ``columns`` are the mapped columns where they are known, as from ``mapped_tables``
    for many tables; otherwise they are discovered.

    Spark counts a task that ran again once more in rare cases (an executor lost after its
    task had ended). So the count is held against the target's own, and where they differ
    the source counts again before ``rows_match`` says no. After a merge it is null, as
    the two need not agree, and so it is where an existing target was left alone.
    """
    if columns is None:
        descriptors = discover_columns(spark, config.source, config.schema, config.table)
        columns = mapped_columns(map_types(descriptors), config.table, config.schema)
    schema = build_schema(columns)
    target = config.target
    exists = spark.catalog.tableExists(target)
    if exists and config.write_mode == "ignore":
        counts = Row(source_rows=None, target_rows=_rows(spark, target), rows_match=None,
                     null_violations=None)
        return _report(spark, config, columns, schema, counts, [])

    before = _rows(spark, target) if exists and config.write_mode == "append" else 0
    frame = config.source.read(spark, config.schema, config.table, columns, config.partitioning)
    if config.infer_unknown:
        columns = inferred_columns(frame, columns)
        schema = build_schema(columns)
    doubtful = lossy_columns(frame, columns)
    seen = Observation()
    checks = column_counts(frame, doubtful)
    checks["null_violations"] = _null_violations(frame, columns)
    watched = frame.observe(seen, *[value.alias(name) for name, value in checks.items()])
    conformed = conform(watched, columns, config.strict, config.rounding)
    if config.batch is not None:
        if config.write_mode != "append":
            raise ValueError("a batch is appended; choose write_mode='append'")
        if not append_once(conformed, target, config.batch, config.partition_cols, config.fmt):
            counts = Row(source_rows=None, target_rows=_rows(spark, target), rows_match=None,
                         null_violations=None)
            return _report(spark, config, columns, schema, counts, [])
    else:
        buckets = Buckets(config.merge_keys, config.merge_buckets) if config.merge_buckets else None
        write_table(
            conformed,
            target,
            config.write_mode,
            config.partition_cols,
            config.fmt,
            config.merge_keys,
            buckets=buckets,
            evolve=config.evolve,
        )
    found = seen.get
    lossy = [
        Row(
            column_name=c.column_name,
            n_rows=found["n_rows"],
            n_nulls=found[f"nulls_{i}"],
            n_lost=found.get(f"lost_{i}", 0),
            n_altered=found.get(f"altered_{i}", 0),
        )
        for i, c in enumerate(doubtful)
    ]
    source_rows, target_rows = found["n_rows"], _rows(spark, target)
    match = None
    if config.write_mode != "merge":
        if target_rows - before != source_rows:
            source_rows = config.source.count(spark, config.schema, config.table).first()["n_rows"]
        match = target_rows - before == source_rows
    counts = Row(
        source_rows=source_rows,
        target_rows=target_rows,
        rows_match=match,
        null_violations=found["null_violations"],
    )
    return _report(spark, config, columns, schema, counts, lossy)


def differences(
    spark: SparkSession, config: IngestConfig, columns: list[MappedColumn]
) -> DataFrame:
    """The rows, not only their numbers, that source and target do not share: ``diff_rows`` of
    the source, read again and cast, and the target's columns of the same names. After an
    append or a merge the target may have more; what its ``side`` calls ``source`` is missing.

    ``columns`` are those of the report.
    """
    frame = config.source.read(spark, config.schema, config.table, columns, config.partitioning)
    source = conform(frame, columns, config.strict, config.rounding)
    target = read_table(spark, config.target).select(*[F.col(quoted(c)) for c in source.columns])
    return diff_rows(source, target, config.merge_keys)


def _rows(spark: SparkSession, table: str) -> int:
    return row_count(spark.table(table)).first()["n_rows"]


def _null_violations(frame: DataFrame, columns: Sequence[MappedColumn]) -> Column:
    """Nulls that NOT NULL columns will have, the lost values of a lenient cast among them."""
    total = F.lit(0).cast("bigint")
    for column, lost in zip(columns, lost_values(frame, columns)):
        if not column.nullable:
            missing = F.col(quoted(column.column_name)).isNull()
            total = total + F.count_if(missing if lost is None else missing | lost)
    return total


def _report(
    spark: SparkSession,
    config: IngestConfig,
    columns: list[MappedColumn],
    schema: T.StructType,
    counts: Row,
    lossy: list[Row],
) -> IngestReport:
    order = list(config.merge_keys) or [c.column_name for c in columns[:1]]
    audit = spark.createDataFrame(
        [(config.table, c.column_name, c.data_type, c.spark_type, c.status) for c in columns],
        "table_name string, column_name string, data_type string, spark_type string, status string",
    )
    shown = preview(spark, config.target, order)
    return IngestReport(config.target, columns, schema, counts, lossy, shown, audit)


def ingest_many(
    spark: SparkSession,
    configs: Sequence[IngestConfig],
    columns: Mapping[str, list[MappedColumn]] | None = None,
    at_once: int = 4,
) -> list[IngestReport]:
    """Several ingests, at most ``at_once`` of them running; reports in the given order.

    Targets must differ. The first failure is raised once the others have ended.
    """
    targets = [c.target for c in configs]
    if len(set(targets)) < len(targets):
        raise ValueError("two ingests have one target")
    known = columns or {}
    with ThreadPoolExecutor(max(1, at_once)) as pool:
        running = [pool.submit(ingest, spark, c, known.get(c.table)) for c in configs]
    return [r.result() for r in running]

