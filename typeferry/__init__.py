"""Typed table ingest: PostgreSQL tables into Spark tables with declared types."""

from typeferry.functions.rules import TYPE_RULES
from typeferry.operators.buckets import Buckets, bucket_of, read_table
from typeferry.operators.changes import apply_changes, current_rows, forget_deleted
from typeferry.operators.cluster import in_zones, write_clustered, write_zones
from typeferry.operators.conform import conform
from typeferry.operators.diff import diff_rows
from typeferry.operators.discover import discover_columns
from typeferry.operators.infer import Evidence, evidence, infer_types, inferred_columns, narrowed
from typeferry.operators.keys import find_keys, keys_of_tables
from typeferry.operators.mapping import (
    MappedColumn,
    build_schema,
    build_spark_schema,
    map_pgsql_type_to_spark,
    map_types,
    mapped_columns,
    mapped_tables,
    mapping_audit,
)
from typeferry.operators.scratch import clear_scratch
from typeferry.operators.splits import Split, equi_depth, split_of, spread
from typeferry.operators.verify import column_checks, preview, reconcile, row_count
from typeferry.operators.write import (
    append_once,
    clean_staged,
    evolve_table,
    merge_table,
    write_table,
)
from typeferry.plans.ingest import IngestConfig, IngestReport, differences, ingest, ingest_many
from typeferry.sources.frames import FrameSource
from typeferry.sources.jdbc import ByBlocks, ByDepth, ByPredicates, ByRange, JdbcSource, SingleTask

__all__ = [
    "TYPE_RULES",
    "Buckets",
    "ByBlocks",
    "ByDepth",
    "ByPredicates",
    "ByRange",
    "Evidence",
    "FrameSource",
    "IngestConfig",
    "IngestReport",
    "JdbcSource",
    "MappedColumn",
    "SingleTask",
    "Split",
    "append_once",
    "apply_changes",
    "bucket_of",
    "build_schema",
    "build_spark_schema",
    "clean_staged",
    "clear_scratch",
    "column_checks",
    "conform",
    "current_rows",
    "diff_rows",
    "differences",
    "discover_columns",
    "equi_depth",
    "evidence",
    "evolve_table",
    "find_keys",
    "forget_deleted",
    "in_zones",
    "infer_types",
    "inferred_columns",
    "ingest",
    "ingest_many",
    "keys_of_tables",
    "map_pgsql_type_to_spark",
    "map_types",
    "mapped_columns",
    "mapped_tables",
    "mapping_audit",
    "merge_table",
    "narrowed",
    "preview",
    "read_table",
    "reconcile",
    "row_count",
    "split_of",
    "spread",
    "write_clustered",
    "write_table",
    "write_zones",
]
