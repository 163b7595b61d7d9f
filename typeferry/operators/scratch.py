"""Tables that live for one step, in the folder the cluster shares."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SCRATCH_DATABASE = "typeferry_scratch"

# What this process has made: tables by name, and temporary folders.
_tables: set[str] = set()
_folders: list[str] = []


def scratch_table(spark: SparkSession, label: str) -> str:
    """A fresh table name in a database under ``spark.checkpoint.dir``.

    Without that setting a temporary folder serves, in local mode only: executors on
    other machines would not find it.
    """
    if not spark.catalog.databaseExists(SCRATCH_DATABASE):
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not spark.conf.get("spark.master", "").startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder all executors share")
            folder = tempfile.mkdtemp(prefix="typeferry-")
            _folders.append(folder)
        location = f"{folder.rstrip('/')}/{SCRATCH_DATABASE}".replace("'", "\\'")
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {SCRATCH_DATABASE} LOCATION '{location}'")
    name = f"{SCRATCH_DATABASE}.{label}_{uuid.uuid4().hex}"
    _tables.add(name)
    return name


def clear_scratch(spark: SparkSession) -> int:
    """Drops the scratch tables this process has named, and its temporary folder; how many
    tables there were. Frames that read them can be used no more."""
    dropped = 0
    while _tables:
        name = _tables.pop()
        if spark.catalog.tableExists(name):
            spark.sql(f"DROP TABLE {name}")
            dropped += 1
    while _folders:
        spark.sql(f"DROP DATABASE IF EXISTS {SCRATCH_DATABASE} CASCADE")
        shutil.rmtree(_folders.pop(), ignore_errors=True)
    return dropped


@contextmanager
def landed(df: DataFrame, label: str = "landed") -> Iterator[DataFrame]:
    """``df`` written once and read from there, so that every use sees the same rows.

    The table is dropped at the end.
    """
    spark = df.sparkSession
    name = scratch_table(spark, label)
    try:
        df.write.format("parquet").saveAsTable(name)
        yield spark.table(name)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        _tables.discard(name)
