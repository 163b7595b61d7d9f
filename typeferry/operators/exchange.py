"""Exchange of a table's partitions, in steps that can be cut off anywhere.

A table's files are never changed in place. New rows of the partitions go to a folder of the
run's own inside the table's, hidden from listings; then the run writes its intent there: for
each partition the folder it is to have, or none, and the folders whose files it had. One
small file, ``committed``, made in a single step, decides: without it nothing has happened,
with it the exchange is done, by this run or by the next that writes to the table. What
follows can be repeated in any part: each partition is pointed to its new folder by the catalog
(``SET LOCATION``), one statement that succeeds or does not, partitions without rows are
dropped, then the old folders are deleted.

A reader sees each partition as it was or as it is to be, never a part of one; readers in the
middle of it may see some partitions of either. Partitions live in the folders of the runs from
then on; appends follow them there. A listing of the table's folder by path does not show
them: read the table through the catalog.

    table/p=1/…                      as first written
    table/_typeferry/<run>/rows/p=2/…  as exchanged by a run
    table/_typeferry/<run>/intent/…    what goes where
    table/_typeferry/<run>/committed, applied, cleaned
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from itertools import batched
from urllib.parse import unquote

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from typeferry.functions.casts import quoted, text_literal

FOLDER = "_typeferry"

# The marks of a run, in their order.
COMMITTED, APPLIED, CLEANED = "committed", "applied", "cleaned"

# Partitions added or dropped by one statement, and statements that run at a time.
AT_ONCE = 100
THREADS = 8

# A table property: its partitions' folders are being named anew after a rename.
RELOCATING = "typeferry.relocating"


def location_of(spark: SparkSession, table: str) -> str:
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'Location'")
    return described.collect()[-1]["data_type"].rstrip("/")


# -- files -----------------------------------------------------------------------------


def file_system(spark: SparkSession, path: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def path_exists(spark: SparkSession, path: str) -> bool:
    system, path = file_system(spark, path)
    return system.exists(path)


def mark(spark: SparkSession, path: str) -> None:
    """Makes an empty file: there or not there, nothing between."""
    system, path = file_system(spark, path)
    system.create(path, True).close()


def delete_path(spark: SparkSession, path: str) -> None:
    system, path = file_system(spark, path)
    system.delete(path, True)


def children(spark: SparkSession, path: str) -> list[str]:
    system, path = file_system(spark, path)
    if not system.exists(path):
        return []
    return sorted(s.getPath().getName() for s in system.listStatus(path))


def runs_of(spark: SparkSession, location: str) -> list[str]:
    """The folders of the runs of a table, oldest first: their names begin with the time."""
    return [f"{location}/{FOLDER}/{name}" for name in children(spark, f"{location}/{FOLDER}")]


# -- a run -----------------------------------------------------------------------------


def exchange_partitions(
    spark: SparkSession,
    target: str,
    run: str,
    merged: DataFrame,
    replaced: DataFrame,
    partitions: Sequence[str],
    staged: str,
) -> None:
    """Puts the partitions of ``merged`` in the place of those that ``replaced`` reads.

    ``replaced`` are rows of the target with its partition columns and their file's path, as
    ``with_file`` gives them. Partitions that it has and ``merged`` has not are dropped.
    ``staged`` is a table name to write through, so that rows take the target's format,
    options and types.
    """
    location = location_of(spark, target)
    folder = f"{location}/{FOLDER}/{run}"
    spark.sql(f"CREATE TABLE {staged} LIKE {target} LOCATION {text_literal(folder + '/rows')}")
    try:
        merged.write.insertInto(staged)
        _write_intent(with_file(spark.table(staged), partitions), replaced, partitions, folder)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {staged}")  # its files stay
    mark(spark, f"{folder}/{COMMITTED}")
    finish_run(spark, target, location, folder, partitions)


def with_file(table: DataFrame, partitions: Sequence[str]) -> DataFrame:
    """The partition columns of a table's rows, and the folder of each row's file."""
    folder = F.regexp_replace("_metadata.file_path", "/[^/]*$", "")
    return table.select(*[F.col(quoted(p)) for p in partitions], folder.alias("folder_"))


def _write_intent(
    written: DataFrame, replaced: DataFrame, partitions: Sequence[str], folder: str
) -> None:
    """A row for each partition: its values as text, its new folder, its old ones."""
    values = [F.col(quoted(p)).cast("string").alias(f"p{i}") for i, p in enumerate(partitions)]
    names = [f"p{i}" for i in range(len(partitions))]
    none = F.lit(None).cast("string")
    new = written.select(*values, F.col("folder_").alias("new"), none.alias("old")).distinct()
    old = replaced.select(*values, none.alias("new"), F.col("folder_").alias("old")).distinct()
    (
        new.unionAll(old)
        .groupBy(*names)
        .agg(F.max("new").alias("new"), F.collect_set("old").alias("old"))
        .write.parquet(f"{folder}/intent")
    )


def _moved(location: str, encoded: str) -> str:
    """A folder of a run, as a file's metadata name it, in the table's folder as it is now."""
    return f"{location}/{FOLDER}/{unquote(encoded).rpartition(f'/{FOLDER}/')[2]}"


def _intent(spark: SparkSession, folder: str) -> Iterator[Row]:
    return spark.read.parquet(f"{folder}/intent").toLocalIterator()


def finish_run(
    spark: SparkSession, target: str, location: str, folder: str, partitions: Sequence[str]
) -> None:
    """Does what a committed run has not done yet; any part of it may have been done."""
    if not path_exists(spark, f"{folder}/{APPLIED}"):
        apply_intent(spark, target, location, _intent(spark, folder), partitions)
        mark(spark, f"{folder}/{APPLIED}")
        spark.catalog.refreshTable(target)
    if not path_exists(spark, f"{folder}/{CLEANED}"):
        for some in batched(_intent(spark, folder), AT_ONCE):
            gone = [unquote(old) for row in some for old in row["old"]]
            _each(lambda old: delete_replaced(spark, old), gone)
        mark(spark, f"{folder}/{CLEANED}")


def delete_replaced(spark: SparkSession, old: str) -> None:
    """One folder whose partition has another now."""
    delete_path(spark, old)


def spec(partitions: Sequence[str], values: Sequence[str | None]) -> str:
    pairs = [
        f"{quoted(p)} = {'null' if v is None else text_literal(v)}"
        for p, v in zip(partitions, values)
    ]
    return f"PARTITION ({', '.join(pairs)})"


def apply_intent(
    spark: SparkSession,
    target: str,
    location: str,
    rows: Iterator[Row],
    partitions: Sequence[str],
) -> None:
    """Points partitions to their folders, and drops those that have none."""
    for some in batched(rows, AT_ONCE):
        named = [(spec(partitions, row[: len(partitions)]), row) for row in some]
        there = [(s, _moved(location, r["new"]), r) for s, r in named if r["new"]]
        added = [f"{s} LOCATION {text_literal(place)}" for s, place, r in there if not r["old"]]
        if added:
            spark.sql(f"ALTER TABLE {target} ADD IF NOT EXISTS {' '.join(added)}")
        _each(lambda found: point(spark, target, found[0], found[1]), there)
        gone = [s for s, r in named if not r["new"]]
        if gone:
            spark.sql(f"ALTER TABLE {target} DROP IF EXISTS {', '.join(gone)}")


def _each(act: Callable[[object], None], things: Sequence[object]) -> None:
    """Does a thing for each, some at a time; the first failure is raised when all have ended."""
    with ThreadPoolExecutor(THREADS) as pool:
        list(pool.map(act, things))


def point(spark: SparkSession, target: str, of: str, place: str) -> None:
    """One partition of the exchange."""
    spark.sql(f"ALTER TABLE {target} {of} SET LOCATION {text_literal(place)}")


# -- other runs ------------------------------------------------------------------------


def finish_exchanges(spark: SparkSession, target: str, partitions: Sequence[str]) -> None:
    """Finishes what committed runs have left undone, oldest first.

    Every write of this library begins with it, so nothing is added to a partition between
    its run's commit and its exchange.
    """
    location = location_of(spark, target)
    for folder in runs_of(spark, location):
        done = path_exists(spark, f"{folder}/{CLEANED}")
        if not done and path_exists(spark, f"{folder}/{COMMITTED}"):
            finish_run(spark, target, location, folder, partitions)


def clean_runs(spark: SparkSession, target: str) -> int:
    """Deletes the folders of runs that never committed, and of those whose partitions have
    all been exchanged again; no run may be at work. How many."""
    gone = 0
    for folder in runs_of(spark, location_of(spark, target)):
        cleaned = path_exists(spark, f"{folder}/{CLEANED}")
        if not path_exists(spark, f"{folder}/{COMMITTED}") or (
            cleaned and not _holds_files(spark, f"{folder}/rows")
        ):
            delete_path(spark, folder)
            gone += 1
    return gone


def _holds_files(spark: SparkSession, folder: str) -> bool:
    system, path = file_system(spark, folder)
    if not system.exists(path):
        return False
    files = system.listFiles(path, True)
    while files.hasNext():
        if not files.next().getPath().getName().startswith(("_", ".")):
            return True
    return False


def relocate(spark: SparkSession, table: str, partitions: Sequence[str]) -> None:
    """After a rename moved the table's folder: points the partitions that live in folders of
    runs to where those are now. The catalog has found those in their first places."""
    location = location_of(spark, table)
    rows: dict[tuple, Row] = {}
    for folder in runs_of(spark, location):
        if not path_exists(spark, f"{folder}/{CLEANED}"):
            continue
        for row in _intent(spark, folder):
            if row["new"] and path_exists(spark, _moved(location, row["new"])):
                values = tuple(row[: len(partitions)])
                rows[values] = Row(*row.__fields__)(*values, row["new"], [])
    apply_intent(spark, table, location, iter(rows.values()), partitions)
    spark.catalog.refreshTable(table)


def set_relocating(spark: SparkSession, table: str, on: bool) -> None:
    if on:
        spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{RELOCATING}' = 'yes')")
    else:
        spark.sql(f"ALTER TABLE {table} UNSET TBLPROPERTIES IF EXISTS ('{RELOCATING}')")
