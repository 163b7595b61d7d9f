"""Appends that happen once, however often and by however many they are tried.

A batch has a name. Its rows are first written to a folder of the run's own inside the table's,
hidden from listings. Then the run makes a small file of the batch's name, which can be made
only once: who makes it has committed the batch, and it names that run. Everyone else's rows
are deleted unread. What is committed is moved, file by file, to where the table's partitions
are; a move that has been done finds nothing to move, so any run can go on where another
was cut off, and every write of this library begins with that.

That a file can be made only once is for the store to keep: HDFS, ABFS and GCS do. Where a look
and the making are two steps (a local disk, older S3 connectors), two writers that commit one
batch in the same instant may both think they have; one writer at a time is safe anywhere.

A reader may see a part of a batch while its files are moved. An overwrite by the user forgets
the batches with the rows; merges and schema changes that rewrite a table keep them.

    table/_typeferry_batches/committed/<batch>   holds the name of the run
    table/_typeferry_batches/runs/<run>/batch    holds the name of the batch
    table/_typeferry_batches/runs/<run>/rows/…   its files, until they are moved
"""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import quote, unquote

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from typeferry.functions.casts import text_literal
from typeferry.operators.exchange import (
    children,
    delete_path,
    file_system,
    location_of,
    path_exists,
    spec,
)

FOLDER = "_typeferry_batches"

NULL = "__HIVE_DEFAULT_PARTITION__"


def _create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Makes a file with a text, unless there is one; whether this call has made it."""
    system, path = file_system(spark, path)
    try:
        stream = system.create(path, False)
    except Py4JJavaError:
        if system.exists(path):
            return False
        raise
    stream.write(bytearray(text.encode()))
    stream.close()
    return True


def _text_of(spark: SparkSession, path: str) -> str:
    system, path = file_system(spark, path)
    stream = system.open(path)
    try:
        size = int(system.getFileStatus(path).getLen())
        return "".join(chr(stream.read()) for _ in range(size)) if size else ""
    finally:
        stream.close()


def _batch_file(location: str, batch: str) -> str:
    return f"{location}/{FOLDER}/committed/{quote(batch, safe='')}"


def stage_batch(
    spark: SparkSession, df: DataFrame, target: str, batch: str, run: str, staged: str
) -> str:
    """Writes the rows of a batch to the folder of a run, in the format of the target."""
    folder = f"{location_of(spark, target)}/{FOLDER}/runs/{run}"
    _create_once(spark, f"{folder}/batch", quote(batch, safe=""))
    spark.sql(f"CREATE TABLE {staged} LIKE {target} LOCATION {text_literal(folder + '/rows')}")
    try:
        df.write.insertInto(staged)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {staged}")  # its files stay
    return folder


def commit_batch(spark: SparkSession, location: str, batch: str, run: str) -> bool:
    """Whether this run is the one that has committed the batch."""
    if _create_once(spark, _batch_file(location, batch), run):
        return True
    return _text_of(spark, _batch_file(location, batch)) == run


def is_committed(spark: SparkSession, target: str, batch: str) -> bool:
    return path_exists(spark, _batch_file(location_of(spark, target), batch))


def finish_batches(spark: SparkSession, target: str, partitions: Sequence[str]) -> None:
    """Moves the files of committed runs into the table, and deletes the runs that came late.
    Runs of batches that nobody has committed yet may be at work and are left."""
    location = location_of(spark, target)
    runs = f"{location}/{FOLDER}/runs"
    for run in children(spark, runs):
        folder = f"{runs}/{run}"
        if not path_exists(spark, f"{folder}/batch"):
            continue
        committed = _batch_file(location, unquote(_text_of(spark, f"{folder}/batch")))
        if not path_exists(spark, committed):
            continue
        if _text_of(spark, committed) == run:
            move_rows(spark, target, location, f"{folder}/rows", partitions)
        delete_path(spark, folder)


def move_rows(
    spark: SparkSession, target: str, location: str, rows: str, partitions: Sequence[str]
) -> None:
    """Moves what files are left in the folder of a run to where their partitions are."""
    system, path = file_system(spark, rows)
    if not system.exists(path):
        return
    by_folder: dict[str, list] = {}
    files = system.listFiles(path, True)
    while files.hasNext():
        file = files.next().getPath()
        name = file.getName()
        if name.startswith(("_", ".")):
            continue
        folder = file.getParent().toString()
        below = folder[folder.index(f"/{FOLDER}/runs/") :].partition("/rows")[2].strip("/")
        by_folder.setdefault(below, []).append(file)
    for below, found in sorted(by_folder.items()):
        place = location
        if below:
            values = [unquote(part.partition("=")[2]) for part in below.split("/")]
            of = spec(partitions, [None if v == NULL else v for v in values])
            place = _partition_location(spark, target, of)
            if place is None:
                place = f"{location}/{below}"
                spark.sql(f"ALTER TABLE {target} ADD {of} LOCATION {text_literal(place)}")
        for file in found:
            move(spark, file, place)
    spark.catalog.refreshTable(target)


def _partition_location(spark: SparkSession, target: str, of: str) -> str | None:
    """Where a partition is, if it is: an exchanged one lives in the folder of its run.

    Looked up first, as some catalogs let ``ADD IF NOT EXISTS`` replace what is there.
    """
    try:
        described = spark.sql(f"DESCRIBE TABLE EXTENDED {target} {of}")
    except AnalysisException as missing:
        if "PARTITIONS_NOT_FOUND" not in (missing.getCondition() or ""):
            raise
        return None
    # The partition's own comes before the table's.
    return described.filter(F.col("col_name") == "Location").collect()[0]["data_type"]


def move(spark: SparkSession, file, place: str) -> None:
    """One file of a batch; its name is its own, so it can be moved but once."""
    system, folder = file_system(spark, place)
    system.mkdirs(folder)
    to = spark._jvm.org.apache.hadoop.fs.Path(folder, file.getName())
    if not system.rename(file, to) and not system.exists(to):
        raise OSError(f"could not move {file} to {place}")


def carry_batches(spark: SparkSession, source: str, target: str) -> None:
    """The names of committed batches, from a table to the one that takes its place."""
    system, path = file_system(spark, f"{location_of(spark, source)}/{FOLDER}/committed")
    if system.exists(path):
        to_system, to = file_system(spark, f"{location_of(spark, target)}/{FOLDER}/committed")
        to_system.mkdirs(to.getParent())
        spark._jvm.org.apache.hadoop.fs.FileUtil.copy(
            system, path, to_system, to, False, True, spark._jsc.hadoopConfiguration()
        )


def clean_batches(spark: SparkSession, target: str) -> int:
    """Deletes the folders of runs that never committed; none may be at work. How many."""
    runs = f"{location_of(spark, target)}/{FOLDER}/runs"
    left = children(spark, runs)
    for run in left:
        delete_path(spark, f"{runs}/{run}")
    return len(left)
