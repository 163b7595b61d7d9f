"""What the operators share: reading, shipping code, the shared folder, components."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import sys
import tempfile
import uuid
import zipfile
from collections.abc import Callable
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PACKAGE = Path(__file__).resolve().parent.parent

BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"
SPARKS_OWN = "67108864b"
BATCH_BYTES = "4194304b"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per Spark context.

    Python workers import the functions of a plan by name; on a cluster they find the
    package only if it is installed there or sent along. Batches of whole texts are held to
    ``BATCH_BYTES`` too, unless the session says otherwise than Spark's own default.
    """
    context = spark.sparkContext
    if spark.conf.get(BATCH_SETTING) == SPARKS_OWN:
        spark.conf.set(BATCH_SETTING, BATCH_BYTES)
    if any(Path(f).name.startswith("typeferry-") for f in context._python_includes):
        return
    path = Path(tempfile.mkdtemp(prefix="typeferry-")) / f"typeferry-{uuid.uuid4().hex}.zip"
    with zipfile.ZipFile(path, "w") as archive:
        for source in sorted(PACKAGE.rglob("*.py")):
            archive.write(source, str(source.relative_to(PACKAGE.parent)))
    context.addPyFile(str(path))


_serving: str | None = None
_kept: list[Callable[[], None]] = []


def kept_by_worker(release: Callable[[], None]) -> None:
    """Registers how to let go of what a module keeps in a worker process between tasks."""
    _kept.append(release)


def begin(operator: str) -> None:
    """Called by a task as it begins. Spark's workers serve one operator after another; what
    the last one kept, tables and caches, goes when a task of another begins. What the
    allocators hold of earlier tasks' batches and arrays goes at each: a worker may stay idle
    for long beside others."""
    global _serving
    if _serving not in (None, operator):
        for release in _kept:
            release()
        gc.collect()
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        with contextlib.suppress(OSError, AttributeError):  # other C libraries
            ctypes.CDLL("libc.so.6").malloc_trim(0)
    _serving = operator


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, as ``spark.checkpoint.dir`` names it.

    Unset, a temporary folder serves in local mode only.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local[") and context.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="typeferry-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder.rstrip("/")


def fresh_folder(spark: SparkSession, label: str) -> str:
    """A new path under the shared folder."""
    return f"{shared_folder(spark)}/typeferry-llm/{label}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` computed once, its lineage cut. Spark's cleaner removes the files in a session with
    ``spark.cleaner.referenceTracking.cleanCheckpoints``; else they stay in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def bucket(text: Column, modulus: int) -> Column:
    """crc32 of a value's text, modulo ``modulus``: null for null."""
    return F.pmod(F.crc32(text.cast("string").cast("binary")), F.lit(modulus))


PLACES = 1 << 52  # that hashes are dealt to


def place(identity: Column) -> Column:
    """Where a row falls by the hash of an id. Rows without one, which all have one hash, fall
    where each of them stands."""
    own = F.xxhash64(F.lit("row"), F.monotonically_increasing_id())
    return F.pmod(F.when(identity.isNull(), own).otherwise(F.xxhash64(identity)), F.lit(PLACES))


def thinned(rows: DataFrame, bound: int) -> DataFrame:
    """A sample by ids, thinned row by row where repeated ids would make it more than twice
    its bound. Without them it is given back as it is; the count reads no texts."""
    n = rows.count()
    if n <= 2 * bound:
        return rows
    own = F.pmod(F.xxhash64(F.lit("thin"), F.monotonically_increasing_id()), F.lit(PLACES))
    return rows.where(own < int(PLACES * bound / n))


def components(edges: DataFrame, max_rounds: int = 64) -> DataFrame:
    """Connected components of the links ``a``, ``b`` (longs, any orientation).

    Returns ``node``, ``root`` for every node of a link; ``root`` is the smallest node
    of its component. Large-star and small-star rounds in turn: each node's neighbours
    are linked to the smallest of them, until every component is one star. A node's
    neighbours are never gathered, only their minimum, so hubs need no special path.
    """
    links = checkpointed(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .where("u <> v")
        .distinct()
    )
    before = _state(links)
    for _ in range(max_rounds):
        both = links.unionAll(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(
            F.col("u").alias("k"), F.least("u", "m").alias("m")
        )
        large = (
            both.where("v > u")
            .join(least, F.col("u") == F.col("k"))
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .where("u <> v")
            .distinct()
        )
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        kept = large.join(least.withColumnRenamed("u", "k"), F.col("u") == F.col("k"))
        links = checkpointed(
            kept.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionAll(least.select("u", F.col("m").alias("v")))
            .where("u <> v")
            .distinct()
        )
        after = _state(links)
        if after == before:
            roots = links.select(F.col("u").alias("node"), F.col("v").alias("root"))
            return roots.unionAll(
                links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        before = after
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def _state(links: DataFrame) -> tuple:
    """A digest of the link set: equal sets have equal digests."""
    return tuple(
        links.agg(
            F.count("*"),
            F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")),
            F.sum(F.col("v").cast("decimal(38,0)")),
        ).first()
    )
