"""SimHash near-duplicates by a tiled exact comparison of all fingerprints.

A fingerprint has a bit for each bit of XXH64 (seed 42) over a document's word shingles:
1 if set in over half of them. Two fingerprints link at ``radius`` or fewer differing
bits. Every pair is decided exactly:

* equal fingerprints are folded first, so a text copied a billion times is one row;
* fingerprints are cut into tiles by the population counts of their ``segments``. Two
  fingerprints that differ in at most ``radius`` bits have segment counts that differ by
  at most ``radius`` in sum, so a tile meets only the tiles in that reach and every other
  pair of tiles is skipped. A tile that outgrows ``tile_rows`` is split by hash;
* a pair of tiles is compared with numpy's exclusive-or and bit counts, and reports a
  spanning forest of its links, never more rows than the tiles hold.

The links of all tile pairs have the same components as the links of all pairs.

Nulls, ties and the like: a null or empty text, or one of white space alone, has
fingerprint zero, which links like any other; rows with a null ``doc_id`` get a
fingerprint and a component but never name one (a component with no other rows has a
null id); repeated rows each get a row; an empty table gives an empty result. Other
columns of the input are not looked at, whatever their names.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from typeferry.llm.common import begin, checkpointed, components, ship

SEED = 42
CHUNK = 1 << 17  # shingles whose hashes are held at once


def shingles(text: str | None, length: int) -> Iterator[bytes]:
    """Space-joined word shingles of a whole text, repeats included."""
    words = (text or "").encode().lower().split()  # both on ASCII alone, as bytes
    if len(words) < length:
        return iter([b" ".join(words)] if words else [])
    return map(b" ".join, zip(*(itertools.islice(words, i, None) for i in range(length))))


def bit_counts(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """How often each of the 64 bits is set, in each run of ``hashes``.

    ``starts`` begins the runs, none longer than 255: eight bits are counted at once, each
    in a byte of its own.
    """
    ones = np.uint64(0x0101010101010101)
    counts = np.empty((len(starts), 64), np.uint8)
    for bit in range(8):
        lanes = np.add.reduceat((hashes >> np.uint64(bit)) & ones, starts)
        counts[:, bit::8] = lanes.view(np.uint8).reshape(-1, 8)
    return counts


def fingerprint_many(texts: list[str | None], length: int) -> np.ndarray:
    """One unsigned 64-bit fingerprint for each text."""
    totals = np.zeros((len(texts), 64), np.int64)
    sizes = np.zeros(len(texts), np.int64)
    hashes: list[int] = []
    owners: list[tuple[int, int]] = []

    def count() -> None:
        starts, rows, at = [], [], 0
        for row, n in owners:
            cuts = range(at, at + n, 255)
            starts.extend(cuts)
            rows.extend([row] * len(cuts))
            at += n
        if at:
            counts = bit_counts(np.array(hashes, np.uint64), np.array(starts))
            np.add.at(totals, np.array(rows), counts)
        hashes.clear()
        owners.clear()

    for row, text in enumerate(texts):
        source = map(xxhash.xxh64_intdigest, shingles(text, length), itertools.repeat(SEED))
        while got := list(itertools.islice(source, CHUNK)):
            hashes += got
            owners.append((row, len(got)))
            sizes[row] += len(got)
            if len(hashes) >= CHUNK:
                count()
    count()
    bits = (totals * 2 > sizes[:, None]).astype(np.uint8)
    return np.packbits(bits, axis=1, bitorder="little").view(np.uint64).ravel()


def fingerprints(docs: DataFrame, shingle: int = 3, keys: Sequence[str] = ()) -> DataFrame:
    """``doc_id``, ``fp`` (the fingerprint's bits as a long) for every row; then ``keys``,
    columns of longs in ``docs``, if some are named."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("simhash")
        for batch in batches:
            fps = fingerprint_many(batch.column(1).to_pylist(), shingle)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(fps.view(np.int64)), *batch.columns[2:]],
                names=["doc_id", "fp", *keys],
            )

    columns = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), *keys)
    return columns.mapInArrow(run, ", ".join(f"{c} long" for c in ("doc_id", "fp", *keys)))


def forest(hit: np.ndarray, same: bool) -> np.ndarray:
    """Spanning links of the bipartite hits of a tile pair, as rows (node, root).

    Nodes of the second tile are numbered after those of the first; in a tile against
    itself they are the same nodes.
    """
    left, right = np.nonzero(hit)
    if same:
        left, right = left[left < right], right[left < right]
        label = np.arange(hit.shape[0])
    else:
        right = right + hit.shape[0]
        label = np.arange(sum(hit.shape))
    while len(left):
        least = np.minimum(label[left], label[right])
        new = label.copy()
        np.minimum.at(new, left, least)
        np.minimum.at(new, right, least)
        new = new[new]
        if (new == label).all():
            break
        label = new
    nodes = np.flatnonzero(label != np.arange(len(label)))
    return np.stack([nodes, label[nodes]], axis=1)


def compare(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """Links within pairs of tiles: columns ``x``, ``y`` (lists of fingerprints), ``same``."""
    for batch in batches:
        sides = []
        for name in ("x", "y"):
            column = batch.column(batch.schema.get_field_index(name))
            sides.append((column.offsets.to_numpy(), column.values.to_numpy().view(np.uint64)))
        (x_at, x), (y_at, y) = sides
        out: list[np.ndarray] = []
        for i, same in enumerate(batch.column(2).to_pylist()):
            # The two lists of one tile may differ in order: they were collected apart.
            a = x[x_at[i] : x_at[i + 1]]
            b = a if same else y[y_at[i] : y_at[i + 1]]
            near = np.bitwise_count(a[:, None] ^ b[None, :]) <= radius
            if near.sum() > (len(a) if same else 0):
                links = forest(near, same)
                out.append((a if same else np.concatenate([a, b]))[links])
        found = np.concatenate(out) if out else np.empty((0, 2), np.uint64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.ascontiguousarray(found[:, k]).view(np.int64)) for k in (0, 1)],
            names=["a", "b"],
        )


def reach(segments: int, radius: int) -> list[list[int]]:
    """Differences of segment counts within the radius: one of each pair d, -d, and zero."""
    steps = itertools.product(range(-radius, radius + 1), repeat=segments)
    near = [d for d in steps if sum(map(abs, d)) <= radius]
    return [list(d) for d in near if d >= (0,) * segments]


def links(fps: DataFrame, radius: int = 3, segments: int = 4, tile_rows: int = 512) -> DataFrame:
    """Links ``a``, ``b`` between the distinct fingerprints ``fp`` of ``fps``.

    They span the components of all pairs within ``radius``.
    """
    ship(fps.sparkSession)
    width = 64 // segments
    mask = F.lit(-1 if width == 64 else (1 << width) - 1)
    counts = F.array(
        *(
            F.bit_count(F.shiftrightunsigned("fp", i * width).bitwiseAND(mask))
            for i in range(segments)
        )
    )
    rows = fps.select("fp", counts.alias("stratum"))
    sizes = rows.groupBy("stratum").agg(
        F.ceil(F.count("*") / tile_rows).cast("int").alias("parts")
    )
    part = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    tiles = (
        rows.join(sizes, "stratum")
        .groupBy("stratum", part.alias("part"))
        .agg(F.collect_list("fp").alias("fps"))
    )
    steps = F.array(*(F.array(*map(F.lit, d)) for d in reach(segments, radius)))
    left = tiles.select(
        F.col("part").alias("x_part"),
        F.col("fps").alias("x"),
        F.col("stratum").alias("x_stratum"),
        F.explode(steps).alias("step"),
    ).select(
        "x",
        "x_part",
        F.zip_with("x_stratum", "step", lambda p, d: p + d).alias("stratum"),
        (F.array_max(F.transform("step", F.abs)) == 0).alias("own"),
    )
    pairs = left.join(tiles, "stratum").where(
        ~F.col("own") | (F.col("x_part") <= F.col("part"))
    )
    same = F.col("own") & (F.col("x_part") == F.col("part"))
    return pairs.select("x", F.col("fps").alias("y"), same.alias("same")).mapInArrow(
        lambda batches: compare(batches, radius), "a long, b long"
    )


def near_duplicates(
    docs: DataFrame, shingle: int = 3, radius: int = 3, segments: int = 4
) -> DataFrame:
    """``doc_id``, ``fp``, ``component_id`` for every row of ``docs``.

    ``component_id`` is the smallest ``doc_id`` that links reach.
    """
    rows = checkpointed(fingerprints(docs, shingle))
    distinct = checkpointed(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    roots = components(links(distinct, radius, segments))
    named = distinct.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root")
    )
    # Stored, so that the join below has two plain sides and a heavy root can be split.
    least = checkpointed(named.groupBy("root").agg(F.min("first_id").alias("component_id")))
    members = named.join(least, "root").select("fp", "component_id")
    return rows.join(members, "fp").select("doc_id", "fp", "component_id")


def _free(docs: DataFrame, name: str) -> str:
    names = {c.lower() for c in docs.columns}
    return next(n for n in (name + "_" * i for i in itertools.count()) if n not in names)


def keyed_rows(docs: DataFrame) -> tuple[DataFrame, list[str]]:
    """``docs`` with columns that tell its rows apart, in the order they are stored, and their
    names. Of files as they are read these are the file's number, the hash of its path and
    the row's place in it; anything else is stored first, as it may come in another order.
    """
    keys = [_free(docs, name) for name in ("row_part", "row_file", "row_number")]
    plan = docs._jdf.queryExecution().analyzed().getClass().getSimpleName()
    if plan == "LogicalRelation":
        part = F.regexp_extract("_metadata.file_name", r"part-(\d{1,18})", 1).try_cast("long")
        found = (F.coalesce(part, F.lit(0).cast("long")), F.xxhash64("_metadata.file_path"),
                 F.col("_metadata.row_index"))
        try:
            return docs.select("*", *[c.alias(k) for c, k in zip(found, keys)]), keys
        except AnalysisException:  # a format without row numbers
            pass
    stored = docs.withColumn(keys[2], F.monotonically_increasing_id())
    return checkpointed(stored), keys[2:]


def one_of_each(docs: DataFrame, shingle: int = 3, radius: int = 3, segments: int = 4) -> DataFrame:
    """One row of each component of ``docs``: the smallest ``doc_id``, nulls last, and of rows
    that share it the first as stored. A row that is near to no other stays, whatever its id.
    """
    keyed, keys = keyed_rows(docs)
    rows = fingerprints(keyed, shingle, keys)
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", F.struct(*keys).alias("key"))
    distinct = checkpointed(rows.groupBy("fp").agg(F.min(first).alias("first")))
    roots = components(links(distinct, radius, segments))
    named = distinct.join(roots, F.col("fp") == F.col("node"), "left").select(
        "first", F.coalesce("root", "fp").alias("root")
    )
    kept = named.groupBy("root").agg(F.min("first").alias("first")).select("first.key.*")
    return keyed.join(kept, keys, "left_semi").drop(*keys)
