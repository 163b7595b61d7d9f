"""Packing of documents into training sequences by best-fit decreasing.

Texts become ids with an end id, and are cut into full windows of ``window`` ids and a rest.
Pieces are dealt at random into groups of about ``group_pieces``, each packed by itself: from
the longest piece down, each goes to the open sequence it leaves the least room in. Open
sequences are filed by their remaining capacity, and a segment tree over the capacities finds
the smallest that suffices in ``log2(window)`` steps. Groups are bounded whatever the sources
or copies, and so large that the padding of separate groups is close to that of one.

A sequence is padded to the window unless its length is a power of two.

Nulls and the like: a null or empty text is one piece, the end id alone; rows with a null
``doc_id`` and repeated rows are packed like any others, each with its own pieces; an empty
table gives no pieces; other columns are not looked at.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from typeferry.llm.common import begin, checkpointed, ship
from typeferry.llm.tokens import encoder, public_path

WINDOW = 2048
PIECE = "doc_id long, copy long, start long, length long, ids_crc32 long, doc_tokens long"


def pieces(
    docs: DataFrame,
    vocabulary: str,
    end_id: int,
    window: int = WINDOW,
    with_ids: bool = True,
) -> DataFrame:
    """The pieces of every text: columns ``PIECE``, and ``ids`` (32-bit, little-endian).

    ``copy`` tells apart rows that repeat a ``doc_id``. Without ids only their checksums
    are kept.
    """
    ship(docs.sparkSession)
    names = ["doc_id", "copy", "start", "length", "ids_crc32", "doc_tokens", "ids"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("packing")
        encode = encoder(vocabulary).encode
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                rows = []
                found = zip(part.column(0).to_pylist(), part.column(1).to_pylist(),
                            encode(part.column(2).to_pylist()))
                for doc_id, copy, ids in found:
                    ids = np.append(ids.astype("<u4"), np.uint32(end_id))
                    for start in range(0, len(ids), window):
                        own = ids[start : start + window]
                        raw = own.tobytes()
                        row = (doc_id, copy, start, len(own), zlib.crc32(raw), len(ids))
                        rows.append((*row, raw) if with_ids else row)
                columns = list(zip(*rows))
                types = [*[pa.int64()] * 6, pa.binary()]
                arrays = [pa.array(c, t) for c, t in zip(columns, types)]
                yield pa.RecordBatch.from_arrays(arrays, names=names[: len(arrays)])

    rows = docs.select(
        F.col("doc_id").cast("long"),
        F.monotonically_increasing_id().alias("copy"),
        F.col("text").cast("string"),
    )
    return rows.mapInArrow(cut, PIECE + ", ids binary" * with_ids)


class Capacities:
    """Open sequences by remaining capacity, under a segment tree of which are there."""

    def __init__(self, window: int):
        self.leaves = 1 << window.bit_length()
        self.some = bytearray(2 * self.leaves)
        self.open: list[list[int]] = [[] for _ in range(window + 1)]

    def put(self, capacity: int, sequence: int) -> None:
        self.open[capacity].append(sequence)
        node = capacity + self.leaves
        while node and not self.some[node]:
            self.some[node] = 1
            node >>= 1

    def take(self, length: int) -> tuple[int, int] | None:
        """The sequence with the least capacity that is at least ``length``, taken out."""
        node = length + self.leaves
        if not self.some[node]:
            while node > 1 and (node & 1 or not self.some[node + 1]):
                node >>= 1  # up until there is something to the right
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if self.some[2 * node] else 2 * node + 1
        capacity = node - self.leaves
        sequence = self.open[capacity].pop()
        if not self.open[capacity]:
            self.some[node] = 0
            while node > 1 and not self.some[node ^ 1]:
                node >>= 1
                self.some[node] = 0
        return sequence, capacity


def best_fit(lengths: list[int], window: int = WINDOW) -> tuple[list[int], list[int]]:
    """Sequence and offset of each piece, the pieces given from the longest down."""
    tree, sequences, offsets, opened = Capacities(window), [], [], 0
    for length in lengths:
        found = tree.take(length)
        if found is None:
            found = opened, window
            opened += 1
        sequence, capacity = found
        sequences.append(sequence)
        offsets.append(window - capacity)
        if capacity > length:
            tree.put(capacity - length, sequence)
    return sequences, offsets


def assign(cut: DataFrame, window: int = WINDOW, group_pieces: int = 1 << 16) -> DataFrame:
    """The pieces with ``sequence_id`` and ``offset``: columns of ``cut`` but ``ids``, and these."""
    spark = cut.sparkSession
    ship(spark)
    groups = max(1, -(-cut.count() // group_pieces))

    def pack(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by(
            [("length", "descending"), *((c, "ascending") for c in ("doc_id", "copy", "start"))]
        )
        found, offsets = best_fit(rows["length"].to_pylist(), window)
        ids = np.array(found, np.int64) * groups + rows["group"].to_numpy()
        rows = rows.drop_columns("group").append_column("sequence_id", pa.array(ids))
        return rows.append_column("offset", pa.array(offsets, pa.int64()))

    place = F.pmod(F.xxhash64("doc_id", "copy", "start"), F.lit(groups))
    return (
        cut.drop("ids")
        .withColumn("group", place)
        .groupBy("group")
        .applyInArrow(pack, PIECE + ", sequence_id long, offset long")
    )


def pack_documents(
    docs: DataFrame,
    vocabulary: str | None = None,
    end_id: int = 1,
    window: int = WINDOW,
    group_pieces: int = 1 << 16,
) -> DataFrame:
    """Every piece of every document with its place; ids by checksum. Encodes once."""
    path = vocabulary or public_path("byte_bpe_50k.json")
    cut = checkpointed(pieces(docs, path, end_id, window, with_ids=False))
    return assign(cut, window, group_pieces)


def sequences(cut: DataFrame, placed: DataFrame, pad_id: int = 0, window: int = WINDOW) -> DataFrame:
    """The packed sequences themselves: ``sequence_id``, ``n_tokens``, ``ids`` with padding.

    ``cut`` holds the pieces with ids, stored (the same pieces that were assigned).
    """
    at = ["doc_id", "copy", "start"]
    match = [F.col(f"p.{c}").eqNullSafe(F.col(f"c.{c}")) for c in at]
    joined = placed.alias("p").join(cut.alias("c"), match)
    parts = F.array_sort(F.collect_list(F.struct("p.offset", "c.ids", "p.length")))
    rows = joined.groupBy("p.sequence_id").agg(parts.alias("parts"))
    whole = F.aggregate("parts", F.lit(b""), lambda raw, x: F.concat(raw, x["ids"]))
    size = F.aggregate("parts", F.lit(0).cast("long"), lambda n, x: n + x["length"])
    rows = rows.select("sequence_id", size.alias("n_tokens"), whole.alias("ids"))
    pad = F.lit(int(pad_id).to_bytes(4, "little"))
    missing = F.when(F.bit_count("n_tokens") == 1, 0).otherwise(window - F.col("n_tokens"))
    filler = F.when(missing > 0, F.repeat(F.hex(pad), missing.cast("int"))).otherwise("")
    return rows.withColumn("ids", F.concat("ids", F.unhex(filler)))
