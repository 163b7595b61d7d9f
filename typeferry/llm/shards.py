"""Token ids in binary shards, found by document key through a minimal perfect hash.

A shard file holds, one after the other: a magic number; the length of a JSON header; the
header, with the place and type of each section; the sections; and the payload, the raw ids
of its documents in ascending order of ``doc_id`` (16 bits each where the vocabulary allows,
else 32). The sections are the keys, the end of each document in the payload, and the index:
levels of bit arrays with their rank counts, and for each slot a fingerprint of its key and
the number of its first document. A lookup takes a few probes whatever the size; a key that
is not there is told by its fingerprint, except for one in 2**32, and then by the key itself.

Documents are dealt out by range of id, so shards follow one another, and no task holds more
than a shard of ``shard_bytes``. Tasks write files under names of their own in the shared
folder; ``manifest`` beside them, a table that Spark commits, says which of them count.

Nulls and the like: a null text is encoded like an empty one, the end id alone; rows with a
null ``doc_id`` come first and have no entry in the index; rows that repeat a ``doc_id``
follow one another, ordered by a hash of their text, and a lookup finds all of them; an empty
table gives no shards; other columns are not looked at.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from functools import reduce
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from typeferry.llm.common import begin, ship
from typeferry.llm.files import NewFile, read_file
from typeferry.llm.tokens import encoder

MAGIC = b"TFSHARD1"
RANGES = 100_000  # shards whose key ranges are broadcast at once
LOAD = 2.0  # bits of a level for each key that is left
MANIFEST = (
    "file string, task long, place long, docs long, ids long, first_key long, last_key long"
)


def mix(keys: np.ndarray, seed: int) -> np.ndarray:
    """64 well-mixed bits of each key (splitmix64)."""
    x = keys.astype(np.uint64) + np.uint64((seed + 1) * 0x9E3779B97F4A7C15 % 2**64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class PerfectHash:
    """Maps each of n distinct keys to a slot of its own in 0..n-1.

    On each level the keys that are left hash to bits; a key alone on its bit is settled
    there. The slot is the rank of the bit among all bits set, over the levels in turn.
    """

    def __init__(self, sizes: list[int], words: np.ndarray):
        self.sizes, self.words = sizes, words
        self.ranks = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)])

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        sizes, parts, left = [], [], keys
        while len(left):
            size = -(-int(len(left) * LOAD + 1) // 64) * 64
            at = mix(left, len(sizes)) % np.uint64(size)
            alone = np.bincount(at.astype(np.int64), minlength=size) == 1
            parts.append(np.packbits(alone, bitorder="little").view(np.uint64))
            sizes.append(size)
            left = left[~alone[at.astype(np.int64)]]
        return cls(sizes, np.concatenate(parts) if parts else np.empty(0, np.uint64))

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key; -1, or the slot of another key, for one that was not built in."""
        out = np.full(len(keys), -1, np.int64)
        base = 0
        for level, size in enumerate(self.sizes):
            open_ = np.flatnonzero(out < 0)
            at = (mix(keys[open_], level) % np.uint64(size)).astype(np.int64) + base
            word, bit = at >> 6, (at & 63).astype(np.uint64)
            hit = (self.words[word] >> bit) & np.uint64(1) == 1
            below = self.words[word] & ((np.uint64(1) << bit) - np.uint64(1))
            out[open_[hit]] = (self.ranks[word] + np.bitwise_count(below))[hit]
            base += size
        return out


def prints(keys: np.ndarray) -> np.ndarray:
    return (mix(keys, 1 << 20) >> np.uint64(32)).astype("<u4")


class Shard:
    """A shard as read: ``documents(keys)`` finds rows by key, ``ids(row)`` their ids."""

    def __init__(self, raw: bytes):
        if raw[:8] != MAGIC:
            raise ValueError("not a shard")
        size = int.from_bytes(raw[8:12], "little")
        head = json.loads(raw[12 : 12 + size])
        parts = {}
        for name, (at, count, kind) in head["sections"].items():
            parts[name] = np.frombuffer(raw, kind, count, 12 + size + at)
        self.nulls = head["nulls"]
        self.keys, self.ends, self.payload = parts["keys"], parts["ends"], parts["payload"]
        self.prints, self.first = parts["prints"], parts["first"]
        self.hash = PerfectHash(head["levels"], parts["levels"])
        if len(self.payload) != self.ends[-1] or len(self.keys) + self.nulls + 1 != len(self.ends):
            raise ValueError("shard sections do not fit together")

    def rows(self, keys: np.ndarray) -> np.ndarray:
        """The first row of each key, -1 for keys that are not there."""
        slots = self.hash.slots(keys)
        if not len(self.first):
            return slots
        own = np.maximum(slots, 0)
        rows = self.first[own].astype(np.int64)
        there = (slots >= 0) & (self.prints[own] == prints(keys))
        there &= self.keys[rows - self.nulls] == keys
        return np.where(there, rows, -1)

    def ids(self, row: int) -> np.ndarray:
        return self.payload[int(self.ends[row]) : int(self.ends[row + 1])]


def packed(keys: np.ndarray, nulls: int, ends: list[int], payload: list[np.ndarray]) -> list[bytes | memoryview]:
    """The bytes of a shard file, ``keys`` sorted, those of the null rows left out."""
    distinct, first = np.unique(keys, return_index=True)
    index = PerfectHash.build(distinct)
    slots = index.slots(distinct)
    by_slot, own = np.empty(len(distinct), "<u4"), np.empty(len(distinct), "<u4")
    by_slot[slots], own[slots] = first + nulls, prints(distinct)
    parts = {
        "keys": keys.astype("<i8"),
        "ends": np.array(ends, "<u8"),
        "levels": index.words.astype("<u8"),
        "prints": own,
        "first": by_slot,
    }
    at, sections = 0, {}
    for name, part in parts.items():
        sections[name] = (at, len(part), part.dtype.str)
        at += part.nbytes
    sections["payload"] = (at, ends[-1], payload[0].dtype.str if payload else "<u2")
    head = json.dumps({"nulls": nulls, "levels": index.sizes, "sections": sections}).encode()
    head += b" " * (-(12 + len(head)) % 8)
    return [MAGIC, len(head).to_bytes(4, "little"), head, *(p.tobytes() for p in parts.values()),
            *(memoryview(p) for p in payload)]


def write_shards(
    docs: DataFrame, folder: str, vocabulary: str, end_id: int, shard_bytes: int = 32 << 20
) -> DataFrame:
    """Encode ``docs`` into shards under ``folder``; returns the manifest, one row a shard.

    ``start`` is the number of ids in all shards before.
    """
    spark = docs.sparkSession
    ship(spark)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("shards")
        tokens, task, place = encoder(vocabulary), TaskContext.get().partitionId(), 0
        keys, ends, payload, nulls = [], [0], [], 0

        def flush() -> pa.RecordBatch:
            file = NewFile(folder, ".ids")
            for part in packed(np.array(keys, np.int64), nulls, ends, payload):
                file.write(part)
            file.close()
            row = {"file": file.name, "task": task, "place": place, "docs": len(ends) - 1,
                   "ids": ends[-1], "first_key": keys[0] if keys else None,
                   "last_key": keys[-1] if keys else None}
            return pa.RecordBatch.from_pylist([row], manifest_schema)

        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                found = tokens.encode(part.column(1).to_pylist())
                for key, ids in zip(part.column(0).to_pylist(), found):
                    if key is None:
                        nulls += 1
                    else:
                        keys.append(key)
                    payload.append(np.append(ids, ids.dtype.type(end_id)))
                    ends.append(ends[-1] + len(payload[-1]))
                    if ends[-1] * ids.itemsize >= shard_bytes:
                        yield flush()
                        keys, ends, payload, nulls, place = [], [0], [], 0, place + 1
        if payload:
            yield flush()

    text = F.col("text").cast("string")
    rows = docs.select(
        F.col("doc_id").cast("long"), text.alias("text"), F.xxhash64(text).alias("tie")
    )
    order = [F.asc_nulls_first("doc_id"), F.col("tie")]
    manifest_schema = pa.schema([
        (c, pa.string() if c == "file" else pa.int64())
        for c in (x.split()[0] for x in MANIFEST.split(", "))
    ])
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("tie")
    rows.mapInArrow(write, MANIFEST).write.parquet(f"{folder}/manifest")
    return manifest(spark, folder)


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    """The shards of a folder. Their running sum is taken in one place: a row each."""
    before = Window.orderBy("task", "place").rowsBetween(Window.unboundedPreceding, -1)
    shards = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")
    return shards.withColumn("start", F.coalesce(F.sum("ids").over(before), F.lit(0)))


def _spread(shards: DataFrame) -> DataFrame:
    """A shard to a task, or a few where there are many."""
    return shards.repartition(max(1, min(shards.count(), 100_000)))


def read_shards(spark: SparkSession, folder: str) -> DataFrame:
    """Every document of the shards: ``doc_id``, ``start``, ``n_tokens``, ``ids_crc32``.

    Rows are found through the index by their keys; the checksum is that of all ids of the
    document as little-endian unsigned 32-bit integers.
    """
    ship(spark)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard in batch.to_pylist():
                found = Shard(read_file(folder, shard["file"]))
                distinct = np.unique(found.keys)
                firsts = found.rows(distinct)
                if (firsts < 0).any():
                    raise ValueError(f"keys without an entry in {shard['file']}")
                lasts = np.append(firsts[1:], len(found.ends) - 1)
                keys: list[int | None] = [None] * found.nulls
                for key, first, last in zip(distinct.tolist(), firsts, lasts):
                    keys += [key] * int(last - first)
                sums = [
                    zlib.crc32(found.payload[a:b].astype("<u4").tobytes())
                    for a, b in pairwise(found.ends.tolist())
                ]
                ends = found.ends.astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(keys, pa.int64()),
                        pa.array(ends[:-1] + shard["start"]),
                        pa.array(np.diff(ends)),
                        pa.array(sums, pa.int64()),
                    ],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    shards = _spread(manifest(spark, folder).select("file", "start"))
    return shards.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def lookup(keys: DataFrame, folder: str) -> DataFrame:
    """The ids of documents by key: ``doc_id``, ``ids`` for each row stored under a key.

    ``keys`` has ``doc_id``. Keys meet the shards whose range holds them; each shard is
    opened once, by the task that got its keys.
    """
    spark = keys.sparkSession
    ship(spark)
    shards = manifest(spark, folder).where("first_key is not null")
    wanted = keys.select(F.col("doc_id").cast("long")).where("doc_id is not null").distinct()
    ranges = shards.select("file", "first_key", "last_key")
    blocks = -(-ranges.count() // RANGES) or 1
    within = F.col("doc_id").between(F.col("first_key"), F.col("last_key"))
    block = F.pmod(F.xxhash64("file"), F.lit(blocks))
    asked = reduce(
        DataFrame.unionAll,
        (wanted.join(F.broadcast(ranges.where(block == i)), within) for i in range(blocks)),
    )

    def find(group: pa.Table) -> pa.Table:
        shard = Shard(read_file(folder, group["file"][0].as_py()))
        asked_keys = group["doc_id"].to_numpy()
        out_keys, out_ids = [], []
        for key, row in zip(asked_keys.tolist(), shard.rows(asked_keys).tolist()):
            while 0 <= row < len(shard.ends) - 1 and shard.keys[row - shard.nulls] == key:
                out_keys.append(key)
                out_ids.append(shard.ids(row).astype(np.int32).tolist())
                row += 1
        return pa.table({
            "doc_id": pa.array(out_keys, pa.int64()),
            "ids": pa.array(out_ids, pa.list_(pa.int32())),
        })

    return asked.select("doc_id", "file").groupBy("file").applyInArrow(
        find, "doc_id long, ids array<int>"
    )
