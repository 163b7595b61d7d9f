"""Embedding near-duplicates through an inverted multi-index.

Vectors of length one are cut in half, and each half has a codebook of its own, fitted by
k-means on a bounded sample. The pairs of codewords are the cells of a grid, and every vector
is filed under its nearest. A vector's neighbours lie in the cells near it: the multi-sequence
traversal visits cells in the order of their distance, the sum of two sorted lists, until the
distance is ``slack`` beyond that of the nearest. ``slack`` is set on the sample such that
``recall`` of the neighbours at exactly the threshold, in random directions, are found.
All candidates are then verified: cosine in double precision, at least ``threshold``.

A pair is a candidate if either vector visits the other's cell, and is verified and counted
once for each. Cells are cut into blocks of ``block`` vectors, visits likewise, so a cell that
holds a third of all vectors is many pairs of blocks in many tasks. Tasks report counts for
each vector and a spanning forest of the links, not the pairs.

Vectors of floats are kept as such, all others as doubles, and compared as doubles. Vectors of
another length have an index of their own, one after the other: a table has few lengths.

Equal vectors are folded first and count as linked with each other. Vectors that are null,
empty, zero, or that hold null or non-finite components link with nothing. Rows with a null
``vec_id`` are linked and counted but never name a component (one with no other rows has a null
id); repeated rows count as rows. An empty table gives an empty result. Other columns, labels among them, are not looked at.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from typeferry.llm.common import checkpointed, components, ship
from typeferry.llm.simhash import forest

SAMPLE = 16_384  # vectors that codebooks and slack are fitted on, in expectation
PLACES = 1 << 52  # of a vector's hash


def usable(vector: Column) -> Column:
    """Whether a vector of numbers can link at all."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def unit(vectors: np.ndarray) -> np.ndarray:
    # By a power of two first, so that neither the largest nor the smallest number is lost.
    vectors = vectors.astype(np.float64)
    vectors = np.ldexp(vectors, -np.frexp(np.abs(vectors).max(axis=1, keepdims=True))[1])
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def squared(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    cross = points @ centres.T
    return np.maximum(
        (points**2).sum(1)[:, None] - 2 * cross + (centres**2).sum(1)[None, :], 0
    )


def codebook(points: np.ndarray, words: int, rounds: int = 12) -> np.ndarray:
    """Codewords by k-means, from a fixed start."""
    rng = np.random.default_rng(7)
    centres = points[rng.permutation(len(points))[:words]].copy()
    for _ in range(rounds):
        own = squared(points, centres).argmin(1)
        counts = np.bincount(own, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, own, points)
        centres[counts > 0] = sums[counts > 0] / counts[counts > 0, None]
    return centres


def multi_sequence(first: np.ndarray, second: np.ndarray, most: float) -> list[tuple[int, int]]:
    """Pairs of codewords in the order of ``first[i] + second[j]``, up to ``most``."""
    a, b = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    heap, out = [(first[a[0]] + second[b[0]], 0, 0)], []
    while heap:
        total, i, j = heapq.heappop(heap)
        if total > most:
            break
        out.append((int(a[i]), int(b[j])))
        if i + 1 < len(a) and j == 0:
            heapq.heappush(heap, (first[a[i + 1]] + second[b[0]], i + 1, 0))
        if j + 1 < len(b):
            heapq.heappush(heap, (first[a[i]] + second[b[j + 1]], i, j + 1))
    return out


@dataclass(frozen=True)
class MultiIndex:
    """Codebooks of the halves, and how far beyond the nearest cell a search goes."""

    first: np.ndarray
    second: np.ndarray
    slack: float

    def distances(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cut = self.first.shape[1]
        return squared(vectors[:, :cut], self.first), squared(vectors[:, cut:], self.second)

    def cells(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        return one.argmin(1).astype(np.int64) * len(self.second) + two.argmin(1)

    @classmethod
    def fit(cls, sample: np.ndarray, words: int, threshold: float, recall: float) -> MultiIndex:
        cut = sample.shape[1] // 2
        index = cls(codebook(sample[:, :cut], words), codebook(sample[:, cut:], words), 0.0)
        rng = np.random.default_rng(11)
        away = rng.standard_normal(sample.shape)
        away -= (away * sample).sum(1, keepdims=True) * sample
        length = np.linalg.norm(away, axis=1, keepdims=True)
        away = np.divide(away, length, out=np.zeros_like(away), where=length > 0)
        near = threshold * sample + np.sqrt(1 - threshold**2) * away
        one, two = index.distances(sample)
        cells = index.cells(*index.distances(near))
        row = np.arange(len(sample))
        there = one[row, cells // len(index.second)] + two[row, cells % len(index.second)]
        slack = np.quantile(there - one.min(1) - two.min(1), recall)
        return cls(index.first, index.second, float(slack) + 1e-9)


def place(
    batches: Iterator[pa.RecordBatch], index: MultiIndex, dim: int, kind: str
) -> Iterator[pa.RecordBatch]:
    """The cell of each vector and the cells it visits, the other ones first."""
    for batch in batches:
        flat = batch.column(1).flatten().to_numpy(zero_copy_only=False)
        rows = flat.astype(kind).reshape(-1, dim)
        one, two = index.distances(unit(rows))
        own, visits = index.cells(one, two), []
        most = one.min(1) + two.min(1) + index.slack
        for x, y, upto in zip(one, two, most):
            seen = multi_sequence(x, y, upto)
            visits.append([i * len(index.second) + j for i, j in seen])
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                batch.column(2),
                pa.array([r.tobytes() for r in rows], pa.binary()),
                pa.array(own),
                pa.array(visits, pa.list_(pa.int64())),
            ],
            names=["node", "copies", "vector", "cell", "visits"],
        )


def verify(
    batches: Iterator[pa.RecordBatch], index: MultiIndex, dim: int, kind: str, threshold: float
) -> Iterator[pa.RecordBatch]:
    """Links between blocks: rows (a, b, null) of a forest, rows (a, null, n) of counts.

    A pair is seen from both sides if each visits the other's cell; then only the side
    that asks is counted here, the other by its own question.
    """
    for batch in batches:
        column = {n: batch.column(i).to_pylist() for i, n in enumerate(batch.schema.names)}
        links, nodes, numbers = [], [], []
        for k in range(batch.num_rows):
            q_id, m_id = np.array(column["q_nodes"][k]), np.array(column["m_nodes"][k])
            q_n, m_n = np.array(column["q_copies"][k]), np.array(column["m_copies"][k])
            q = unit(np.frombuffer(b"".join(column["q_vectors"][k]), kind).reshape(-1, dim))
            m = unit(np.frombuffer(b"".join(column["m_vectors"][k]), kind).reshape(-1, dim))
            hit = (q @ m.T >= threshold) & (q_id[:, None] != m_id[None, :])
            if not hit.any():
                continue
            both = np.concatenate([q_id, m_id])
            links.append(both[forest(hit, False)])
            q_one, q_two = index.distances(q)
            q_cell = index.cells(q_one, q_two)
            one, two = index.distances(m)
            upto = (one.min(1) + two.min(1) + index.slack)[:, None]
            width = len(index.second)
            back = one[:, q_cell // width] + two[:, q_cell % width] <= upto
            alone = hit & ~back.T  # the member does not ask for this pair itself
            nodes += [q_id, m_id]
            numbers += [hit @ m_n, q_n @ alone]
        found = np.concatenate([np.empty((0, 2), np.int64), *links])
        ids = np.concatenate([np.empty(0, np.int64), *nodes])
        counts = np.concatenate([np.empty(0, np.int64), *numbers]).astype(np.int64)
        ids, at = np.unique(ids[counts > 0], return_inverse=True)
        totals = np.zeros(len(ids), np.int64)
        np.add.at(totals, at, counts[counts > 0])
        blank = [pa.nulls(len(ids), pa.int64()), pa.nulls(len(found), pa.int64())]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate([found[:, 0], ids])),
                pa.concat_arrays([pa.array(found[:, 1]), blank[0]]),
                pa.concat_arrays([blank[1], pa.array(totals)]),
            ],
            names=["a", "b", "n"],
        )


def blocks(rows: DataFrame, cell: Column, prefix: str, block: int) -> DataFrame:
    """The rows of each cell in lists of about ``block``, dealt by hash."""
    rows = rows.withColumn("at", cell)
    sizes = rows.groupBy("at").agg(F.ceil(F.count("*") / block).cast("int").alias("parts"))
    part = F.pmod(F.xxhash64("node"), F.col("parts"))
    grouped = rows.join(sizes, "at").groupBy("at", part.alias(f"{prefix}part"))
    packed = F.collect_list(F.struct("node", "copies", "vector")).alias("rows")
    return grouped.agg(packed).select(
        "at",
        F.col("rows.node").alias(f"{prefix}nodes"),
        F.col("rows.copies").alias(f"{prefix}copies"),
        F.col("rows.vector").alias(f"{prefix}vectors"),
    )


def near_duplicates(
    vectors: DataFrame,
    threshold: float = 0.95,
    recall: float = 0.995,
    words: int | None = None,
    block: int = 256,
) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id`` for every row of ``vec_id``, ``embedding``."""
    ship(vectors.sparkSession)
    given = vectors.schema["embedding"].dataType
    floats = isinstance(given, T.ArrayType) and isinstance(given.elementType, T.FloatType)
    rows = vectors.select(
        F.col("vec_id").cast("long"),
        F.col("embedding").cast("array<float>" if floats else "array<double>"),
    )
    is_good = usable(F.col("embedding"))
    size = F.size("embedding")
    lengths = rows.where(is_good).groupBy(size.alias("d")).count().orderBy(F.desc("count"), "d")
    out = rows.where(~is_good).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    for found in lengths.collect():
        some = rows.where(is_good & (size == found["d"]))
        kind = "<f4" if floats else "<f8"
        linked = _one_length(some, found["d"], kind, threshold, recall, words, block)
        out = linked.unionAll(out)
    return out


def _one_length(
    rows: DataFrame,
    dim: int,
    kind: str,
    threshold: float,
    recall: float,
    words: int | None,
    block: int,
) -> DataFrame:
    distinct = checkpointed(
        rows.groupBy("embedding")
        .agg(F.min("vec_id").alias("first_id"), F.count("*").alias("copies"))
        .withColumn("node", F.monotonically_increasing_id())
    )
    total = distinct.count()
    upto = int(PLACES * min(1.0, SAMPLE / max(total, 1)))
    low = distinct.where(F.pmod(F.xxhash64("embedding"), F.lit(PLACES)) < upto)
    flat = low.select("embedding").toArrow()["embedding"].combine_chunks().flatten()
    sample = flat.to_numpy(zero_copy_only=False).astype(kind).reshape(-1, dim)
    sample = sample[np.lexsort(sample.T[::-1])]
    size = words or 2 ** round(np.log2(np.clip(np.sqrt(total / 16), 8, 1024)))
    index = MultiIndex.fit(unit(sample), size, threshold, recall)
    found = _links(distinct, index, dim, kind, threshold, block)
    counts = found.where("n is not null").groupBy("a").agg(F.sum("n").alias("n"))
    roots = components(found.where("b is not null").select("a", "b"))
    named = distinct.join(roots, "node", "left").join(
        counts, F.col("node") == F.col("a"), "left"
    ).select(
        "embedding",
        "first_id",
        (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"),
        F.coalesce("root", "node").alias("root"),
    )
    least = checkpointed(named.groupBy("root").agg(F.min("first_id").alias("component_id")))
    linked = named.join(least, "root").select("embedding", "n_links", "component_id")
    return rows.join(linked, "embedding").select("vec_id", "n_links", "component_id")


def _links(
    distinct: DataFrame, index: MultiIndex, dim: int, kind: str, threshold: float, block: int
) -> DataFrame:
    placed = checkpointed(
        distinct.select("node", "embedding", "copies").mapInArrow(
            lambda batches: place(batches, index, dim, kind),
            "node long, copies long, vector binary, cell long, visits array<long>",
        )
    )
    members = blocks(placed, F.col("cell"), "m_", block)
    asking = blocks(placed.withColumn("visit", F.explode("visits")), F.col("visit"), "q_", block)
    pairs = asking.join(members, "at").drop("at")
    return checkpointed(
        pairs.mapInArrow(
            lambda batches: verify(batches, index, dim, kind, threshold), "a long, b long, n long"
        )
    )


def oracle(threshold: float = 0.95) -> str:
    """All pairs of vectors of a length compared in DuckDB's SQL, and what their links reach."""
    return f"""with recursive good as materialized (select vec_id, embedding::double[] as v from embeddings
  where embedding is not null and list_bool_and([x is not null and isfinite(x) for x in embedding])
    and list_bool_or([x <> 0 for x in embedding])),
near as materialized (select a.vec_id as a, b.vec_id as b from good a join good b
  on len(a.v) = len(b.v) and a.vec_id <> b.vec_id
  where list_cosine_similarity(a.v, b.v) >= {threshold}),
reached(a, b) as (select vec_id, vec_id from embeddings union
  select reached.a, near.b from reached join near on reached.b = near.a),
least as (select a, min(b) as component_id from reached group by a)
select vec_id, (select count(*) from near where near.a = e.vec_id)::bigint as n_links,
  component_id, vec_id = component_id as kept
from embeddings e join least on e.vec_id = least.a"""
