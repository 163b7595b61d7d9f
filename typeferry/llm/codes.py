"""Vector codes by product quantisation in whole numbers, with adaptive distance bounds.

A vector's components become ``floor(256 * x)``, the vector is cut into ``parts`` equal parts,
and each part position has a codebook: at first that part of the ``entries`` vectors with the
smallest ``vec_id``. A round assigns every part to the nearest entry (squared distance, ties to
the lower number) and moves each entry to the floored mean of its parts; one more assignment
gives the codes.

Only the first assignment measures all distances. It keeps, for each part, the ``b`` nearest
entries, a lower bound for the distance of each but the first, in rising order, and one outer
bound for all others. In the next assignment every bound is lowered by what its entry has
moved, the outer one by the largest move. Entries whose bound lies beyond the distance to the
part's own entry are out; if the outer bound lies beyond it, only the kept ones are measured,
else all. All of it is in integers: bounds are roots rounded down, moves are rounded up,
distances are exact, so a bound never decides a tie. ``b`` starts at a quarter of the entries
and follows what the last assignment needed, over all rows: the number for which the bounds
kept plus the full searches cost least, an eighth of the entries at the least.

The rows with their bounds are written to the shared folder after each assignment, and beside
them each task's sums for the new entries; Spark adds those up, and the driver sees the sums
alone (entries times components). Nothing depends on how rows are dealt to tasks.

Rows whose vector is null or holds null or non-finite components are dropped; empty vectors
stay, with code 00 throughout and error 0. Rows without a ``vec_id`` are coded and come last in
the order for the first entries; repeated ids are told apart by their vectors, equal rows are
equal. Vectors of another length have codebooks of their own; a length that ``parts`` does not
divide is filled up with zeros. Fewer vectors than ``entries`` give fewer entries. ``label`` may
be null, in any number of rows. An empty table gives an empty result. Other columns are not
looked at. A component so large that distances leave exact arithmetic (beyond 92,681 for parts
of four) fails the job with a message, as no error of it would fit a long.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from math import isqrt

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from typeferry.llm.common import checkpointed, fresh_folder, ship
from typeferry.llm.files import remove_folder

STEPS = 256  # integers to one
SCALE = 16  # bounds are in sixteenths
FAR = (1 << 31) - 1  # the bound of nothing, or of what is too far to tell
EXACT = 1 << 53  # integers that doubles hold
MODEL_BYTES = 1 << 28  # of all codebooks
SMALL_BYTES = 1 << 20  # of labels with their errors, to be broadcast


def finite(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite."""
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(good, F.lit(False))


def whole(values: np.ndarray, dim: int, parts: int) -> np.ndarray:
    """Vectors as integers, a row each, filled up with zeros to a multiple of ``parts``."""
    width = -(-dim // parts)
    out = np.zeros((len(values), parts * width), np.int64)
    if values.size:
        with np.errstate(over="ignore"):
            scaled = np.floor(values * float(STEPS))
        most = isqrt(EXACT // (4 * width))
        if np.abs(scaled).max() > most:
            raise ValueError(f"a component of a vector of {dim} lies beyond {most / STEPS:,.0f}")
        out[:, :dim] = scaled
    return out


def floor_root(squares: np.ndarray) -> np.ndarray:
    root = np.sqrt(squares.astype(np.float64)).astype(np.int64)
    root -= root * root > squares
    root += (root + 1) * (root + 1) <= squares
    return root


def ceil_root(squares: np.ndarray) -> np.ndarray:
    root = floor_root(squares)
    return root + (root * root < squares)


def distances(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """All squared distances; exact, since every number on the way is below ``EXACT``."""
    x, c = points.astype(np.float64), entries.astype(np.float64)
    found = (x * x).sum(1)[:, None] - 2 * (x @ c.T) + (c * c).sum(1)
    return found.astype(np.int64)


@dataclass
class Bounds:
    """Of a part position: each row's nearest entries, and bounds for the others.

    ``near`` has b entries, the row's own first. ``low`` has b bounds, in rising order: of the
    second entry and so on, and last of all entries that are not kept.
    """

    near: np.ndarray
    low: np.ndarray

    def ordered(self) -> Bounds:
        low = np.minimum.accumulate(self.low[:, ::-1], axis=1)[:, ::-1]
        return Bounds(self.near, np.clip(low, 0, FAR))

    def cut(self, keep: int) -> Bounds:
        """The nearest ``keep`` entries only; the first bound left out speaks for the rest."""
        return Bounds(self.near[:, :keep], self.low[:, :keep])


def search(points: np.ndarray, entries: np.ndarray, keep: int) -> tuple[Bounds, np.ndarray]:
    """All distances measured: bounds, and the distance to the nearest entry."""
    size = len(entries)
    keys = distances(points, entries) * size + np.arange(size)
    if keep < size:
        keys = np.partition(keys, keep, axis=1)[:, : keep + 1]
    keys.sort(axis=1)
    low = np.full((len(points), keep), FAR, np.int64)
    bounds = floor_root(keys[:, 1 : keep + 1] // size * SCALE**2)
    low[:, : bounds.shape[1]] = np.minimum(bounds, FAR)
    return Bounds(keys[:, :keep] % size, low), keys[:, 0] // size


def again(
    points: np.ndarray, entries: np.ndarray, moved: np.ndarray, before: Bounds
) -> tuple[Bounds, np.ndarray, np.ndarray]:
    """The assignment after the entries have moved.

    Returns the bounds, the distance to the nearest entry, and for each row how many bounds
    did not exclude their entries: 0, its own entry stays unasked; b, all had to be measured.
    """
    size, keep = len(entries), before.near.shape[1]
    near = before.near
    low = before.low.astype(np.int64)
    low[:, :-1] -= moved[near[:, 1:]]
    low[:, -1] = FAR if keep == size else low[:, -1] - moved.max()
    found = Bounds(near.copy(), low).ordered()
    own = ((points - entries[near[:, 0]]) ** 2).sum(1)
    # Strictly beyond: an equal distance may belong to a lower number.
    unsure = (found.low**2 <= (own * SCALE**2)[:, None]).sum(1)

    some = np.flatnonzero((unsure > 0) & (unsure < keep))
    if len(some):
        listed = near[some]
        exact = ((points[some, None, :] - entries[listed]) ** 2).sum(2)
        keys = np.sort(exact * size + listed, axis=1)
        found.near[some], own[some] = keys % size, keys[:, 0] // size
        bounds = floor_root(keys[:, 1:] // size * SCALE**2)
        found.low[some, :-1] = np.minimum(bounds, found.low[some, -1:])
    every = np.flatnonzero(unsure == keep)
    if len(every):
        fresh, own[every] = search(points[every], entries, keep)
        found.near[every], found.low[every] = fresh.near, fresh.low
    return found.ordered(), own, unsure


@dataclass(frozen=True)
class Codebooks:
    """The entries for vectors of one length, and what the bounds of the rows refer to."""

    entries: np.ndarray  # part, entry, component
    moved: np.ndarray  # part, entry: how far since the last assignment, rounded up
    had: tuple[int, ...]  # bounds that the rows hold, by part
    keep: tuple[int, ...]  # bounds that are kept from now on

    @classmethod
    def first(cls, vectors: np.ndarray, parts: int) -> Codebooks:
        size = len(vectors)
        entries = vectors.reshape(size, parts, -1).transpose(1, 0, 2).copy()
        start = (max(1, size // 4),) * parts
        return cls(entries, np.zeros((parts, size), np.int64), start, start)

    def next(self, sums: dict[tuple[int, int, int], int]) -> Codebooks:
        """Entries at the floored means of their parts, and b by what was needed."""
        parts, size, width = self.entries.shape
        entries = self.entries.copy()
        for part in range(parts):
            for entry in range(size):
                n = sums.get((part, entry, -1), 0)
                for place in range(width if n else 0):
                    entries[part, entry, place] = sums[part, entry, place] // n
        moved = ceil_root(((entries - self.entries) ** 2).sum(2) * SCALE**2)
        keep = tuple(self._needed(part, sums) for part in range(parts))
        return Codebooks(entries, moved, self.keep, keep)

    def _needed(self, part: int, sums: dict[tuple[int, int, int], int]) -> int:
        """The cheapest b: a bound each for all rows, all entries for those beyond it."""
        size, most = self.entries.shape[1], self.keep[part]
        counts = [sums.get((part, -1, reach), 0) for reach in range(self.had[part] + 1)]
        total = sum(counts)
        least = min(most, max(1, size // 8))
        if not total:
            return most
        return min(
            range(least, most + 1), key=lambda b: (b * total + size * sum(counts[b:]), b)
        )

    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


Model = dict[int, Codebooks]


@dataclass
class Sums:
    """What a task adds up for vectors of one length."""

    totals: np.ndarray  # part, entry, component; the last is the count
    reach: list[np.ndarray] = field(default_factory=list)

    @classmethod
    def of(cls, book: Codebooks) -> Sums:
        parts, size, width = book.entries.shape
        return cls(
            np.zeros((parts, size, width + 1), np.int64),
            [np.zeros(had + 1, np.int64) for had in book.had],
        )

    def add(self, part: int, own: np.ndarray, points: np.ndarray) -> None:
        size = self.totals.shape[1]
        for place in range(points.shape[1]):  # exact: a batch's sums are far below EXACT
            added = np.bincount(own, points[:, place], minlength=size)
            self.totals[part, :, place] += added.astype(np.int64)
        self.totals[part, :, -1] += np.bincount(own, minlength=size)

    def rows(self) -> tuple[np.ndarray, ...]:
        """Columns part, entry, place, total. Place -1 is the count; entry -1 has the reach."""
        part, entry, place = np.indices(self.totals.shape).reshape(3, -1)
        place = np.where(place == self.totals.shape[2] - 1, -1, place)
        out = [np.stack([part, entry, place, self.totals.ravel()])]
        for number, counts in enumerate(self.reach):
            n = np.arange(len(counts))
            out.append(np.stack([np.full(len(n), number), np.full(len(n), -1), n, counts]))
        return tuple(np.concatenate(out, axis=1))


def by_length(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    sizes = batch.column("dim")
    for dim in pc.unique(sizes).to_pylist():
        yield dim, batch.filter(pc.equal(sizes, dim))


def lists(rows: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    count, width = rows.shape
    offsets = pa.array(np.arange(count + 1, dtype=np.int32) * width, pa.int32())
    return pa.ListArray.from_arrays(offsets, pa.array(rows.ravel(), kind))


def assigned(
    batch: pa.RecordBatch, book: Codebooks, parts: int, dim: int
) -> tuple[np.ndarray, list[tuple[Bounds, np.ndarray, np.ndarray | None]]]:
    """The integers of a batch's vectors, and each part's bounds, distances and reach."""
    n, first = batch.num_rows, "embedding" in batch.schema.names
    width = book.entries.shape[2]
    if first:
        flat = batch.column("embedding").flatten().to_numpy(zero_copy_only=False)
        q = whole(flat.reshape(n, dim), dim, parts)
    else:
        q = batch.column("q").flatten().to_numpy(zero_copy_only=False).reshape(n, parts * width)
        near = np.frombuffer(b"".join(batch.column("near").to_pylist()), np.uint8).reshape(n, -1)
        low = batch.column("low").flatten().to_numpy(zero_copy_only=False).reshape(n, -1)
    out, at = [], 0
    for part in range(parts):
        points = q[:, part * width : (part + 1) * width]
        if first:
            out.append((*search(points, book.entries[part], book.keep[part]), None))
            continue
        span = slice(at, at + book.had[part])
        at = span.stop
        before = Bounds(near[:, span].astype(np.int64), low[:, span])
        out.append(again(points, book.entries[part], book.moved[part], before))
    return q, out


STATE = ("q array<long>, near binary, low array<int>, "
         "dim int, part int, entry int, place int, total long")  # fmt: skip


def assign(batches: Iterator[pa.RecordBatch], model: Model, parts: int) -> Iterator[pa.RecordBatch]:
    """The rows with new bounds; then, as rows of their own, the sums for the new entries."""
    sums: dict[int, Sums] = {}
    label_type = None
    for whole_batch in batches:
        label_type = whole_batch.column("label").type
        for dim, batch in by_length(whole_batch):
            book = model[dim]
            total = sums.setdefault(dim, Sums.of(book))
            q, found = assigned(batch, book, parts, dim)
            width = book.entries.shape[2]
            near, low = [], []
            for part, (bounds, _, reach) in enumerate(found):
                points = q[:, part * width : (part + 1) * width]
                total.add(part, bounds.near[:, 0], points)
                if reach is not None:
                    total.reach[part] += np.bincount(reach, minlength=len(total.reach[part]))
                kept = bounds.cut(book.keep[part])
                near.append(kept.near.astype(np.uint8))
                low.append(kept.low)
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id"),
                    batch.column("label"),
                    lists(q, pa.int64()),
                    pa.array([r.tobytes() for r in np.concatenate(near, axis=1)], pa.binary()),
                    lists(np.concatenate(low, axis=1), pa.int32()),
                    batch.column("dim"),
                    *[pa.nulls(n, pa.int32())] * 3,
                    pa.nulls(n, pa.int64()),
                ],
                names=["vec_id", "label", "q", "near", "low",
                       "dim", "part", "entry", "place", "total"],
            )
    for dim, total in sums.items():
        part, entry, place, value = total.rows()
        n = len(part)
        yield pa.RecordBatch.from_arrays(
            [
                pa.nulls(n, pa.int64()),
                pa.nulls(n, label_type),
                pa.nulls(n, pa.list_(pa.int64())),
                pa.nulls(n, pa.binary()),
                pa.nulls(n, pa.list_(pa.int32())),
                pa.array(np.full(n, dim), pa.int32()),
                pa.array(part, pa.int32()),
                pa.array(entry, pa.int32()),
                pa.array(place, pa.int32()),
                pa.array(value, pa.int64()),
            ],
            names=["vec_id", "label", "q", "near", "low",
                   "dim", "part", "entry", "place", "total"],
        )


def coded(batches: Iterator[pa.RecordBatch], model: Model, parts: int) -> Iterator[pa.RecordBatch]:
    """The last assignment: codes and errors."""
    named = {dim: book.sha256() for dim, book in model.items()}
    for whole_batch in batches:
        for dim, batch in by_length(whole_batch):
            _, found = assigned(batch, model[dim], parts, dim)
            own = np.stack([bounds.near[:, 0] for bounds, _, _ in found], axis=1).astype(np.uint8)
            error = sum(distance for _, distance, _ in found)
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id"),
                    batch.column("label"),
                    pa.array([r.tobytes().hex() for r in own], pa.string()),
                    pa.array(error, pa.int64()),
                    pa.array([named[dim]] * n, pa.string()),
                ],
                names=["vec_id", "label", "code", "error", "codebooks_sha256"],
            )


def first_entries(rows: DataFrame, parts: int, entries: int) -> Model:
    """Codebooks of the vectors with the smallest ids, for each length."""
    order = Window.partitionBy("dim").orderBy(F.col("vec_id").asc_nulls_last(), "embedding")
    found = (
        rows.select("vec_id", "embedding", "dim")
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= entries)
        .select("dim", "rank", "embedding")
    )
    bytes_ = rows.select("dim").distinct().agg(F.sum((F.col("dim") + parts) * entries * 8)).first()[0] or 0
    if bytes_ > MODEL_BYTES:
        raise ValueError(f"codebooks for all vector lengths would take {bytes_:,} bytes")
    groups: dict[int, list] = {}
    for row in found.orderBy("dim", "rank").collect():
        groups.setdefault(row["dim"], []).append(row["embedding"])
    return {
        dim: Codebooks.first(whole(np.array(g, np.float64).reshape(len(g), dim), dim, parts), parts)
        for dim, g in groups.items()
    }


def codes(
    vectors: DataFrame,
    label: str = "label",
    parts: int = 16,
    entries: int = 64,
    rounds: int = 2,
) -> tuple[DataFrame, Model]:
    """``vec_id``, ``label``, ``code``, ``error``, ``codebooks_sha256`` for each kept row, and
    the codebooks by vector length. At most 256 entries: a code has two hex digits a part."""
    if not 1 <= entries <= 256:
        raise ValueError("a codebook has 1 to 256 entries")
    spark = vectors.sparkSession
    ship(spark)
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col(label).alias("label"),
        F.col("embedding").cast("array<double>").alias("embedding"),
        F.size("embedding").alias("dim"),
    ).where(finite(F.col("embedding")))
    kind = rows.schema["label"].dataType.simpleString()
    model = first_entries(rows, parts, entries)
    given, folder = rows, None
    for _ in range(rounds):
        used, folder = folder, fresh_folder(spark, "codes")
        book = model
        given.mapInArrow(
            lambda batches, book=book: assign(batches, book, parts),
            f"vec_id long, label {kind}, {STATE}",
        ).write.parquet(folder)
        written = spark.read.parquet(folder)
        totals = (
            written.where("total is not null")
            .groupBy("dim", "part", "entry", "place")
            .agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
        )
        sums: dict[int, dict] = {dim: {} for dim in model}
        for r in totals.collect():
            sums[r["dim"]][r["part"], r["entry"], r["place"]] = int(r["total"])
        model = {dim: book.next(sums[dim]) for dim, book in model.items()}
        given = written.where("total is null").select("vec_id", "label", "dim", "q", "near", "low")
        if used:
            remove_folder(spark, used)
    out = checkpointed(
        given.mapInArrow(
            lambda batches: coded(batches, model, parts),
            f"vec_id long, label {kind}, code string, error long, codebooks_sha256 string",
        )
    )
    if folder:
        remove_folder(spark, folder)
    return out, model


def with_label_errors(rows: DataFrame) -> DataFrame:
    """Adds ``label_error``, the sum of ``error`` over rows of an equal label, nulls together.

    The labels are broadcast if their size, which is looked at, allows; else they are joined,
    and Spark splits the rows of a heavy one.
    """
    totals = checkpointed(
        rows.groupBy(F.col("label").alias("same"))
        .agg(F.sum(F.col("error").cast("decimal(38,0)")).cast("long").alias("label_error"))
    )
    length = F.coalesce(F.octet_length(F.col("same").cast("string")), F.lit(0)) + 32
    size = totals.agg(F.sum(length)).first()[0] or 0
    side = F.broadcast(totals) if size <= SMALL_BYTES else totals
    return rows.join(side, F.col("label").eqNullSafe(F.col("same"))).drop("same")


def oracle(parts: int = 16, entries: int = 64, rounds: int = 2) -> str:
    """The same in DuckDB's SQL by brute force, for vectors of one length."""
    steps = [
        f"""kept as (select row_number() over (order by vec_id, embedding) as r, vec_id, label,
    embedding, len(embedding) // {parts} as w from embeddings
  where embedding is not null and coalesce(list_bool_and(
    [x is not null and isfinite(x::double) for x in embedding]), true)),
comp as (select r, w, unnest(range(len(embedding))) as i, embedding from kept),
cut as (select r, i // w as part, i % w as place,
    floor({STEPS} * embedding[i + 1]::double)::bigint as x from comp),
book0 as (select part, r - 1 as entry, place, x as c from cut where r <= {entries})"""
    ]
    for turn in range(rounds + 1):
        steps.append(
            f"""far{turn} as (select r, part, entry, sum((x - c) * (x - c))::bigint as d
  from cut join book{turn} using (part, place) group by all),
own{turn} as (select r, part, min(d * 256 + entry) % 256 as entry, min(d) as d from far{turn}
  group by all)"""
        )
        if turn < rounds:
            steps.append(
                f"""mean{turn} as (select part, entry, place, floor_div as c from (
  select part, entry, place, sum(x)::hugeint as s, count(*) as n,
    ((s - (((s % n) + n) % n)) // n)::bigint as floor_div
  from cut join own{turn} using (r, part) group by all)),
book{turn + 1} as (select part, entry, place, coalesce(m.c, b.c) as c
  from book{turn} b left join mean{turn} m using (part, entry, place))"""
            )
    joined = ",\n".join(steps)
    return f"""with {joined},
coded as (select r, string_agg(lower(lpad(to_hex(entry), 2, '0')), '' order by part) as code,
    sum(d)::bigint as error from own{rounds} group by r),
named as (select sha256(string_agg(c::varchar, ',' order by part, entry, place)) as sha
  from book{rounds})
select vec_id, code, error, sum(error) over (partition by label)::bigint as label_error,
  sha as codebooks_sha256 from coded join kept using (r), named"""
