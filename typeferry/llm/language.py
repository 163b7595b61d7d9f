"""Language identification by mixture inference: which languages, and how much of each.

A document is a mixture of languages: each of its letter trigrams comes from language l with
probability share_l, and then has the likelihood that l gives it. Expectation-maximisation
finds the shares of all languages and of ``other``, a flat background for text in no learned
language. The likelihood is concave in the shares, so the fit does not hang on its start.
Sets of the largest components, nested, are then compared by likelihood less a penalty for
each further language, and the best set's shares are the result.

Fitting: trigram counts by language, over all labelled rows; ``docs_per_language``, if it is
asked for, holds them to so many of each language in expectation, by the hash of their id.
Every language that a usable row names is learned. Trigrams are hashed to ``BUCKETS``, and a model holds those that a
language has been seen with, so it grows with the languages alone. Every text is scored whole.

Nulls and the like: a null text, or one without letters, has no language: ``lang`` null,
share 0, ``other`` 0. Rows with a null language, text or id are not learned from. Without a
learned language every text has none. Ties go to the alphabetically first language. Repeated
rows count as often as they come. Results stand beside the columns they are asked for, and
names of other columns do not matter.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from typeferry.llm.common import begin, kept_by_worker, ship

BUCKETS = 1 << 16
CELLS = 1 << 22  # of likelihoods that a text has as a plain matrix
SPAN = 1 << 20  # characters hashed at once
HELD = 64  # languages a task counts at once
PLACES = 1 << 52  # of an id's hash, of which the sample takes the lowest

RESULT = "struct<lang:string,share:double,other:double,mix:array<struct<lang:string,share:double>>>"
_MIX = pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())]))
_RESULT = pa.struct(
    [("lang", pa.string()), ("share", pa.float64()), ("other", pa.float64()), ("mix", _MIX)]
)


@cache
def _letters() -> np.ndarray:
    """For each code point: itself if it is a letter, else a space."""
    points = np.arange(0x110000, dtype=np.uint32)
    is_letter = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, len(points))
    points[~is_letter] = 32
    return points


kept_by_worker(_letters.cache_clear)


def trigrams(text: str | None) -> np.ndarray:
    """Hashed letter trigrams of a whole text, word edges included."""
    parts = []
    points = np.frombuffer(f" {(text or '').lower()} ".encode("utf-32-le"), np.uint32)
    points = _letters()[points]
    letter = points != 32
    points = points[letter | np.append(True, letter[:-1])].astype(np.uint64)
    for at in range(0, max(len(points) - 2, 0), SPAN):
        a, b, c = (points[at + k : at + k + SPAN] for k in range(3))
        n = len(c)
        mixed = (a[:n] << np.uint64(42)) ^ (b[:n] << np.uint64(21)) ^ c
        mixed = (mixed * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(48)
        parts.append(mixed[b[:n] != 32])
    return np.concatenate(parts).astype(np.int64) if parts else np.empty(0, np.int64)


def counted(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if len(grams) < 4096:
        return np.unique(grams, return_counts=True)
    counts = np.bincount(grams, minlength=BUCKETS)
    found = np.flatnonzero(counts)
    return found, counts[found]


class Sparse:
    """Likelihoods of some buckets, by language: ``base`` but at some places."""

    def __init__(self, base: np.ndarray, places: tuple[np.ndarray, np.ndarray], values: np.ndarray, size: int):
        self.base, self.values, self.shape = base, values, (size, len(base))
        self.rows, self.columns = places
        self.more = values - base[self.columns]

    def __matmul__(self, shares: np.ndarray) -> np.ndarray:
        more = np.bincount(self.rows, self.more * shares[self.columns], self.shape[0])
        return self.base @ shares + more

    @property
    def T(self) -> Transposed:
        return Transposed(self)

    def __getitem__(self, key: tuple[slice, np.ndarray]) -> np.ndarray:
        """Some languages' likelihoods, as a plain matrix."""
        at = np.full(len(self.base), -1)
        at[key[1]] = np.arange(len(key[1]))
        out = np.tile(self.base[key[1]], (self.shape[0], 1))
        some = at[self.columns] >= 0
        out[self.rows[some], at[self.columns[some]]] = self.values[some]
        return out


@dataclass(frozen=True)
class Transposed:
    of: Sparse

    def __matmul__(self, weights: np.ndarray) -> np.ndarray:
        own = self.of
        more = np.bincount(own.columns, own.more * weights[own.rows], own.shape[1])
        return own.base * weights.sum() + more


@dataclass(frozen=True)
class LanguageModel:
    """Probabilities of buckets by language and, last, ``other``.

    ``base`` has those of a bucket not seen with a language; ``columns`` and ``values`` the
    languages each bucket was seen with, and its probabilities, from ``firsts`` on.
    """

    languages: tuple[str, ...]
    base: np.ndarray
    firsts: np.ndarray
    columns: np.ndarray
    values: np.ndarray
    penalty: float = 6.0

    @classmethod
    def of(
        cls, seen: dict[str, tuple[np.ndarray, np.ndarray]], smoothing: float, penalty: float
    ) -> LanguageModel:
        """From the buckets seen with each language, and how often."""
        languages = tuple(sorted(seen))
        sums = [seen[n][1].sum() + smoothing * BUCKETS for n in languages]
        base = np.array([*(smoothing / x for x in sums), 1 / BUCKETS])
        buckets = np.concatenate([np.empty(0, np.int64), *(seen[n][0] for n in languages)])
        values = [(seen[n][1] + smoothing) / x for n, x in zip(languages, sums)]
        sizes = [len(v) for v in values]
        columns = np.repeat(np.arange(len(languages), dtype=np.int32), sizes)
        order = np.argsort(buckets, kind="stable")
        firsts = np.searchsorted(buckets[order], np.arange(BUCKETS + 1))
        values = np.concatenate([np.empty(0), *values])[order]
        return cls(languages, base, firsts, columns[order], values, penalty)

    def likelihood(self, found: np.ndarray) -> np.ndarray | Sparse:
        """Of some buckets, by language and ``other``."""
        counts = self.firsts[found + 1] - self.firsts[found]
        rows = np.repeat(np.arange(len(found)), counts)
        at = np.arange(len(rows)) + np.repeat(self.firsts[found] - np.cumsum(counts) + counts, counts)
        places, values = (rows, self.columns[at]), self.values[at]
        if len(found) * len(self.base) > CELLS:
            return Sparse(self.base, places, values, len(found))
        out = np.tile(self.base, (len(found), 1))
        out[places] = values
        return out

    def mixture(self, text: str | None) -> dict | None:
        """Shares by language and of ``other``; null for a text without letters."""
        found, counts = counted(trigrams(text))
        if not len(found) or not self.languages:
            return None
        likelihood, counts = self.likelihood(found), counts.astype(float)
        shares, full = fit(likelihood, counts)
        order = np.argsort(-shares, kind="stable")
        price = self.penalty * np.log1p(counts.sum())
        best, chosen = -np.inf, shares
        for k in range(1, len(order) + 1):
            some, reached = fit(likelihood[:, order[:k]], counts)
            if reached - price * k > best:
                best, chosen = reached - price * k, np.zeros(len(shares))
                chosen[order[:k]] = some
            if full - reached < price:  # no larger set can make up for its price
                break
        known = chosen[:-1] if chosen[:-1].any() else shares[:-1]
        top = int(np.argmax(known))
        mix = [(n, float(s)) for n, s in zip(self.languages, chosen) if s > 0]
        return {
            "lang": self.languages[top],
            "share": float(np.clip(chosen[top], 0, 1)),
            "other": float(np.clip(chosen[-1], 0, 1)),
            "mix": [{"lang": n, "share": s} for n, s in sorted(mix, key=lambda x: -x[1])],
        }


def fit(likelihood: np.ndarray, counts: np.ndarray, rounds: int = 40) -> tuple[np.ndarray, float]:
    """Shares that make the counts likeliest, and their log-likelihood."""
    k = likelihood.shape[1]
    shares, total = np.full(k, 1 / k), counts.sum()
    for _ in range(rounds if k > 1 else 0):
        new = shares * (likelihood.T @ (counts / (likelihood @ shares))) / total
        done = np.abs(new - shares).max() < 1e-3
        shares = new
        if done:
            break
    return shares, float(counts @ np.log(likelihood @ shares))


def learn(
    docs: DataFrame,
    usable: Column,
    docs_per_language: int | None = None,
    penalty: float = 6.0,
    smoothing: float = 0.3,
) -> LanguageModel:
    """A model from all rows of ``docs`` where ``usable`` holds: columns doc_id, text, lang."""
    spark = docs.sparkSession
    ship(spark)
    rows = docs.where(usable & F.expr("doc_id is not null and lang is not null")).select(
        F.col("lang").cast("string").alias("lang"),
        F.col("text").cast("string").alias("text"),
        F.pmod(F.xxhash64("doc_id"), F.lit(PLACES)).alias("place"),
    )
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not sizes:
        return LanguageModel.of({}, smoothing, penalty)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("language")
        held: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if lang not in held:
                    if len(held) == HELD:
                        yield from map(_counts, held.keys(), held.values())
                        held.clear()
                    held[lang] = np.zeros(BUCKETS, np.int64)
                np.add.at(held[lang], trigrams(text), 1)
        yield from map(_counts, held.keys(), held.values())

    def pack(rows: pa.Table) -> pa.Table:
        found, counts = (rows[c].to_numpy().astype(np.int64) for c in ("bucket", "n"))
        order = np.argsort(found)
        values = [pa.array([x[order].tobytes()], pa.binary()) for x in (found, counts)]
        return pa.table([rows["lang"].slice(0, 1), *values], names=["lang", "buckets", "counts"])

    if docs_per_language is not None:
        upto = [(n, math.ceil(PLACES * min(1, docs_per_language / x))) for n, x in sizes.items()]
        upto = F.broadcast(spark.createDataFrame(sorted(upto), "name string, upto long"))
        known = F.col("lang") == F.col("name")
        rows = rows.join(upto, known & (F.col("place") < F.col("upto")))
    parts = rows.select("lang", "text").mapInArrow(count, "lang string, bucket int, n long")
    sums = parts.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    found = sums.groupBy("lang").applyInArrow(pack, SEEN)  # no more than BUCKETS rows each
    none = np.empty(0, np.int64)
    seen = {name: (none, none) for name in sizes}
    for r in found.collect():
        seen[r["lang"]] = np.frombuffer(r["buckets"], np.int64), np.frombuffer(r["counts"], np.int64)
    return LanguageModel.of(seen, smoothing, penalty)


SEEN = "lang string, buckets binary, counts binary"


def _counts(lang: str, total: np.ndarray) -> pa.RecordBatch:
    """The buckets that a language has been seen with, and how often."""
    found = np.flatnonzero(total)
    langs = pa.array([lang] * len(found), pa.string())
    columns = [langs, pa.array(found.astype(np.int32)), pa.array(total[found])]
    return pa.RecordBatch.from_arrays(columns, names=["lang", "bucket", "n"])


def mixtures(docs: DataFrame, model: LanguageModel, text: str = "text") -> Column:
    """The mixture of each text as a column of type ``RESULT``, for a select over ``docs``."""
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)  # grows with the languages, not the documents
    none = {"lang": None, "share": 0.0, "other": 0.0, "mix": []}

    @F.arrow_udf(RESULT)
    def infer(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        begin("language")
        for part in texts:
            found = [shared.value.mixture(t) or none for t in part.to_pylist()]
            yield pa.array(found, _RESULT)

    return infer(F.col(text).cast("string"))


def identified(docs: DataFrame, model: LanguageModel, most_other: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that stay: some learned language, and ``other`` no larger part."""
    name = _free_name(docs)
    kept = docs.withColumn(name, mixtures(docs, model)).where(
        F.col(f"{name}.lang").isNotNull() & (F.col(f"{name}.other") <= most_other)
    )
    return kept.drop(name)


def _free_name(docs: DataFrame) -> str:
    name = "mixture_"
    while name in {c.lower() for c in docs.columns}:
        name += "_"
    return name
