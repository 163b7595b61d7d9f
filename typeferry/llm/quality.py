"""A quality classifier that borrows strength from sites, by hierarchical empirical Bayes.

Every document has the evidence of a logistic classifier over measures of its text. Documents
of one path, and paths of one host, tend to be alike: grouped sums of the evidence give each
host a posterior rate of good documents, shrunk toward the rate of all, and each path one,
shrunk toward its host's. How strongly is estimated from the data: the spread of the rates of
hosts (and of paths around their hosts) beyond what their sizes would give by chance. Sparse
sites stay near their parent, large ones speak for themselves. A document's own evidence is
taken out of its sites before they speak about it, and its score is the classifier's log-odds
plus what its path's rate adds to the rate of all.

The classifier is fitted on all labelled rows, the sums of each round made where they are; a
``sample``, if it is asked for, holds them to so many in expectation, by the hash of their id.
Sums, rates and spreads are those of all documents. Sites are joined by host and
path: up to ``FEW_SITES`` are broadcast, beyond that Spark splits heavy ones.

Nulls and the like: a null or empty text has score 0 and is no evidence about its site; null
hosts are one host, null paths one path of their host; rows that repeat a document count as
often as they come; rows with a null ``doc_id`` are scored, but not learned from; without
labels of both kinds the classifier gives every text the rate of what labels there are, or a
half; an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from typeferry.llm.common import begin, checkpointed, kept_by_worker, ship, thinned
from typeferry.llm.sums import PARTS, parts_of, summed

SPAN = 1 << 20  # characters measured at once
LEAST = 0.5  # score of an accepted document
FEW_SITES = 100_000  # up to which the table of sites is broadcast
MEASURES = (
    "log_words", "word_length", "upper", "digit", "symbol", "space", "distinct_words",
    "repeated_words", "lone_symbols", "marked_words", "common_word", "line_length",
)


@cache
def _kinds() -> np.ndarray:
    """0 other letters, 1 upper case, 2 digits, 3 white space, 4 symbols, by code point."""
    out = np.empty(0x110000, np.uint8)
    for i in range(0x110000):
        c = chr(i)
        if c.isalpha():
            out[i] = c.isupper()
        else:
            out[i] = 2 if c.isdigit() else 3 if c.isspace() else 4
    return out


kept_by_worker(_kinds.cache_clear)


def measure(text: str | None) -> list[float]:
    """``MEASURES`` of a whole text."""
    text = text or ""
    kinds = np.zeros(5)
    for at in range(0, len(text), SPAN):
        points = np.frombuffer(text[at : at + SPAN].encode("utf-32-le"), np.uint32)
        kinds += np.bincount(_kinds()[points], minlength=5)
    words = text.split()
    n = max(len(words), 1)
    counts: dict[str, int] = {}
    for word in words:
        counts[word] = counts.get(word, 0) + 1
    same = sum(a == b for a, b in pairwise(words))
    size = max(len(text), 1)
    lone = sum(counts.get(x, 0) for x in ("|", "-", "*", "#", "=", ">", "•"))
    ends = sum(c for w, c in counts.items() if len(w) > 1 and not (w[-1].isalnum() or w[-1] in ".,;:!?)\"'"))
    marks = sum(c for w, c in counts.items() if w.endswith(("!!", "??", "...")))
    return [
        np.log1p(len(words)),
        kinds[[0, 1, 2, 4]].sum() / n / 10,
        kinds[1] / size,
        kinds[2] / size,
        kinds[4] / size,
        kinds[3] / size,
        len(counts) / n ** 0.9,
        same / n,
        lone / n,
        (ends + marks) / n,
        max(counts.values(), default=0) / n,
        np.log1p(n / (text.count("\n") + 1)),
    ]


Total = Callable[[Callable[[np.ndarray, np.ndarray], np.ndarray], int], np.ndarray]


@dataclass(frozen=True)
class Classifier:
    """Log-odds of a good text from its measures."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float

    def log_odds(self, texts: list[str | None]) -> np.ndarray:
        if not texts:
            return np.empty(0)
        rows = expand((np.array([measure(t) for t in texts]) - self.mean) / self.scale)
        return np.clip(rows @ self.weights + self.bias, -12, 12)

    @classmethod
    def fit(cls, rows: np.ndarray, labels: np.ndarray, ridge: float = 3.0) -> Classifier:
        """Logistic regression by Newton's method."""
        return cls.fitted(lambda of, size: of(rows, labels), ridge)

    @classmethod
    def fitted(cls, total: Total, ridge: float = 3.0) -> Classifier:
        """The same of rows wherever they are: ``total`` gives the sum over all of them of a
        function of measures and labels, a vector of some size."""
        k = len(MEASURES)
        width = expand(np.zeros((1, k))).shape[1]
        n, good, squares, *sums = total(
            lambda x, y: np.append([len(y), y.sum(), (y**2).sum()], x.sum(0)), k + 3
        )
        if n * squares == good**2:  # one label, or none
            rate = (good + 0.5) / (n + 1)
            return cls(np.zeros(k), np.ones(k), np.zeros(width), float(np.log(rate / (1 - rate))))
        mean = np.array(sums) / n
        scale = np.sqrt(total(lambda x, y: ((x - mean) ** 2).sum(0), k) / n) + 1e-6
        w = np.zeros(width + 1)
        penalty = np.full(width + 1, ridge)
        penalty[-1] = 0
        for _ in range(30):

            def newton(x: np.ndarray, y: np.ndarray, w: np.ndarray = w) -> np.ndarray:
                x = np.hstack([expand((x - mean) / scale), np.ones((len(x), 1))])
                p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
                return np.append(x.T @ (y - p), (x * (p * (1 - p))[:, None]).T @ x)

            found = total(newton, (width + 1) * (width + 2))
            slope = found[: width + 1] - penalty * w
            curve = found[width + 1 :].reshape(width + 1, -1) + np.diag(penalty + 1e-9)
            step = np.linalg.solve(curve, slope)
            w = w + step / max(1.0, np.abs(step).max())
            if np.abs(step).max() < 1e-6:
                break
        return cls(mean, scale, w[:-1], float(w[-1]))


def expand(rows: np.ndarray) -> np.ndarray:
    """The measures, clipped, and their squares: both ends of a measure can be bad."""
    rows = np.clip(rows, -6, 6)
    return np.hstack([rows, rows**2])


def learn(
    docs: DataFrame, labels: DataFrame, usable: Column, sample: int | None = None
) -> Classifier:
    """A classifier from all rows of ``docs`` where ``usable`` holds and ``labels`` has a
    ``quality``."""
    ship(docs.sparkSession)
    known = labels.select(
        F.col("doc_id").cast("long").alias("own_id"), F.col("quality").cast("int").alias("own")
    ).where("own is not null and own_id is not null").distinct()
    rows = docs.where(usable).select(
        F.col("doc_id").cast("long").alias("doc"), F.col("text").cast("string").alias("text")
    )
    match = F.col("doc") == F.col("own_id")
    if sample is None:
        # Measures are joined, not texts, and stored for the rounds that read them.
        measured = rows.where("doc is not null").mapInArrow(_measured, "doc long, x array<double>")
        stored = checkpointed(measured.join(known, match).select("x", "own"))
        return Classifier.fitted(lambda of, size: _total(stored, of, size))
    n = known.count()
    place = F.pmod(F.xxhash64("own_id"), F.lit(1 << 52))
    known = known.where(place < int((1 << 52) * min(1, sample / max(n, 1))))
    # The sample is bounded; the texts of others are not shuffled.
    rows = rows.join(F.broadcast(known), match).select(F.col("own").cast("long").alias("doc"), "text")
    rows = thinned(rows, sample).repartition(16)  # copies of an id may be any number
    got = rows.mapInArrow(_measured, "doc long, x array<double>").toArrow()
    return Classifier.fit(_matrix(got["x"].combine_chunks()), got["doc"].to_numpy().astype(float))


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The measures of texts beside another column."""
    begin("quality")
    for batch in batches:
        found = [measure(t) for t in batch.column(1).to_pylist()]
        arrays = [batch.column(0), pa.array(found, pa.list_(pa.float64()))]
        yield pa.RecordBatch.from_arrays(arrays, names=["doc", "x"])


def _matrix(rows: pa.Array) -> np.ndarray:
    return rows.flatten().to_numpy().reshape(-1, len(MEASURES))


def _total(rows: DataFrame, of: Callable[[np.ndarray, np.ndarray], np.ndarray], size: int) -> np.ndarray:
    """The sum over measures ``x`` and labels ``own`` of a function of them."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("quality")
        total = np.zeros(size)
        for batch in batches:
            total += of(_matrix(batch.column(0)), batch.column(1).to_numpy().astype(float))
        yield parts_of(total)

    return summed(rows.mapInArrow(add, PARTS), size)


def evidence(docs: DataFrame, classifier: Classifier) -> Column:
    """The classifier's log-odds of each text; null where there is none."""
    ship(docs.sparkSession)

    @F.arrow_udf("double")
    def weigh(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        begin("quality")
        for part in texts:
            yield pa.array(classifier.log_odds(part.to_pylist()), pa.float64())

    text = F.col("text").cast("string")
    return F.when(text.rlike(r"\S"), weigh(text))


def site(value: Column) -> Column:
    """A key for a host or path, null one of its own."""
    return F.coalesce(F.concat(F.lit("="), value.cast("string")), F.lit(""))


def spread(squares: float, sizes: float, rate: float, n: float, groups: int) -> float:
    """The strength of a prior, as a number of documents, from how rates spread around it.

    ``squares`` is the sum of sizes times squared deviations, ``sizes`` that of squared sizes.
    """
    chance = rate * (1 - rate)
    free = n - sizes / n if n else 0.0
    between = (squares - chance * max(groups - 1, 0)) / free if free > 0 else 0.0
    if between <= 0 or chance <= 0:
        return 1e6
    return float(np.clip(chance / between - 1, 1.0, 1e6))


def rates(weighed: DataFrame) -> tuple[DataFrame, float, float, float]:
    """Sums by host and path, the rate of all, and the strengths of the two priors.

    ``weighed`` has ``host``, ``path`` and ``good``, the probability of each document.
    """
    paths = checkpointed(
        weighed.where("good is not null")
        .groupBy("host", "path")
        .agg(F.count("*").alias("n"), F.sum("good").alias("s"))
    )
    hosts = paths.groupBy("host").agg(F.sum("n").alias("host_n"), F.sum("s").alias("host_s"))
    total = paths.agg(F.sum("n").alias("n"), F.sum("s").alias("s")).first()
    n = float(total["n"] or 0)
    rate = (total["s"] or 0.0) / n if n else 0.5
    off = F.col("host_s") / F.col("host_n") - rate
    h = hosts.agg(
        F.sum(F.col("host_n") * off * off).alias("q"),
        F.sum(F.col("host_n").cast("double") * F.col("host_n")).alias("z"),
        F.count("*").alias("g"),
    ).first()
    off = F.col("s") / F.col("n") - F.col("host_s") / F.col("host_n")
    both = paths.join(hosts, "host")
    p = both.agg(
        F.sum(F.col("n") * off * off).alias("q"),
        F.sum(F.col("n").cast("double") * F.col("n") / F.col("host_n")).alias("z"),
        F.count("*").alias("g"),
        F.countDistinct("host").alias("k"),
    ).first()
    host_prior = spread(h["q"] or 0.0, h["z"] or 0.0, rate, n, h["g"])
    chance = rate * (1 - rate)
    free = n - (p["z"] or 0.0)
    within = ((p["q"] or 0.0) - chance * (p["g"] - p["k"])) / free if free > 0 else 0.0
    path_prior = float(np.clip(chance / within - 1, 1.0, 1e6)) if within > 0 else 1e6
    return both, rate, host_prior, path_prior


def scores(docs: DataFrame, classifier: Classifier, host: str = "source", path: str = "lang") -> DataFrame:
    """``doc_id``, ``score``, ``text_score``, ``host_rate``, ``path_rate`` for every row."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        site(F.col(host)).alias("host"),
        site(F.col(path)).alias("path"),
        evidence(docs, classifier).alias("odds"),
    )
    rows = checkpointed(rows.withColumn("good", _probability(F.col("odds"))))
    joined = rows.join(_sized(site_rates(rows)), ["host", "path"], "left")
    return joined.select("doc_id", *_posterior("odds", "good"))


def _sized(sites: DataFrame) -> DataFrame:
    """The sites, to be broadcast if they are few: then documents stay where they are. If
    not, the join is a shuffle, of which Spark splits heavy sites."""
    return F.broadcast(sites) if sites.count() <= FEW_SITES else sites


def site_rates(weighed: DataFrame) -> DataFrame:
    """Sums of each host and path with the priors beside them, for ``_posterior``."""
    sites, rate, host_prior, path_prior = rates(weighed)
    return sites.select(
        "host", "path", "n", "s", "host_n", "host_s",
        F.lit(rate).alias("rate"),
        F.lit(host_prior).alias("host_prior"),
        F.lit(path_prior).alias("path_prior"),
    )


def _probability(odds: Column) -> Column:
    return 1 / (1 + F.exp(-odds))


def _log_odds(rate: Column) -> Column:
    low = F.greatest(F.least(rate, F.lit(1 - 1e-6)), F.lit(1e-6))
    return F.log(low / (1 - low))


def _posterior(odds: str, good: str) -> list[Column]:
    """Score and rates of a document, its own evidence taken out of its sites."""
    own = F.coalesce(F.col(good), F.lit(0.0))
    one = F.when(F.col(good).isNotNull(), 1).otherwise(0)
    rate = F.col("rate")
    host = (F.col("host_s") - own + F.col("host_prior") * rate) / (
        F.col("host_n") - one + F.col("host_prior")
    )
    path = (F.col("s") - own + F.col("path_prior") * host) / (
        F.col("n") - one + F.col("path_prior")
    )
    score = _probability(F.col(odds) + _log_odds(path) - _log_odds(rate))
    return [
        F.coalesce(score, F.lit(0.0)).alias("score"),
        F.coalesce(F.col(good), F.lit(0.0)).alias("text_score"),
        host.alias("host_rate"),
        path.alias("path_rate"),
    ]


def accepted(
    docs: DataFrame, classifier: Classifier, host: str = "source", path: str = "lang",
    least: float = LEAST,
) -> DataFrame:
    """The rows of ``docs`` whose score is ``least`` or more, all their columns as they were."""
    rows = docs.select(
        F.struct("*").alias("row"),  # whatever its columns are called
        site(F.col(host)).alias("host"),
        site(F.col(path)).alias("path"),
        evidence(docs, classifier).alias("odds"),
    ).withColumn("good", _probability(F.col("odds")))
    joined = rows.join(_sized(site_rates(rows)), ["host", "path"], "left")
    return joined.select("row", *_posterior("odds", "good")).where(F.col("score") >= least).select("row.*")
