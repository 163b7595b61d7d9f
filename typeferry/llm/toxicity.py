"""Toxicity by weak supervision: many noisy voters, a generative model of them, a classifier.

* Voters. Each looks for one thing in a text: a word of a fixed lexicon, a pair of words that
  follow one another, or a word or beginning of words, once or several times, that labelled
  toxic texts have far more often than others (mined from a bounded sample of labelled rows).
  It votes or abstains.
* Label model. Whether a document is toxic is hidden, unless it is labelled, and each voter
  has a rate of voting in either case. Voters of one language say nothing of another, so an
  abstention is no evidence, but for texts on which all abstain: those have a rate of their
  own. Expectation-maximisation fits the rates, and the
  correlations of voters within each case, over all documents that may be learned from; they
  are grouped by pattern of votes first. Voters that go together would count one thing many
  times: each one's log-odds are divided by one plus its positive correlations with others.
* Classifier. A logistic one over the presence of words and beginnings, trained on the
  posterior labels of a bounded sample, half of it with votes, weighted back to all documents.
  The score is its probability.

Samples: ``TOXIC`` and ``CLEAN`` labelled rows for mining, ``TRAIN`` documents for training,
in expectation, by the hash of their id. Votes and rates are those of all usable documents.
Labels, languages, sources and ids are never inputs of a score.

Nulls and the like: a null or empty text has no votes and gets the classifier's bias as its
score; labels that are null or neither 0 nor 1 are not labels; rows with a null ``doc_id`` are
scored and not learned from; repeated rows each get a score; without labels the lexicon votes
alone; an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from typeferry.llm.common import PLACES, begin, checkpointed, ship, thinned
from typeferry.llm.sums import PARTS, parts_of, summed
from typeferry.llm.words import Terms, Words, word_batches

TOXIC, CLEAN, TRAIN = 4_000, 8_000, 12_000
VOTERS, FEATURES = 160, 800
SUPPORT = 4  # toxic texts that a mined signal is in, at the least
LENGTHS = (None, 3, 4, 5, 6, 7)  # whole words, and their first bytes
LEVELS = np.array([1, 2, 4])  # how often a thing must be there; in a signal's last two bits
STRONG = 0.5  # correlation from which two voters count as saying one thing

# Words and pairs of words that are insults or threats wherever they stand.
LEXICON = (
    "idiot", "moron", "stupid", "loser", "pathetic", "worthless", "disgusting", "scum", "trash",
    "clown", "imbecile", "retard", "bastard", "bitch", "asshole", "dumbass", "jerk", "creep",
    "filth", "vermin", "subhuman", "dummkopf", "trottel", "arschloch", "abschaum", "connard",
    "salope", "ordure", "estúpido", "imbécil", "pendejo", "basura",
)
PAIRS = (
    "shut up", "hate you", "kill yourself", "go die", "drop dead", "halt maul", "ta gueule",
    "te odio",
)


def tagged(hashes: np.ndarray, kind: int) -> np.ndarray:
    """Hashes of one kind of thing, the last two bits left free."""
    return (hashes ^ np.uint64((kind + 1) * 0xA24BAED4963EE407 % 2**64)) & ~np.uint64(3)


def features_of(words: Words) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Text number and hash of each word, of its beginnings, and of each pair of words."""
    whole = words.hashes()
    for kind, length in enumerate(LENGTHS):
        if length is None:
            yield words.text, tagged(whole, kind)
        else:
            longer = words.ends - words.starts > length
            yield words.text[longer], tagged(words.hashes(length)[longer], kind)
    beside = words.text[1:] == words.text[:-1]
    pairs = whole[:-1] * np.uint64(0x9FB21C651E98DF25) + whole[1:]
    yield words.text[:-1][beside], tagged(pairs[beside], len(LENGTHS))


class Signals:
    """Things to look for, each a hash whose last two bits say how often, by ``LEVELS``."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = np.unique(hashes.astype(np.uint64))
        bases = self.hashes & ~np.uint64(3)
        self.terms = Terms(bases)
        self.which = np.searchsorted(self.terms.sorted, bases)
        self.least = LEVELS[(self.hashes & np.uint64(3)).astype(np.int64)]

    def __len__(self) -> int:
        return len(self.hashes)


def presence(texts: list[str | None], signals: Signals) -> np.ndarray:
    """Which of the signals each text has."""
    n = len(signals.terms.sorted)
    counts = np.zeros(len(texts) * n, np.int64)
    for words in word_batches(texts):
        for text, hashes in features_of(words):
            numbers = signals.terms.numbers(hashes)
            hit = numbers >= 0
            counts += np.bincount(text[hit] * n + numbers[hit], minlength=len(counts))
    return counts.reshape(len(texts), n)[:, signals.which] >= signals.least


def all_signals(text: str | None) -> np.ndarray:
    """Every signal that a text has."""
    found = [h for words in word_batches([text]) for _, h in features_of(words)]
    own, counts = np.unique(np.concatenate([np.empty(0, np.uint64), *found]), return_counts=True)
    return np.concatenate([own[counts >= n] | np.uint64(i) for i, n in enumerate(LEVELS)])


def fixed_voters() -> np.ndarray:
    found = []
    for entry in LEXICON + PAIRS:
        (words,) = word_batches([entry])
        parts = list(features_of(words))
        found.append(parts[-1][1] if " " in entry else parts[0][1])
    return np.concatenate(found)


@dataclass(frozen=True)
class LabelModel:
    """The rate of toxic texts, in all and without votes; the rates of each voter's vote on
    toxic and on other texts, and its discount."""

    prior: float
    silent: float
    toxic: np.ndarray
    clean: np.ndarray
    discount: np.ndarray

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        weights = self.discount * np.log(self.toxic / self.clean)
        odds = np.log(self.prior / (1 - self.prior)) + votes.astype(float) @ weights
        found = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
        return np.where(votes.any(axis=1), found, self.silent)


@dataclass(frozen=True)
class Scorer:
    """The classifier: weights of terms, by presence."""

    terms: Signals
    weights: np.ndarray
    bias: float

    def scores(self, texts: list[str | None]) -> np.ndarray:
        out = [np.empty(0)]
        for at in range(0, len(texts), 256):
            found = presence(texts[at : at + 256], self.terms)
            out.append(1 / (1 + np.exp(-np.clip(found @ self.weights + self.bias, -30, 30))))
        return np.concatenate(out)


def usable_rows(docs: DataFrame, usable: Column) -> DataFrame:
    """``doc_id``, ``text`` and ``place`` of the rows that may be learned from."""
    ship(docs.sparkSession)
    return docs.where(usable & F.col("doc_id").isNotNull()).select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        F.pmod(F.xxhash64(F.col("doc_id").cast("long")), F.lit(PLACES)).alias("place"),
    )


def known_labels(labels: DataFrame) -> DataFrame:
    """``own`` (an id) and ``toxic``; of several labels of a document the worst."""
    found = labels.select(
        F.col("doc_id").cast("long").alias("own"), F.col("toxic").cast("int").alias("toxic")
    )
    found = found.where("own is not null and toxic in (0, 1)")
    return found.groupBy("own").agg(F.max("toxic").alias("toxic"))


def _share(bound: int, size: int, place: str = "place") -> Column:
    return F.col(place) < int(PLACES * min(1.0, bound / max(size, 1)))


@dataclass(frozen=True)
class Mined:
    """Signals of labelled texts (``h``), and in how many of each kind they are (``toxic``,
    ``clean``)."""

    found: DataFrame
    n_toxic: int
    n_clean: int

    def strongest(self, most: int, lift: float, least: float) -> tuple[np.ndarray, ...]:
        """The signals that tell most, by the likelihood ratio of being in toxic and in clean
        texts at different rates and at one: those with a ratio statistic of ``least`` and a
        rate ``lift`` times that in clean texts. Their hashes, and their rates in either kind.

        All signals are weighed; only the strongest come to the driver."""
        toxic, clean = F.col("toxic"), F.col("clean")
        both = (toxic + clean) / max(self.n_toxic + self.n_clean, 1)
        total = F.lit(0.0)
        for found, n in ((toxic, self.n_toxic), (clean, self.n_clean)):
            for seen, share in ((found, both), (n - found, 1 - both)):
                ratio = seen / F.greatest(n * share, F.lit(1e-12))
                total = total + F.when(seen > 0, 2 * seen * F.log(ratio)).otherwise(0.0)
        in_toxic, in_clean = (toxic + 0.5) / (self.n_toxic + 1), (clean + 0.5) / (self.n_clean + 1)
        got = (
            self.found.select("h", in_toxic.alias("a"), in_clean.alias("b"), total.alias("total"))
            .where((F.col("a") >= lift * F.col("b")) & (F.col("total") >= least))
            .orderBy(F.desc("total"), "h")
            .limit(most)
            .toArrow()
        )
        hashes = got["h"].to_numpy().astype(np.int64).view(np.uint64)
        return hashes, got["a"].to_numpy(), got["b"].to_numpy()


def mine(rows: DataFrame, known: DataFrame) -> Mined:
    """What a bounded sample of labelled texts have in them."""
    sizes = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    own_place = F.pmod(F.xxhash64("own"), F.lit(PLACES)).alias("own_place")
    lots = known.select("own", "toxic", own_place).where(
        ((F.col("toxic") == 1) & _share(TOXIC, sizes.get(1, 0), "own_place"))
        | ((F.col("toxic") == 0) & _share(CLEAN, sizes.get(0, 0), "own_place"))
    )
    # The lots are bounded; the texts of others are not shuffled.
    drawn = rows.join(F.broadcast(lots), F.col("doc_id") == F.col("own"))
    drawn = thinned(drawn.select("text", F.col("toxic").cast("long")), TOXIC + CLEAN)
    drawn = checkpointed(drawn.repartition(16))

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The signals of some texts at a time, each with its number of texts."""
        begin("toxicity")
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                kinds = batch.column(1).slice(at, 256).to_pylist()
                texts = batch.column(0).slice(at, 256).to_pylist()
                for kind in (0, 1):
                    own = [all_signals(t) for t, k in zip(texts, kinds) if k == kind]
                    if own:
                        hashes, n = np.unique(np.concatenate(own), return_counts=True)
                        none = np.zeros(len(n), np.int64)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(hashes.view(np.int64)),
                             *map(pa.array, (none, n) if kind else (n, none))],
                            names=["h", "clean", "toxic"],
                        )

    found = (
        drawn.mapInArrow(spread, "h long, clean long, toxic long")
        .groupBy("h")
        .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
        .where(F.col("toxic") >= SUPPORT)
    )
    n = {r["toxic"]: r["count"] for r in drawn.groupBy("toxic").count().collect()}
    return Mined(checkpointed(found), n.get(1, 0), n.get(0, 0))


def pack_votes(votes: np.ndarray) -> pa.Array:
    """Votes as bytes, a bit for each voter."""
    packed = np.packbits(votes, axis=1)
    return pa.array([row.tobytes() for row in packed], pa.binary())


def unpack_votes(raw: pa.Array, n: int) -> np.ndarray:
    rows = np.frombuffer(b"".join(raw.to_pylist()), np.uint8).reshape(len(raw), -1)
    return np.unpackbits(rows, axis=1, count=n).astype(float)


def text_hash() -> Column:
    return F.xxhash64("text").alias("text_hash")


def cast_votes(rows: DataFrame, known: DataFrame, voters: Signals) -> DataFrame:
    """``doc_id``, ``place``, ``text_hash``, ``votes`` (a bit for each voter) and ``toxic``, null
    where it is not known, of all usable rows. Votes, not texts, are joined with the labels."""

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("toxicity")
        for batch in batches:
            texts, votes = batch.column(3).to_pylist(), []
            for at in range(0, len(texts), 256):
                votes.append(pack_votes(presence(texts[at : at + 256], voters)))
            if votes:
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:3], pa.concat_arrays(votes)],
                    names=["doc_id", "place", "text_hash", "votes"],
                )

    cast = rows.select("doc_id", "place", text_hash(), "text").mapInArrow(
        vote, "doc_id long, place long, text_hash long, votes binary"
    )
    return cast.join(known, F.col("doc_id") == F.col("own"), "left").drop("own")


def _rate(part: float, whole: float) -> float:
    return float(np.clip((part + 0.5) / (whole + 1), 1e-6, 1 - 1e-6))


def fit_labels(votes: DataFrame, n: int, toxic: np.ndarray, clean: np.ndarray, rounds: int = 6) -> LabelModel:
    """The label model of ``n`` voters, from starting rates."""
    patterns = checkpointed(
        votes.groupBy("votes", "toxic").agg(F.count("*").cast("double").alias("count"))
    )
    model = LabelModel(0.1, 0.02, toxic, clean, np.ones(n))
    block = 2 + n + n * n  # of each case: all texts, those without votes, votes, pairs of votes

    for _ in range(rounds):

        def expect(batches: Iterator[pa.RecordBatch], model=model) -> Iterator[pa.RecordBatch]:
            total = np.zeros(2 * block)
            for batch in batches:
                if not batch.num_rows:
                    continue
                x = unpack_votes(batch.column(0), n)
                known = batch.column(1).to_numpy(zero_copy_only=False).astype(float)
                guess = np.where(np.isnan(known), model.posterior(x), known)
                times = batch.column(2).to_numpy()
                for k, weight in enumerate((guess * times, (1 - guess) * times)):
                    at = k * block
                    total[at] += weight.sum()
                    total[at + 1] += weight[~x.any(axis=1)].sum()
                    total[at + 2 : at + 2 + n] += weight @ x
                    total[at + 2 + n : at + block] += ((x * weight[:, None]).T @ x).ravel()
            yield parts_of(total)

        found = summed(patterns.mapInArrow(expect, PARTS), 2 * block).reshape(2, block)
        if not found[:, 0].sum():
            break
        rates, together = [], np.zeros((n, n))
        for weight, _, *rest in found:
            ones, both = np.array(rest[:n]), np.array(rest[n:]).reshape(n, n)
            rates.append(np.clip((ones + 0.2) / (weight + 1.0), 1e-7, 1 - 1e-7))
            p = ones / max(weight, 1e-9)
            spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
            apart = both / max(weight, 1e-9) - np.outer(p, p)
            together = np.maximum(together, apart / np.outer(spread, spread) * (weight > 1))
        np.fill_diagonal(together, 0)
        together[together < STRONG] = 0
        model = LabelModel(
            _rate(found[0, 0], found[:, 0].sum()),
            _rate(found[0, 1], found[:, 1].sum()),
            *rates,
            1 / (1 + together.sum(1)),
        )
    return model


def fit_scorer(
    rows: DataFrame, votes: DataFrame, voters: Signals, model: LabelModel, terms: Signals
) -> Scorer:
    """The classifier over ``terms``, from posterior labels of a sample: those of labelled
    rows are their labels."""
    some = F.lit(bytes(-(-len(voters) // 8)))
    voted = (F.col("votes") != some).alias("voted")
    sizes = {r["voted"]: r["n"] for r in votes.groupBy(voted).agg(F.count("*").alias("n")).collect()}
    n_yes, n_no = sizes.get(True, 0), sizes.get(False, 0)
    bound = TRAIN // 2
    chosen = votes.where(
        ((F.col("votes") != some) & _share(bound, n_yes))
        | ((F.col("votes") == some) & _share(bound, n_no))
    ).select(
        F.col("doc_id").alias("own"), F.col("text_hash").alias("own_text"), "votes",
        F.col("toxic").alias("known"),
    )
    # Rows of one id and text are one line here, and each row meets its own: where ids are
    # repeated the lines are no more than the distinct rows, and the sample is thinned.
    lines = checkpointed(chosen.distinct())
    if lines.count() <= 4 * TRAIN:
        lines = F.broadcast(lines)
    same = (F.col("doc_id") == F.col("own")) & (F.col("text_hash") == F.col("own_text"))
    met = rows.select("doc_id", text_hash(), "text").join(lines, same)
    sample = thinned(met.select("votes", "text", "known"), TRAIN)

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("toxicity")
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for at in range(0, len(texts), 256):
                own = unpack_votes(batch.column(0).slice(at, 256), len(voters))
                found = pack_votes(presence(texts[at : at + 256], terms))
                known = batch.column(2).slice(at, 256).to_numpy(zero_copy_only=False).astype(float)
                label = np.where(np.isnan(known), model.posterior(own), known)
                yield pa.RecordBatch.from_arrays(
                    [found, pa.array(label), pa.array(own.any(axis=1))],
                    names=["x", "y", "voted"],
                )

    got = sample.mapInArrow(look, "x binary, y double, voted boolean").toArrow()
    if not got.num_rows or not len(terms):
        return Scorer(terms, np.zeros(len(terms)), float(np.log(model.prior / (1 - model.prior))))
    x = unpack_votes(got["x"].combine_chunks(), len(terms)).astype(np.float32)
    y, yes = got["y"].to_numpy(), got["voted"].to_numpy()
    weight = np.where(yes, n_yes / max(yes.sum(), 1), n_no / max((~yes).sum(), 1))
    weight *= (2 * y - 1) ** 2  # a label that could be either teaches nothing
    return Scorer(terms, *logistic(x, y, weight / max(weight.mean(), 1e-9)))


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 0.5) -> tuple[np.ndarray, float]:
    """Weights and bias by Newton's method; labels are probabilities."""
    x = np.hstack([x, np.ones((len(x), 1), np.float32)])
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (weight * (y - p)) - penalty * w
        curve = (x * (weight * p * (1 - p))[:, None].astype(np.float32)).T @ x
        step = np.linalg.solve(curve + np.diag(penalty + 1e-6), slope)
        w += step / max(1.0, np.abs(step).max() / 2)
        if np.abs(step).max() < 1e-4:
            break
    return w[:-1], float(w[-1])


def learn(docs: DataFrame, labels: DataFrame, usable: Column) -> tuple[Scorer, LabelModel]:
    """A scorer, and the label model it was taught by, from the rows where ``usable`` holds."""
    rows, known = usable_rows(docs, usable), checkpointed(known_labels(labels))
    mined = mine(rows, known)
    best = mined.strongest(VOTERS, lift=6.0, least=20.0)
    start = {int(h): (a, b) for h, a, b in zip(*best)}
    for h in fixed_voters().tolist():
        start.setdefault(h, (0.05, 0.001))
    voters = Signals(np.array(list(start), np.uint64))
    rates = np.array([start[int(h)] for h in voters.hashes])
    votes = checkpointed(cast_votes(rows, known, voters))
    model = fit_labels(votes, len(voters), rates[:, 0], rates[:, 1])
    wider, _, _ = mined.strongest(FEATURES, lift=3.0, least=12.0)
    terms = Signals(np.concatenate([wider, voters.hashes]))
    return fit_scorer(rows, votes, voters, model, terms), model


def scores(docs: DataFrame, scorer: Scorer) -> Column:
    """The score of each text, for a select over ``docs``."""
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(scorer)  # FEATURES and VOTERS bound it

    @F.arrow_udf("double")
    def score(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        begin("toxicity")
        for part in texts:
            yield pa.array(shared.value.scores(part.to_pylist()), pa.float64())

    return score(F.col("text").cast("string"))
