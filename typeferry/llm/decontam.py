"""Benchmark decontamination by latent semantic retrieval.

Texts are read in half passages of ``HALF`` words; two that follow one another are a passage,
so passages overlap by half. Passages and benchmark items become TF-IDF vectors, and those a
latent space: the leading right singular vectors of the matrix of passages over the terms of
the benchmark, by a randomised method. Each task sums its part of the Gram matrix, pair by pair
of terms, times a random matrix; the sums over tasks are a sketch of the Gram matrix, and the
sketch's own decomposition, a small one, gives the basis. The items are rows of the matrix too, weighted so
that the basis keeps them apart. The search then asks, for every passage of every text, which
items have a cosine of ``least_cosine`` or more: projections are compared, under the norms of
the whole vectors. A passage whose benchmark terms are too small a part of it to reach that
cosine at all (by the Cauchy-Schwarz inequality) needs no projection.

A passage holds only a part of a long item, and the smaller a part, the smaller the cosine. An
item of over ``WHOLE`` words is therefore asked for by windows of a passage's size, too, each a
vector of its own, and any of them makes it a candidate. A short item is a small part of a
passage; one of fewer than ``HALF`` words is a candidate also wherever enough of its words
stand close together for the check below to succeed: that search misses nothing.

Each find is then checked word by word: the longest common subsequence of the item with any
stretch of the text about as long. An item is leaked if ``copied`` of its words are there in
order; or, paraphrased, if ``rephrased`` are and the answer, too, is there. The answer is the
``answer`` column of the benchmark, or else the last sentence of the item.

All document frequencies come from all texts, over half passages, in ``BUCKETS`` hashed
buckets. The basis is fitted on the passages of all documents; ``fit_docs``, if it is asked for,
holds it to so many in expectation, by the hash of their id. The benchmark is the stated query set: it
is taken in blocks of ``block_items`` vectors in expectation (an item of up to ``WHOLE`` words
is one vector), of whatever number, one pass over the texts each.

Nulls and the like: a null or empty text has no passages and no finds; an item without words,
or with a null text, is found nowhere; items that repeat another are found wherever it is;
rows that repeat a document give repeated finds; rows with a null ``doc_id`` give finds with a
null id; an empty table gives none; other columns are not looked at.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from typeferry.llm.common import PLACES, begin, checkpointed, place, ship, thinned
from typeferry.llm.sums import PARTS, parts_of, summed
from typeferry.llm.words import Terms, Words, word_batches

HALF = 16
WHOLE = 4 * HALF  # words of an item that one vector stands for
BUCKETS = 1 << 18
CHARS = 1 << 19  # of texts worked on at once
FEW_FINDS = 1_000_000
ROWS = 2048  # halves or passages in latent space at once
OFTEN = 2896  # terms of the benchmark whose pairs a task has a table for, of 34 MB


def bucket_of(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(46)).astype(np.int64)


# -- half passages ---------------------------------------------------------------------


@dataclass(frozen=True)
class Halves:
    """The words of some texts, cut into half passages that do not span texts."""

    hashes: np.ndarray
    starts: np.ndarray  # first word of each half
    text: np.ndarray  # of each half
    firsts: np.ndarray  # first word of each text, and the number of words

    @classmethod
    def cut(cls, batches: list[Words], n_texts: int) -> Halves:
        hashes = np.concatenate([np.empty(0, np.uint64), *(b.hashes() for b in batches)])
        text = np.concatenate([np.empty(0, np.int64), *(b.text for b in batches)])
        sizes = np.bincount(text, minlength=n_texts)
        firsts = np.concatenate([[0], np.cumsum(sizes)])
        counts = -(-sizes // HALF)
        owner = np.repeat(np.arange(n_texts), counts)
        within = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
        return cls(hashes, firsts[owner] + within * HALF, owner, firsts)

    def total(self, values: np.ndarray) -> np.ndarray:
        """Sums of a value (or row) of each word over each half."""
        if not len(self.starts):
            return np.zeros((0, *values.shape[1:]))
        return np.add.reduceat(values, self.starts, axis=0)

    def repeated(self) -> np.ndarray:
        """For each word, whether its bucket came before in the same half."""
        out = np.zeros(len(self.hashes) + 1, bool)
        ends = np.append(self.starts[1:], len(self.hashes))
        for i in range(0, len(self.starts), 1 << 14):
            at = self.starts[i : i + (1 << 14), None] + np.arange(HALF)
            at = np.where(at < ends[i : i + (1 << 14), None], at, len(self.hashes))
            terms = bucket_of(np.append(self.hashes, np.uint64(0)))[at]
            order = np.argsort(terms, axis=1, kind="stable")
            terms, at = np.take_along_axis(terms, order, 1), np.take_along_axis(at, order, 1)
            out[at[:, 1:][terms[:, 1:] == terms[:, :-1]]] = True
        return out[:-1]

    def frequencies(self) -> np.ndarray:
        """In how many halves each bucket occurs."""
        return np.bincount(bucket_of(self.hashes[~self.repeated()]), minlength=BUCKETS)

    def weights(self, by_bucket: np.ndarray) -> np.ndarray:
        """The weight of each word; none for words that came before in their half."""
        return np.where(self.repeated(), 0, by_bucket[bucket_of(self.hashes)])


def halves_of(texts: list[str | None]) -> Iterator[tuple[int, Halves]]:
    """Half passages of all texts, some texts at a time, with the number of the first."""
    at = size = 0
    for i, text in enumerate(texts):
        size += len(text or "")
        if size >= CHARS or i + 1 == len(texts):
            part = texts[at : i + 1]
            yield at, Halves.cut(list(word_batches(part)), len(part))
            at, size = i + 1, 0


# -- the benchmark ---------------------------------------------------------------------


@dataclass(frozen=True)
class Item:
    item_id: int | None
    words: np.ndarray
    answer: np.ndarray


def word_hashes(text: str | None) -> np.ndarray:
    return np.concatenate([np.empty(0, np.uint64), *(b.hashes() for b in word_batches([text]))])


def last_sentence(text: str, least_words: int = 4) -> str:
    """The last sentence, or as many as hold ``least_words`` words."""
    cuts = [m.end() for m in re.finditer(r"[.!?\n]+\s+", text)]
    for at in reversed(cuts):
        if len(text[at:].split()) >= least_words:
            return text[at:]
    return text


def item_of(item_id: int | None, text: str | None, answer: str | None) -> Item:
    found = word_hashes(answer) if answer else np.empty(0, np.uint64)
    if not len(found):
        found = word_hashes(last_sentence(text or ""))
    return Item(item_id, word_hashes(text), found)


def windows(words: np.ndarray) -> list[np.ndarray]:
    """What an item is asked for by: all of it and, if it is long, windows of a passage's size."""
    if len(words) <= WHOLE:
        return [words]
    starts = [*range(0, len(words) - 2 * HALF, HALF), len(words) - 2 * HALF]
    return [words, *(words[at : at + 2 * HALF] for at in starts)]


def span_of(size: int) -> int:
    """Words of a stretch that an item of so many words is compared with."""
    return size + max(4, size // 2)


class ShortItems:
    """Where items of fewer than ``HALF`` words may be, for the least share of them to be there.

    If at least ``need`` of n words are there in order, so is one of any n - need + 1 of them:
    the rarest are looked for, and the words around each are counted.
    """

    def __init__(self, items: list[Item], weights: np.ndarray, least: float):
        own = [i for i, item in enumerate(items) if len(item.words) < HALF]
        self.numbers = np.array(own, np.int64)
        words = [items[i].words for i in own]
        sizes = [len(w) for w in words]
        self.need = np.array([max(1, math.ceil(least * n - 1e-9)) for n in sizes], np.int64)
        self.span = np.array([span_of(n) for n in sizes], np.int64)
        self.terms = Terms(np.concatenate([np.empty(0, np.uint64), *words]))
        self.holds = np.zeros((len(own), len(self.terms.sorted) + 1), bool)  # last: other words
        rare = np.zeros_like(self.holds)
        for row, (held, n, need) in enumerate(zip(words, sizes, self.need.tolist())):
            numbers = self.terms.numbers(held)
            self.holds[row, numbers] = True
            order = np.argsort(-weights[bucket_of(held)], kind="stable")
            rare[row, numbers[order[: n - need + 1]]] = True
        term, self.owners = np.nonzero(rare.T)
        self.firsts = np.searchsorted(term, np.arange(self.holds.shape[1] + 1))

    def search(self, halves: Halves) -> tuple[np.ndarray, np.ndarray]:
        """Halves and items, each pair once."""
        none = np.empty(0, np.int64)
        if not len(self.numbers) or not len(halves.starts):
            return none, none
        terms = self.terms.numbers(halves.hashes)
        at = np.flatnonzero(terms >= 0)
        counts = self.firsts[terms[at] + 1] - self.firsts[terms[at]]
        at, counts = at[counts > 0], counts[counts > 0]
        ends = np.cumsum(counts)
        found = [np.empty((0, 2), np.int64)]
        reach = np.arange(-int(self.span.max()) + 1, int(self.span.max()))
        i = 0
        while i < len(at):  # some places at once, whatever the number of items at each
            j = max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + 2 * ROWS)))
            place, n = at[i:j], counts[i:j]
            within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            item = self.owners[np.repeat(self.firsts[terms[place]], n) + within]
            place = np.repeat(place, n)
            half = np.searchsorted(halves.starts, place, side="right") - 1
            text = halves.text[half]
            near = place[:, None] + reach
            inside = (near >= halves.firsts[text][:, None]) & (near < halves.firsts[text + 1][:, None])
            inside &= np.abs(reach) < self.span[item][:, None]
            held = self.holds[item[:, None], terms[np.where(inside, near, 0)]] & inside
            enough = held.sum(axis=1) >= self.need[item]
            found.append(np.unique(np.stack([half, self.numbers[item]], 1)[enough], axis=0))
            i = j
        pairs = np.unique(np.concatenate(found), axis=0)
        return pairs[:, 0], pairs[:, 1]


# -- the latent space ------------------------------------------------------------------


@dataclass(frozen=True)
class Latent:
    """The basis, a row for each term weighted by its frequency, and the items in it."""

    terms: Terms
    weights: np.ndarray  # by bucket
    basis: np.ndarray
    items: list[Item]
    vectors: np.ndarray  # of the items' windows, over the norms of their whole TF-IDF vectors
    owners: np.ndarray  # the item of each vector
    least_cosine: float
    short: ShortItems

    def search(self, halves: Halves) -> tuple[np.ndarray, np.ndarray]:
        """Passages (by their first half) and items with the least cosine or more."""
        none = np.empty(0, np.int64)
        if not len(halves.starts):
            return none, none
        numbers = self.terms.numbers(halves.hashes)
        weights = halves.weights(self.weights)
        whole = halves.total(weights**2)
        known = halves.total(np.where(numbers >= 0, weights, 0) ** 2)
        follows = np.append(halves.text[1:] == halves.text[:-1], False)
        whole = whole + np.where(follows, np.append(whole[1:], 0), 0)
        known = known + np.where(follows, np.append(known[1:], 0), 0)
        # A word of both halves counts twice: the square of a passage's norm is at least the
        # sum of its halves', and at most twice that.
        able = np.flatnonzero(known * 2 >= self.least_cosine**2 * whole)
        passages, items = [none], [none]
        for i in range(0, len(able), ROWS):
            part = able[i : i + ROWS]
            used = np.unique(np.concatenate([part, part[follows[part]] + 1]))
            rows = self._project(halves, used, numbers, weights)
            vectors = rows[np.searchsorted(used, part)]
            both = follows[part]
            vectors[both] += rows[np.searchsorted(used, part[both] + 1)]
            near = vectors @ self.vectors.T
            least = (self.least_cosine * np.sqrt(whole[part])).astype(np.float32)
            p, m = np.nonzero(near >= least[:, None])
            pairs = np.unique(np.stack([part[p], self.owners[m]], 1), axis=0)
            passages.append(pairs[:, 0])
            items.append(pairs[:, 1])
        return np.concatenate(passages), np.concatenate(items)

    def _project(
        self, halves: Halves, used: np.ndarray, numbers: np.ndarray, weights: np.ndarray
    ) -> np.ndarray:
        """Vectors of some halves in the latent space."""
        ends = np.append(halves.starts[1:], len(halves.hashes))[used]
        at = halves.starts[used, None] + np.arange(HALF)
        inside = at < ends[:, None]
        at = np.where(inside, at, 0)
        terms = np.where(inside & (weights[at] > 0), numbers[at], -1)
        # Known terms first, and halves with many of them first: each step adds the next
        # term of all halves that have one.
        terms = -np.sort(-terms, axis=1)
        counts = (terms >= 0).sum(axis=1)
        order = np.argsort(-counts, kind="stable")
        terms, counts = terms[order], counts[order]
        rows = np.zeros((len(used), self.basis.shape[1]), np.float32)
        for k in range(int(counts[0]) if len(counts) else 0):
            some = np.searchsorted(-counts, -k, side="left")  # halves with more than k terms
            rows[:some] += self.basis[terms[:some, k]]
        out = np.empty_like(rows)
        out[order] = rows
        return out


def item_matrix(asked: list[np.ndarray], terms: Terms, weights: np.ndarray) -> np.ndarray:
    """TF-IDF rows of the items' windows, of length one."""
    out = np.zeros((len(asked), len(terms.sorted)))
    for row, words in enumerate(asked):
        np.add.at(out[row], terms.numbers(words), weights[bucket_of(words)])
    return out / np.linalg.norm(out, axis=1, keepdims=True)


def fit(
    docs: DataFrame, items: list[Item], weights: np.ndarray, rank: int, fit_docs: int | None,
    n_docs: int, least_cosine: float, least_shared: float,
) -> Latent:
    """The latent space: a randomised decomposition of passages and items over their terms.

    It has ``rank`` dimensions, and at least 64 more than there are windows.
    """
    asked = [windows(i.words) for i in items]
    owners = np.repeat(np.arange(len(items)), [len(w) for w in asked])
    asked = [w for of_item in asked for w in of_item]
    rank = max(rank, len(asked) + 64)
    terms = Terms(np.concatenate([i.words for i in items]))
    n, width = len(terms.sorted), min(rank + 16, len(terms.sorted))
    own = weights[bucket_of(terms.sorted)]
    omega = np.random.default_rng(5).standard_normal((n, width)).astype(np.float32)

    # The terms by how often they occur: the first ``near`` of them have a table of pairs.
    by_use = np.argsort(own, kind="stable")
    use = np.empty(n, np.int64)
    use[by_use] = np.arange(n)
    near, used = min(n, OFTEN), omega[by_use]

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("decontamination")
        total = np.zeros((n, width))
        table = np.zeros(near * (near + 1) // 2)
        energy = 0.0
        for batch in batches:
            for _, halves in halves_of(batch.column(0).to_pylist()):
                numbers, word = terms.numbers(halves.hashes), halves.weights(weights)
                norms = np.sqrt(np.maximum(halves.total(word**2), 1e-30))
                known = np.flatnonzero((numbers >= 0) & (word > 0))
                half = np.searchsorted(halves.starts, known, side="right") - 1
                term, scale = use[numbers[known]], word[known] / norms[half]
                energy += float((scale**2).sum())
                for step in range(HALF):  # each word with the one so many known words on
                    at = np.flatnonzero(half[step:] == half[: len(half) - step])
                    if not len(at):
                        break
                    low = np.minimum(term[at], term[at + step])
                    high = np.maximum(term[at], term[at + step])
                    value = scale[at] * scale[at + step]
                    often = high < near
                    cell = high[often] * (high[often] + 1) // 2 + low[often]
                    np.add.at(table, cell, value[often])
                    rare = ~often
                    if rare.any():
                        add_pairs(total, used, low[rare], high[rare], value[rare])
                        if step:
                            add_pairs(total, used, high[rare], low[rare], value[rare])
        if energy:
            add_table(total, used, table, near)
            out = np.empty_like(total)
            out[by_use] = total
            yield parts_of(np.append(out.ravel(), energy))

    bound = n_docs if fit_docs is None else fit_docs
    low = docs.where(place(F.col("doc_id")) < int(PLACES * min(1, bound / max(n_docs, 1))))
    some = thinned(low, bound).select("text")
    if fit_docs is not None:
        some = some.repartition(8)  # a bounded sample
    some = some.coalesce(_tasks(docs))
    found = summed(some.mapInArrow(sketch, PARTS), n * width + 1)
    rows = item_matrix(asked, terms, weights)
    share = max(found[-1], 1.0) / len(asked)  # the items weigh as much as the passages
    gram = found[:-1].reshape(n, width) + share * (rows.T @ (rows @ omega))
    basis = leading(gram, omega.astype(float), rank)
    vectors = rows @ basis
    return Latent(
        terms, weights, (basis * own[:, None]).astype(np.float32), items,
        vectors.astype(np.float32), owners, least_cosine, ShortItems(items, weights, least_shared),
    )


def add_pairs(
    total: np.ndarray, omega: np.ndarray, terms: np.ndarray, others: np.ndarray, values: np.ndarray
) -> None:
    """Adds each value times the row of ``omega`` of the other term to the row of a term."""
    order = np.argsort(terms, kind="stable")
    for i in range(0, len(order), ROWS):
        some = order[i : i + ROWS]
        own = terms[some]
        first = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
        parts = omega[others[some]] * values[some, None]
        total[own[first]] += np.add.reduceat(parts, first, axis=0)


def add_table(total: np.ndarray, omega: np.ndarray, table: np.ndarray, size: int) -> None:
    """Adds the product of a symmetric matrix, given by its lower half, with ``omega``."""
    for i in range(0, size, ROWS // 4):
        j = min(size, i + ROWS // 4)
        rows = np.zeros((j - i, j), np.float32)
        for k in range(i, j):
            rows[k - i, : k + 1] = table[k * (k + 1) // 2 : (k + 1) * (k + 2) // 2]
        total[i:j] += rows @ omega[:j]
        rows[np.arange(j - i), np.arange(i, j)] = 0  # the diagonal counts once
        total[:j] += rows.T @ omega[i:j]


def leading(sketch: np.ndarray, omega: np.ndarray, rank: int) -> np.ndarray:
    """Leading eigenvectors of a positive matrix G from ``sketch`` = G ``omega``."""
    shift = 1e-9 * np.linalg.norm(sketch) / np.sqrt(len(sketch))
    sketch = sketch + shift * omega
    core = omega.T @ sketch
    values, vectors = np.linalg.eigh((core + core.T) / 2)
    keep = values > values.max() * 1e-10
    half = sketch @ (vectors[:, keep] / np.sqrt(values[keep]))
    left, sizes, _ = np.linalg.svd(half, full_matrices=False)
    return left[:, : min(rank, int((sizes > sizes[0] * 1e-6).sum()))]


# -- word by word ----------------------------------------------------------------------


def common_subsequence(places: dict[int, int], size: int, words: list[int]) -> int:
    """Length of the longest common subsequence; ``places`` holds the item's words as bits."""
    full = (1 << size) - 1
    row = full
    for word in words:
        hit = places.get(word, 0) & row
        row = (row + hit | row - hit) & full
    return size - row.bit_count()


def bits(words: list[int]) -> dict[int, int]:
    out: dict[int, int] = {}
    for at, word in enumerate(words):
        out[word] = out.get(word, 0) | 1 << at
    return out


class Verifier:
    """Word-by-word checks of one item."""

    def __init__(self, item: Item):
        self.size, self.places = len(item.words), bits(item.words.tolist())
        self.answer_size, self.answer = len(item.answer), bits(item.answer.tolist())

    def best(self, words: list[int]) -> tuple[float, float, int]:
        """Greatest share of the item in any stretch, the answer's share there, and where."""
        span = span_of(self.size)
        step = max(1, self.size // 4)
        found = (0.0, 0.0, 0)
        for at in range(0, max(1, len(words) - span + step), step):
            stretch = words[at : at + span]
            shared = common_subsequence(self.places, self.size, stretch) / self.size
            if shared > found[0]:
                answer = common_subsequence(self.answer, self.answer_size, stretch)
                found = shared, answer / self.answer_size, at
        return found


FIND = (
    "doc_id long, item_id long, kind string, overlap double, answer_overlap double, "
    "first_word long, cosine_passages long"
)


def finds(
    docs: DataFrame,
    benchmark: DataFrame,
    rank: int = 256,
    least_cosine: float = 0.35,
    copied: float = 0.75,
    rephrased: float = 0.55,
    answered: float = 0.75,
    fit_docs: int | None = None,
    block_items: int = 384,
) -> DataFrame:
    """A row for each item found in a text: columns ``FIND``.

    ``benchmark`` has ``item_id``, ``text`` and, if it likes, ``answer``.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    out = None
    for latent in _spaces(docs, benchmark, rank, least_cosine, copied, rephrased, fit_docs, block_items):
        part = _search(docs, latent, copied, rephrased, answered)
        out = part if out is None else out.unionAll(part)
    return spark.createDataFrame([], FIND) if out is None else out


def _spaces(
    docs: DataFrame, benchmark: DataFrame, rank: int, least_cosine: float, copied: float,
    rephrased: float, fit_docs: int | None, block_items: int,
) -> Iterator[Latent]:
    """The latent space of each block of the benchmark."""
    ship(docs.sparkSession)
    answer = F.col("answer") if "answer" in benchmark.columns else F.lit(None)
    asked = benchmark.select(
        F.col("item_id").cast("long"), F.col("text").cast("string"), answer.cast("string").alias("answer")
    )
    words = F.coalesce(F.size(F.split("text", "[^\\p{L}\\p{N}]+")), F.lit(0))
    vectors = F.when(words > WHOLE, F.ceil(words / HALF)).otherwise(1)
    blocks = max(1, -(-int(asked.agg(F.sum(vectors)).first()[0] or 0) // block_items))
    n_docs, weights = corpus_weights(docs)
    for block in range(blocks):
        own = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block
        items = [item_of(*r) for r in asked.where(own).orderBy("item_id", "text").collect()]
        items = [i for i in items if len(i.words)]
        if items:
            yield fit(
                docs, items, weights, rank, fit_docs, n_docs, least_cosine, min(copied, rephrased)
            )


def _tasks(docs: DataFrame) -> int:
    """Tasks that give sums of a few megabytes: some for each core, whatever the partitions."""
    return 4 * docs.sparkSession.sparkContext.defaultParallelism


def corpus_weights(docs: DataFrame) -> tuple[int, np.ndarray]:
    """The number of documents, and the inverse document frequency of each bucket, over the
    half passages of all texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("decontamination")
        total = np.zeros(BUCKETS + 2)
        for batch in batches:
            total[-1] += batch.num_rows
            for _, halves in halves_of(batch.column(0).to_pylist()):
                total[:BUCKETS] += halves.frequencies()
                total[-2] += len(halves.starts)
        yield parts_of(total)

    rows = docs.select("text").coalesce(_tasks(docs))
    found = summed(rows.mapInArrow(count, PARTS), BUCKETS + 2)
    weights = np.log((found[-2] + 1) / (found[:BUCKETS] + 1)) + 1e-3
    return int(found[-1]), weights


def _search(
    docs: DataFrame, latent: Latent, copied: float, rephrased: float, answered: float
) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(latent)  # bounded by block_items
    names = [x.split()[0] for x in FIND.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.float64(), pa.float64(), pa.int64(), pa.int64()]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("decontamination")
        space = shared.value
        verifiers: dict[int, Verifier] = {}
        for batch in batches:
            ids, rows = batch.column(0).to_pylist(), []
            found = _found(space, verifiers, batch.column(1).to_pylist(), copied, rephrased, answered)
            for text, item, verdict, passages in found:
                rows.append((ids[text], space.items[item].item_id, *verdict, passages))
            columns = zip(*rows) if rows else [[]] * len(names)
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return docs.mapInArrow(search, FIND)


def _found(
    space: Latent, verifiers: dict[int, Verifier], texts: list[str | None],
    copied: float, rephrased: float, answered: float,
) -> Iterator[tuple[int, int, tuple[str, float, float, int], int]]:
    """Text, item, verdict and number of near passages of each find."""
    for at, halves in halves_of(texts):
        near: dict[tuple[int, int], list[int]] = {}
        passages, items = space.search(halves)
        for passage, item in zip(passages.tolist(), items.tolist()):
            near.setdefault((int(halves.text[passage]), item), []).append(passage)
        by_cosine = {key: len(found) for key, found in near.items()}
        passages, items = space.short.search(halves)
        for passage, item in zip(passages.tolist(), items.tolist()):
            near.setdefault((int(halves.text[passage]), item), []).append(passage)
        for (text, item), found in near.items():
            if item not in verifiers:
                verifiers[item] = Verifier(space.items[item])
            verdict = _verdict(halves, found, text, verifiers[item], copied, rephrased, answered)
            if verdict:
                yield at + text, item, verdict, by_cosine.get((text, item), 0)


def _verdict(
    halves: Halves, passages: list[int], text: int, verifier: Verifier,
    copied: float, rephrased: float, answered: float,
) -> tuple[str, float, float, int] | None:
    """Kind, overlaps and first word of the best of the stretches around the passages."""
    first, last = int(halves.firsts[text]), int(halves.firsts[text + 1])
    reach = verifier.size + HALF
    best = (0.0, 0.0, 0)
    low = high = -1
    stretches: list[tuple[int, int]] = []
    for passage in sorted(passages):
        start = int(halves.starts[passage])
        a, b = max(first, start - reach), min(last, start + 2 * HALF + reach)
        if a <= high and stretches:
            high = max(high, b)
            stretches[-1] = (low, high)
        else:
            low, high = a, b
            stretches.append((low, high))
    for a, b in stretches:
        shared, answer, at = verifier.best(halves.hashes[a:b].tolist())
        if shared > best[0]:
            best = shared, answer, a + at - first
    if best[0] >= copied:
        return "copy", *best
    if best[0] >= rephrased and best[1] >= answered:
        return "paraphrase", *best
    return None


def decontaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    rank: int = 256,
    least_cosine: float = 0.35,
    copied: float = 0.75,
    rephrased: float = 0.55,
    answered: float = 0.75,
    fit_docs: int | None = None,
    block_items: int = 384,
) -> DataFrame:
    """The rows of ``docs`` whose text holds no item, each row by itself, whatever its id.

    Texts that hold one are known by their digest. Up to ``FEW_FINDS`` digests are broadcast,
    and the documents stay where they are.
    """
    columns = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    keyed = columns.select(_digest("text").alias("held_text"), "text")
    held = None
    for latent in _spaces(
        columns, benchmark, rank, least_cosine, copied, rephrased, fit_docs, block_items
    ):
        part = _held(keyed, latent, copied, rephrased, answered)
        held = part if held is None else held.unionAll(part)
    if held is None:
        return docs
    held = checkpointed(held.distinct())
    if held.count() <= FEW_FINDS:
        held = F.broadcast(held)
    same = _digest("d.text") == F.col("h.held_text")
    return docs.alias("d").join(held.alias("h"), same, "left_anti")


def _digest(text: str) -> Column:
    """Sixteen bytes that stand for a text; null for null."""
    return F.unhex(F.md5(F.col(text).cast("string").cast("binary")))


def _held(
    keyed: DataFrame, latent: Latent, copied: float, rephrased: float, answered: float
) -> DataFrame:
    """The first column of the rows whose second, a text, holds an item."""
    shared = keyed.sparkSession.sparkContext.broadcast(latent)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("decontamination")
        verifiers: dict[int, Verifier] = {}
        for batch in batches:
            found = _found(
                shared.value, verifiers, batch.column(1).to_pylist(), copied, rephrased, answered
            )
            rows = sorted({text for text, *_ in found})
            yield batch.select([0]).take(pa.array(rows, pa.int64()))

    return keyed.mapInArrow(search, "held_text binary")
