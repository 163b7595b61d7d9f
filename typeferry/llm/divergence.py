"""How far sources of a language diverge from one another, and in which terms.

A term is a run of letters ``A-Z``, ``a-z`` and of all characters beyond ASCII, only A-Z in
lower case. Each language keeps the terms that ``least`` of its documents hold. Each group, a
source within a language, and each language gives each of the V kept terms a share
``p = 1 + floor(10^9 * (count + 1) / (N + V))``, where N is the sum of its counts. The divergence
of a group from another is the sum over all kept terms of ``floor((p - q)^2 / q)``.

Most counts are zero, so all groups are compared row by row in the way of Gustavson's sparse
products. The kept terms are cut into blocks by hash. A task holds a block as an index by term
(which groups hold it, with which share), and one row per group: it takes a group, goes
through the group's terms, and for each adds, over the index's postings, to an accumulator that
has a number for every peer. Pairs of postings are never rows. What the accumulators hold is
the correction of a baseline: first all terms of both sides count as missing (V times a number
of the pair), then the group's terms meet the peers' zero shares and the peers' terms the
group's, both by the number of terms of an equal share; the scattered sum then replaces, for
terms that both hold, those two and the baseline by the true value. The sums of all blocks are
added up by Spark, as decimals. Every number is an integer and exact.

A block has about ``block`` postings. A language with very many sources is cut into slices of
groups, so that a task's accumulators stay below ``PAIRS`` numbers. Texts are counted where they
are read, a buffer of bytes at a time, and only the counts are shuffled: by language, source and
term, so neither a source with a third of the rows nor a frequent term is one task's work. A
task sees at most as many rows of one term, or one language, as there are sources; the result
has the square of that number for each language.

Nulls in text, language and source count as empty strings. Repeated rows, and rows that share a
``doc_id`` or have none, are documents each. Groups without any term take part with their zero
shares; a language without kept terms has divergences of 0 and no terms. Ties are ranked by the
bytes of the item. Texts of any length are read whole; a very long run of letters is one term.
An empty table gives an empty result. Other columns are not looked at.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from typeferry.llm.common import begin, checkpointed, fresh_folder, ship
from typeferry.llm.files import remove_folder

ONE = 10**9
ENTRIES = 200_000  # terms of groups that a task holds before it gives their counts
PIECE = 1 << 20  # bytes of a text split at once
PAIRS = 1 << 22  # accumulated numbers of a task
CELLS = 1 << 20  # numbers of a table of shares by peers

_WORDS = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def words(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text in UTF-8, a piece at a time."""
    plain = text.translate(_WORDS)
    at = 0
    while at < len(plain):
        end = plain.find(b" ", at + PIECE)
        end = len(plain) if end < 0 else end
        yield plain[at:end].split()
        at = end


def count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows lang, source, item, n, docs: occurrences of a term, and documents that hold it.

    Every group has a row of its own too, its item the source after a blank, which no term has.
    """
    begin("divergence")
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    entries = 0

    def give() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, docs) in held.items():
            items = [b" " + source.encode(), *n]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * len(items), pa.string()),
                    pa.array([source] * len(items), pa.string()),
                    pa.array(items, pa.binary()).cast(pa.string()),
                    pa.array([0, *n.values()], pa.int64()),
                    pa.array([0, *(docs[term] for term in n)], pa.int64()),
                ],
                names=["lang", "source", "item", "n", "docs"],
            )
        held.clear()

    for batch in batches:
        texts = batch.column("text").cast(pa.binary())
        groups = zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist())
        for row, group in enumerate(groups):
            n, docs = held.setdefault(group, (Counter(), Counter()))
            before, seen = len(n), set()
            for some in words(texts[row].as_py()):
                n.update(some)
                seen.update(some)
            docs.update(seen)
            entries += len(n) - before
            if entries > ENTRIES:
                yield from give()
                entries = 0
    yield from give()


def far(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // q


def spans(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The numbers of all ranges, one after the other."""
    sizes = ends - starts
    offset = np.repeat(starts - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes)
    return offset + np.arange(sizes.sum())


class Index:
    """The kept terms of a block: by term the groups that hold it, and by group its terms."""

    def __init__(self, term: np.ndarray, group: np.ndarray, p: np.ndarray, zero: np.ndarray):
        self.zero = zero  # each group's share of a term it does not hold
        by_term = np.lexsort((group, term))
        self.holder, self.p = group[by_term], p[by_term]
        sizes = np.bincount(term, minlength=1)
        self.ends = np.cumsum(sizes)
        self.starts = self.ends - sizes
        by_group = np.argsort(group, kind="stable")
        self.term, self.own = term[by_group], p[by_group]
        self.rows = np.searchsorted(group[by_group], np.arange(len(zero) + 1))
        # The postings folded by holder and share.
        keys, self.times = np.unique(group * (1 << 32) + p, return_counts=True)
        self.keys_holder, self.keys_p = keys >> 32, keys & ((1 << 32) - 1)

    def row(self, g: int, missing: int) -> np.ndarray:
        """A group's sums for every peer: ``missing`` terms that neither side holds, and the
        block's terms, each counted in ``missing`` or in another block's as if nobody held it."""
        zero, mine = self.zero, slice(self.rows[g], self.rows[g + 1])
        terms, own = self.term[mine], self.own[mine]
        nobody = far(zero[g], zero)
        sums = (missing - len(terms)) * nobody
        shares, times = np.unique(own, return_counts=True)
        step = max(1, CELLS // len(zero))
        for at in range(0, len(shares), step):
            some = shares[at : at + step, None]
            sums += (times[at : at + step, None] * far(some, zero[None, :])).sum(0)
        theirs = far(zero[g], self.keys_p) - nobody[self.keys_holder]
        np.add.at(sums, self.keys_holder, self.times * theirs)
        # Row accumulation: terms of the group, scattered through the index to their holders.
        starts, ends = self.starts[terms], self.ends[terms]
        at = spans(starts, ends)
        peer, q, p = self.holder[at], self.p[at], np.repeat(own, ends - starts)
        both = far(p, q) - far(p, zero[peer]) - far(zero[g], q) + nobody[peer]
        np.add.at(sums, peer, both)
        return sums


def accumulate(key: tuple, postings: pa.Table, peers: pa.Table) -> pa.Table:
    """The rows of a slice of groups in a block: lang, number, sums (a number for each peer)."""
    lang, block, part = (k.as_py() for k in key)
    number = peers["number"].to_numpy()
    zero = np.empty(len(number), np.int64)
    zero[number] = peers["zero"].to_numpy()
    terms = postings["item"].combine_chunks().dictionary_encode()
    if isinstance(terms, pa.ChunkedArray):
        terms = terms.combine_chunks()
    index = Index(
        terms.indices.to_numpy(zero_copy_only=False).astype(np.int64),
        postings["number"].to_numpy().astype(np.int64),
        postings["p"].to_numpy(),
        zero,
    )
    kept, size = (peers[c][0].as_py() if len(number) else 0 for c in ("kept", "size"))
    groups = range(part * size, min(len(number), (part + 1) * size))
    rows = [index.row(g, kept if block == 0 else 0) for g in groups]
    flat = np.concatenate(rows) if rows else np.empty(0, np.int64)
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * len(number)
    return pa.table(
        {
            "lang": pa.array([lang] * len(rows), pa.string()),
            "number": pa.array(list(groups), pa.int32()),
            "sums": pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat)),
        }
    )


def share(count: str, total: str) -> F.Column:
    """1 + floor(10^9 (count + 1) / total), exact for any count."""
    return F.expr(
        f"1 + (cast({ONE} as decimal(11,0)) * cast({count} + 1 as decimal(20,0)))"
        f" div cast(nullif({total}, 0) as decimal(20,0))"
    )


def audit(docs: DataFrame, least: int = 3, top: int = 200, block: int = 1 << 18) -> DataFrame:
    """``lang``, ``source``, ``part``, ``item``, ``value``, ``rank``.

    Part ``pair``: the other sources of the language, by how far the group is from them. Part
    ``term``: up to ``top`` terms that the group holds more of than its language does.
    """
    spark = docs.sparkSession
    ship(spark)
    texts = docs.select(
        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")]
    )
    folder, group_folder = fresh_folder(spark, "terms"), fresh_folder(spark, "groups")
    same_term = Window.partitionBy("lang", "item")
    (
        texts.mapInArrow(
            count_terms, "lang string, source string, item string, n long, docs long"
        )
        .groupBy("lang", "source", "item")
        .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
        .withColumn("lang_n", F.sum("n").over(same_term))
        .withColumn("lang_docs", F.sum("docs").over(same_term))
        .withColumn("first", F.col("source") == F.min("source").over(same_term))
        .withColumn("is_term", ~F.col("item").startswith(" "))
        .where(~F.col("is_term") | (F.col("lang_docs") >= least))
        .select("lang", "source", "item", "n", "lang_n", "first", "is_term")
        .write.parquet(folder)
    )
    rows = spark.read.parquet(folder)
    same_lang = Window.partitionBy("lang")
    (
        rows.groupBy("lang", "source")
        .agg(
            F.sum("n").alias("total"),
            F.count_if("is_term").alias("held"),
            F.count_if(F.col("is_term") & F.col("first")).alias("firsts"),
        )
        .withColumn("kept", F.sum("firsts").over(same_lang))
        .withColumn("lang_total", F.sum("total").over(same_lang))
        .withColumn("groups", F.count("*").over(same_lang))
        .withColumn("postings", F.sum("held").over(same_lang))
        .withColumn("number", F.row_number().over(same_lang.orderBy("source")) - 1)
        .select(
            "lang",
            "source",
            "number",
            "kept",
            (F.col("total") + F.col("kept")).alias("whole"),
            (F.col("lang_total") + F.col("kept")).alias("lang_whole"),
            share("0L", "total + kept").alias("zero"),
            F.greatest(F.lit(1), F.ceil(F.col("postings") / block)).cast("int").alias("blocks"),
            F.greatest(F.lit(1), F.floor(PAIRS / F.col("groups"))).cast("int").alias("size"),
            "groups",
        )
        .withColumn("slices", F.ceil(F.col("groups") / F.col("size")).cast("int"))
        .write.parquet(group_folder)
    )
    groups = spark.read.parquet(group_folder)
    held = (
        rows.where("is_term")
        .drop("first", "is_term")
        .join(groups, ["lang", "source"])
        .withColumn("p", share("n", "whole"))
    )
    pairs = _pairs(held, spark.read.parquet(group_folder))  # a reading of its own, for the cogroup
    out = checkpointed(_terms(held, top).unionByName(pairs))
    remove_folder(spark, folder)
    remove_folder(spark, group_folder)
    return out


def _terms(held: DataFrame, top: int) -> DataFrame:
    """Spark cuts to the strongest in each task before it brings a group together."""
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return (
        held.withColumn("q", share("lang_n", "lang_whole"))
        .where("p > q")
        .select("lang", "source", "item", F.expr("(p - q) * (p - q) div q").alias("value"))
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= top)
        .withColumn("part", F.lit("term"))
    )


def _pairs(held: DataFrame, groups: DataFrame) -> DataFrame:
    slices = F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice")
    block = F.pmod(F.xxhash64("item"), F.col("blocks")).cast("int").alias("block")
    postings = held.select("lang", block, "item", "number", "p", slices)
    peers = groups.select(
        "*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")
    ).select("lang", "block", slices, "number", F.coalesce("zero", F.lit(1)).alias("zero"),
             "kept", "size")
    key = ["lang", "block", "slice"]
    sums = (
        postings.groupBy(*key)
        .cogroup(peers.groupBy(*key))
        .applyInArrow(accumulate, "lang string, number int, sums array<long>")
    )
    named = groups.select("lang", "number", "source")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return (
        sums.select("lang", "number", F.posexplode("sums").alias("peer", "sum"))
        .where("number <> peer")
        .groupBy("lang", "number", "peer")
        .agg(F.sum(F.col("sum").cast("decimal(38,0)")).cast("long").alias("value"))
        .join(named, ["lang", "number"])
        .join(
            named.select("lang", F.col("number").alias("peer"), F.col("source").alias("item")),
            ["lang", "peer"],
        )
        .select("lang", "source", "item", "value")
        .withColumn("rank", F.row_number().over(order))
        .withColumn("part", F.lit("pair"))
    )


def oracle(least: int = 3, top: int = 200) -> str:
    """The same in DuckDB's SQL, with every kept term of every group."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"""with d as (select row_number() over () as r, coalesce(lang, '') as lang,
    coalesce(source, '') as source, coalesce(text, '') as text from documents),
w as (select r, lang, source, translate(unnest(regexp_extract_all(text,
    '[A-Za-z\\x{{80}}-\\x{{10FFFF}}]+')), '{upper}', '{lower}') as term from d),
per as (select r, lang, source, term, count(*) as n from w group by all),
kept as (select lang, term, sum(n) as n from per group by all having count(*) >= {least}),
sizes as (select lang, count(*) as v, sum(n) as total from kept group by all),
here as (select lang, source, term, sum(per.n) as n from per join kept using (lang, term)
  group by all),
totals as (select lang, source, coalesce(sum(n), 0) as total
  from (select distinct lang, source from d) left join here using (lang, source) group by all),
shares as (select lang, source, term, coalesce(here.n, 0) as n,
    (1 + ({ONE}::hugeint * (coalesce(here.n, 0) + 1)) // (totals.total + v))::bigint as p,
    (1 + ({ONE}::hugeint * (kept.n + 1)) // (sizes.total + v))::bigint as q
  from totals join sizes using (lang) join kept using (lang)
  left join here using (lang, source, term)),
far as (select a.lang, a.source, b.source as item, sum((a.p - b.p) * (a.p - b.p) // b.p) as value
  from shares a join shares b on a.lang = b.lang and a.term = b.term and a.source <> b.source
  group by all),
parts as (
  select a.lang, a.source, 'pair' as part, b.source as item, coalesce(value, 0)::bigint as value
  from totals a join totals b on a.lang = b.lang and a.source <> b.source
  left join far on far.lang = a.lang and far.source = a.source and far.item = b.source
  union all
  select lang, source, 'term', term, ((p - q) * (p - q) // q)::bigint from shares
  where n > 0 and p > q)
select *, (row_number() over (partition by lang, source, part order by value desc, item))::int
  as rank from parts qualify part = 'pair' or rank <= {top}"""
