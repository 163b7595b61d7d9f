import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from typeferry.llm import divergence
from typeferry.llm.queries import op12_divergence


def brute(rows, least=3, top=200):
    """Every kept term of every group, in Python's integers. Rows are (lang, source, text)."""
    docs, counts = {}, {}
    for lang, source, text in rows:
        lang, source, text = lang or "", source or "", text or ""
        found = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text)
        found = ["".join(c.lower() if "A" <= c <= "Z" else c for c in t) for t in found]
        docs.setdefault(lang, Counter()).update(set(found))
        counts.setdefault(lang, {}).setdefault(source, Counter()).update(found)
    out = []
    for lang, sources in counts.items():
        kept = [t for t, n in docs[lang].items() if n >= least]

        def shares(count, kept=kept):
            total = sum(count[t] for t in kept) + len(kept)
            return {t: 1 + 10**9 * (count[t] + 1) // total for t in kept}

        whole = shares(sum(sources.values(), Counter()))
        p = {source: shares(count) for source, count in sources.items()}
        for source, count in sources.items():
            parts = {
                "pair": [
                    (sum((p[source][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o)
                    for o in sources
                    if o != source
                ],
                "term": [
                    ((p[source][t] - whole[t]) ** 2 // whole[t], t)
                    for t in kept
                    if count[t] and p[source][t] > whole[t]
                ],
            }
            for part, found in parts.items():
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                for rank, (value, item) in enumerate(found, 1):
                    if part == "pair" or rank <= top:
                        out.append((lang, source, part, item, value, rank))
    return sorted(out)


def rows_of(frame):
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return sorted(tuple(r) for r in frame.select(*columns).collect())


def test_query_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = op12_divergence(spark, "/root/testdata/sf0.001")
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    expected = brute([(r.lang, r.source, r.text) for r in docs.collect()])
    assert len(expected) > 500 and rows_of(got) == expected


def test_sql_against_brute_force():
    path = "/root/testdata/sf0.001/documents.parquet"
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{path}'")
    found = con.execute("select lang, source, text from documents").fetchall()
    assert sorted(con.execute(divergence.oracle()).fetchall()) == brute(found)


def made(seed=0, n=400, sources=17):
    rng = np.random.default_rng(seed)
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(300)] + ["É", "straße"]
    rows = []
    for _ in range(n):
        source = int(rng.integers(0, 3 * sources)) % sources if rng.random() < 0.6 else 0
        size = int(rng.zipf(1.7)) % 60
        at = np.minimum(rng.zipf(1.4, size) - 1 + source, len(words) - 1)
        lang = ["en", "de", None][int(rng.integers(0, 9)) // 4]
        rows.append((lang, f"s{source}", " ".join(words[i] for i in at).title()))
    return rows


@pytest.mark.parametrize("block, pairs, entries", [(1 << 18, 1 << 22, 200_000), (37, 20, 50)])
def test_blocks_and_slices(spark, monkeypatch, block, pairs, entries):
    """A third of the rows in one source; many blocks and slices of a few groups."""
    monkeypatch.setattr(divergence, "PAIRS", pairs)
    monkeypatch.setattr(divergence, "ENTRIES", entries)
    rows = made()
    docs = spark.createDataFrame(rows, "lang string, source string, text string").repartition(7)
    assert rows_of(divergence.audit(docs, top=11, block=block)) == brute(rows, top=11)


def test_row_accumulation():
    """A block's rows against sums over every term."""
    rng = np.random.default_rng(3)
    groups, terms = 9, 40
    zero = rng.integers(1, 50, groups)
    held = rng.random((groups, terms)) < 0.3
    p = np.where(held, rng.integers(1, 10**6, held.shape), zero[:, None])
    g, t = np.nonzero(held)
    order = rng.permutation(len(g))
    index = divergence.Index(t[order], g[order], p[g, t][order], zero)
    for row in range(groups):
        for_all = [int(divergence.far(p[row], p[other]).sum()) for other in range(groups)]
        assert index.row(row, terms).tolist() == for_all


def test_counts_beyond_longs(spark):
    """Shares of counts whose product with 10^9 is no long."""
    frame = spark.createDataFrame([(9 * 10**17, 10**18 + 3)], "n long, whole long")
    found = frame.select(divergence.share("n", "whole")).first()[0]
    assert found == 1 + 10**9 * (9 * 10**17 + 1) // (10**18 + 3)


def test_long_texts_are_counted_in_pieces(monkeypatch):
    monkeypatch.setattr(divergence, "PIECE", 10)
    text = "Ab cd é " * 50 + "x" * 40 + " 7y"
    found = [t for some in divergence.words(text.encode()) for t in some]
    assert found == [t.encode() for t in re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", text.lower())]
    assert list(divergence.words(b"")) == []


def test_odd_rows(spark):
    rows = [
        (None, None, None), ("", "", ""), ("en", "a", "One two two"), ("en", "a", "One two two"),
        ("en", "b", "one, TWO 2 three"), ("en", None, None), ("en", "c", "..."), ("de", "a", "eins"),
        ("fr", "a", "un un un"), ("fr", "b", "Un"), ("fr", "b", "un"), ("fr", " b", "un \u0000 x"),
        ("pl", "a b", None), ("pl", " a b", None),
    ]
    docs = spark.createDataFrame(rows, "lang string, source string, text string").select(
        "*", F.lit(1).alias("doc_id"), F.lit(2).alias("item"), F.lit(3).alias("n"),
        F.lit(4).alias("first"), F.lit(5).alias("number"),
    )
    expected = brute(rows)
    assert any(r[2] == "term" for r in expected) and any(r[0] == "pl" for r in expected)
    assert rows_of(divergence.audit(docs)) == expected
    assert divergence.audit(docs.limit(0)).count() == 0
