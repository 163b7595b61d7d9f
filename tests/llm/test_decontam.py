import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from typeferry.llm import decontam, words
from typeferry.llm.queries import op9_decontam

SF_DIR = "/root/testdata/sf0.01"


def plain_words(text):
    return re.findall(r"(?:[^\W_]|[^\x00-\x7f])+", text.lower())


def test_word_hashes_tell_words_apart(monkeypatch):
    texts = ["The cat, the CAT; été-été 12 a", None, "", "...", "x" * 50 + " cat", "the é"]
    expected = [plain_words(t or "") for t in texts]
    for size in (words.BUFFER, 16):
        monkeypatch.setattr(words, "BUFFER", size)
        got = [[] for _ in texts]
        for batch in words.word_batches(texts):
            for number, h in zip(batch.text.tolist(), batch.hashes().tolist()):
                got[number].append(h)
        assert list(map(len, got)) == list(map(len, expected))
        names = {}
        for own, hashes in zip(expected, got):
            for w, h in zip(own, hashes):
                assert names.setdefault(w, h) == h
        assert len(set(names.values())) == len(names)


def test_beginnings():
    (batch,) = words.word_batches(["lower lowest low"])
    a, b, c = batch.hashes(4).tolist()
    assert a == b != c and c == batch.hashes()[2]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 5), max_size=20), st.lists(st.integers(0, 5), max_size=30))
def test_common_subsequence(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = (
                table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
            )
    assert decontam.common_subsequence(decontam.bits(a), len(a), b) == table[-1][-1]


def test_halves():
    texts = ["w " * 33, None, "a b", "c"]
    ((at, halves),) = decontam.halves_of(texts)
    assert at == 0 and halves.text.tolist() == [0, 0, 0, 2, 3]
    assert halves.starts.tolist() == [0, 16, 32, 33, 35]
    assert halves.repeated().tolist() == [False] + [True] * 15 + [False] + [True] * 15 + [False] * 4
    assert halves.frequencies().sum() == 6
    assert list(decontam.halves_of([])) == []


def test_basis_of_a_known_matrix():
    rng = np.random.default_rng(0)
    left, _ = np.linalg.qr(rng.standard_normal((60, 5)))
    gram = left @ np.diag([9.0, 7, 5, 3, 2]) @ left.T
    omega = rng.standard_normal((60, 20))
    basis = decontam.leading(gram @ omega, omega, 5)
    assert np.allclose(basis @ basis.T @ left, left, atol=1e-6)


@pytest.fixture(scope="module")
def planted(spark):
    """Documents of the table, with items put in whole, rephrased and in part."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text")
    items = spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()
    rng = random.Random(4)
    base = [r.text for r in docs.where("length(text) > 1500").orderBy("doc_id").collect()]
    rows, expected = [], {}
    for n, item in enumerate(items):
        body = base[n].split(" ")
        body = [w for w in body if w not in item.text]
        own = item.text.split()
        kind = ("copy", "copy", "paraphrase", "part")[n % 4]
        if n % 4 == 1:  # one word in eight replaced
            own = [w if rng.random() > 0.12 else "other" for w in own]
        elif kind == "paraphrase":  # the answer kept, a third of the rest replaced
            answer = len(decontam.last_sentence(item.text).split())
            own = [w if i >= len(own) - answer or i % 3 else "instead" for i, w in enumerate(own)]
        elif kind == "part":
            own = own[: len(own) // 4]
        at = rng.randrange(len(body))
        rows.append((n, " ".join(body[:at] + own + body[at:])))
        expected[n] = item.item_id, kind
    return spark.createDataFrame(rows, "doc_id long, text string"), expected


def test_planted_items(spark, planted):
    docs, expected = planted
    benchmark = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    found = {}
    for r in decontam.finds(docs, benchmark).collect():
        found.setdefault(r.doc_id, set()).add((r.item_id, r.kind))
    hit = {n for n, (item, _) in expected.items() if any(i == item for i, _ in found.get(n, ()))}
    leaked = {n for n, (_, kind) in expected.items() if kind != "part"}
    assert len(hit & leaked) >= 0.95 * len(leaked)
    assert not hit - leaked


def test_recall_of_the_search_against_brute_force(spark):
    """Every document that holds an item whole, found by plain search, is a find."""
    benchmark = spark.read.parquet("/root/testdata/sf0.1/benchmark.parquet").collect()
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").collect()
    items = {r.item_id: " " + " ".join(plain_words(r.text)) + " " for r in benchmark}
    expected = set()
    for d in docs:
        text = " " + " ".join(plain_words(d.text or "")) + " "
        expected |= {(d.doc_id, i) for i, words_ in items.items() if words_ in text}
    assert len(expected) > 50
    got = op9_decontam(spark, "/root/testdata/sf0.1").collect()
    found = {(r.doc_id, r.item_id) for r in got}
    assert len(expected & found) == len(expected)
    assert all(r.overlap >= 0.55 for r in got)


def test_odd_rows(spark):
    item = "one two three four five six seven eight nine ten. Eleven twelve thirteen fourteen."
    rows = [(1, None), (2, ""), (None, f"x {item}"), (4, item), (4, item), (5, "z " * 90_000 + item)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").select(
        "*", F.lit(1).alias("item_id"), F.lit("a").alias("answer"), F.lit(1).alias("held_id")
    )
    asked = [(7, item, None), (7, item, "thirteen"), (8, None, None), (9, "", "x"), (None, item, "")]
    benchmark = spark.createDataFrame(asked, "item_id long, text string, answer string")
    found = decontam.finds(docs, benchmark).collect()
    assert sorted({str(r.doc_id) for r in found}) == ["4", "5", "None"]
    assert {r.item_id for r in found} == {7, None}
    assert len(found) == 4 * 3
    assert {r.first_word for r in found if r.doc_id == 5} != {0}
    kept = decontam.decontaminated(docs, benchmark)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [1, 2]
    assert decontam.finds(docs.limit(0), benchmark).count() == 0
    assert decontam.finds(docs, benchmark.limit(0)).count() == 0
    blocks = decontam.finds(docs, benchmark, block_items=1).collect()
    assert len(blocks) == len(found)


@pytest.mark.parametrize("size", [0, 1, 16, 64, 65, 80, 81, 1000])
def test_windows_cover_an_item(size):
    found = decontam.windows(np.arange(size))
    assert found[0].tolist() == list(range(size)) and (len(found) > 1) == (size > 64)
    assert all(len(w) == 32 for w in found[1:])
    assert size <= 64 or set(np.concatenate(found[1:]).tolist()) == set(range(size))


def test_whole_copies_of_items_of_any_length(spark):
    """Items of 3 to 1,000 words, the short ones of common words, at many places of texts."""
    rng = random.Random(8)
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text", "lang")
    some = docs.where("lang = 'en' and length(text) > 800").orderBy("doc_id").collect()
    pool = [w for r in some for w in plain_words(r.text)]
    sizes = (3, 5, 6, 10, 15, 20, 33, 65, 100, 200, 400, 600, 1000)
    items = []
    for n, size in enumerate(sizes * 3):
        words_ = []
        while len(set(words_)) < min(size, 16) / 2:  # some texts repeat one word
            at = rng.randrange(len(pool) - size)
            words_ = pool[at : at + size]
        rng.shuffle(words_)
        items.append((n, " ".join(words_)))
    rows = []
    for n, item in items:
        body = pool[n * 400 : n * 400 + 300]
        at = rng.randrange(len(body))
        rows.append((n, " ".join([*body[:at], item, *body[at:]])))
    rows.append((-1, " ".join(reversed(pool[:5000]))))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    planted = spark.createDataFrame(rows, "doc_id long, text string")
    for block_items in (384, 40):
        found = decontam.finds(planted, benchmark, block_items=block_items).collect()
        whole = {(r.doc_id, r.item_id) for r in found if r.overlap == 1 and r.kind == "copy"}
        assert {n for n, _ in items} == {d for d, i in whole if d == i}
        assert len(found) == len({(r.doc_id, r.item_id) for r in found})


def test_short_items_against_brute_force():
    """No stretch that the word-by-word check accepts is passed over."""
    rng = np.random.default_rng(2)
    names = [f"w{i}" for i in range(40)]
    texts = [" ".join(rng.choice(names, rng.integers(0, 300))) for _ in range(20)]
    items = [
        decontam.item_of(i, " ".join(rng.choice(names, rng.integers(1, 20))), None)
        for i in range(60)
    ]
    weights = rng.random(decontam.BUCKETS)
    short = decontam.ShortItems(items, weights, 0.55)
    ((_, halves),) = decontam.halves_of(texts)
    found = {(int(halves.text[h]), i) for h, i in zip(*map(np.ndarray.tolist, short.search(halves)))}
    for text in range(len(texts)):
        own = halves.hashes[halves.firsts[text] : halves.firsts[text + 1]].tolist()
        for i, item in enumerate(items):
            if len(item.words) < decontam.HALF and decontam.Verifier(item).best(own)[0] >= 0.55:
                assert (text, i) in found
