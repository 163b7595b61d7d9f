"""The pipeline's stages, each against a plain version of its decision."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from test_decontam import plain_words
from test_packing import check_layout
from test_simhash import plain_components, plain_fingerprint

from typeferry.llm import language, quality

SF_DIR = "/root/testdata/sf0.01"
STAGES = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def runs(spark):
    """What each stage was given, and what it kept."""
    docs, out = spark.read.parquet(f"{SF_DIR}/documents.parquet").cache(), {}
    for name, stage in corpus_pipeline.STAGES:
        kept = stage(spark, docs, SF_DIR).cache()
        out[name] = docs, kept
        docs = kept
    return out


def ids(frame):
    return [r.doc_id for r in frame.select("doc_id").collect()]


def test_stages():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "language", "quality", "simhash", "decontamination", "packing",
    ]


def test_columns_and_rows_are_those_of_documents(runs):
    for name, (given, kept) in runs.items():
        if name != "packing":
            assert kept.columns == given.columns and kept.exceptAll(given).isEmpty()


def test_language(spark, runs):
    given, kept = runs["language"]
    model = language.learn(given, F.col("lang").isNotNull())
    expected = []
    for r in given.collect():
        found = model.mixture(r.text)
        if found is not None and found["other"] <= 0.5:
            expected.append(r.doc_id)
    assert sorted(ids(kept)) == sorted(expected)
    assert len(expected) > 0.97 * given.count()


def test_quality(spark, runs):
    given, kept = runs["quality"]
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    scores = quality.scores(given, quality.learn(given, labels, F.lit(True)))
    assert sorted(ids(kept)) == sorted(ids(scores.where("score >= 0.5")))
    known = labels.join(given.select("doc_id"), "doc_id")
    left = known.join(kept.select("doc_id").withColumn("kept", F.lit(1)), "doc_id", "left")
    rates = {r.quality: r.rate for r in left.groupBy("quality").agg(F.count("kept") / F.count("*")).toDF("quality", "rate").collect()}
    assert rates[1] > 0.98 and rates[0] < 0.2


def test_simhash(runs):
    given, kept = runs["simhash"]
    rows = [(r.doc_id, plain_fingerprint(r.text)) for r in given.collect()]
    assert sorted(ids(kept)) == sorted(set(plain_components(rows)))


def test_decontamination(spark, runs):
    given, kept = runs["decontamination"]
    items = [
        " " + " ".join(plain_words(r.text)) + " "
        for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()
    ]
    held = set()
    for r in given.collect():
        text = " " + " ".join(plain_words(r.text)) + " "
        if any(item in text for item in items):
            held.add(r.doc_id)
    assert held and not held & set(ids(kept))
    assert given.count() - kept.count() < 2 * len(held) + 20


def test_packing(runs):
    given, placed = runs["packing"]
    assert set(ids(placed)) == set(ids(given))
    assert check_layout(placed.collect()) > 0.97


def test_run(spark, runs):
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF_DIR).collect())) == sorted(
        map(tuple, runs["packing"][1].collect())
    )


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_odd_documents(spark, name):
    item = spark.read.parquet(f"{SF_DIR}/benchmark.parquet").first().text
    rows = [
        (1, None, "en", "a", 0), (2, "", None, None, None), (None, "some words here", "en", "a", 3),
        (4, item, "en", None, 9), (4, item, "en", None, 9), (5, "word " * 40_000, None, "b", 1),
        (6, "123 %", "de", "b", 5),
    ]
    docs = spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long"
    ).select("*", *(F.lit(1).alias(c) for c in ("fp", "score", "host", "start", "kept_id", "own")))
    for frame in (docs, docs.limit(0)):
        kept = STAGES[name](spark, frame, SF_DIR)
        rows_kept = kept.collect()
        if name != "packing":
            assert kept.columns == docs.columns
            assert len(rows_kept) <= 7
    assert rows_kept == []


def test_rows_that_ids_do_not_tell_apart(spark):
    """Rows without an id, or with the same one, are judged by their own texts."""
    benchmark = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    item = benchmark.first().text
    source = spark.read.parquet(f"{SF_DIR}/documents.parquet").where("length(text) > 1500")
    # Of texts that are near to one another, or hold an item, one stands here at most.
    texts = []
    for r in simhash_kept(spark, source).orderBy("doc_id").limit(9).collect():
        texts.append(r.text)
    rows = [
        (1, texts[0], 0), (None, texts[0], 1), (None, texts[1], 2), (None, texts[1], 3),
        (None, texts[2], 4), (7, texts[3], 5), (7, texts[4], 6), (7, texts[3], 7), (2, texts[4], 8),
        (None, texts[5] + " " + item, 9), (8, texts[6] + " " + item, 10), (8, texts[7], 11),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long").select(
        "*", F.lit(1).alias("row_key"), F.lit(2).alias("kept_key")
    )
    kept = STAGES["simhash"](spark, docs, SF_DIR)
    assert kept.columns == docs.columns
    found = sorted(r.n_chars for r in kept.collect())
    assert len(found) == 8 and {0, 4, 8, 9, 10, 11} < set(found)
    assert len({2, 3} & set(found)) == 1 and len({5, 7} & set(found)) == 1
    clean = STAGES["decontamination"](spark, kept, SF_DIR)
    assert clean.columns == docs.columns
    assert sorted(r.n_chars for r in clean.collect()) == [x for x in found if x not in (9, 10)]


def simhash_kept(spark, docs):
    clean = docs.where("doc_id is not null and lang = 'en'")
    return STAGES["decontamination"](spark, STAGES["simhash"](spark, clean, SF_DIR), SF_DIR)
