import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from typeferry.llm import toxicity
from typeferry.llm.common import bucket
from typeferry.llm.queries import op3_toxicity

SF_DIR = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    got = op3_toxicity(spark, SF_DIR)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    assert got.count() == spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
    rows = got.join(labels, "doc_id").where("held_out").collect()
    toxic = np.array([r.toxic for r in rows])
    found = np.array([r.predicted for r in rows])
    assert len(rows) > 500 and toxic.sum() > 50
    assert found[toxic == 1].mean() > 0.9
    assert found[toxic == 0].mean() < 0.02
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)


def test_held_out_labels_are_not_learned(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    usable = bucket(F.col("doc_id"), 4) != 2
    flipped = labels.withColumn("toxic", F.when(usable, F.col("toxic")).otherwise(1 - F.col("toxic")))
    a, b = (toxicity.learn(docs, t, usable)[0] for t in (labels, flipped))
    assert np.allclose(a.weights, b.weights) and a.bias == pytest.approx(b.bias)


def test_label_model_finds_rates_and_copies(spark):
    """Three voters, a copy of the first, and a third of the labels."""
    rng = np.random.default_rng(0)
    y = rng.random(20_000) < 0.2
    rates = np.array([[0.8, 0.7, 0.6], [0.05, 0.1, 0.02]])
    x = rng.random((len(y), 3)) < np.where(y[:, None], rates[0], rates[1])
    x = np.hstack([x, x[:, :1]])
    known = [int(label) if i % 3 == 0 else None for i, label in enumerate(y)]
    rows = [(raw.as_py(), label) for raw, label in zip(toxicity.pack_votes(x), known)]
    votes = spark.createDataFrame(rows, "votes binary, toxic int")
    model = toxicity.fit_labels(votes, 4, np.full(4, 0.5), np.full(4, 0.05), rounds=30)
    assert np.abs(model.toxic - rates[0][[0, 1, 2, 0]]).max() < 0.2
    assert np.abs(model.clean - rates[1][[0, 1, 2, 0]]).max() < 0.08
    assert model.discount[0] < 0.6 and model.discount[3] < 0.6 < model.discount[1]
    assert abs(model.prior - 0.2) < 0.1


def test_presence():
    voters = toxicity.Signals(toxicity.fixed_voters())
    assert len(voters) == len(toxicity.LEXICON) + len(toxicity.PAIRS)
    texts = ["You IDIOT!", "an idiotic thing", "just shut\nup", "shut it up", None, "", "imbécil"]
    assert toxicity.presence(texts, voters).sum(1).tolist() == [1, 0, 1, 0, 0, 0, 1]
    across = toxicity.presence(["shut", "up"], voters)
    assert not across.any()


def test_signals_by_how_often():
    text = "lowerly lower lowest. Lowing other lowerly"
    found = toxicity.all_signals(text)
    signals = toxicity.Signals(found)
    seen = toxicity.presence([text, None, f"{text}. {text}"], signals)
    assert seen.sum(1).tolist() == [len(found), 0, len(found)]
    level = (found & np.uint64(3)).astype(int)
    assert (level == 2).sum() == 2  # beginning with "low" five times, with "lowe" four
    once = toxicity.Signals(toxicity.all_signals("lower"))
    assert (toxicity.presence(["lowerly"], once).sum(), len(once)) == (2, 3)


def test_votes_survive_packing():
    votes = np.random.default_rng(1).random((9, 13)) < 0.5
    assert (toxicity.unpack_votes(toxicity.pack_votes(votes), 13) == votes).all()


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, "you idiot"), (3, "you idiot"), (None, "x"), (5, "z " * 300_000 + "scum")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").select(
        "*", *(F.lit(1).alias(c) for c in ("toxic", "place", "votes", "own", "score"))
    )
    labels = spark.createDataFrame(
        [(1, None), (2, 7), (3, 1), (3, 0), (None, 1)], "doc_id long, toxic int"
    )
    nothing = labels.limit(0)
    for known in (labels, nothing):
        scorer, _ = toxicity.learn(docs, known, F.lit(True))
        found = docs.select("doc_id", toxicity.scores(docs, scorer).alias("s")).collect()
        assert len(found) == 6 and all(0 <= r.s <= 1 for r in found)
        assert len({r.s for r in found if r.doc_id in (1, 2)}) == 1
    scorer, _ = toxicity.learn(docs.limit(0), nothing, F.lit(True))
    assert 0 <= scorer.scores([None])[0] <= 1


def test_query_against_brute_force(spark, monkeypatch):
    """Every row's score from the signals of its whole text, with the classifier learned."""
    kept, real = [], toxicity.learn

    def learn(*args):
        kept.append(real(*args))
        return kept[0]

    monkeypatch.setattr(toxicity, "learn", learn)
    folder = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in op3_toxicity(spark, folder).collect()}
    rows = spark.read.parquet(f"{folder}/documents.parquet").collect()
    scorer = kept[0][0]
    weights = dict(zip(scorer.terms.hashes.tolist(), scorer.weights.tolist()))
    assert len(got) == len(rows)
    for row in rows:
        own = set(toxicity.all_signals(row.text).tolist())
        odds = scorer.bias + sum(w for h, w in weights.items() if h in own)
        r = got[row.doc_id]
        assert abs(r.score - 1 / (1 + np.exp(-odds))) < 1e-6
        assert r.predicted == int(r.score >= 0.3)
        assert r.held_out == (zlib.crc32(str(row.doc_id).encode()) % 4 == 2)
