"""Models fitted on all rows, of more than their samples once held."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from typeferry.llm import decontam, language, quality


def test_language_counts_every_labelled_text(spark):
    docs = spark.range(9_000).select(
        F.col("id").alias("doc_id"), F.lit("abc").alias("text"),
        F.when(F.col("id") < 8_900, "a").otherwise("b").alias("lang"),
    )
    model = language.learn(docs, F.lit(True))
    each = len(language.trigrams("abc"))
    expected = [0.3 / (n * each + 0.3 * language.BUCKETS) for n in (8_900, 100)]
    assert model.languages == ("a", "b") and np.allclose(model.base[:2], expected, rtol=1e-12)


def test_more_languages_than_a_task_holds(spark, monkeypatch):
    monkeypatch.setattr(language, "HELD", 2)
    rows = [(i, f"text number {'xyzuvw'[i % 5]}", f"l{i % 5}") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").coalesce(1)
    model = language.learn(docs, F.lit(True))
    each = [sum(len(language.trigrams(t)) for _, t, n in rows if n == m) for m in model.languages]
    assert np.allclose(model.base[:5], [0.3 / (n + 0.3 * language.BUCKETS) for n in each])


def test_quality_is_fitted_on_every_label(spark):
    word = F.when(F.col("id") % 3 == 0, "Good words here, and more.").otherwise("| x | * !! 12")
    text = F.concat_ws(" ", word, F.hash("id").cast("string"))
    docs = spark.range(30_000).select(F.col("id").alias("doc_id"), text.alias("text"))
    own = ((F.col("doc_id") % 3 == 0) != (F.hash("doc_id") % 9 == 0)).cast("int")
    labels = docs.select("doc_id", own.alias("quality")).repartition(3)
    rows = docs.join(labels, "doc_id").collect()
    plain = quality.Classifier.fit(
        np.array([quality.measure(r.text) for r in rows]), np.array([r.quality for r in rows], float)
    )
    got = quality.learn(docs, labels, F.lit(True))
    for name in ("mean", "scale", "weights", "bias"):
        assert np.allclose(getattr(got, name), getattr(plain, name), rtol=1e-6, atol=1e-8)


@pytest.mark.parametrize("often", [2896, 7, 0])
def test_latent_space_is_fitted_on_every_passage(spark, monkeypatch, often):
    monkeypatch.setattr(decontam, "OFTEN", often)
    names = F.array(*[F.lit(f"w{i}") for i in range(30)])
    picked = [names[F.pmod(F.xxhash64(F.lit(k), "id"), F.lit(30 - k)).cast("int")] for k in range(20)]
    docs = spark.range(24_000).select(F.col("id").alias("doc_id"), F.concat_ws(" ", *picked).alias("text"))
    items = [decontam.item_of(i, " ".join(f"w{j}" for j in range(5 * i, 5 * i + 8)), None) for i in range(3)]
    sums, real = [], decontam.summed
    monkeypatch.setattr(decontam, "summed", lambda *a: sums.append(real(*a)) or sums[-1])
    n_docs, weights = decontam.corpus_weights(docs)
    space = decontam.fit(docs, items, weights, 256, None, n_docs, 0.35, 0.55)
    n = len(space.terms.sorted)
    gram, energy = np.zeros((n, n)), 0.0
    for _, halves in decontam.halves_of([r.text for r in docs.collect()]):
        numbers, word = space.terms.numbers(halves.hashes), halves.weights(weights)
        half = np.searchsorted(halves.starts, np.arange(len(word)), side="right") - 1
        rows = np.zeros((len(halves.starts), n))
        known = numbers >= 0
        share = word[known] / np.sqrt(halves.total(word**2))[half[known]]
        np.add.at(rows, (half[known], numbers[known]), share)
        gram += rows.T @ rows
        energy += (rows**2).sum()
    width = (len(sums[-1]) - 1) // n
    omega = np.random.default_rng(5).standard_normal((n, width)).astype(np.float32)
    assert np.isclose(sums[-1][-1], energy)
    expected = gram @ omega
    assert np.allclose(sums[-1][:-1].reshape(n, width), expected, atol=1e-5 * np.abs(expected).max())
