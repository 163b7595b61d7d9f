"""Fitting samples under repeated and missing ids: a third of the rows under one id, a third
without."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from typeferry.llm import common, decontam, quality, toxicity, warc

N = 3_000


def test_places_and_thinning(spark):
    third = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, F.col("id"))
    rows = spark.range(N).select(third.alias("i"), F.lit("text").alias("text"))
    upto = int(common.PLACES * 0.1)
    for seed in range(3):
        low = rows.where(common.place(F.col("i") + seed) < upto)
        # The id of a third of the rows may be in or out; those without are dealt one by one.
        assert low.where("i is null").count() < 0.15 * N / 3
    assert common.thinned(rows, N).count() == N
    assert 200 < common.thinned(rows, 300).count() < 420


@pytest.fixture(scope="module")
def crowded(spark):
    """Documents and labels of sf0.1, with a third more rows under one id and a third without."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").limit(3000)
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    # The id that any sample takes first.
    place = common.place(F.col("doc_id"))
    one = labels.join(docs, "doc_id").where("toxic = 1").orderBy(place).first()["doc_id"]
    again = docs.withColumn("doc_id", F.lit(one).cast("long"))
    none = docs.withColumn("doc_id", F.lit(None).cast("long"))
    labels = labels.unionAll(labels.where(f"doc_id = {one}")).unionAll(labels.where(f"doc_id = {one}"))
    return docs.unionAll(again).unionAll(none), labels


def collected(monkeypatch):
    """The rows of every table that comes to the driver."""
    from pyspark.sql.classic.dataframe import DataFrame

    sizes, real = [], DataFrame.toArrow

    def to_arrow(self):
        out = real(self)
        sizes.append(out.num_rows)
        return out

    monkeypatch.setattr(DataFrame, "toArrow", to_arrow)
    return sizes


def test_toxicity(spark, crowded, monkeypatch):
    docs, labels = crowded
    monkeypatch.setattr(toxicity, "TRAIN", 400)
    monkeypatch.setattr(toxicity, "TOXIC", 100)
    monkeypatch.setattr(toxicity, "CLEAN", 200)
    sizes = collected(monkeypatch)
    scorer, _ = toxicity.learn(docs, labels, F.lit(True))
    assert max(sizes) <= 900 and len(scorer.weights) > 0


def test_quality(spark, crowded, monkeypatch):
    docs, labels = crowded
    sizes = collected(monkeypatch)
    quality.learn(docs, labels, F.lit(True), sample=300)
    assert 200 < max(sizes) <= 700


def test_warc_dictionary(spark):
    page = F.concat(F.lit("<html><p>"), F.xxhash64("id").cast("string"), F.lit("</p></html>"))
    third = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, F.col("id"))
    pages = spark.range(N).select(third.alias("page_id"), page.alias("html"))
    assert 0 < len(warc.train(pages, rows=200)) < 64 << 10
    few = pages.limit(3)
    raw = warc.train(few, rows=200)
    assert raw and set(raw.split(b"</html>")) <= set(b"".join(r.html.encode() for r in few.collect()).split(b"</html>"))
    assert warc.train(pages.limit(0)) == b"" == warc.train(pages.withColumn("html", F.lit("")))


def test_decontamination(spark, crowded, monkeypatch):
    docs, _ = crowded
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    read, real = [], common.thinned

    def thinned(rows, bound):
        out = real(rows, bound)
        read.append(out.count())
        return out

    monkeypatch.setattr(decontam, "thinned", thinned)
    with_sample = decontam.finds(docs, bench)
    assert with_sample.count() >= 0
    assert read and np.max(read) <= 22_000
