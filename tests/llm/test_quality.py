import numpy as np
import pytest
from pyspark.sql import functions as F

from typeferry.llm import quality
from typeferry.llm.common import bucket
from typeferry.llm.queries import op10_quality

SF_DIR = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    got = op10_quality(spark, SF_DIR)
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    assert got.count() == spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
    rows = got.join(labels, "doc_id").where("held_out").select("score", "predicted", "quality").collect()
    good = np.array([r.quality for r in rows])
    found = np.array([r.predicted for r in rows])
    assert len(rows) > 300
    assert found[good == 1].mean() > 0.99
    assert found[good == 0].mean() < 0.15


def plain_rates(rows):
    """Shrunk rates by host and path, without leaving anything out: a check of the sums."""
    hosts, paths = {}, {}
    for host, path, good in rows:
        for table, key in ((hosts, host), (paths, (host, path))):
            n, s = table.get(key, (0, 0.0))
            table[key] = n + 1, s + good
    return hosts, paths


@pytest.mark.parametrize("few", [0, 100_000])
def test_sites_broadcast_or_not(spark, monkeypatch, few):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    classifier = quality.learn(docs, labels, F.lit(True))
    monkeypatch.setattr(quality, "FEW_SITES", few)
    kept = quality.accepted(docs, classifier)
    scored = quality.scores(docs, classifier).where("score >= 0.5")
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in scored.collect())


def test_sums_and_priors(spark):
    rng = np.random.default_rng(2)
    rows, truth = [], {}
    for host in range(60):
        mean = rng.beta(8, 2)
        for path in range(4):
            rate = rng.beta(40 * mean, 40 * (1 - mean))
            truth[f"h{host}", f"p{path}"] = rate
            n = 1 if host % 3 == 0 else 60
            rows += [(f"h{host}", f"p{path}", float(rng.random() < rate)) for _ in range(n)]
    frame = spark.createDataFrame(rows, "host string, path string, good double")
    sites, rate, host_prior, path_prior = quality.rates(frame)
    hosts, paths = plain_rates(rows)
    got = {(r.host, r.path): r for r in sites.collect()}
    assert set(got) == set(paths)
    for (host, path), (n, s) in paths.items():
        r = got[host, path]
        assert (r.n, round(r.s, 6)) == (n, round(s, 6))
        assert (r.host_n, round(r.host_s, 6)) == (hosts[host][0], round(hosts[host][1], 6))
    assert abs(rate - np.mean([g for *_, g in rows])) < 1e-9
    assert 4 < host_prior < 30 and 10 < path_prior < 200
    sparse = [(k, v) for k, v in paths.items() if v[0] == 1]
    shrunk = lambda k: (
        paths[k][1] + path_prior * (hosts[k[0]][1] + host_prior * rate) / (hosts[k[0]][0] + host_prior)
    ) / (paths[k][0] + path_prior)
    error = np.mean([(shrunk(k) - truth[k]) ** 2 for k, _ in sparse])
    raw = np.mean([(s / n - truth[k]) ** 2 for k, (n, s) in sparse])
    assert error < raw / 3


def test_site_moves_the_score(spark):
    bad = [(i, "word " * 30, "bad", "x") for i in range(40)]
    good = [(100 + i, "some plain words that are fine here number", "good", "x") for i in range(40)]
    docs = spark.createDataFrame([*bad, *good, (200, "w", "bad", "x"), (201, "w", "good", "x")],
                                 "doc_id long, text string, source string, lang string")
    labels = docs.select("doc_id", F.when(F.col("source") == "good", 1).otherwise(0).alias("quality"))
    classifier = quality.learn(docs, labels, F.lit(True))
    found = {r.doc_id: r for r in quality.scores(docs, classifier).collect()}
    assert found[200].text_score == pytest.approx(found[201].text_score)
    assert found[200].score < found[201].score
    assert found[200].path_rate < 0.3 < 0.7 < found[201].path_rate


def test_odd_rows(spark):
    rows = [
        (1, None, "a", "x"), (2, "", "a", "x"), (3, " \n", None, None), (None, "some words", "a", None),
        (5, "some words", None, "x"), (5, "some words", None, "x"), (6, "z " * 400_000, "b", "y"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string").select(
        "*", *(F.lit(i).alias(c) for i, c in enumerate(("host", "path", "odds", "good", "row", "score", "n")))
    )
    labels = spark.createDataFrame([(5, 1), (6, 0), (6, None), (None, 1)], "doc_id long, quality int")
    classifier = quality.learn(docs, labels, F.lit(True))
    found = quality.scores(docs, classifier).collect()
    assert len(found) == 7
    assert [r.score for r in found if r.doc_id in (1, 2, 3)] == [0.0] * 3
    assert all(0 <= r.score <= 1 for r in found)
    kept = quality.accepted(docs, classifier, least=0.0)
    assert kept.columns == docs.columns and kept.count() == 7
    assert sorted(map(str, kept.collect())) == sorted(map(str, docs.collect()))
    assert quality.accepted(docs, classifier, least=1.1).count() == 0
    nothing = docs.limit(0)
    assert quality.scores(nothing, classifier).count() == 0
    plain = quality.learn(nothing, labels, F.lit(True))
    assert {r.text_score for r in quality.scores(docs, plain).collect()} == {0.0, 0.5}
    assert quality.accepted(nothing, plain).columns == docs.columns


def test_learned_rows_are_the_usable_ones(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    usable = bucket(F.col("doc_id"), 5) != 0
    flipped = labels.withColumn(
        "quality", F.when(usable, F.col("quality")).otherwise(1 - F.col("quality"))
    )
    a, b = (quality.learn(docs, t, usable) for t in (labels, flipped))
    assert np.allclose(a.weights, b.weights) and a.bias == pytest.approx(b.bias)


def brute_scores(rows, odds):
    """Every row's score from the log-odds of all texts: rows are (host, path)."""
    good = [None if o is None else 1 / (1 + np.exp(-o)) for o in odds]
    hosts, paths = {}, {}
    for (host, path), g in zip(rows, good):
        if g is not None:
            for table, key in ((hosts, host), (paths, (host, path))):
                n, s = table.get(key, (0, 0.0))
                table[key] = n + 1, s + g
    n = sum(c for c, _ in hosts.values())
    rate = sum(s for _, s in hosts.values()) / n
    chance = rate * (1 - rate)
    between = sum(c * (s / c - rate) ** 2 for c, s in hosts.values()) - chance * (len(hosts) - 1)
    between /= n - sum(c * c for c, _ in hosts.values()) / n
    within = sum(c * (s / c - hosts[h][1] / hosts[h][0]) ** 2 for (h, _), (c, s) in paths.items())
    within -= chance * (len(paths) - len(hosts))
    within /= n - sum(c * c / hosts[h][0] for (h, _), (c, _) in paths.items())
    host_prior, path_prior = (
        np.clip(chance / x - 1, 1.0, 1e6) if x > 0 else 1e6 for x in (between, within)
    )
    out = []
    for (host, path), o, g in zip(rows, odds, good):
        own, one = (0.0, 0) if g is None else (g, 1)
        c, s = hosts.get(host, (0, 0.0))
        h = (s - own + host_prior * rate) / (c - one + host_prior)
        c, s = paths.get((host, path), (0, 0.0))
        p = (s - own + path_prior * h) / (c - one + path_prior)
        if g is None:
            out.append(0.0)
            continue
        p = np.clip(p, 1e-6, 1 - 1e-6)
        out.append(1 / (1 + np.exp(-(o + np.log(p / (1 - p)) - np.log(rate / (1 - rate))))))
    return out


def test_query_against_brute_force(spark, monkeypatch):
    """The whole query, with the classifier it has learned, over every row."""
    kept, real = [], quality.learn

    def learn(*args, **named):
        kept.append(real(*args, **named))
        return kept[0]

    monkeypatch.setattr(quality, "learn", learn)
    folder = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in op10_quality(spark, folder).collect()}
    rows = spark.read.parquet(f"{folder}/documents.parquet").collect()
    texts = [r.text if r.text and r.text.strip() else None for r in rows]
    odds = [None if t is None else float(kept[0].log_odds([t])[0]) for t in texts]
    expected = brute_scores([(r.source, r.lang) for r in rows], odds)
    assert len(got) == len(rows)
    for row, score in zip(rows, expected):
        assert abs(got[row.doc_id].score - score) < 1e-9
        assert got[row.doc_id].predicted == int(score >= quality.LEAST)
