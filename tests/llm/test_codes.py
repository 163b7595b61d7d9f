import hashlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from typeferry.llm import codes
from typeferry.llm.queries import op11_codes


def brute(rows, parts=16, entries=64, rounds=2):
    """Plain k-means in whole numbers: rows (vec_id, vector), all finite and of one length."""
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, list(r[1])))
    dim = len(rows[0][1])
    width = -(-dim // parts)
    x = np.zeros((len(rows), parts * width), np.int64)
    x[:, :dim] = np.floor(256 * np.array([r[1] for r in rows], np.float64).reshape(-1, dim))
    x = x.reshape(len(rows), parts, width).transpose(1, 0, 2)
    book = x[:, :entries].copy()
    for turn in range(rounds + 1):
        d = ((x[:, :, None, :] - book[:, None, :, :]) ** 2).sum(3)
        own = d.argmin(2)
        if turn < rounds:
            for p in range(parts):
                for e in set(own[p].tolist()):
                    book[p, e] = x[p, own[p] == e].sum(0) // int((own[p] == e).sum())
    sha = hashlib.sha256(",".join(map(str, book.ravel().tolist())).encode()).hexdigest()
    return {
        (r[0], tuple(r[1])): ("".join(f"{own[p, i]:02x}" for p in range(parts)),
                              int(d.min(2)[:, i].sum()), sha)
        for i, r in enumerate(rows)
    }


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.1"])
def test_query_against_brute_force(spark, sf):
    rows = spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet").collect()
    expected = brute([(r.vec_id, r.embedding) for r in rows])
    errors = {}
    for r in rows:
        errors[r.label] = errors.get(r.label, 0) + expected[r.vec_id, tuple(r.embedding)][1]
    got = op11_codes(spark, f"/root/testdata/{sf}")
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    label = {r.vec_id: r.label for r in rows}
    found = {r.vec_id: r for r in got.collect()}
    assert len(found) == len(rows)
    for (vec_id, _), (code, error, sha) in expected.items():
        r = found[vec_id]
        assert (r.code, r.error, r.codebooks_sha256) == (code, error, sha)
        assert r.label_error == errors[label[vec_id]]


@pytest.mark.parametrize("rounds, entries", [(0, 64), (1, 7), (4, 64), (6, 33)])
def test_rounds_and_ties(spark, rounds, entries):
    """Few distinct components: most distances are tied, bounds decide nothing by themselves."""
    rng = np.random.default_rng(rounds)
    values = rng.integers(-3, 4, (700, 10)) / 256
    rows = [(int(i), v.tolist(), 1) for i, v in enumerate(values)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    found, _ = codes.codes(frame.repartition(5), parts=5, entries=entries, rounds=rounds)
    expected = brute([(r[0], r[1]) for r in rows], 5, entries, rounds)
    got = {r.vec_id: (r.code, r.error, r.codebooks_sha256) for r in found.collect()}
    assert got == {i: v for (i, _), v in expected.items()}


def test_bounds_exclude_only_what_is_farther():
    """Whatever the entries do, the assignment is that of all distances; many are not measured."""
    rng = np.random.default_rng(1)
    points = rng.integers(-200, 200, (3000, 4))
    entries = points[:64].copy()
    bounds, _ = codes.search(points, entries, 16)
    spared = 0
    for step in (3, 10, 40):
        moved_to = entries + rng.integers(-step, step + 1, entries.shape)
        moved = codes.ceil_root(((moved_to - entries) ** 2).sum(1) * codes.SCALE**2)
        entries = moved_to
        bounds, own, unsure = codes.again(points, entries, moved, bounds)
        d = codes.distances(points, entries)
        assert (bounds.near[:, 0] == d.argmin(1)).all() and (own == d.min(1)).all()
        assert (np.diff(bounds.low, axis=1) >= 0).all()
        spared += (unsure < 16).sum()
        # Every entry that is not kept lies at the outer bound or beyond.
        d[np.arange(3000)[:, None], bounds.near] = 1 << 50
        assert (codes.floor_root(d.min(1) * codes.SCALE**2) >= bounds.low[:, -1]).all()
    assert spared > 3000


def test_kept_bounds_follow_what_was_needed():
    entries = np.zeros((2, 64, 1), np.int64)
    book = codes.Codebooks(entries, np.zeros((2, 64), np.int64), (16, 16), (16, 16))
    sums = {(0, -1, 0): 1000, (1, -1, 0): 100, (1, -1, 12): 900}
    assert book.next(sums).keep == (8, 13)
    assert book.next({}).keep == (16, 16)


def test_odd_rows(spark):
    a, b = [0.5, -0.25, 1.0], [0.1, 0.2, 0.3]
    nan, inf = float("nan"), float("inf")
    rows = [
        (3, a, "x"), (1, b, "x"), (1, b, "x"), (1, a, None), (None, b, None), (2, None, "x"),
        (4, [1.0, None, 1.0], "x"), (5, [nan, 1.0, 1.0], "y"), (6, [1.0, -inf, 1.0], "y"),
        (7, [], "y"), (8, [], None), (9, [2.0] * 4, "y"), (10, [2.0] * 32, "z"),
    ]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string")
    frame = frame.select(
        "*", F.lit(1).alias("dim"), F.lit(2).alias("q"), F.lit(0).alias("error"),
        F.lit("s").alias("same"), F.lit(0).alias("total"),
    )
    got = codes.with_label_errors(codes.codes(frame)[0])
    found = got.collect()
    expected = {}
    for dim in (3, 4, 32):
        some = [(i, v) for i, v, _ in rows if v is not None and len(v) == dim
                and all(x is not None and abs(x) < inf for x in v)]
        expected |= brute(some)
    empty = hashlib.sha256(b"").hexdigest()
    expected |= {(7, ()): ("00" * 16, 0, empty), (8, ()): ("00" * 16, 0, empty)}
    kept = [(i, v, n) for i, v, n in rows if v is not None and (i, tuple(v)) in expected]
    assert sorted((str(r.vec_id), r.code, r.error, r.codebooks_sha256) for r in found) == sorted(
        (str(i), *expected[i, tuple(v)]) for i, v, _ in kept
    )
    by_label = {}
    for i, v, n in kept:
        by_label[n] = by_label.get(n, 0) + expected[i, tuple(v)][1]
    assert {(r.label, r.label_error) for r in found} == set(by_label.items())
    assert codes.codes(frame.limit(0))[0].count() == 0
    far = spark.createDataFrame([(1, [1e300], 1)], "vec_id long, embedding array<double>, label int")
    with pytest.raises(Exception, match="lies beyond"):
        codes.codes(far)


def test_a_third_under_one_label_and_one_id(spark):
    rng = np.random.default_rng(5)
    vectors = rng.integers(-300, 300, (900, 16)) / 512
    rows = [(0 if i % 3 == 0 else None if i % 3 == 1 else i, v.tolist(), i % 3 or None)
            for i, v in enumerate(vectors)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    found, _ = codes.codes(frame.repartition(7))
    expected = brute([(r[0], r[1]) for r in rows])
    assert sorted((str(r.vec_id), r.code, r.error) for r in found.collect()) == sorted(
        (str(i), *expected[i, tuple(v)][:2]) for i, v, _ in rows
    )


def test_sql_leaves_out_what_the_query_drops():
    con = duckdb.connect()
    con.execute("create table embeddings (vec_id bigint, embedding float[], label int)")
    con.execute("insert into embeddings values (1, null, 1), (2, ['nan'::float], 1)")
    assert con.execute(codes.oracle()).fetchall() == []
