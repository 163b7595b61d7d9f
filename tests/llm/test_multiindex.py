import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from typeferry.llm import multiindex
from typeferry.llm.queries import op2_multiindex


def brute(ids, vectors, threshold=0.95):
    x = multiindex.unit(np.array(vectors, np.float32))
    near = x @ x.T >= threshold
    np.fill_diagonal(near, False)
    label = list(range(len(ids)))
    for i, j in zip(*np.nonzero(near)):
        if label[i] != label[j]:
            old, new = label[i], label[j]
            label = [new if v == old else v for v in label]
    least = {}
    for i, v in zip(ids, label):
        least[v] = min(least.get(v, i), i)
    return {i: (int(n), least[v]) for i, n, v in zip(ids, near.sum(1), label)}


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.1"])
def test_query_against_brute_force(spark, sf):
    rows = spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet").collect()
    expected = brute([r.vec_id for r in rows], [r.embedding for r in rows])
    got = op2_multiindex(spark, f"/root/testdata/{sf}")
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    found = {r.vec_id: (r.n_links, r.component_id) for r in got.collect()}
    assert found == expected
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.collect())


@pytest.mark.parametrize("words, block", [(4, 3), (16, 64)])
def test_recall_near_the_threshold(spark, words, block):
    """Random directions at cosines just above and below: the hard case for the index."""
    rng = np.random.default_rng(words)
    base = multiindex.unit(rng.standard_normal((150, 24)))
    made = [base]
    for cosine in (0.951, 0.96, 0.98, 0.949):
        away = rng.standard_normal(base.shape)
        away -= (away * base).sum(1, keepdims=True) * base
        made.append(cosine * base + math.sqrt(1 - cosine**2) * multiindex.unit(away))
    vectors = np.concatenate(made).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    expected = brute(range(len(rows)), vectors)
    found = {
        r.vec_id: (r.n_links, r.component_id)
        for r in multiindex.near_duplicates(frame, words=words, block=block).collect()
    }
    total = sum(n for n, _ in expected.values())
    assert all(found[i][0] <= n for i, (n, _) in expected.items())
    assert sum(n for n, _ in found.values()) >= 0.98 * total


def test_multi_sequence_order():
    rng = np.random.default_rng(0)
    a, b = rng.random(9), rng.random(7)
    found = multiindex.multi_sequence(a, b, 1.0)
    sums = [a[i] + b[j] for i, j in found]
    assert sums == sorted(sums)
    assert set(found) == {(i, j) for i in range(9) for j in range(7) if a[i] + b[j] <= 1.0}


def test_odd_rows(spark):
    near, far = [1.0, 2.0, 3.0, 4.0], [4.0, -1.0, 0.5, 0.0]
    rows = [
        (1, near), (2, near), (2, near), (None, near), (3, [2.0, 4.0, 6.0, 8.0]), (4, far),
        (5, None), (6, []), (7, [0.0] * 4), (8, [1.0, None, 1.0, 1.0]),
        (9, [float("nan"), 1.0, 1.0, 1.0]), (10, [float("inf"), 1.0, 1.0, 1.0]), (11, [1.0, 2.0]),
        (12, [1.0, 2.0, 3.0]), (13, [2.0, 4.0, 6.0]), (14, [3.0, -1.0, 0.0]),
    ]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").select(
        "*", F.lit(1).alias("node"), F.lit(2).alias("n_links"), F.lit(0).alias("label")
    )
    got = sorted(
        (str(r.vec_id), r.n_links, str(r.component_id))
        for r in multiindex.near_duplicates(frame).collect()
    )
    linked = [("1", 4, "1"), ("2", 4, "1"), ("2", 4, "1"), ("None", 4, "1"), ("3", 4, "1")]
    alone = [(str(i), 0, str(i)) for i in (4, 5, 6, 7, 8, 9, 10, 11, 14)]
    linked += [("12", 1, "12"), ("13", 1, "12")]
    assert got == sorted(linked + alone)
    assert multiindex.near_duplicates(frame.limit(0)).count() == 0


def test_doubles_are_compared_as_doubles(spark):
    """Beyond the range of floats, and apart by less than they can tell."""
    near = [1.0, 2.0, 3.0]
    rows = [(1, [1e300, 1e300]), (2, [1e300, 1e300]), (3, [1e-300, 1e-300]), (4, [5e-324, 0.0]),
            (5, near), (6, [1.0, 2.0, 3.0 + 1e-12]), (7, [-1e300, 1e300])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = {r.vec_id: (r.n_links, r.component_id) for r in multiindex.near_duplicates(frame).collect()}
    assert found == {1: (2, 1), 2: (2, 1), 3: (2, 1), 4: (0, 4), 5: (1, 5), 6: (1, 5), 7: (0, 7)}
    exact = multiindex.near_duplicates(frame, threshold=1 - 1e-14)
    assert exact.where("vec_id = 6").first().n_links == 1


@pytest.mark.parametrize("kind", ["array<int>", "array<decimal(5,2)>"])
def test_other_numbers(spark, kind):
    frame = spark.sql(f"select id as vec_id, cast(array(1, id, 2) as {kind}) as embedding from range(3)")
    assert multiindex.near_duplicates(frame).count() == 3
