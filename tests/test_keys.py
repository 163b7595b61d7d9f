"""Minimal keys against counting every set of columns."""

from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from typeferry.operators.keys import find_keys, is_unique, keys_of_tables


def brute(rows, names, width):
    full = [i for i in range(len(names)) if all(r[i] is not None for r in rows)]
    keys = []
    for size in range(1, width + 1):
        for s in combinations(full, size):
            if not any(set(k) <= set(s) for k in keys) and len({tuple(r[i] for i in s) for r in rows}) == len(rows):
                keys.append(s)
    return [tuple(names[i] for i in k) for k in keys]


@pytest.mark.parametrize("seed", range(4))
def test_random_tables(spark, seed):
    rng = np.random.default_rng(seed)
    n, sizes = 400, (2, 20, 25, 400, 30, 5)
    rows = {tuple(int(rng.integers(0, s)) for s in sizes) for _ in range(n)}
    rows = [(*r, None if seed == 1 and i == 3 else i, i if seed != 2 else i // 2) for i, r in enumerate(rows)]
    names = ["a", "b", "c d", "d", "e", "f", "g", "h`i"]
    df = spark.createDataFrame(rows, ", ".join(f"`{c.replace('`', '``')}` int" for c in names))
    assert find_keys(df, 3) == brute(rows, names, 3)


def test_one_pair_among_many_rows(spark):
    """No column is unique, one pair is, and another misses it by a single row."""
    df = spark.range(50_000).select(
        (F.col("id") % 500).alias("a"),
        F.floor(F.col("id") / 500).alias("b"),
        F.when(F.col("id") == 7, 8).otherwise(F.floor(F.col("id") / 500)).alias("c"),
        F.lit(1).alias("d"),
    )
    assert find_keys(df, 2) == [("a", "b")]
    assert not is_unique(df, ["a", "c"])


def test_odd_tables(spark):
    empty = spark.createDataFrame([], "a int, b string")
    assert find_keys(empty) == []
    one = spark.createDataFrame([(1, None, [1.0, 2.0], {"x": 1})], "a int, b string, v array<double>, m map<string,int>")
    assert find_keys(one) == [("a",), ("v",)]
    twice = spark.createDataFrame([(1, 2), (1, 2)], "a int, b int")
    assert find_keys(twice) == []
    found = keys_of_tables({"x": one, "y": empty}).collect()
    assert [(r.table_name, r.columns) for r in found] == [("x", ["a"]), ("x", ["v"])]
    assert keys_of_tables({"y": empty}).count() == 0


def test_sets_are_ruled_out_without_a_look(spark, monkeypatch):
    """Pairs of narrow columns are never sketched."""
    from typeferry.operators import keys

    seen = []
    real = keys._estimates
    monkeypatch.setattr(keys, "_estimates", lambda df, sets: seen.extend(sets) or real(df, sets))
    df = spark.range(10_000).select(
        (F.col("id") % 10).alias("a"), (F.col("id") % 9).alias("b"), (F.col("id") % 5000).alias("c")
    )
    find_keys(df, 2)
    assert ("a", "b") not in seen and ("a", "c") in seen
