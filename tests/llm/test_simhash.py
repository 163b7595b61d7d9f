import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from typeferry.llm import simhash
from typeferry.llm.common import components
from typeferry.llm.queries import op1_simhash

SF_DIR = "/root/testdata/sf0.001"


def plain_fingerprint(text, length=3):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for space in "\t\n\x0b\x0c\r":
        lowered = lowered.replace(space, " ")
    words = [w for w in lowered.split(" ") if w]
    parts = [words[i : i + length] for i in range(len(words) - length + 1)] or [words]
    hashes = [xxhash.xxh64(" ".join(p).encode(), seed=42).intdigest() for p in parts if p]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(rows, radius=3):
    """rows: (doc_id, fingerprint). The smallest id of each row's component."""
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (rows[i][1] ^ rows[j][1]).bit_count() <= radius and group[i] != group[j]:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    ids = {}
    for (doc_id, _), g in zip(rows, group):
        if doc_id is not None:
            ids[g] = min(ids.get(g, doc_id), doc_id)
    return [ids.get(g) for g in group]


def test_query_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    rows = [(r.doc_id, plain_fingerprint(r.text)) for r in docs]
    expected = {
        (doc_id, f"{fp:016x}", c) for (doc_id, fp), c in zip(rows, plain_components(rows))
    }
    got = op1_simhash(spark, SF_DIR)
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    assert {tuple(r) for r in got.collect()} == expected


@pytest.mark.parametrize(
    "text", [None, "", " \t\n", "one", "One tWo", "ÀÉ a b c d É é", "w " * 300_000]
)
def test_fingerprint_of_odd_texts(text):
    assert int(simhash.fingerprint_many([text], 3)[0]) == plain_fingerprint(text)


def test_links_span_all_pairs(spark):
    rng = np.random.default_rng(3)
    seeds = rng.integers(0, 2**63, 40, dtype=np.uint64)
    fps = {int(s) for s in seeds}
    for s in seeds:  # chains whose ends are further apart than the radius
        x = int(s)
        for _ in range(rng.integers(0, 9)):
            for b in rng.integers(0, 64, rng.integers(1, 5)):
                x ^= 1 << int(b)
            fps.add(x)
    fps = sorted(fps)
    expected = plain_components([(f, f) for f in fps])
    signed = [f - 2**64 if f >= 2**63 else f for f in fps]
    frame = spark.createDataFrame([(s,) for s in signed], "fp long")
    for segments, tile_rows in ((1, 512), (2, 16), (4, 1), (8, 4)):
        found = simhash.links(frame, 3, segments, tile_rows)
        root = {r.node: r.root for r in components(found).collect()}
        groups = {}
        for s, e in zip(signed, expected):
            groups.setdefault(root.get(s, s), set()).add(e)
        assert all(len(g) == 1 for g in groups.values())
        assert len(groups) == len(set(expected))


def test_odd_rows(spark):
    rows = [(5, None), (3, ""), (None, "  "), (7, "a b c d"), (7, "a b c d"), (None, "x y z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").select(
        "*", F.lit(1).alias("fp"), F.lit(2).alias("component_id"), F.lit(0).alias("root")
    )
    got = simhash.near_duplicates(docs).collect()
    assert sorted((str(r.doc_id), str(r.component_id)) for r in got) == [
        ("3", "3"), ("5", "3"), ("7", "7"), ("7", "7"), ("None", "3"), ("None", "None"),
    ]
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted((str(r.doc_id), r.text) for r in kept.collect()) == [
        ("3", ""), ("7", "a b c d"), ("None", "x y z")
    ]
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


@pytest.mark.parametrize("seed", range(5))
def test_a_tile_against_itself_in_another_order(seed):
    """On a cluster the two lists of a tile come in the order their blocks were fetched in."""
    rng = np.random.default_rng(seed)
    fps = rng.integers(0, 2**63, 60, dtype=np.uint64)
    fps[30:] = fps[:30] ^ (np.uint64(1) << rng.integers(0, 64, 30, dtype=np.uint64))
    other = rng.permutation(fps)

    def lists(values):
        return pa.array([values.view(np.int64).tolist()], pa.list_(pa.int64()))

    batch = pa.RecordBatch.from_arrays(
        [lists(fps), lists(other), pa.array([True])], names=["x", "y", "same"]
    )
    found = next(simhash.compare(iter([batch]), 3))
    ends = [found.column(i).to_numpy().view(np.uint64) for i in (0, 1)]
    assert len(ends[0]) == 30 and (np.bitwise_count(ends[0] ^ ends[1]) == 1).all()


def test_rows_of_files_are_told_apart_without_a_copy(spark, tmp_path):
    rows = [(i % 4 or None, f"w{i // 3} x{i // 3} y{i // 3} z") for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").select(
        "*", F.lit(1).alias("row_part"), F.lit(2).alias("ROW_number"), F.lit(3).alias("first")
    )
    stored = simhash.one_of_each(docs.coalesce(1))
    path = str(tmp_path / "docs")
    docs.coalesce(1).write.parquet(path)
    read = spark.read.parquet(path)
    keyed, keys = simhash.keyed_rows(read)
    assert keys == ["row_part_", "row_file", "row_number_"]
    assert keyed.select(*keys).distinct().count() == 30
    found = simhash.one_of_each(read)
    assert found.columns == docs.columns and found.count() < 30
    assert sorted(map(str, found.collect())) == sorted(map(str, stored.collect()))
    filtered = simhash.keyed_rows(read.filter("doc_id is not null"))
    assert len(filtered[1]) == 1  # no plain reading: stored


def test_components(spark):
    path = [(i, i + 1) for i in range(1, 40)]
    star = [(100, i) for i in range(101, 400)]
    edges = spark.createDataFrame([*path, *star, (7, 7), (2, 1)], "a long, b long")
    root = {r.node: r.root for r in components(edges).collect()}
    assert root == {i: 1 for i in range(1, 41)} | {i: 100 for i in range(100, 400)}
    assert components(edges.limit(0)).count() == 0
