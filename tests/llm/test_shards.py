import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from typeferry.llm import shards
from typeferry.llm.common import fresh_folder
from typeferry.llm.files import file_system, remove_folder
from typeferry.llm.queries import op4_shards
from typeferry.llm.tokens import public_path

SF_DIR = "/root/testdata/sf0.001"
WORDS = public_path("word_bpe_49k.json")


@settings(max_examples=100, deadline=None)
@given(st.sets(st.integers(-(2**63), 2**63 - 1), max_size=400))
def test_perfect_hash(keys):
    keys = np.array(sorted(keys), np.int64)
    index = shards.PerfectHash.build(keys)
    assert sorted(index.slots(keys).tolist()) == list(range(len(keys)))


def test_lookups_of_absent_keys():
    keys = np.arange(0, 30_000, 3)
    raw = b"".join(shards.packed(keys, 0, list(range(len(keys) + 1)), [np.zeros(len(keys), "<u2")]))
    shard = shards.Shard(raw)
    assert shard.rows(keys).tolist() == list(range(len(keys)))
    assert (shard.rows(keys + 1) == -1).all()
    with pytest.raises(ValueError):
        shards.Shard(b"something else" * 9)


def library_ids(rows):
    tokenizer = Tokenizer.from_file(WORDS)
    return {
        r.doc_id: tokenizer.encode(r.text or "", add_special_tokens=False).ids + [2] for r in rows
    }


def test_query_against_the_library(spark):
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").orderBy("doc_id").collect()
    expected, start = set(), 0
    for doc_id, ids in library_ids(rows).items():
        raw = np.array(ids, "<u4").tobytes()
        expected.add((doc_id, start, len(ids), zlib.crc32(raw)))
        start += len(ids)
    got = op4_shards(spark, SF_DIR)
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert {tuple(r) for r in got.collect()} == expected


def test_lookup_over_many_shards(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(120)
    folder = fresh_folder(spark, "test")
    listed = shards.write_shards(docs, folder, WORDS, 2, shard_bytes=20_000).collect()
    assert len(listed) > 5
    monkeypatch.setattr(shards, "RANGES", 3)  # several blocks of key ranges
    expected = library_ids(docs.collect())
    wanted = spark.createDataFrame([(k,) for k in [*expected, -5, 10**9, None]], "doc_id long")
    found = {r.doc_id: r.ids for r in shards.lookup(wanted, folder).collect()}
    assert found == expected
    remove_folder(spark, folder)
    system, path = file_system(folder)
    assert system.get_file_info(path).type.name == "NotFound"
    with pytest.raises(ValueError):
        remove_folder(spark, "/tmp/elsewhere")


def test_odd_rows(spark):
    long = "many words " * 50_000
    rows = [(7, "b"), (None, "x"), (7, "a"), (3, None), (3, ""), (None, None), (9, long)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").select(
        "*", F.lit(1).alias("start"), F.lit("t").alias("tie")
    )
    folder = fresh_folder(spark, "test")
    shards.write_shards(docs, folder, WORDS, 2)
    got = sorted(shards.read_shards(spark, folder).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == [None, None, 3, 3, 7, 7, 9]
    assert [r.n_tokens for r in got][2:6] == [1, 1, 2, 2]
    assert got[-1].start == sum(r.n_tokens for r in got[:-1])
    keys = spark.createDataFrame([(3,), (7,), (7,), (8,)], "doc_id long")
    found = [r.doc_id for r in shards.lookup(keys, folder).collect()]
    assert sorted(found) == [3, 3, 7, 7]
    empty = fresh_folder(spark, "test")
    shards.write_shards(docs.limit(0), empty, WORDS, 2)
    assert shards.read_shards(spark, empty).count() == 0
