"""Appends that happen once: cut off at each step, run again, run by two."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from typeferry import Buckets, append_once, clean_staged, merge_table, read_table, write_table
from typeferry.operators import exchange, once
from typeferry.operators import write as writing

SCHEMA = "k int, v string, p string"
FIRST = [(1, "a", "x"), (2, "a", "y"), (3, "a", None)]
SECOND = [(4, "b", "x"), (5, "b", "new/%"), (6, "b", None), (4, "b", "x")]


class Cut(Exception):
    """The driver is lost."""


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def found(spark, t):
    spark.catalog.refreshTable(t)
    return Counter(tuple(r) for r in read_table(spark, t).select("k", "v", "p").collect())


LAYOUTS = {"flat": {}, "partitioned": {"partition_by": ["p"]}, "buckets": {"buckets": Buckets(["k"], 3)}}


@pytest.mark.parametrize("layout", LAYOUTS)
def test_a_batch_is_added_once(spark, fresh, layout):
    t = fresh()
    write_table(frame(spark, FIRST), t, **LAYOUTS[layout])
    assert append_once(frame(spark, SECOND), t, "day/1 %")
    assert not append_once(frame(spark, SECOND), t, "day/1 %")
    assert not append_once(frame(spark, FIRST), t, "day/1 %")
    assert found(spark, t) == Counter(FIRST + SECOND)
    assert append_once(frame(spark, SECOND), t, "day/2")
    assert found(spark, t) == Counter(FIRST + SECOND + SECOND)
    assert not [r for r in exchange.children(spark, f"{exchange.location_of(spark, t)}/{once.FOLDER}/runs")]


# What is cut off, at which call of it, and whether the batch is committed by then.
STEPS = {
    "rows written": ("commit_batch", 1, False),
    "committed": ("finish_batches", 1, True),
    "before the first file": ("move", 1, True),
    "between two files": ("move", 2, True),
    "before the folder goes": ("delete_path", 1, True),
}


@pytest.mark.parametrize(
    "layout, then",
    [("flat", "rerun"), ("flat", "merge"), ("flat", "clean"), ("partitioned", "rerun"),
     ("partitioned", "append"), ("partitioned", "merge")],
)
@pytest.mark.parametrize("step", STEPS)
def test_cut_off_at_each_step(spark, fresh, monkeypatch, layout, step, then):
    t = fresh()
    write_table(frame(spark, FIRST), t, **LAYOUTS[layout])
    name, call, committed = STEPS[step]
    real, calls = getattr(once, name), []

    def cut(*args, **named):
        calls.append(1)
        if len(calls) == call:
            raise Cut
        return real(*args, **named)

    with monkeypatch.context() as m:
        m.setattr(once, name, cut)
        with pytest.raises(Cut):
            append_once(frame(spark, SECOND), t, "b")
    expected = Counter(FIRST)
    if then == "append":
        write_table(frame(spark, [(9, "c", "x")]), t, "append")
        expected += Counter([(9, "c", "x")])
    elif then == "merge":  # of a flat table: it is rewritten, and the batch is still known
        merge_table(frame(spark, [(1, "c", "x")]), t, ["k"])
        expected = expected - Counter([(1, "a", "x")]) + Counter([(1, "c", "x")])
    elif then == "clean":
        clean_staged(spark, t)
    if then != "rerun":
        assert found(spark, t) == (expected + Counter(SECOND) if committed else expected)
    assert append_once(frame(spark, SECOND), t, "b") == (not committed)
    assert found(spark, t) == expected + Counter(SECOND)


def test_second_writer_of_a_batch(spark, fresh, monkeypatch):
    """Both have written their rows before either commits; the loser's are deleted."""
    t = fresh()
    write_table(frame(spark, FIRST), t, partition_by=["p"])
    real, inner = once.commit_batch, []

    def commit(*args):
        if not inner:
            inner.append(1)
            inner.append(append_once(frame(spark, SECOND), t, "b"))
        return real(*args)

    monkeypatch.setattr(once, "commit_batch", commit)
    assert not append_once(frame(spark, FIRST), t, "b")
    assert inner == [1, True]
    assert found(spark, t) == Counter(FIRST + SECOND)
    assert not exchange.children(spark, f"{exchange.location_of(spark, t)}/{once.FOLDER}/runs")


def test_batches_follow_exchanged_partitions(spark, fresh):
    """A partition that a merge has moved to another folder takes its files there."""
    t = fresh()
    write_table(frame(spark, FIRST), t, partition_by=["p"])
    merge_table(frame(spark, [(1, "n", "x")]), t, ["k"])
    append_once(frame(spark, SECOND), t, "b")
    assert found(spark, t) == Counter([(1, "n", "x"), *FIRST[1:], *SECOND])
    paths = spark.table(t).filter("p = 'x'").select(F.input_file_name().alias("f")).distinct().collect()
    assert len(paths) > 1 and all(exchange.FOLDER in r.f for r in paths)
    merge_table(frame(spark, [(5, "n", "x")]), t, ["k"])
    assert not append_once(frame(spark, SECOND), t, "b")
    assert found(spark, t)[(5, "n", "x")] == 1


def test_missing_target_overwrite_and_refusals(spark, fresh, tmp_path):
    t = fresh()
    assert append_once(frame(spark, SECOND), t, "b", partition_by=["p"])
    assert writing.partition_columns(spark, t) == ["p"] and found(spark, t) == Counter(SECOND)
    write_table(frame(spark, FIRST), t)
    assert append_once(frame(spark, SECOND), t, "b")  # an overwrite has forgotten it
    assert found(spark, t) == Counter(FIRST + SECOND)
    with pytest.raises(ValueError, match="differ in columns"):
        append_once(frame(spark, SECOND).drop("v"), t, "c")
    assert append_once(frame(spark, []), t, "empty") and not append_once(frame(spark, FIRST), t, "empty")
    u = fresh()
    frame(spark, FIRST).write.option("path", str(tmp_path / "own")).saveAsTable(u)
    append_once(frame(spark, SECOND), u, "b")
    merge_table(frame(spark, [(1, "n", "x")]), u, ["k"])
    assert not append_once(frame(spark, SECOND), u, "b")
    assert found(spark, u) == Counter([(1, "n", "x"), *FIRST[1:], *SECOND])
