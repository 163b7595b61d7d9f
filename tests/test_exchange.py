"""Partition exchange: cut off at each step, moved by renames, met by other writes."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from typeferry import clean_staged, merge_table, write_table
from typeferry.operators import exchange
from typeferry.operators import write as writing

SCHEMA = "k int, v string, p string"
TARGET = [(1, "o", "a"), (2, "o", "a"), (3, "o", "b"), (4, "o", "c"), (5, "o", None), (6, "o", "x y/%")]
# Moves a row, empties b, replaces in the odd partition, adds a partition; c is not touched.
SOURCE = [(3, "n", "a"), (6, "n", "x y/%"), (5, "n", "new"), (7, "n", "new")]
MERGED = [(1, "o", "a"), (2, "o", "a"), (3, "n", "a"), (4, "o", "c"), (5, "n", "new"), (7, "n", "new"),
          (6, "n", "x y/%")]


class Cut(Exception):
    """The driver is lost."""


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def found(spark, table):
    spark.catalog.refreshTable(table)
    return Counter(tuple(r) for r in spark.table(table).select("k", "v", "p").collect())


def by_partition(rows):
    out = {}
    for r in rows:
        out.setdefault(r[2], Counter())[r] += 1
    return out


STEPS = {
    "rows": ("_write_intent", 1),
    "before the commit": ("mark", 1),
    "before the first partition": ("point", 1),
    "between two partitions": ("point", 2),
    "before the last partition": ("point", 3),
    "before applied": ("mark", 2),
    "before the first folder goes": ("delete_replaced", 1),
    "between two folders": ("delete_replaced", 2),
    "before cleaned": ("mark", 3),
}


def cut_at(monkeypatch, step):
    name, call = STEPS[step]
    real, calls = getattr(exchange, name), []

    def cut(*args, **named):
        calls.append(1)
        if len(calls) == call:
            raise Cut
        return real(*args, **named)

    monkeypatch.setattr(exchange, name, cut)


def merged_but_cut(spark, t, monkeypatch, step):
    with monkeypatch.context() as m:
        cut_at(m, step)
        with pytest.raises(Cut):
            merge_table(frame(spark, SOURCE), t, ["k"])


@pytest.mark.parametrize("step", STEPS)
def test_cut_off_at_each_step(spark, fresh, monkeypatch, step):
    t = fresh()
    write_table(frame(spark, TARGET), t, partition_by=["p"])
    merged_but_cut(spark, t, monkeypatch, step)
    # Each partition is as it was or as it is to be.
    old, new = by_partition(TARGET), by_partition(MERGED)
    state = by_partition(found(spark, t).elements())
    for p in old.keys() | new.keys():
        assert state.get(p, Counter()) in (old.get(p, Counter()), new.get(p, Counter()))
    if step in ("rows", "before the commit"):
        assert found(spark, t) == Counter(TARGET)
    merge_table(frame(spark, SOURCE), t, ["k"])
    assert found(spark, t) == Counter(MERGED)
    spark.sql(f"MSCK REPAIR TABLE {t}")  # no file of an earlier state is left to be found
    assert found(spark, t) == Counter(MERGED)


@pytest.mark.parametrize("step", STEPS)
def test_next_write_finishes_the_exchange(spark, fresh, monkeypatch, step):
    """An append to partitions that are gone, exchanged, and new, after the cut."""
    t = fresh()
    write_table(frame(spark, TARGET), t, partition_by=["p"])
    merged_but_cut(spark, t, monkeypatch, step)
    added = [(10, "x", "b"), (11, "x", "a"), (12, "x", None)]
    write_table(frame(spark, added), t, "append")
    before = TARGET if step in ("rows", "before the commit") else MERGED
    assert found(spark, t) == Counter([*before, *added])
    assert clean_staged(spark, t) >= (before is TARGET)
    assert found(spark, t) == Counter([*before, *added])


@pytest.mark.parametrize("rename", [1, 2])
def test_exchanged_partitions_survive_a_swap_that_is_cut_off(spark, fresh, monkeypatch, rename):
    """The old table, its partitions in a run's folder, is renamed away, or also back."""
    t = fresh()
    write_table(frame(spark, TARGET), t, partition_by=["p"])
    merge_table(frame(spark, SOURCE), t, ["k"])
    real, calls = writing._rename, []

    def cut(spark, table, to):
        if writing.OLD in to or len(calls):
            calls.append(1)
            if len(calls) == 2:
                raise Cut  # the staged table is not put in place
        real(spark, table, to)

    with monkeypatch.context() as m:
        m.setattr(writing, "_rename", cut)
        with pytest.raises(Cut):
            write_table(frame(spark, [(0, "z", "a")]), t)
    assert not spark.catalog.tableExists(t)
    for name in writing._beside(spark, t, writing.STAGED).values():
        spark.sql(f"DROP TABLE {name}")  # so that only the old one can be put back
    if rename == 2:  # and its partitions are not found anew before the driver is lost again
        with monkeypatch.context() as m:
            m.setattr(writing, "_find_partitions", lambda spark, table: (_ for _ in ()).throw(Cut))
            with pytest.raises(Cut):
                write_table(frame(spark, []), t, "append")
    write_table(frame(spark, []), t, "append")
    assert found(spark, t) == Counter(MERGED)
    properties = spark.sql(f"SHOW TBLPROPERTIES {t}").collect()
    assert exchange.RELOCATING not in [r["key"] for r in properties]


def test_many_merges_and_clean_up(spark, fresh):
    """Runs pile up only as long as partitions live in them."""
    t = fresh()
    write_table(frame(spark, TARGET), t, partition_by=["p"])
    for i in range(3):
        merge_table(frame(spark, [(1, f"n{i}", "a"), (2, f"n{i}", "a")]), t, ["k"])
    merge_table(frame(spark, [(4, "n", "c")]), t, ["k"])
    location = exchange.location_of(spark, t)
    assert len(exchange.runs_of(spark, location)) == 4
    assert clean_staged(spark, t) == 2
    expected = [(1, "n2", "a"), (2, "n2", "a"), (3, "o", "b"), (4, "n", "c"), (5, "o", None), (6, "o", "x y/%")]
    assert found(spark, t) == Counter(expected)
    write_table(frame(spark, TARGET), t)
    assert found(spark, t) == Counter(TARGET)
    assert exchange.runs_of(spark, exchange.location_of(spark, t)) == []


def test_two_merges_at_a_time(spark, fresh):
    """Of two tables: neither waits for a setting of the other."""
    from concurrent.futures import ThreadPoolExecutor

    tables = [fresh() for _ in range(3)]
    for t in tables:
        write_table(frame(spark, TARGET), t, partition_by=["p"])
    with ThreadPoolExecutor(3) as pool:
        list(pool.map(lambda t: merge_table(frame(spark, SOURCE), t, ["k"]), tables))
    for t in tables:
        assert found(spark, t) == Counter(MERGED)


@pytest.mark.parametrize("fmt, options", [("csv", {"header": "true", "sep": ";"}), ("orc", {})])
def test_format_and_options_of_the_table(spark, fresh, fmt, options):
    t = fresh()
    df = frame(spark, TARGET).filter("p is not null")
    df.write.format(fmt).options(**options).partitionBy("p").saveAsTable(t)
    merge_table(frame(spark, SOURCE), t, ["k"])
    files = spark.table(t).select(F.col("_metadata.file_path").alias("f"), "p").distinct().collect()
    assert all((exchange.FOLDER in r.f) == (r.p != "c") for r in files)
    assert found(spark, t) == Counter(r for r in MERGED)


def test_external_table(spark, fresh, tmp_path):
    t = fresh()
    frame(spark, TARGET).write.partitionBy("p").option("path", str(tmp_path / "own dir")).saveAsTable(t)
    merge_table(frame(spark, SOURCE), t, ["k"])
    assert found(spark, t) == Counter(MERGED)
    spark.sql(f"MSCK REPAIR TABLE {t}")
    assert found(spark, t) == Counter(MERGED)
