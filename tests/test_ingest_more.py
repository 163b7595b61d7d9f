"""Ingests that infer types, happen once, let the target grow, and are compared by content."""

import pytest
from pyspark.sql import functions as F

from typeferry import FrameSource, IngestConfig, MappedColumn, differences, ingest, inferred_columns, read_table


def unknown(*names):
    return [MappedColumn(n, "mood", "mood", "string", True, "unknown") for n in names]


def source(spark, rows, schema="a string, b string, c string"):
    return FrameSource({"x": spark.createDataFrame(rows, schema)})


ROWS = [("1", "1.50", "2024-01-31"), ("-70000", "0.25", None), (None, "2.00", "1999-12-31")]


def test_types_without_a_rule_are_inferred(spark, fresh):
    t = fresh()
    config = IngestConfig(source(spark, ROWS), "x", target_table=t, infer_unknown=True)
    report = ingest(spark, config, unknown("a", "B", "c"))
    assert report.schema.simpleString() == "struct<a:int,B:decimal(3,2),c:date>"
    assert [r.status for r in report.audit.collect()] == ["inferred"] * 3
    assert tuple(report.counts) == (3, 3, True, 0) and not any(r.n_lost for r in report.lossy)
    assert [f.dataType.simpleString() for f in spark.table(t).schema] == ["int", "decimal(3,2)", "date"]
    assert differences(spark, config, report.columns).count() == 0
    plain = ingest(spark, IngestConfig(source(spark, ROWS), "x", target_table=fresh()), unknown("a", "b", "c"))
    assert plain.schema.simpleString() == "struct<a:string,b:string,c:string>"


def test_only_unknown_columns_are_looked_at(spark):
    df = spark.createDataFrame([("1", "2")], "a string, b string")
    known = MappedColumn("a", "text", "text", "string", True, "ok")
    found = inferred_columns(df, [known, *unknown("b")])
    assert found == [known, MappedColumn("b", "mood", "mood", "smallint", True, "inferred")]
    assert inferred_columns(df, [known]) == [known]


def test_a_batch_is_ingested_once(spark, fresh):
    t = fresh()
    config = IngestConfig(source(spark, ROWS), "x", target_table=t, write_mode="append", batch="one")
    columns = [c._replace(status="ok") for c in unknown("a", "b", "c")]
    assert tuple(ingest(spark, config, columns).counts) == (3, 3, True, 0)
    assert tuple(ingest(spark, config, columns).counts) == (None, 3, None, None)
    assert spark.table(t).count() == 3
    with pytest.raises(ValueError, match="write_mode='append'"):
        ingest(spark, IngestConfig(source(spark, ROWS), "x", target_table=t, batch="two"), columns)


def test_differences_by_row(spark, fresh):
    t = fresh()
    config = IngestConfig(source(spark, ROWS), "x", target_table=t, merge_keys=["a"], merge_buckets=4,
                          write_mode="merge")
    columns = unknown("a", "b", "c")
    ingest(spark, config, columns)
    other = [("1", "changed", None), ("-70000", "0.25", None), (None, "2.00", "1999-12-31"), ("9", "new", "")]
    changed = IngestConfig(source(spark, other), "x", target_table=t, merge_keys=["a"])
    found = differences(spark, changed, columns).collect()
    assert sorted((r.a, r.b, r.side, r.kind) for r in found) == [
        ("1", "1.50", "target", "changed"), ("1", "changed", "source", "changed"),
        ("9", "new", "source", "missing"),
    ]


def test_a_target_that_grows(spark, fresh):
    t = fresh()
    ingest(spark, IngestConfig(source(spark, [(1,)], "a int"), "x", target_table=t))
    more = IngestConfig(source(spark, [(2**40, "n")], "a long, b string"), "x", target_table=t,
                        write_mode="append", evolve=True)
    report = ingest(spark, more)
    assert tuple(report.counts) == (1, 2, True, 0)
    assert sorted(map(tuple, read_table(spark, t).collect())) == [(1, None), (2**40, "n")]
    assert spark.table(t).filter(F.col("a") > 1).count() == 1
