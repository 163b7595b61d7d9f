"""Schemas that grow on append and merge."""

import datetime
import decimal

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from typeferry import Buckets, merge_table, read_table, write_table
from typeferry.operators.evolve import joined_schema, wider
from typeferry.operators.write import layout_of


def kind(text):
    return T._parse_datatype_string(text)


WIDER = [
    ("smallint", "bigint", "bigint"), ("int", "decimal(5,2)", "decimal(12,2)"),
    ("bigint", "decimal(38,20)", None), ("decimal(5,2)", "decimal(4,3)", "decimal(6,3)"),
    ("float", "smallint", "float"), ("float", "int", "double"), ("double", "int", "double"),
    ("double", "bigint", None), ("float", "double", "double"), ("double", "decimal(5,2)", None),
    ("date", "timestamp", "timestamp"), ("date", "timestamp_ntz", "timestamp_ntz"),
    ("timestamp", "timestamp_ntz", None), ("string", "int", None), ("boolean", "int", None),
    ("void", "int", "int"), ("array<int>", "array<bigint>", "array<bigint>"),
    ("array<int>", "int", None), ("map<string,int>", "map<string,bigint>", "map<string,bigint>"),
    ("struct<a:int,b:string>", "struct<b:string,c:date,a:bigint>", "struct<a:bigint,b:string,c:date>"),
    ("struct<a:int>", "struct<a:string>", None),
]


@pytest.mark.parametrize("a, b, expected", WIDER)
def test_join_of_types(spark, a, b, expected):
    found = [wider(kind(x), kind(y)) for x, y in ((a, b), (b, a))]
    if "struct" not in a:  # the order of fields is that of the first
        assert [f and f.simpleString() for f in found] == [expected, expected]
    else:
        assert (found[0] and found[0].simpleString()) == expected


SCALARS = st.sampled_from(
    [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType(), T.FloatType(), T.DoubleType(),
     T.DecimalType(5, 2), T.DecimalType(20, 0), T.DateType(), T.TimestampType(), T.StringType(),
     T.BooleanType(), T.NullType()]
)


@given(SCALARS, SCALARS, SCALARS)
def test_the_join_is_a_lattice_where_it_is(a, b, c):
    assert wider(a, a) == a
    assert wider(a, b) == wider(b, a)
    left, right = wider(a, b), wider(b, c)
    if left is not None and right is not None:
        one, two = wider(left, c), wider(a, right)
        if one is not None and two is not None:
            assert one == two


def test_names_by_the_rule_of_the_session():
    def same(a, b):
        return a.lower() == b.lower()

    one, two = kind("A int, b string"), kind("B string, a bigint, c date")
    assert joined_schema(one, two, same).simpleString() == "struct<A:bigint,b:string,c:date>"
    with pytest.raises(ValueError, match="no type holds"):
        joined_schema(one, kind("a string"), same)
    with pytest.raises(ValueError, match="two columns"):
        joined_schema(one, kind("a int, A int"), same)


def rows(spark, t):
    return sorted((tuple(r) for r in read_table(spark, t).collect()), key=str)


def files(spark, t):
    return {r[0] for r in spark.table(t).select(F.input_file_name()).distinct().collect()}


@pytest.mark.parametrize("partition_by, buckets", [(None, None), (["p"], None), (None, Buckets(["k"], 4))])
def test_new_columns_leave_the_files(spark, fresh, partition_by, buckets):
    t = fresh()
    df = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "k int, v string, p string")
    write_table(df, t, partition_by=partition_by, buckets=buckets)
    before = files(spark, t)
    more = spark.createDataFrame([("x", 3, datetime.date(2024, 1, 1))], "p string, k int, d date")
    write_table(more, t, "append", evolve=True)
    assert before < files(spark, t)
    found = {r.k: (r.v, r.p, r.d) for r in read_table(spark, t).collect()}
    assert found == {1: ("a", "x", None), 2: ("b", "y", None), 3: (None, "x", datetime.date(2024, 1, 1))}
    merge_table(spark.createDataFrame([(2, "y", 2.5)], "k int, p string, w double"), t, ["k"], evolve=True)
    found = {r.k: (r.v, r.p, r.d, r.w) for r in read_table(spark, t).collect()}
    assert found[2] == (None, "y", None, 2.5) and found[1] == ("a", "x", None, None) and len(found) == 3


@pytest.mark.parametrize("partition_by, buckets", [(None, None), (["p"], None), (None, Buckets(["k"], 4))])
def test_wider_types(spark, fresh, partition_by, buckets):
    """Keys too: their buckets are those of the wider type."""
    t = fresh()
    df = spark.createDataFrame([(1, 1, "x"), (2, 2, "y")], "k int, v int, p string")
    write_table(df, t, partition_by=partition_by, buckets=buckets)
    spark.sql(f"ALTER TABLE {t} SET TBLPROPERTIES ('a' = 'b')")
    more = spark.createDataFrame([(2**40, decimal.Decimal("0.5"), "x"), (2, decimal.Decimal("9.5"), "y")],
                                 "k long, v decimal(3,1), p string")
    merge_table(more, t, ["k"], evolve=True)
    found = {r.k: (float(r.v), r.p) for r in read_table(spark, t).collect()}
    assert found == {1: (1.0, "x"), 2: (9.5, "y"), 2**40: (0.5, "x")}
    kinds = {f.name: f.dataType.simpleString() for f in read_table(spark, t).schema.fields}
    assert kinds == {"k": "bigint", "v": "decimal(11,1)", "p": "string"}
    layout = layout_of(spark, t)
    assert layout.properties["a"] == "b" and layout.buckets == (buckets and Buckets(("k",), 4))
    merge_table(spark.createDataFrame([(1, "x")], "k int, p string"), t, ["k"], evolve=True)
    assert {r.k: r.v for r in read_table(spark, t).collect()}[1] is None


def test_nested(spark, fresh):
    t = fresh()
    write_table(spark.sql("select 1 as k, array(1, null) as a, named_struct('x', 1) as s"), t)
    write_table(spark.sql("select 2 as k, array(3000000000) as a, named_struct('y', 'b') as s"), t,
                "append", evolve=True)
    write_table(spark.sql("select 3 as k, named_struct('x', 5L) as s"), t, "append", evolve=True)
    found = {r.k: (r.a, r.s and tuple(r.s)) for r in spark.table(t).collect()}
    assert found == {1: ([1, None], (1, None)), 2: ([3000000000], (None, "b")), 3: (None, (5, None))}


def test_without_leave_nothing_evolves(spark, fresh):
    t = fresh()
    write_table(spark.sql("select 1 as k"), t)
    with pytest.raises(Exception):
        write_table(spark.sql("select 2 as k, 3 as v"), t, "append")
    with pytest.raises(ValueError, match="differ in columns"):
        merge_table(spark.sql("select 2 as k, 3 as v"), t, ["k"])
    with pytest.raises(ValueError, match="no type holds"):
        write_table(spark.sql("select 'x' as k"), t, "append", evolve=True)
    write_table(spark.sql("select 2 as k, 3 as v"), t, "overwrite", evolve=True)
    assert rows(spark, t) == [(2, 3)]
