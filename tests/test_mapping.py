"""Golden rules, edge inputs and properties of the type mapping."""

import warnings

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from typeferry import (
    TYPE_RULES,
    build_schema,
    build_spark_schema,
    map_pgsql_type_to_spark,
    map_types,
    mapped_columns,
    mapping_audit,
)
from typeferry.operators.mapping import DESCRIPTOR, map_one

# The expected types, grouped by result, stated apart from the rule table.
GOLDEN = {
    "smallint": ["smallint", "int2", "smallserial"],
    "int": ["integer", "int", "int4", "serial"],
    "bigint": ["bigint", "int8", "bigserial", "oid"],
    "float": ["real", "float4"],
    "double": ["double precision", "float8", "float", "money"],
    "decimal(38,18)": ["numeric", "decimal"],
    "string": [
        "character varying", "varchar", "character", "char", "bpchar", "text", "name", "citext",
        "time", "time without time zone", "time with time zone", "timetz", "interval",
        "inet", "cidr", "macaddr", "macaddr8", "json", "jsonb", "uuid", "xml",
        "bit", "bit varying", "varbit",
        "point", "line", "lseg", "box", "path", "polygon", "circle",
        "int4range", "int8range", "numrange", "tsrange", "tstzrange", "daterange",
        "tsvector", "tsquery", "pg_lsn", "txid_snapshot",
    ],
    "binary": ["bytea"],
    "boolean": ["boolean", "bool"],
    "date": ["date"],
    "timestamp": [
        "timestamp", "timestamp without time zone", "timestamp with time zone", "timestamptz",
    ],
}
EXPECTED = {name: spark_type for spark_type, names in GOLDEN.items() for name in names}


def descriptors(spark, rows):
    """Rows of (data_type, udt_name, precision, scale, is_nullable, dimensions)."""
    full = [
        ("public", "t", f"c{i}", r[0], r[1], r[2], r[3], r[4], r[5], i)
        for i, r in enumerate((tuple(row) + (None,) * 6)[:6] for row in rows)
    ]
    return spark.createDataFrame(full, DESCRIPTOR)


def mapped(spark, rows):
    return mapped_columns(map_types(descriptors(spark, rows)), "t")


def test_rule_table_is_whole():
    assert len(TYPE_RULES) == len(dict(TYPE_RULES)) == 68
    assert set(dict(TYPE_RULES)) == set(EXPECTED)


@pytest.mark.parametrize("form", ["{}", "{}[]", "{}[][]", "  {}\t", "{} []"])
def test_golden_rules(spark, form):
    found = mapped(spark, [(form.format(name),) for name in EXPECTED])
    depth = form.count("[]")
    for column, expected in zip(found, EXPECTED.values()):
        assert column.spark_type == "array<" * depth + expected + ">" * depth, column
        assert column.status == "ok"


def test_upper_case(spark):
    found = mapped(spark, [(f" {name.upper()} ",) for name in EXPECTED])
    assert [c.spark_type for c in found] == list(EXPECTED.values())


def test_edge_inputs(spark):
    cases = [
        ((" INTEGER ",), "int", "ok"),
        (("integer[][]",), "array<array<int>>", "ok"),
        (("integer []",), "array<int>", "ok"),
        (("integer[] []",), "array<array<int>>", "ok"),
        (("integer[]", None, None, None, None, 1), "array<array<int>>", "ok"),
        (("integer", None, 32, 0), "int", "ok"),
        (("double precision", None, 53, None), "double", "ok"),
        (("numeric[]", None, 10, 2), "array<decimal(10,2)>", "ok"),
        (("ARRAY",), "array<string>", "ok"),
        (("array[]",), "array<string>", "ok"),
        (("ARRAY", None, None, None, None, 3), "array<array<array<string>>>", "ok"),
        (("ARRAY", "_int4"), "array<int>", "ok"),
        (("ARRAY", "_int4", None, None, None, 2), "array<array<int>>", "ok"),
        (("ARRAY", "_numeric"), "array<decimal(38,18)>", "ok"),
        (("ARRAY", "_mood"), "array<string>", "unknown"),
        (("integer", "_text"), "int", "ok"),
        (("  integer  ",), "int", "ok"),
        (("\x1cinteger\x1f",), "int", "ok"),
        (("integer[ ]",), "string", "unknown"),
        (("integer[ ][]",), "array<string>", "unknown"),
        (("integer[[]]",), "string", "unknown"),
        (("integer][]",), "array<string>", "unknown"),
        (("integer\t[]\u2003[]",), "array<array<int>>", "ok"),
        (("\u3000integer [] \x85",), "array<int>", "ok"),
        (("   []",), "array<string>", "unknown"),
        (("\u00e9t\u00e9",), "string", "unknown"),
        (("[]",), "array<string>", "unknown"),
        (("USER-DEFINED",), "string", "unknown"),
        (('"char"',), "string", "unknown"),
        (("hstore",), "string", "unknown"),
        (("serial4",), "string", "unknown"),
        (("xid",), "string", "unknown"),
        (("varchar(20)",), "string", "unknown"),
        (("numeric(10,2)",), "string", "unknown"),
        (("timestamp(3) without time zone",), "string", "unknown"),
        (("",), "string", "unknown"),
        ((None,), None, "missing"),
    ]
    for column, (_, spark_type, status) in zip(mapped(spark, [c[0] for c in cases]), cases):
        assert (column.spark_type, column.status) == (spark_type, status), column


def test_decimals(spark):
    cases = {
        (10, 2): "decimal(10,2)",
        (38, 18): "decimal(38,18)",
        (None, None): "decimal(38,18)",
        (None, 4): "decimal(38,4)",
        (18, None): "decimal(18,18)",
        (10, None): None,
        (1000, 2): None,
        (5, -2): None,
        (0, 0): None,
    }
    found = mapped(spark, [("numeric", None, p, s) for p, s in cases])
    for column, expected in zip(found, cases.values()):
        assert column.spark_type == (expected or "string")
        assert column.status == ("ok" if expected else "invalid_decimal")


def test_nullability(spark):
    found = mapped(spark, [("int", None, None, None, v) for v in ("YES", "NO", "no", "NO ", None)])
    assert [c.nullable for c in found] == [True, False, False, True, True]


def test_only_the_type_is_needed(spark):
    frame = spark.createDataFrame([("int4[]",)], "data_type string")
    row = map_types(frame).first()
    assert (row.spark_type, row.nullable, row.status) == ("array<int>", True, "ok")


def test_upper_case_catalog(spark):
    frame = descriptors(spark, [("numeric", None, 12, 3, "NO"), ("integer", None, None, None, "NO", 1)])
    shouting = frame.toDF(*[name.upper() for name in frame.columns])
    columns = mapped_columns(map_types(shouting), "t", "public")
    assert [(c.spark_type, c.nullable) for c in columns] == [
        ("decimal(12,3)", False), ("array<int>", False),
    ]


def test_schema_of_dictionaries(spark):
    schema = build_spark_schema(
        [
            {"column_name": "id", "data_type": "integer", "is_nullable": "NO"},
            {
                "column_name": "price",
                "data_type": "numeric",
                "numeric_precision": 10,
                "numeric_scale": 2,
            },
        ]
    )
    assert schema == T.StructType(
        [
            T.StructField("id", T.IntegerType(), False),
            T.StructField("price", T.DecimalType(10, 2), True),
        ]
    )
    with pytest.raises(KeyError):
        build_spark_schema([{"column_name": "id"}])
    assert build_spark_schema([], spark) == T.StructType([])


def test_single_type(monkeypatch):
    """Without a session, and without starting one."""
    from pyspark.sql import SparkSession

    def refuse(*_):
        raise AssertionError("a session is asked for")

    monkeypatch.setattr(SparkSession.Builder, "getOrCreate", refuse)
    monkeypatch.setattr(SparkSession, "getActiveSession", refuse)
    assert map_pgsql_type_to_spark("int8", array_dimensions=1) == T.ArrayType(T.LongType())
    assert map_pgsql_type_to_spark("numeric", 12, 3) == T.DecimalType(12, 3)
    with pytest.warns(UserWarning, match="hstore"):
        assert map_pgsql_type_to_spark("hstore") == T.StringType()


def test_schema_build(spark):
    frame = map_types(descriptors(spark, [("int", None, None, None, "NO"), ("money",)]))
    with warnings.catch_warnings():
        warnings.simplefilter("error")
        schema = build_schema(frame, "t", "public")
    assert schema.simpleString() == "struct<c0:int,c1:double>"
    assert [f.nullable for f in schema] == [False, True]
    with pytest.raises(ValueError, match="public.absent"):
        build_schema(frame, "absent", "public")
    with pytest.raises(ValueError, match="c0"):
        build_schema(map_types(descriptors(spark, [(None,)])), "t")
    assert mapping_audit(frame).columns == [
        "table_name", "column_name", "data_type", "spark_type", "status",
    ]


def test_no_shuffle(spark, capsys):
    map_types(descriptors(spark, [("int",)])).explain()
    plan = capsys.readouterr().out
    assert "BroadcastHashJoin" in plan
    assert not any(word in plan for word in ("hashpartitioning", "SortMergeJoin", "Python"))


def test_one_type_as_many(spark):
    """The lookup without a session says what the frame's expressions say."""
    forms = ["{}", "{}[]", " {}\t[] []", "\u3000{}\x1c", "{}[ ]", "{}[[]]"]
    names = [*EXPECTED, "hstore", "ARRAY", "array", "", "\u00e9T\u00e9", "numeric(10,2)"]
    cases = [
        (form.format(name), udt, p, s, "YES", d)
        for form in forms
        for name in names
        for udt, p, s, d in ((None, None, None, None), ("_INT4", 10, 2, 0), ("_mood", 5, -2, 2),
                             ("text", None, 4, 1), ("_numeric", 1000, 2, 3))
    ]
    cases.append((None, None, None, None, None, None))
    found = map_types(descriptors(spark, cases)).orderBy("ordinal_position").collect()
    for case, row in zip(cases, found):
        one = map_one(case[0], case[1], case[2], case[3], case[5])
        assert one == (row["base_type"], row["spark_type"], row["status"]), case


blanks = st.text(alphabet=" \t\n\x1d\x85\u00a0\u2028", max_size=3)
type_names = st.sampled_from([*EXPECTED, "hstore", "USER-DEFINED", "array"])


@settings(
    max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(
    st.lists(
        st.tuples(type_names, blanks, blanks, blanks, st.booleans(), st.integers(0, 3)),
        min_size=1,
        max_size=60,
    )
)
def test_properties(spark, cases):
    spelled = [
        (before + (name.upper() if upper else name) + (between + "[]") * depth + after,)
        for name, before, between, after, upper, depth in cases
    ]
    plain = [(name, None, None, None, None, depth) for name, _, _, _, _, depth in cases]
    a, b = mapped(spark, spelled), mapped(spark, plain)
    assert len(a) == len(cases)
    assert [(c.spark_type, c.status) for c in a] == [(c.spark_type, c.status) for c in b]
    for column in a:
        assert column.type().simpleString() == column.spark_type
