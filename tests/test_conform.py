"""Casts to the mapped types: strict, lenient, and what they lose."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from typeferry import FrameSource, MappedColumn, column_checks, conform
from typeferry import discover_columns, map_types, mapped_columns


def column(spark_type, data_type="x", base_type=None, name="v", nullable=True):
    return MappedColumn(name, data_type, base_type or data_type, spark_type, nullable, "ok")


def frame(spark, source_type, *values):
    return spark.createDataFrame([(v,) for v in values], f"v {source_type}")


@pytest.fixture(params=["true", "false"], ids=["ansi", "not ansi"])
def ansi(spark, request):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", request.param)
    yield request.param
    spark.conf.set("spark.sql.ansi.enabled", before)


GOOD = [
    ("string", " 12 ", "int", 12),
    ("double", 1.25, "decimal(10,2)", Decimal("1.25")),
    ("double", 2.0, "int", 2),
    ("string", "t", "boolean", True),
    ("array<string>", ["1", "2"], "array<int>", [1, 2]),
    ("array<array<int>>", [[1], [2, None]], "array<array<bigint>>", [[1], [2, None]]),
    ("int", 5, "bigint", 5),
    ("int", 5, "string", "5"),
]
BAD = [
    ("string", "abc", "int", None),
    ("int", 40000, "smallint", None),
    ("decimal(20,3)", Decimal("123456.789"), "decimal(5,2)", None),
    ("array<string>", ["1", "b"], "array<int>", [1, None]),
    ("array<array<string>>", [["1"], ["b", None]], "array<array<int>>", [[1], [None, None]]),
]


@pytest.mark.parametrize("source, value, target, expected", GOOD)
def test_values_that_fit(spark, ansi, source, value, target, expected):
    df = frame(spark, source, value, None)
    for strict in (True, False):
        out = conform(df, [column(target)], strict)
        assert out.schema[0].dataType.simpleString() == target
        assert [r.v for r in out.collect()] == [expected, None]
    assert column_checks(df, [column(target)]).first().asDict() == {
        "column_name": "v", "n_rows": 2, "n_nulls": 1, "n_lost": 0, "n_altered": 0,
    }


ALTERED = [
    ("double", 3.7, "int", 3),
    ("double", 1.005, "decimal(10,2)", Decimal("1.01")),
    ("decimal(6,3)", Decimal("123.456"), "decimal(5,1)", Decimal("123.5")),
    ("bigint", 9007199254740993, "double", 9007199254740992.0),
    ("bigint", 2**63 - 1, "double", 2.0**63),
    ("int", 16777217, "float", 16777216.0),
    ("double", 0.1, "float", 0.10000000149011612),
    ("decimal(20,2)", Decimal("123456789012345678.25"), "double", 123456789012345680.0),
    ("int", 2, "boolean", True),
    ("string", "1.005", "decimal(10,2)", Decimal("1.01")),
    ("array<double>", [1.0, 2.5], "array<int>", [1, 2]),
]


@pytest.mark.parametrize("source, value, target, lenient", ALTERED)
def test_values_that_would_be_altered(spark, ansi, source, value, target, lenient):
    df = frame(spark, source, value, None)
    with pytest.raises(Exception, match="column v: a value would be altered"):
        conform(df, [column(target)]).collect()
    for options in ({"rounding": True}, {"strict": False}):
        assert [r.v for r in conform(df, [column(target)], **options).collect()] == [lenient, None]
    found = column_checks(df, [column(target)]).first()
    assert (found["n_lost"], found["n_altered"]) == (0, 1)


def test_times_of_day_are_not_dropped(spark, ansi):
    df = spark.sql(
        "SELECT * FROM VALUES (timestamp'2024-02-29 00:00:00'), (timestamp'2024-02-29 10:00:00') AS t(v)"
    )
    with pytest.raises(Exception, match="would be altered"):
        conform(df, [column("date")]).collect()
    assert conform(df, [column("date")], rounding=True).distinct().count() == 1
    assert column_checks(df, [column("date")], ["altered"]).first().asDict() == {
        "column_name": "v", "n_rows": 2, "n_altered": 1,
    }
    text = df.select(F.col("v").cast("string").alias("v"))
    assert column_checks(text, [column("date")]).first()["n_altered"] == 1


def test_other_spellings_are_the_same_value(spark, ansi):
    for value, target in ((" 12 ", "int"), ("t", "boolean"), ("1.50", "decimal(5,1)"),
                          ("1e2", "decimal(5,1)"), ("0.1", "float"), ("2024-02-29 ", "date")):
        df = frame(spark, "string", value)
        assert column_checks(df, [column(target)]).first()["n_altered"] == 0
        assert conform(df, [column(target)]).first().v is not None


def test_measures_by_name(spark):
    df = frame(spark, "string", "1", "x", None)
    assert column_checks(df, [column("int")], []).columns == ["column_name", "n_rows"]
    assert column_checks(df, [column("int")], ["lost"]).first()["n_lost"] == 1
    with pytest.raises(ValueError, match="nulls, lost, altered"):
        column_checks(df, [column("int")], ["rows"])


def test_column_names_by_the_rule_of_the_session(spark):
    df = spark.createDataFrame([("1",)], "V string")
    assert conform(df, [column("int")]).first().asDict() == {"v": 1}
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        with pytest.raises(ValueError, match="no columns"):
            conform(df, [column("int")])
    finally:
        spark.conf.unset("spark.sql.caseSensitive")


@pytest.mark.parametrize("source, value, target, lenient", BAD)
def test_values_that_do_not_fit(spark, ansi, source, value, target, lenient):
    df = frame(spark, source, value, None)
    with pytest.raises(Exception, match="CAST|column v|OVERFLOW|OUT_OF_RANGE"):
        conform(df, [column(target)]).collect()
    assert [r.v for r in conform(df, [column(target)], strict=False).collect()] == [lenient, None]
    assert column_checks(df, [column(target)]).first()["n_lost"] == 1


def test_money(spark, ansi):
    df = frame(spark, "string", "-$1,234.50", "$0.07", None)
    out = conform(df, [column("double", "money")])
    assert [r.v for r in out.collect()] == [-1234.5, 0.07, None]
    arrays = frame(spark, "array<string>", ["$1.50", None])
    assert conform(arrays, [column("array<double>", "money[]", "money")]).first().v == [1.5, None]


def test_time_and_bit_read_by_the_driver_as_something_else(spark):
    df = spark.sql("SELECT timestamp'1970-01-01 13:05:07.25' AS v")
    assert conform(df, [column("string", "time without time zone")]).first().v == "13:05:07.250000"
    # Another column of the same type read keeps Spark's own text.
    assert conform(df, [column("string", "text")]).first().v == "1970-01-01 13:05:07.25"
    bits = frame(spark, "boolean", True, False, None)
    assert [r.v for r in conform(bits, [column("string", "bit")]).collect()] == ["1", "0", None]


def test_timestamps_without_zone_become_instants(spark):
    df = spark.sql("SELECT timestamp_ntz'2024-03-31 02:30:00' AS v")
    out = conform(df, [column("timestamp", "timestamp")])
    assert out.schema[0].dataType == T.TimestampType()
    assert out.first().v.isoformat() == "2024-03-31T02:30:00"


def test_order_names_and_extra_columns(spark):
    df = spark.createDataFrame([(1, "x", 2.0)], "`a.b` int, `q``c` string, extra double")
    out = conform(df, [column("string", name="q`c"), column("bigint", name="a.b")])
    assert out.columns == ["q`c", "a.b"] and out.first() == ("x", 1)
    with pytest.raises(ValueError, match="absent"):
        conform(df, [column("int", name="absent")])


def test_is_a_projection(spark, capsys):
    df = spark.range(10).select(F.col("id").cast("string").alias("v"), F.lit(1).alias("w"))
    conform(df, [column("int")]).explain()
    plan = capsys.readouterr().out
    assert "Exchange" not in plan and "Python" not in plan


def test_checks_of_many_columns_in_one_pass(spark, capsys):
    df = spark.createDataFrame(
        [(1, "1", "x"), (70000, "b", None), (None, "3", "y")], "a int, b string, c string"
    )
    checks = column_checks(
        df, [column("smallint", name="a"), column("int", name="b"), column("string", name="c")]
    )
    checks.explain()
    assert capsys.readouterr().out.count("Exchange ") == 1
    assert [tuple(r) for r in checks.collect()] == [
        ("a", 3, 1, 1, 0), ("b", 3, 0, 1, 0), ("c", 3, 1, 0, 0),
    ]


def test_spelling_of_spark_types_round_trips(spark):
    ddl = (
        "a smallint, b int, c bigint, d float, e double, f decimal(12,3), g string, h binary, "
        "i boolean, j date, k timestamp, l array<int>, m array<array<decimal(5,1)>>"
    )
    df = spark.createDataFrame([], ddl)
    source = FrameSource({"t": df})
    columns = mapped_columns(map_types(discover_columns(spark, source, "public", "t")))
    assert [c.status for c in columns] == ["ok"] * len(columns)
    assert conform(df, columns).schema == df.schema


def test_other_types_fall_back_to_text(spark):
    df = spark.sql("SELECT map('a', 1) AS m, named_struct('x', 1) AS s")
    source = FrameSource({"t": df})
    found = discover_columns(spark, source)
    columns = mapped_columns(map_types(found), "t")
    assert [(c.data_type, c.status) for c in columns] == [("USER-DEFINED", "unknown")] * 2
    assert conform(df, columns).first() == ("{a -> 1}", "{1}")


def test_source_filters(spark):
    source = FrameSource({"t": spark.range(1), "u": spark.range(1)}, schema="s")
    assert discover_columns(spark, source).count() == 2
    assert discover_columns(spark, source, "s", "t").count() == 1
    assert discover_columns(spark, source, "other").count() == 0
    with pytest.raises(ValueError):
        source.read(spark, "s", "absent", [])


EDGES = {
    "double": [0.0, -0.5, 127.9, 128.0, -128.9, -129.0, 9.995, 9.994, 99.99, -99.995, 2.0**31,
               2.0**31 - 0.5, -(2.0**31) - 0.5, 2.0**63, -(2.0**63), 1e300, float("inf"),
               float("-inf"), float("nan"), 999.994999, 9999.999],
    "float": [0.0, 1.5, 2.0**31, -(2.0**31), 2.0**63, 3e38, float("nan"), float("inf")],
    "bigint": [0, 127, 128, -128, -129, 32767, 32768, 2**31 - 1, 2**31, -(2**31) - 1, 2**63 - 1,
               -(2**63), 99, 100, -100, 999, 1000],
    "smallint": [0, 9, 10, 100, -100, 127, 128, 32767, -32768],
    "decimal(38,2)": [Decimal(x) for x in ("0", "9.99", "10", "-10", "127.99", "128", "-128.99",
                      "-129", "9223372036854775807.99", "9223372036854775808",
                      "-9223372036854775809", "999999999999999999999999999999999999.99")],
    "string": ["", " ", "1", " 1 ", "abc", "1e3", "NaN", "nan", "inf", "-Infinity", "0x1p3", "t",
               "T", "yes\t", " yes", "no", "maybe", "on", "0", "1.5", "128", "-129", "12a",
               "1f", "1d", "+5", ".5", "5.", "1_000", "99999999999999999999", "٣", "10.005"],
}
TARGETS = ["tinyint", "smallint", "int", "bigint", "float", "double", "boolean", "decimal(3,2)",
           "decimal(5,2)", "decimal(38,2)", "decimal(10,0)", "date", "timestamp"]


@pytest.mark.parametrize("source", EDGES)
def test_lenient_casts_equal_try_cast(spark, source):
    """The tests before the cast change its speed only."""
    from typeferry.functions.casts import lenient_cast

    df = frame(spark, source, *EDGES[source], None)
    read_as = df.schema[0].dataType
    plans = []
    for target in map(T.DataType.fromDDL, TARGETS):
        try:
            df.select(F.col("v").try_cast(target)).schema
        except Exception:
            continue  # no such cast
        plans.append((target, F.col("v").try_cast(target), lenient_cast(F.col("v"), read_as, target)))
    assert plans
    for target, tried, ours in plans:
        differ = df.select("v", tried.alias("a"), ours.alias("b")).filter(
            ~F.col("a").eqNullSafe(F.col("b"))
        )
        assert differ.collect() == [], target
