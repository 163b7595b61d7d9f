"""The narrowest type of text columns."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from typeferry.operators.infer import Evidence, _summary, evidence, infer_types, narrowed

CASES = {
    "boolean": ["true", "false", None],
    "smallint": ["0", "-32768", "32767"],
    "int": ["0", "32768", "-1"],
    "bigint": ["2147483648", "-9223372036854775808", "9223372036854775807"],
    "decimal(4,2)": ["12.50", "-0.05", "0.00"],
    "decimal(2,2)": ["0.50", "-0.25"],
    "decimal(38,1)": ["1" * 37 + ".5"],
    "double": ["1.5", "2.25", "-0.0", "1.0E10", "NaN", "Infinity"],
    "date": ["2024-02-29", "1969-12-31", None],
    "timestamp": ["2024-01-01 00:09:58.778549", "2024-01-01 00:00:00"],
}
TEXTS = {
    "leading zeros": ["007", "1"],
    "a sign": ["+1"],
    "minus zero": ["-0"],
    "too long for a long": ["9223372036854775808"],
    "too long for a decimal": ["1" * 38 + ".5"],
    "minus zero decimal and another scale": ["-0.00", "1.5"],
    "booleans in capitals": ["TRUE"],
    "blanks": [" 1"],
    "a line end": ["1\n"],
    "no such date": ["2024-02-30"],
    "a date in another form": ["2024-2-9"],
    "a date and a number": ["2024-02-29", "1"],
    "empty": [""],
    "words": ["one"],
    "nulls alone": [None, None],
}


def frame(spark, values):
    return spark.createDataFrame([(v,) for v in values], "c string")


@pytest.mark.parametrize("kind", CASES)
def test_types(spark, kind):
    df = frame(spark, CASES[kind])
    assert [(r.column_name, r.spark_type) for r in infer_types(df).collect()] == [("c", kind)]
    cast = narrowed(df)
    assert cast.schema["c"].dataType.simpleString() == kind
    if kind != "timestamp":
        back = [r.c for r in cast.selectExpr("cast(c as string) as c").collect()]
        assert back == CASES[kind]


@pytest.mark.parametrize("case", TEXTS)
def test_texts_stay(spark, case):
    assert evidence(frame(spark, TEXTS[case]))["c"].type == "string"


def test_all_columns_in_one_pass(spark):
    row = [values[0] for values in CASES.values()]
    names = [f"c{i} `x" for i in range(len(row))]
    columns = ", ".join(f"`{n.replace('`', '``')}` string" for n in names) + ", n int"
    df = spark.createDataFrame([(*row, 1)], columns)
    found = infer_types(df).collect()
    assert [r.column_name for r in found] == [*names, "n"] and found[-1].spark_type == "int"
    assert found[-1].n_set is None
    assert evidence(df, [names[0]]).keys() == {names[0]}
    assert evidence(df.select("n")) == {}
    empty = infer_types(df.limit(0)).collect()
    assert all(r.spark_type == "string" for r in empty[:-1])


PARTS = [*CASES.values(), *TEXTS.values()]


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.sampled_from(PARTS), min_size=2, max_size=3))
def test_evidence_of_parts_joins_to_that_of_all(spark, parts):
    whole = evidence(frame(spark, [v for p in parts for v in p]))["c"]
    joined = Evidence()
    for p in parts:
        joined = joined.join(evidence(frame(spark, p))["c"])
    assert joined == whole


def test_known_evidence(spark):
    before = evidence(frame(spark, ["70000"]))
    found = infer_types(frame(spark, ["1", "2"]), before).first()
    assert (found.spark_type, found.n_set) == ("int", 3)


def test_each_test_of_a_value_is_made_once(spark):
    plan = _summary(frame(spark, ["1"]), ["c"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(r"\A(0|-?[1-9][0-9]{0,18})\z") == plan.count(r"\A-?(0|[1-9][0-9]*)\.[0-9]+\z") == 1


def test_texts_that_could_pass_for_others(spark):
    """Casts are tried only where they could succeed; held against trying them all."""
    texts = [
        "+10000-01-01", "-0001-01-01", "0000-01-01", "+10000-01-01 00:00:00", "-5-01-01", "1.0E-5", "-1.5",
        "-Infinity", "Infinity", "NaN", "-NaN", "inf", "+1.5", ".5", "-.5", "1e5", "12:30", "a:b", "{\"a\": 1}",
        "2024-01-01 1:00:00", "2024-01-01 01:00:00.5", "2024-01-01T01:00:00", "-", ":", "today", "1.", "0.0",
        "-0.0", "-0.00", "0.5", "-0.05",
    ]
    for text in texts:
        df = frame(spark, [text])
        tried = [
            df.select(F.col("c").try_cast(k).cast("string").eqNullSafe(F.col("c"))).first()[0]
            for k in ("double", "date", "timestamp_ntz")
        ]
        got = evidence(df)["c"]
        assert [got.double, got.date, got.timestamp] == tried, text
