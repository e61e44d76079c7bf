"""Cleaning rules and the three-valued flag rule."""

import itertools

import pytest
from pyspark.sql import functions as F

from agora.functions.cleaning import (
    drop_empty_records,
    epoch_text,
    falsy_bool,
    falsy_number,
    falsy_text,
    flag_adult_in_safe_community,
    stringify,
    zero_if_missing,
)
from agora.plans.moderation import register_flag_function


def python_rule(a, b):
    # The reference's rule: ``post and (not community)`` with Python values.
    return a and (not b)


VALUES = [True, False, None]


def test_flag_rule_nine_combinations(spark):
    rows = list(itertools.product(VALUES, VALUES))
    df = spark.createDataFrame(rows, "a boolean, b boolean")
    out = df.select("a", "b", flag_adult_in_safe_community("a", "b").alias("f")).collect()
    for r in out:
        expect = python_rule(r.a, r.b)
        assert r.f == expect, (r.a, r.b, r.f, expect)


def test_flag_sql_function_matches(spark):
    name = register_flag_function(spark)
    rows = list(itertools.product(VALUES, VALUES))
    spark.createDataFrame(rows, "a boolean, b boolean").createOrReplaceTempView("flag_cases")
    got = spark.sql(f"SELECT a, b, {name}(a, b) AS f FROM flag_cases").collect()
    for r in got:
        assert r.f == python_rule(r.a, r.b)


@pytest.mark.parametrize(
    "post,community,expect",
    [(True, False, True), (True, True, False), (False, None, False), (True, None, True), (None, True, None)],
)
def test_golden_content_flag(spark, post, community, expect):
    df = spark.createDataFrame([(post, community)], "a boolean, b boolean")
    assert df.select(flag_adult_in_safe_community("a", "b")).first()[0] == expect


def test_falsy_rules(spark):
    df = spark.createDataFrame(
        [(0, "", False, None), (5, "x", True, 3), (None, None, None, 0)],
        "n long, s string, b boolean, c long",
    )
    out = df.select(
        falsy_number("n").alias("n"),
        falsy_text("s").alias("s"),
        falsy_bool("b").alias("b"),
        zero_if_missing("c").alias("c"),
    ).collect()
    assert [tuple(r) for r in out] == [(None, None, None, 0), (5, "x", True, 3), (None, None, None, 0)]


def test_drop_records_with_no_field_left(spark):
    df = spark.createDataFrame([(None, None, "c1"), ("x", None, "c2")], "a string, b long, sub string")
    assert [r.sub for r in drop_empty_records(df, ["a", "b"]).collect()] == ["c2"]


def test_stringify_and_epoch_text(spark):
    df = spark.createDataFrame([(None, 1704672000.0), (7, 1704672000.5)], "x long, t double")
    out = df.select(stringify("x").alias("s"), epoch_text("t").alias("e")).collect()
    assert out[0].s == "None" and out[1].s == "7"
    assert out[0].e == str(1704672000.0)
    assert float(out[1].e) == 1704672000.5


def test_nan_counts_as_truthy(spark):
    df = spark.createDataFrame([(float("nan"),)], "x double")
    v = df.select(falsy_number("x")).first()[0]
    assert v != v  # NaN kept, as Python's bool(nan) is True
    assert df.select(F.isnan(falsy_number("x"))).first()[0]


def test_sql_rules_equal_column_rules(spark):
    from agora.functions import cleaning as c

    df = spark.createDataFrame(
        [(0.0, "", False, 0), (5.0, "x", True, 3), (None, None, None, None), (float("nan"), " ", None, 7)],
        "n double, s string, b boolean, k long",
    )
    by_column = df.select(
        c.falsy_number("n").alias("n"), c.falsy_text("s").alias("s"),
        c.falsy_bool("b").alias("b"), c.zero_if_missing("k").alias("k"),
    )
    by_sql = df.selectExpr(
        f"{c.falsy_number_sql('n')} AS n", f"{c.falsy_text_sql('s')} AS s",
        f"{c.falsy_bool_sql('b')} AS b", f"{c.zero_if_missing_sql('k')} AS k",
    )
    assert by_column.schema == by_sql.schema

    def rows(d):
        return [tuple("nan" if isinstance(v, float) and v != v else v for v in r) for r in d.collect()]

    assert rows(by_column) == rows(by_sql)
