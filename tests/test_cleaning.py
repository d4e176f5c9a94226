import math

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Observation
from pyspark.sql import functions as F

from civicmart.functions.cleaning import (
    ColumnRule,
    apply_rules,
    apply_rules_beside_raw,
    fill_zero,
    hyphens_to_spaces,
    rejected_counts,
    safe_ratio,
    text_to_null,
    to_double,
    to_int,
)


def column(spark, values, kind="string"):
    return spark.createDataFrame([(v,) for v in values], f"v {kind}")


def applied(spark, values, expression, kind="string"):
    df = column(spark, values, kind).coalesce(1)
    return [r[0] for r in df.select(expression(F.col("v"))).collect()]


@pytest.mark.parametrize(
    "raw, expected",
    [
        ("12", 12),
        (" 12 ", 12),
        ("+7", 7),
        ("-3", -3),
        ("46595.0", 46595),
        ("12.9", 12),
        ("1e3", 1000),
        ("-", None),
        ("..", None),
        ("", None),
        ("1-URGENT", None),
        ("1,234", None),
        ("99999999999", None),
        ("No consta", None),
        (None, None),
    ],
)
def test_text_to_int(spark, raw, expected):
    assert applied(spark, [raw], to_int) == [expected]


@pytest.mark.parametrize(
    "raw, expected",
    [
        ("64.7", 64.7),
        (" 64.7\t", 64.7),
        (".5", 0.5),
        ("5.", 5.0),
        ("-1.5E-3", -0.0015),
        ("Infinity", math.inf),
        ("-", None),
        ("..", None),
        (".", None),
        ("", None),
        ("64,7", None),
        ("e5", None),
        (None, None),
    ],
)
def test_text_to_double(spark, raw, expected):
    assert applied(spark, [raw], to_double) == [expected]


def test_not_a_number_text_is_kept_as_such(spark):
    assert math.isnan(applied(spark, ["NaN"], to_double)[0])


def test_typed_columns_pass_through(spark):
    assert applied(spark, [4, None], to_int, "bigint") == [4, None]
    assert applied(spark, [4.75, None], to_int, "double") == [4, None]
    assert applied(spark, [4.75], to_double, "double") == [4.75]


@settings(max_examples=25, deadline=None, derandomize=True, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(allow_nan=False, width=64), min_size=1, max_size=40))
def test_doubles_survive_text(spark, values):
    assert applied(spark, [repr(v) for v in values], to_double) == values


@settings(max_examples=25, deadline=None, derandomize=True, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text("0123456789+-.eE é", max_size=6), min_size=1, max_size=60))
def test_the_guard_changes_no_result(spark, texts):
    """Looking at the shape first gives what trying the cast on everything gives."""

    def unguarded(value):
        return value.try_cast("double")

    assert applied(spark, texts, to_double) == applied(spark, texts, unguarded)


def test_every_hyphen_becomes_one_space(spark):
    assert applied(spark, ["a - b-c", "plain", None], hyphens_to_spaces) == ["a   b c", "plain", None]


def test_sentinel_is_compared_exactly(spark):
    raw = ["No consta", "no consta", "No consta ", None]
    assert applied(spark, raw, text_to_null) == [None, "no consta", "No consta ", None]


def test_hyphens_go_before_the_sentinel_is_compared(spark):
    rule = ColumnRule(("v",), "name", hyphens=True, sentinel="No consta")
    df = column(spark, ["No-consta", "No consta", "a-b", None]).coalesce(1)
    assert [r.name for r in df.select(rule.column()).collect()] == [None, None, "a b", None]


def test_ratio_is_null_for_zero_and_null_divisors(spark):
    df = spark.createDataFrame([(6, 4), (6, 0), (6, None), (None, 3)], "a int, b int")
    got = [r[0] for r in df.coalesce(1).select(safe_ratio(F.col("a"), F.col("b"))).collect()]
    assert got == [1.5, None, None, None]


def test_awkward_names_and_spellings(spark):
    df = spark.createDataFrame(
        [("64.7", "x", None, 1), ("-", None, "y", 2)],
        "`Índex RFD Barcelona = 100` string, `Demanda_ocupació` string, Demanda_ocupacio string,"
        " `Densitat. (hab/ha)` int",
    )
    rules = [
        ColumnRule(("Índex RFD Barcelona = 100",), "index", "double"),
        ColumnRule(("Demanda_ocupació", "Demanda_ocupacio"), "demand"),
        ColumnRule(("Densitat. (hab/ha)",), "density", "double"),
    ]
    out = apply_rules(df, rules)
    assert out.columns == ["index", "demand", "density"]
    assert rows(out, "density") == [(64.7, "x", 1.0), (None, "y", 2.0)]


def test_rules_read_struct_fields(spark):
    df = spark.sql("select named_struct('Codi', '7', 'Nom', 'a-b') as record")
    rules = [ColumnRule(("Codi",), "code", "int"), ColumnRule(("Nom",), "name", hyphens=True)]
    assert rows(apply_rules(df, rules, "record")) == [(7, "a b")]


def test_unknown_kind_is_refused():
    with pytest.raises(ValueError):
        ColumnRule(("a",), "a", "money").column()


def test_rejected_values_are_counted_during_the_pass(spark):
    df = column(spark, ["1", "-", "..", None, "2"])
    rules = [ColumnRule(("v",), "n", "int")]
    quality = Observation("q")
    out = apply_rules_beside_raw(df, rules).observe(quality, *rejected_counts(rules)).select("n")
    assert rows(out) == [(1,), (2,), (None,), (None,), (None,)]
    assert quality.get == {"rows": 5, "rejected_n": 2}
    # One cast to int, not one for the value and one for the count.
    assert out._jdf.queryExecution().executedPlan().toString().count("as int)") == 2


def test_fill_touches_the_named_column_only(spark):
    df = spark.createDataFrame([(None, None), (1.0, 2.0)], "a double, b double")
    assert rows(fill_zero(df, "a"), "a") == [(0.0, None), (1.0, 2.0)]
