import random
from collections import defaultdict

import pytest
from conftest import rows
from pyspark.sql import functions as F

from civicmart.operators import features
from civicmart.operators.features import (
    SALT,
    drop_incomplete,
    first_row,
    grouped_total,
    labelled_total,
    left_chain,
    present,
    row_count,
    heavy_keys,
    value_range,
    with_ratios,
)
from civicmart.plans.mart import build_mart

KEYS = ["year", "neighborhood_code"]


def test_a_group_of_nulls_totals_zero(spark):
    df = spark.createDataFrame(
        [(1, 1, None), (1, 1, None), (1, 2, None), (1, 2, 3.5), (2, 1, 1.0)], "y int, n int, v double"
    )
    out = grouped_total(df, ["y", "n"], "v", "t")
    assert rows(out, "y", "n") == [(1, 1, 0.0), (1, 2, 3.5), (2, 1, 1.0)]


def test_integer_totals_are_long(spark):
    df = spark.createDataFrame([(1, 2_000_000_000), (1, 2_000_000_000)], "k int, v int")
    assert rows(grouped_total(df, ["k"], "v", "t")) == [(1, 4_000_000_000)]


def test_labels_are_case_sensitive(spark):
    df = spark.createDataFrame(
        [(1, 1, "Atur Registrat"), (1, 2, "Atur registrat"), (1, 4, "atur registrat"), (1, 8, None), (2, 1, "no")],
        "k int, v int, label string",
    )
    out = labelled_total(df, ["k"], "v", "t", "label", ["Atur Registrat", "Atur registrat"])
    assert rows(out) == [(1, 3)]


def chain_frames(spark):
    base = spark.createDataFrame(
        [(1, 1, "base", 10), (1, 2, "base", 20), (2, 1, "base", 30), (None, 1, "base", 40)],
        "y int, n int, name string, p int",
    )
    first = spark.createDataFrame(
        [(1, 1, "side", 0.5), (1, 1, "side", 0.6), (2, 1, "side", None), (9, 9, "side", 1.0), (None, 1, "side", 2.0)],
        "y int, n int, name string, d double",
    )
    second = spark.createDataFrame([(1, 1, 7), (1, 2, 8)], "y int, n int, t int")
    return base, first, second


EXPECTED_CHAIN = [
    (1, 1, "base", 10, 0.5, 7),
    (1, 1, "base", 10, 0.6, 7),
    (1, 2, "base", 20, None, 8),
    (2, 1, "base", 30, None, None),
    (None, 1, "base", 40, None, None),
]


@pytest.mark.parametrize("parts", [None, 3, 50])
def test_left_chain_keeps_base_columns_fans_out_and_keeps_unmatched(spark, parts):
    base, *sides = chain_frames(spark)
    heavy = None if parts is None else heavy_keys(base, ["y", "n"], parts)
    out = left_chain(base, sides, ["y", "n"], heavy)
    assert out.columns == ["y", "n", "name", "p", "d", "t"] and SALT not in out.columns
    assert rows(out) == sorted(EXPECTED_CHAIN, key=repr)


def test_hot_keys_and_no_others_are_dealt_over_tasks(spark):
    """Nine tenths of the base under one key, sides too big to broadcast by fiat."""
    base = spark.range(10_000).select(F.when(F.col("id") < 9000, 0).otherwise(F.col("id")).alias("k"), "id")
    side = spark.range(10_000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    heavy = heavy_keys(base, ["k"], 16)
    assert [tuple(r) for r in heavy.collect()] == [(0, 15)]
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    previous = {key: spark.conf.get(key) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        out = left_chain(base, [side], ["k"], heavy)
        per_task = out.groupBy(F.spark_partition_id()).count().collect()
        assert max(r["count"] for r in per_task) < 6000
        assert out.count() == 10_000
        assert out.filter("v = k * 2").count() == 10_000
        repeated = features._with_parts(side, heavy, ["k"])
        assert {(r.k, r[features.PARTS]) for r in repeated.filter("k < 3").collect()} == {(0, 15), (1, 1), (2, 1)}
        assert repeated.agg(F.sum(features.PARTS)).first()[0] == 10_000 + 14
    finally:
        for key, value in previous.items():
            spark.conf.set(key, value)


def test_heavy_keys_follow_the_shares_alone(spark):
    rows_ = spark.range(100).select(F.when(F.col("id") < 60, 0).when(F.col("id") < 90, None).otherwise(F.col("id")).alias("k"))
    assert rows(heavy_keys(rows_, ["k"], 10)) == [(0, 6), (None, 3)]
    assert rows(heavy_keys(rows_.unionByName(rows_), ["k"], 10)) == [(0, 6), (None, 3)]
    assert rows(heavy_keys(rows_, ["k"], 1)) == [] == rows(heavy_keys(rows_.limit(0), ["k"]))


def test_present_and_incomplete(spark):
    df = spark.createDataFrame([(1, 1.0), (2, None), (None, 3.0), (4, float("nan"))], "a int, b double")
    assert rows(present(df, "a", "b").select("a")) == [(1,), (4,)]
    assert rows(drop_incomplete(df, ["a", "b"])) == [(1, 1.0)]
    assert drop_incomplete(df, ["a"]).count() == 3


def test_ratios_and_small_aggregates(spark):
    df = spark.createDataFrame([(6, 4), (5, 0)], "a int, b int")
    out = with_ratios(df, {"r": ("a", "b"), "s": ("b", "a")})
    assert rows(out, "a") == [(5, 0, None, 0.0), (6, 4, 1.5, 4 / 6)]
    assert rows(row_count(df)) == [(2,)]
    assert rows(value_range(df, "a")) == [(6, 5)]
    assert rows(first_row(df, "b")) == [(5, 0)]
    empty = df.filter("a > 100")
    assert rows(row_count(empty)) == [(0,)] and rows(value_range(empty, "a")) == [(None, None)]
    assert first_row(empty, "a").collect() == []


def random_inputs(seed):
    rng = random.Random(seed)
    cells = [(y, n) for y in (2011, 2012, 2013) for n in range(1, 7)]
    income = [
        (y, n, n % 3, f"d{n % 3}", rng.choice([0, 100, 250]), rng.choice([None, 64.5, 120.25]))
        for y, n in cells
    ]
    density = [(y, n, 9, "other", -1, 2.5 * n, rng.choice([None, 8.0 * n])) for y, n in cells if rng.random() < 0.8]
    density += density[:2]
    immigrants = [(y, n, rng.choice([None, 1.0, 2.5])) for y, n in cells * 5 if rng.random() < 0.6]
    labels = ["Atur Registrat", "Atur registrat", "Demanda no aturats"]
    unemployment = [(y, n, rng.choice([None, 3, 4]), rng.choice(labels)) for y, n in cells * 4 if rng.random() < 0.6]
    return income, density, immigrants, unemployment


def expected_mart(income, density, immigrants, unemployment):
    total_i, total_u = defaultdict(float), defaultdict(int)
    for y, n, v in immigrants:
        total_i[y, n] += v or 0
    for y, n, c, label in unemployment:
        if label in ("Atur Registrat", "Atur registrat"):
            total_u[y, n] += c or 0
    out = []
    for y, n, code, name, population, index in income:
        for dy, dn, *_, gross, net in density:
            if (dy, dn) == (y, n) and None not in (index, net) and (y, n) in total_i and (y, n) in total_u:
                i, u = total_i[y, n], total_u[y, n]
                ratios = [x / population if population else None for x in (i, u)]
                out.append((y, n, code, name, population, index, gross, net, i, u, *ratios))
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("parts", [None, 4])
def test_mart_against_loops(spark, seed, parts):
    data = random_inputs(seed)
    schemas = [
        "year int, neighborhood_code int, district_code int, district_name string, population int, RDF_index double",
        "year int, neighborhood_code int, district_code int, district_name string, population int,"
        " density double, net_density double",
        "year int, neighborhood_code int, value double",
        "year int, neighborhood_code int, count int, job_demand string",
    ]
    frames = [spark.createDataFrame(rs, schema) for rs, schema in zip(data, schemas)]
    heavy = None if parts is None else heavy_keys(frames[0], ["year", "neighborhood_code"], parts)
    out = build_mart(*frames, heavy=heavy)
    assert out.columns == [
        "year", "neighborhood_code", "district_code", "district_name", "population", "RDF_index",
        "density", "net_density", "total_immigrants", "total_unemployed", "ratio_immigrants",
        "ratio_unemployed",
    ]
    expected = expected_mart(*data)
    assert expected and rows(out) == expected
    if parts is None:
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert "LeftOuter" not in plan and plan.count("Join Inner") == 3
