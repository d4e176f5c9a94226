"""Documents read in pieces, names reconciled, buckets, and linear trials from one pass."""

import json

import numpy as np
import pytest
from conftest import rows
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

import __spark_entry__ as contract
from civicmart.functions.names import name_key, reconcile
from civicmart.operators.linear_path import elastic_net, linear_rmse, moments
from civicmart.plans.file_queries import document_lines, write_document
from civicmart.sources.documents import read_records
from civicmart.sources.spec import text_fields

TABLES = "/root/testdata/sf0.001"
FIELDS = text_fields("a", "b")


def document(tmp_path, records, indent=None):
    path = tmp_path / "d.json"
    path.write_text(json.dumps({"help": "[x]", "success": True, "result": {"records": records, "fields": [{"id": "a"}]}}, indent=indent))
    return str(path)


@pytest.mark.parametrize("records", [[], [{"a": "1"}], [{"a": "1", "b": "é"}, {"b": "]}"}], [{"a": str(i), "b": "x" * (i % 9)} for i in range(500)]])
def test_records_of_one_document(spark, tmp_path, records):
    found = read_records(spark, document(tmp_path, records), FIELDS)
    assert rows(found) == sorted(((r.get("a"), r.get("b")) for r in records), key=repr)


@pytest.mark.parametrize("text", ["x}, y", "}, {", '"}, {"', "}", "]}, "])
def test_a_cut_inside_a_text_is_found_out(spark, tmp_path, text):
    records = [{"a": "1", "b": "plain"}, {"a": text, "b": text}, {"a": "3", "b": None}]
    found = read_records(spark, document(tmp_path, records), FIELDS)
    assert rows(found) == sorted(((r["a"], r["b"]) for r in records), key=repr)


def test_one_document_is_read_by_several_tasks(spark, tmp_path):
    path = document(tmp_path, [{"a": str(i), "b": "y" * 50} for i in range(3000)])
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "50000")
    try:
        found = read_records(spark, path, FIELDS)
        tasks = found.select(F.spark_partition_id().alias("task")).distinct().count()
        assert tasks >= 3 and found.select("a").distinct().count() == 3000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)


@pytest.mark.parametrize("count", [0, 1, 2, 1000])
def test_a_document_is_written_whole_by_one_task_that_holds_nothing(spark, tmp_path, count):
    lines = spark.range(0, count, 1, 3).select(F.to_json(F.struct(F.col("id").cast("string").alias("a"))).alias("line"))
    write_document(spark, lines, str(tmp_path / "out"))
    (file,) = (tmp_path / "out").glob("part-*")
    records = json.loads(file.read_text())["result"]["records"]
    assert records[0] == {"event_id": "-1"}
    assert sorted(int(r["a"]) for r in records[1:]) == list(range(count))
    # One line each, and one each to open and close it.
    assert len(file.read_text().splitlines()) == count + 2
    plan = document_lines(spark, lines)._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan and "Exchange" not in plan and "Window" not in plan


def test_name_keys(spark):
    names = ["Sant Gervasi - la Bonanova", "SANT  GERVASI LA BONANOVA", "sant gervasi-la bonanova.", "Gràcia", "gràcia", "l'Eixample", "L Eixample", "--", None]
    df = spark.createDataFrame([(n,) for n in names], "n string").select(name_key(F.col("n")).alias("k"))
    keys = [r.k for r in df.collect()]
    assert keys == ["sant gervasi la bonanova"] * 3 + ["gracia"] * 2 + ["l eixample"] * 2 + [None] * 2


def test_names_are_reconciled_and_others_reported(spark):
    lookup = spark.createDataFrame([("Gràcia", 6), ("GRACIA", 6), ("Sants", 3), ("sants", 4), (None, 9)], "place string, code int")
    data = spark.createDataFrame([(1, "gracia"), (2, "GRÀCIA"), (3, "Sants"), (4, "Nou"), (5, "Nou"), (6, None)], "id int, name string")
    coded, missing = reconcile(data, "name", lookup, "place", "code")
    assert rows(coded.select("id", "code")) == [(1, 6), (2, 6), (3, None), (4, None), (5, None), (6, None)]
    assert rows(missing) == [("Nou", 2, 0), ("Sants", 1, 2), (None, 1, 0)]


def test_bucketed_tables_join_without_an_exchange(spark):
    joined = contract.queries()["bucketed_chain"](spark, TABLES)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("SortMergeJoin") == 2 and plan.count("Bucketed: true") == 3


@pytest.mark.parametrize("reg, mixing", [(0.0, 0.0), (0.01, 0.0), (0.3, 1.0), (0.05, 0.5), (2.0, 0.2), (50.0, 1.0)])
def test_linear_path_equals_spark_ml(spark, reg, mixing):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 3)) * [1, 20, 0.1] + [5, -3, 0]
    y = x @ [0.5, 0.01, -8] + 0.3 * x[:, 0] * x[:, 1] / 20 + rng.normal(size=400)
    df = spark.createDataFrame([(*map(float, a), 7.0, float(b)) for a, b in zip(x, y)], "p double, q double, r double, fixed double, y double")
    names = ["p", "q", "r", "fixed"]
    of = moments(df, names, "y")
    fit = elastic_net(of, reg, mixing)
    vectors = VectorAssembler(inputCols=names, outputCol="features").transform(df)
    model = LinearRegression(labelCol="y", regParam=reg, elasticNetParam=mixing, tol=1e-12, maxIter=1000).fit(vectors)
    assert np.allclose(fit.coefficients, model.coefficients.toArray(), atol=1e-6, rtol=1e-6)
    assert fit.intercept == pytest.approx(model.intercept, abs=1e-5)
    assert linear_rmse(of, fit) == pytest.approx(model.summary.rootMeanSquaredError, rel=1e-6)


def test_moments_without_rows_or_spread(spark):
    none = moments(spark.createDataFrame([], "x double, y double"), ["x"], "y")
    assert none.n == 0 and linear_rmse(none, elastic_net(none, 0.1, 0.5)) is None
    flat = moments(spark.createDataFrame([(1.0, 2.0), (1.0, 2.0)], "x double, y double"), ["x"], "y")
    fit = elastic_net(flat, 0.1, 0.5)
    assert fit.coefficients.tolist() == [0.0] and fit.intercept == 2.0 and linear_rmse(flat, fit) == 0.0
