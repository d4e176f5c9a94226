import math

import pytest
from conftest import rows
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from civicmart.functions.keys import PRIME, hash_bucket, hash_coefficients
from civicmart.operators import regression, search as searching
from civicmart.operators.regression import (
    feature_stages,
    hash_split,
    dealt_rows,
    kept_rows,
    make_model,
    model_chain,
    regression_metrics,
)
from civicmart.operators.search import SearchSpace, search, shared_fits
from civicmart.operators.sinks import write_predictions
from civicmart.plans.zones import train_stage
from civicmart.operators.sinks import read_runs
from civicmart.sources.readers import read_own_csv

FEATURES = ["a", "b"]
QUICK = SearchSpace(rf_numTrees=(3, 5), rf_maxDepth=(2, 4), gbt_maxIter=(2, 3), gbt_maxDepth=(2, 3))


@pytest.fixture(scope="module")
def data(spark):
    """Label = 3a - 2b + 5, exactly linear."""
    a, b = F.col("id") % 17, F.col("id") % 23
    df = spark.range(600).select(
        (F.col("id") % 10 + 2000).alias("year"),
        F.col("id").alias("code"),
        a.cast("double").alias("a"),
        b.cast("double").alias("b"),
        (3.0 * a - 2.0 * b + 5).alias("y"),
    )
    return df.cache()


def test_split_is_complete_disjoint_and_about_right(data):
    train, test = hash_split(data, ["year", "code"], 8, "holdout")
    assert train.count() + test.count() == 600
    assert train.intersect(test).count() == 0
    assert 0.72 < train.count() / 600 < 0.88


def test_split_does_not_depend_on_partitioning(data):
    parts = [
        rows(hash_split(frame, ["year", "code"], 8, "holdout")[1].select("code"))
        for frame in (data, data.repartition(1), data.repartition(13, "b"))
    ]
    assert parts[0] == parts[1] == parts[2]


def test_salts_give_different_splits(data):
    tests = [rows(hash_split(data, ["code"], 8, salt)[1].select("code")) for salt in ("x", "y")]
    assert tests[0] != tests[1]


def test_bucket_formula(spark):
    df = spark.createDataFrame([(5, -7), (2**40, 3), (None, 3)], "i bigint, j int")
    (a, b), offset = hash_coefficients(2, "s")
    expected = [
        ((i % PRIME) * a % PRIME + (j % PRIME) * b % PRIME + offset) % PRIME % 10
        for i, j in ((5, -7), (2**40, 3), (-1, 3))
    ]
    assert [r[0] for r in df.coalesce(1).select(hash_bucket(df, ["i", "j"], 10, "s")).collect()] == expected


def test_text_and_double_keys_spread(spark):
    df = spark.range(2000).select(F.col("id").cast("string").alias("t"), (F.col("id") / 7).alias("d"))
    sizes = [r["count"] for r in df.groupBy(hash_bucket(df, ["t", "d"], 10)).count().collect()]
    assert len(sizes) == 10 and min(sizes) > 120 and max(sizes) < 290


def test_scaling_divides_by_the_sample_deviation(data):
    scaled = Pipeline(stages=feature_stages(FEATURES)).fit(data).transform(data)
    deviation = data.agg(F.stddev_samp("a").alias("a"), F.stddev_samp("b").alias("b")).first()
    for row in scaled.select("a", "b", vector_to_array("features").alias("f")).limit(50).collect():
        assert row.f[0] == pytest.approx(row.a / deviation.a)
        assert row.f[1] == pytest.approx(row.b / deviation.b)


def test_measures_equal_the_evaluator(data):
    scored = data.withColumn("prediction", F.col("y") * 0.9 + F.col("a") * 0.3)
    got = regression_metrics(scored, "y").first()
    for name in ("rmse", "r2"):
        evaluator = RegressionEvaluator(labelCol="y", predictionCol="prediction", metricName=name)
        assert got[name] == pytest.approx(evaluator.evaluate(scored), rel=1e-12)
    spread = data.agg(F.max("y") - F.min("y")).first()[0]
    assert got.nrmse == pytest.approx(got.rmse / spread) and got["rows"] == 600


def test_measures_of_constant_and_empty_labels(data):
    scored = data.select(F.lit(4.0).alias("y"), F.lit(5.0).alias("prediction"))
    constant = regression_metrics(scored, "y").first()
    assert constant.rmse == 1.0 and constant.nrmse == math.inf and constant.r2 is None
    assert tuple(regression_metrics(scored.limit(0), "y").first()) == (0, None, None, None)


def test_linear_model_recovers_the_label(data):
    model = model_chain(
        {"model_type": "lr", "lr_regParam": 0.0, "lr_elasticNetParam": 0.0}, FEATURES, "y"
    ).fit(data)
    assert regression_metrics(model.transform(data), "y").first().rmse < 1e-6


@pytest.mark.parametrize(
    "params",
    [
        {"model_type": "rf", "rf_numTrees": 8, "rf_maxDepth": 6},
        {"model_type": "gbt", "gbt_maxIter": 8, "gbt_maxDepth": 4},
    ],
)
def test_tree_models_learn(data, params):
    train, test = hash_split(data, ["code"], 8, "holdout")
    with kept_rows(train) as kept:
        model = model_chain(params, FEATURES, "y").fit(kept)
    assert regression_metrics(model.transform(test), "y").first().r2 > 0.8


def test_kept_rows_are_all_rows_and_released(spark):
    with kept_rows(dealt_rows(spark.range(100).coalesce(1), 3)) as kept:
        assert kept.count() == 100 and kept.is_cached
    assert not kept.is_cached


@pytest.mark.parametrize(
    "params",
    [
        {"model_type": "rf", "rf_numTrees": 5, "rf_maxDepth": 5},
        {"model_type": "gbt", "gbt_maxIter": 3, "gbt_maxDepth": 3},
    ],
)
def test_models_depend_on_rows_alone(data, params):
    """The same rows in 1, 4 and 13 parts, some of them many times."""
    rows_ = data.select("y", *FEATURES)
    rows_ = rows_.unionByName(rows_.limit(1)).unionByName(rows_.limit(1))
    found = []
    for parts in (1, 4, 13):
        with kept_rows(dealt_rows(rows_.repartition(parts))) as kept:
            model = model_chain(params, FEATURES, "y").fit(kept)
        scored = model.transform(rows_.coalesce(1)).select("y", *FEATURES, "prediction")
        found.append([r.prediction for r in scored.orderBy("y", *FEATURES).collect()])
    assert found[0] == pytest.approx(found[1], abs=1e-9)
    assert found[0] == pytest.approx(found[2], abs=1e-9)


def test_a_repeated_row_is_dealt_over_all_parts(spark):
    from pyspark.sql import functions as F

    same = spark.range(1000).select(F.lit(1.0).alias("x"))
    sizes = dealt_rows(same, 4).groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) == 4 and max(r["count"] for r in sizes) < 400


def test_rows_lie_in_as_many_parts_as_they_need(spark):
    def parts(rows, rows_a_part):
        dealt = dealt_rows(spark.range(rows).select(F.col("id").cast("double").alias("x")), rows_a_part=rows_a_part)
        assert dealt.distinct().count() == rows
        return dealt.rdd.getNumPartitions()

    assert (parts(1, 50), parts(50, 50), parts(101, 50)) == (1, 1, 3)
    # No more than the session's shuffles have.
    assert parts(1000, 50) == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_trials_learn_from_few_parts_where_there_are_few_rows(data, monkeypatch):
    seen = []

    def watched(params, label, *rest):
        model = make_model(params, label, *rest)
        fit = model.fit
        model.fit = lambda rows: seen.append(rows.rdd.getNumPartitions()) or fit(rows)
        return model

    monkeypatch.setattr(searching, "make_model", watched)
    space = SearchSpace(families=("rf",), rf_numTrees=(2, 3), rf_maxDepth=(2, 3))
    search(data, FEATURES, "y", ["code"], space, trials=2)
    assert seen == [1, 1]


def test_unknown_model_is_refused():
    with pytest.raises(ValueError):
        make_model({"model_type": "svm"}, "y")


def test_draws_depend_on_seed_and_trial_only_and_stay_in_range():
    space = SearchSpace()
    drawn = [space.draw(trial, 1) for trial in range(300)]
    assert drawn == [space.draw(trial, 1) for trial in range(300)]
    assert drawn != [space.draw(trial, 2) for trial in range(300)]
    assert {p["model_type"] for p in drawn} == {"lr", "rf", "gbt"}
    for params in drawn:
        for name, value in params.items():
            if name != "model_type":
                low, high = getattr(space, name)
                assert low <= value <= high


def test_search_finds_the_family_that_fits(data):
    result = search(data, FEATURES, "y", ["code"], QUICK, trials=6, seed=3)
    assert len(result.trials) == 6
    assert result.best_rmse == min(rmse for _, rmse in result.trials)
    again = search(data, FEATURES, "y", ["code"], QUICK, trials=6, seed=3)
    assert [p for p, _ in again.trials] == [p for p, _ in result.trials]


def test_boosted_trials_of_equal_depth_share_a_fit():
    gbt = [{"model_type": "gbt", "gbt_maxIter": n, "gbt_maxDepth": d} for n, d in ((3, 2), (9, 2), (2, 5))]
    forest = {"model_type": "rf", "rf_numTrees": 4, "rf_maxDepth": 4}
    line = {"model_type": "lr", "lr_regParam": 1.0, "lr_elasticNetParam": 0.5}
    assert shared_fits([line, gbt[0], forest, gbt[1], gbt[2], line]) == [[1, 3], [4], [2], [0], [5]]


def test_a_shared_fit_gives_every_trial_its_own_error(data, monkeypatch):
    space = SearchSpace(families=("gbt",), gbt_maxIter=(2, 6), gbt_maxDepth=(2, 2))
    logged, fitted = {}, []
    monkeypatch.setattr(searching, "make_model", lambda params, label: fitted.append(params) or make_model(params, label))
    log = lambda trial, params, rmse: logged.update({trial: (params, rmse)})
    result = search(data, FEATURES, "y", ["code"], space, trials=4, log=log)
    assert len({p["gbt_maxIter"] for p, _ in result.trials}) > 1 and len(fitted) == 1
    assert [logged[trial] for trial in range(4)] == result.trials
    fit_part, check_part = hash_split(data, ["code"], 7, "validation")
    for params, rmse in result.trials:
        alone = model_chain(params, FEATURES, "y").fit(dealt_rows(fit_part.select("y", *FEATURES), 1))
        assert rmse == pytest.approx(regression_metrics(alone.transform(check_part), "y").first().rmse, rel=1e-9)


def test_boosted_trials_without_validation_rows_say_so(data):
    space = SearchSpace(families=("gbt",), gbt_maxIter=(2, 6), gbt_maxDepth=(2, 2))
    kept = hash_split(data, ["code"], 7, "validation")[0]
    with pytest.raises(ValueError, match="validation"):
        search(kept, FEATURES, "y", ["code"], space, trials=3)


def test_search_without_validation_rows_says_so(data):
    with pytest.raises(ValueError, match="validation"):
        search(data.limit(1), FEATURES, "y", ["code"], SearchSpace(families=("lr",)), trials=1)


def test_training_writes_predictions_model_and_run_log(spark, data, tmp_path):
    dirty = data.unionByName(data.limit(3).withColumn("a", F.lit(None).cast("double")))
    report = train_stage(
        dirty, str(tmp_path), FEATURES, "y", ["year", "code"], SearchSpace(families=("lr",)), trials=3
    )
    test = hash_split(data, ["year", "code"], 8, "holdout")[1]
    predictions = spark.read.option("header", True).csv(str(tmp_path / "predictions"))
    assert predictions.count() == test.count()
    assert {"features", "prediction", "y"} <= set(predictions.columns)
    model = PipelineModel.load(str(tmp_path / "model"))
    again = regression_metrics(model.transform(test), "y").first()
    assert report.metrics["test_rmse"] == pytest.approx(again.rmse)
    runs = read_runs(spark, str(tmp_path / "runs")).orderBy("trial").collect()
    assert [r.trial for r in runs] == [-1, 0, 1, 2]
    assert set(runs[0].metrics) == {"test_rmse", "test_r2", "test_nrmse"}
    assert all(r.params["model_type"] == "lr" and r.run_id == report.run_id for r in runs)


def test_predictions_round_trip_as_csv(spark, data, tmp_path):
    scored = Pipeline(stages=feature_stages(FEATURES)).fit(data).transform(data)
    write_predictions(scored, str(tmp_path / "out"))
    back = read_own_csv(spark, str(tmp_path / "out"), "year bigint, code bigint, a double, b double, y double, unscaled_features string, features string")
    parsed = back.withColumn("f", F.from_json("features", "array<double>"))
    expected = scored.select("code", vector_to_array("features").alias("f"))
    assert rows(parsed.select("code", "f")) == rows(expected)
