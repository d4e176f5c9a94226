"""Model queries: trained on the whole training part, scored on the whole hold-out.

Forests and boosted trees have no SQL counterpart in general. Where a tree separates every
value of its one input it predicts group means, and a linear fit solves the normal equations:
those queries have SQL, and so have the search's draws and the consistency of its log.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.features import drop_incomplete
from ..operators.regression import dealt_rows, hash_split, kept_rows, model_chain
from ..operators.linear_path import elastic_net, moments
from ..operators.search import SearchSpace
from ..operators.sinks import read_runs, write_model, write_predictions, write_table
from ..session import materialise, scratch_path
from ..sources.readers import read_own_csv, read_table
from .mart import build_mart
from .registry import load, query
from .table_queries import LABEL, LINE_KEYS, MODEL_INPUTS, TRADE_COLUMNS, labelled_lines
from .trade import customer_year_facts, mart_inputs
from .zones import train_stage

TRIALS, SEED = 20, 42


def scored_holdout(spark: SparkSession, sf_dir: str, params: dict[str, object]) -> DataFrame:
    """Fit on 80 %, score the rest, write the predictions and read them back."""
    train, test = hash_split(labelled_lines(spark, sf_dir), LINE_KEYS, 8, "holdout")
    with kept_rows(dealt_rows(train.select(LABEL, *MODEL_INPUTS))) as rows:
        model = model_chain(params, MODEL_INPUTS, LABEL).fit(rows)
    scored = model.transform(test).select(*LINE_KEYS, LABEL, "prediction")
    path = scratch_path(spark, "predictions")
    write_predictions(scored, path)
    return read_own_csv(spark, path, scored.schema)


@query()
def score_rf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M6, M8, M9, K7."""
    return scored_holdout(spark, sf_dir, {"model_type": "rf", "rf_numTrees": 10, "rf_maxDepth": 5})


@query()
def score_gbt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M7, M8, M9, K7."""
    return scored_holdout(spark, sf_dir, {"model_type": "gbt", "gbt_maxIter": 10, "gbt_maxDepth": 3})


def _group_means(spark: SparkSession, sf_dir: str, params: dict[str, object]) -> DataFrame:
    """A model with one input of few values, saved, loaded, and asked for each value."""
    lines = load(spark, sf_dir, "lineitem").select(
        F.col("l_linenumber").cast("double").alias("line"), F.col("l_quantity").alias("quantity")
    )
    with kept_rows(dealt_rows(lines)) as rows:
        model = model_chain(params, ["line"], "quantity").fit(rows)
    path = scratch_path(spark, "means_model")
    write_model(model, path)
    scored = PipelineModel.load(path).transform(lines.select("line").distinct())
    path = scratch_path(spark, "means")
    write_predictions(scored.select("line", "prediction"), path)
    back = read_own_csv(spark, path, "line double, prediction double")
    return back.select("line", F.round("prediction", 6).alias("prediction"))


MEANS_SQL = """
select cast(l_linenumber as double) as line, round(avg(l_quantity), 6) as prediction
from lineitem group by l_linenumber
"""


@query(MEANS_SQL)
def rf_group_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M6, K7, K8: one tree on all rows, deep enough to part every value."""
    one_tree = {"model_type": "rf", "rf_numTrees": 1, "rf_maxDepth": 6, "rf_bootstrap": False}
    return _group_means(spark, sf_dir, one_tree)


@query(MEANS_SQL)
def gbt_group_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M7, K7, K8: the first round of boosting."""
    return _group_means(spark, sf_dir, {"model_type": "gbt", "gbt_maxIter": 1, "gbt_maxDepth": 6})


SEARCH_INPUTS = ("population", "net_density", "ratio")


def search_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feature table at customer and year: what a trial trains on."""
    facts = customer_year_facts(spark, sf_dir).filter("lines > 0 and orders > 0")
    return materialise(
        facts.select(
            "o_custkey",
            "year",
            (F.col("cents") / F.col("orders")).alias("index"),
            F.col("lines").cast("double").alias("population"),
            (F.col("quantity") / F.col("lines")).alias("net_density"),
            (F.col("finished") / F.col("orders")).alias("ratio"),
        ),
        "search_rows",
    )


def _drawn_sql() -> str:
    """The parameters of each trial, as the search draws them, and the row of the final test."""
    values = []
    for trial in range(TRIALS):
        drawn = SearchSpace().draw(trial, SEED)
        first, second = [str(v) for k, v in drawn.items() if k != "model_type"]
        values.append(f"({trial}, '{drawn['model_type']}', '{first}', '{second}')")
    return f"""
with drawn(trial, model_type, first, second) as (values {", ".join(values)}),
kept as (
  select count(*) as n from (
    select o_custkey, year(o_orderdate) as y from orders join customer on o_custkey = c_custkey
    join lineitem on l_orderkey = o_orderkey group by 1, 2))
select cast(trial as int) as trial, model_type, first, second, true as measured,
       true as best_is_least, n as "rows"
from drawn, kept
"""


@query(_drawn_sql())
def model_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The run log of a whole search, checked against itself.

    All ranges and all trials. ``best_is_least``: the final row repeats the parameters of the
    trial with the least error, and the saved model loads.
    """
    output = scratch_path(spark, "search")
    data = search_rows(spark, sf_dir)
    train_stage(data, output, SEARCH_INPUTS, "index", ["o_custkey", "year"], SearchSpace(), TRIALS, SEED)
    PipelineModel.load(f"{output}/model")
    runs = read_runs(spark, f"{output}/runs")
    trials = runs.filter("trial >= 0")
    least = trials.agg(F.min_by("params", F.col("metrics")["rmse"]).alias("least"))
    final = runs.filter("trial = -1").select(
        F.to_json("params").alias("final"), F.col("metrics")["test_rmse"].alias("test_rmse")
    )
    checked = least.select(F.to_json("least").alias("least")).join(final, F.lit(True)).select(
        (F.col("least") == F.col("final")).alias("best_is_least"), F.col("test_rmse").isNotNull().alias("tested")
    )
    verdict = checked.first()
    value = lambda *names: F.coalesce(*(F.col("params")[name] for name in names))
    return trials.select(
        "trial",
        F.col("params")["model_type"].alias("model_type"),
        value("lr_regParam", "rf_numTrees", "gbt_maxIter").alias("first"),
        value("lr_elasticNetParam", "rf_maxDepth", "gbt_maxDepth").alias("second"),
        (F.col("metrics")["rmse"] > 0).alias("measured"),
        F.lit(bool(verdict.best_is_least and verdict.tested)).alias("best_is_least"),
        F.lit(data.count()).alias("rows"),
    )


@query()
def mart_training(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stages 3 and 4 together, K8, M9: train on the feature table, then load the saved
    model and score every cell with it."""
    output = scratch_path(spark, "mart_training")
    write_table(build_mart(*mart_inputs(spark, sf_dir), TRADE_COLUMNS), f"{output}/mart")
    mart = read_table(spark, f"{output}/mart")
    inputs = ["density", "ratio_a", "population", "ratio_b"]
    keys = list(TRADE_COLUMNS.keys)
    train_stage(mart, output, inputs, "target_index", keys, SearchSpace(), TRIALS, SEED)
    model = PipelineModel.load(f"{output}/model")
    return model.transform(drop_incomplete(mart, inputs)).select(*keys, "target_index", "prediction")


# Penalties of the path: (reg, mixing).
PATH = ((0.0, 0.0), (0.5, 0.0), (20.0, 0.3), (2000.0, 1.0), (1e9, 1.0))


@query(f"""
with m as (
  select avg(l_quantity) as mx, avg(l_extendedprice) as my, stddev_pop(l_quantity) as sx,
    stddev_pop(l_extendedprice) as sy, corr(l_quantity, l_extendedprice) as r
  from lineitem),
path(reg, mixing) as (values {", ".join(f"({reg}::double, {mixing}::double)" for reg, mixing in PATH)}),
w as (
  select *, sign(r) * greatest(abs(r) - reg / sy * mixing, 0) / (1 + reg / sy * (1 - mixing)) * sy / sx as slope
  from m cross join path)
select reg, mixing, round(slope, 6) as slope, round(my - slope * mx, 4) as intercept from w
""")
def elastic_net_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A line for every penalty from one aggregate, against the closed form of one input."""
    of = moments(load(spark, sf_dir, "lineitem"), ["l_quantity"], "l_extendedprice")
    fits = [(reg, mixing, elastic_net(of, reg, mixing)) for reg, mixing in PATH]
    rows = [(reg, mixing, round(float(fit.coefficients[0]), 6), round(fit.intercept, 4)) for reg, mixing, fit in fits]
    return spark.createDataFrame(rows, "reg double, mixing double, slope double, intercept double")
