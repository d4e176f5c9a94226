"""Splits, regression models and metrics on Spark ML."""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.ml import Pipeline
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from ..functions.keys import each_copy, hash_bucket
from ..session import materialise

UNSCALED, FEATURES, PREDICTION = "unscaled_features", "features", "prediction"
MODEL_SEED = 42

def hash_split(
    df: DataFrame, keys: Sequence[str], tenths: int, salt: str | int
) -> tuple[DataFrame, DataFrame]:
    """Two disjoint parts that together hold every row: ``tenths``/10 and the rest.

    Membership depends on the key values only. Copies of a row stay on one side, so a
    repeated row cannot be both learned from and tested on.
    """
    first = in_first_part(df, keys, tenths, salt)
    return df.filter(first), df.filter(~first)


def in_first_part(df: DataFrame, keys: Sequence[str], tenths: int, salt: str | int) -> Column:
    return hash_bucket(df, keys, 10, salt) < tenths


def dealt_rows(df: DataFrame, partitions: int | None = None, rows_a_part: int | None = None) -> DataFrame:
    """The rows of ``df`` in a layout that follows from their values alone.

    Tree building samples by part and order, so the same rows must lie in the same parts in the
    same order on every cluster. Equal rows are counted first, on the map side, and told apart
    by a running number: a row repeated without end is dealt over all parts like any other.
    ``partitions`` is the parallelism of every pass of a fit and part of a model's definition;
    without it, the session's ``spark.sql.shuffle.partitions``, which a cluster sets to a few
    times the cores that its shuffles should use. With ``rows_a_part``, as many parts as hold so
    many rows each, and no more than that setting.
    """
    columns = list(df.columns)
    counted = materialise(df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n")), "counted-rows")
    if partitions is None:
        partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        if rows_a_part is not None:
            rows = counted.agg(F.sum("_n")).first()[0] or 0
            partitions = min(partitions, max(1, math.ceil(rows / rows_a_part)))
    copies = each_copy(counted, "_n", "_copy")
    copies = copies.withColumn("_place", F.xxhash64(*columns, "_copy"))
    dealt = copies.repartition(partitions, "_place").sortWithinPartitions("_place", *columns)
    return dealt.select(*columns)


@contextmanager
def kept_rows(df: DataFrame, copies: int = 1) -> Iterator[DataFrame]:
    """Rows for a fit, which reads them once per tree level or iteration: kept in executor
    memory, then disk; lost blocks are recomputed. Tasks go where a block lies: of a small table
    that many fits read at the same time, ``copies`` executors hold one each, as far as there are."""
    kept = df.persist(StorageLevel(True, True, False, False, copies))
    try:
        yield kept
    finally:
        kept.unpersist()


def feature_stages(features: Sequence[str]) -> list:
    """Assemble the columns and divide each by its standard deviation, without centring."""
    return [
        VectorAssembler(inputCols=list(features), outputCol=UNSCALED),
        StandardScaler(inputCol=UNSCALED, outputCol=FEATURES, withStd=True, withMean=False),
    ]


def make_model(params: Mapping[str, object], label: str, features: str = FEATURES):
    """The regressor that a parameter set describes."""
    kind = params["model_type"]
    common = {"featuresCol": features, "labelCol": label, "predictionCol": PREDICTION}
    if kind == "lr":
        return LinearRegression(
            regParam=params["lr_regParam"], elasticNetParam=params["lr_elasticNetParam"], **common
        )
    if kind == "rf":
        return RandomForestRegressor(
            numTrees=params["rf_numTrees"],
            maxDepth=params["rf_maxDepth"],
            bootstrap=params.get("rf_bootstrap", True),
            seed=MODEL_SEED,
            **common,
        )
    if kind == "gbt":
        # Boosting chains many jobs on one cached frame; the session's checkpoint folder,
        # where set, cuts that lineage every ten rounds.
        return GBTRegressor(
            maxIter=params["gbt_maxIter"], maxDepth=params["gbt_maxDepth"], seed=MODEL_SEED, **common
        )
    raise ValueError(f"unknown model type {kind!r}")


def model_chain(params: Mapping[str, object], features: Sequence[str], label: str) -> Pipeline:
    """Assembler, scaler and regressor; the scaler learns from the rows passed to fit."""
    return Pipeline(stages=[*feature_stages(features), make_model(params, label)])


def metric_sums(label: str, prediction: str = PREDICTION) -> list[Column]:
    """What the measures need of the scored rows, for ``agg`` or ``observe``."""
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    return [
        F.count(F.lit(1)).alias("rows"),
        F.sum((y - p) * (y - p)).alias("sse"),
        F.var_pop(y).alias("variance"),
        (F.max(y) - F.min(y)).alias("spread"),
    ]


def measures(sums: DataFrame) -> DataFrame:
    """(rows, rmse, r2, nrmse) from the row of ``metric_sums``."""
    rmse = F.sqrt(F.col("sse") / F.when(F.col("rows") > 0, F.col("rows")))
    spread = F.col("spread")
    return sums.select(
        "rows",
        rmse.alias("rmse"),
        (1 - F.try_divide(F.col("sse"), F.col("variance") * F.col("rows"))).alias("r2"),
        F.when(spread != 0, F.try_divide(rmse, spread))
        .when(spread == 0, F.lit(float("inf")))
        .alias("nrmse"),
    )


def regression_metrics(
    scored: DataFrame, label: str, prediction: str = PREDICTION
) -> DataFrame:
    """One row (rows, rmse, r2, nrmse) in a single pass.

    NRMSE is RMSE over the label's range, infinite for a constant label. An empty input
    gives 0 rows and null metrics.
    """
    return measures(scored.agg(*metric_sums(label, prediction)))
