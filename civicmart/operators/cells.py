"""Tree models from the cells of their bins instead of from all rows.

Spark ML cuts each feature into bins before it grows a tree, and from then on a tree sees of a row
its bins, its label and its weight alone. So rows of equal bins, a *cell*, can be summed up once: their
number and mean label give every split the gain, and every leaf the prediction, that the rows give.
There are no more cells than products of bins, however many rows. The trees themselves are Spark ML's.

A forest draws every row for every tree anew, as often as a Poisson variable of mean 1 says. The
draws are made row by row and summed up per cell and tree, so a cell is no less random than its rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence
from contextlib import ExitStack, contextmanager
from dataclasses import dataclass

from pyspark import SparkContext
from pyspark.ml import Model, Pipeline, PipelineModel
from pyspark.ml.feature import Bucketizer
from pyspark.ml.regression import GBTRegressionModel, RandomForestRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from ..session import discard, in_parallel, materialise
from .regression import FEATURES, MODEL_SEED, PREDICTION, feature_stages, kept_rows, make_model

BINS = 32  # What Spark ML's trees have unless told otherwise.
# Values of a feature from which its bins are cut; of more, as many quantiles.
VALUES = 10_000
# Rows that a cell has to hold on average before cells are used: below, they spare too little.
CELL_ROWS = 8
# Cells of a part, and trees of a forest that are grown at a time.
CELL_PART = 10_000
TREES_AT_A_TIME = 6
# Executors that hold the cells, as one alone would have to run all fits.
COPIES = 8
ROWS, WITHIN, TREE, BAGS = "_rows", "_within", "_tree", "_bags"


def cuts(counts: Sequence[tuple[float, float]], bins: int = BINS) -> list[float]:
    """Where a feature is cut, by Spark ML's rule: between all its values if there are no more than
    ``bins``, else where the rows below come nearest to the next multiple of an equal share.
    ``counts`` are (value, rows) by value."""
    middle = [(a[0] / 2 + b[0] / 2) for a, b in zip(counts, counts[1:])]
    if len(counts) <= bins:
        return middle
    share = sum(n for _, n in counts) / bins
    found, below, target = [], counts[0][1], share
    for cut, (_, n) in zip(middle, counts[1:]):
        if abs(below - target) < abs(below + n - target):
            found.append(cut)
            target += share
        below += n
    return found


def value_counts(df: DataFrame, feature: str, most: int = VALUES) -> list[tuple[float, float]]:
    """The values of a feature and how many rows have them; of more than ``most`` values, as many
    quantiles over all rows. At most ``most`` numbers reach the driver."""
    value = F.col(feature).cast("double")
    found = df.groupBy(value.alias("value")).agg(F.count(F.lit(1)).alias("n")).limit(most + 1).collect()
    if len(found) > most:
        shares = [(k + 0.5) / most for k in range(most)]
        points = df.agg(F.percentile_approx(value, shares, 10 * most)).first()[0]
        counts: dict[float, float] = {}
        for point in points:
            counts[point] = counts.get(point, 0) + 1
        return sorted(counts.items())
    return sorted((row.value + 0.0, row.n) for row in found)


def binning(df: DataFrame, features: Sequence[str]) -> Bucketizer:
    """The stage that gives each feature the number of its bin."""
    splits = []
    for counts in in_parallel(df.sparkSession, lambda name: value_counts(df, name), features):
        # A tree sends a value equal to its cut to the left, the stage sends it up.
        inner = [math.nextafter(cut, math.inf) for cut in cuts(counts)]
        # One value, or none: a bin that stays empty, as the stage wants two.
        inner = sorted({cut for cut in inner if math.isfinite(cut)}) or [math.nextafter(counts[0][0] if counts else 0.0, math.inf)]
        splits.append([-math.inf, *inner, math.inf])
    return Bucketizer(splitsArray=splits, inputCols=list(features), outputCols=bin_names(features))


def bin_names(features: Sequence[str]) -> list[str]:
    return [f"{name}_bin" for name in features]


def poisson(of: Column) -> Column:
    """A Poisson variable of mean 1 as a function of a hash, a bigint whose values are equally likely."""
    below, chance, limits = 0.0, math.exp(-1), []
    for k in range(1, 19):
        below += chance
        chance /= k
        limits.append(min(int(below * 2**64) - 2**63, 2**63 - 1))
    drawn = F.when(of < limits[0], 0)
    for k, limit in enumerate(limits[1:], 1):
        drawn = drawn.when(of < limit, k)
    return drawn.otherwise(len(limits))


def summed(binned: DataFrame, names: Sequence[str], label: str) -> DataFrame:
    """A row per cell: number of rows, mean label and the variance of labels within it."""
    return binned.groupBy(*names).agg(
        F.count(F.lit(1)).alias(ROWS), F.avg(label).alias(label), F.var_pop(label).alias(WITHIN)
    )


def bagged(binned: DataFrame, names: Sequence[str], label: str, trees: int) -> DataFrame:
    """A row per cell: for every tree that draws any of its rows, how many it draws and their mean label.

    The rows of ``binned`` lie in parts and an order that follow from their values (``dealt_rows``), and
    so do their numbers. What is summed up on the map side has a row per cell and tree. Labels are summed
    up as whole numbers in two parts, as sums of doubles depend on the order in which parts arrive, and by
    their last digit a forest may go another way.
    """
    known = binned.agg(F.count(F.lit(1)).alias("n"), F.max(F.abs(label)).alias("most")).first()
    if known.most is not None and not math.isfinite(known.most):
        raise ValueError(f"label {label} has rows without a finite value")
    # Sums of up to 32 draws of every row stay below 2**62.
    bits = 56 - known.n.bit_length()
    scale = math.ldexp(1.0, min(bits - math.frexp(known.most or 0.0)[1], 1000))
    numbered = binned.select(F.monotonically_increasing_id().alias("_id"), label, *names)
    each = numbered.withColumn(TREE, F.explode(F.sequence(F.lit(0), F.lit(trees - 1))))
    each = each.withColumn("_n", poisson(F.xxhash64("_id", TREE, F.lit(MODEL_SEED)))).filter("_n > 0")
    large = F.floor(F.col(label) * scale)
    small = F.floor((F.col(label) * scale - large) * 2.0**bits)
    sums = [F.sum(F.col("_n") * part) for part in (large, small)]
    mean = (sums[0] + sums[1] / 2.0**bits) / F.sum("_n") / scale
    by_tree = each.groupBy(*names, TREE).agg(F.sum("_n").alias("rows"), mean.alias("mean"))
    bags = F.map_from_entries(F.collect_list(F.struct(TREE, F.struct("rows", "mean"))))
    return by_tree.groupBy(*names).agg(bags.alias(BAGS))


@dataclass
class Cells:
    """What trees learn from: cells with scaled bins, their rows, mean label and variance within."""

    table: DataFrame
    bags: DataFrame | None
    scaling: PipelineModel
    names: Sequence[str]
    label: str
    max_bins: int

    def fit(self, params: Mapping[str, object]) -> Model:
        """The trees that ``make_model`` grows from the rows; they read scaled bins (``scaling``)."""
        if params["model_type"] != "rf":
            return self._weighted(params).fit(self.table)
        trees = params["rf_numTrees"]
        alone = {**params, "rf_numTrees": 1, "rf_bootstrap": False}

        def grow(tree: int) -> RandomForestRegressionModel:
            bag = F.col(BAGS)[tree]
            drawn = self.bags.select(FEATURES, bag["rows"].alias(ROWS), bag["mean"].alias(self.label))
            one = self._weighted(alone).setSeed(MODEL_SEED + tree)
            # What Spark takes for forests of more than one tree.
            one = one.setFeatureSubsetStrategy("onethird" if trees > 1 else "all")
            return one.fit(drawn.filter(F.col(ROWS) > 0))

        grown = in_parallel(self.table.sparkSession, grow, range(trees), TREES_AT_A_TIME)
        return forest_of(grown, params, self.label)

    def _weighted(self, params: Mapping[str, object]):
        return make_model(params, self.label).setWeightCol(ROWS).setMaxBins(self.max_bins)

    @contextmanager
    def checked(self, rows: DataFrame) -> Iterator[CheckedCells]:
        """Other rows, to measure models on."""
        binned = self.scaling.stages[0].transform(with_labels(rows, self.label))
        table = materialise(summed(binned, self.names, self.label), "checked-cells")
        with kept_rows(scaled(table, self.scaling, self.names)) as cells:
            sums = cells.agg(F.sum(ROWS).alias("rows"), F.sum(F.col(ROWS) * F.col(WITHIN)).alias("within")).first()
            yield CheckedCells(cells, self.label, sums["rows"] or 0, sums["within"])
        discard(table)


@dataclass
class CheckedCells:
    """Cells of rows that models are measured on. A model gives all rows of a cell one prediction, so
    its squared errors are those of the mean label, and the variance within that no model alters."""

    table: DataFrame
    label: str
    rows: int
    within: float | None

    def rmse(self, model: Model) -> float | None:
        """As ``regression_metrics`` has it over the rows; None if there are none."""
        if not self.rows:
            return None
        error = F.col(self.label) - F.col(PREDICTION)
        between = model.transform(self.table).agg(F.sum(F.col(ROWS) * error * error)).first()[0]
        return math.sqrt((between + self.within) / self.rows)

    def rmse_by_round(self, model: GBTRegressionModel) -> list[float | None]:
        """``rmse`` after each round of boosting."""
        if not self.rows:
            return [None] * model.getNumTrees
        within = self.within / self.rows
        return [math.sqrt(squared + within) for squared in model.evaluateEachIteration(self.table, "squared")]


def with_labels(rows: DataFrame, label: str) -> DataFrame:
    """Rows whose missing labels are no numbers: models refuse these, and a mean would not show nulls."""
    return rows.withColumn(label, F.coalesce(F.col(label).cast("double"), F.lit(math.nan)))


def scaled(table: DataFrame, scaling: PipelineModel, names: Sequence[str]) -> DataFrame:
    """Cells with their vector, in parts and an order that follow from their bins."""
    parts = max(1, math.ceil(table.count() / CELL_PART))
    dealt = table.repartition(parts, *names).sortWithinPartitions(*names)
    others = [column for column in table.columns if column not in names]
    return PipelineModel(scaling.stages[1:]).transform(dealt).select(FEATURES, *others)


@contextmanager
def cells_of(rows: DataFrame, features: Sequence[str], label: str, trees: int) -> Iterator[Cells | None]:
    """The cells of ``rows``, kept rows in the layout of ``dealt_rows``, with draws for forests of up to
    ``trees`` trees. None where cells would hold fewer than ``CELL_ROWS`` rows on average, or a
    feature is no number but a vector or a boolean."""
    if not all(isinstance(rows.schema[name].dataType, NumericType) for name in features):
        yield None
        return
    names = bin_names(features)
    bins = binning(rows, features)
    binned = bins.transform(with_labels(rows, label))
    written = [materialise(summed(binned, names, label), "cells")]
    size = written[0].agg(F.count(F.lit(1)).alias("cells"), F.sum(ROWS).alias("rows")).first()
    if not size.cells or size["rows"] < CELL_ROWS * size.cells:
        discard(*written)
        yield None
        return
    scaling = Pipeline(stages=[bins, *feature_stages(names)]).fit(rows)
    if trees:
        written.append(materialise(bagged(binned, names, label, trees), "bags"))
    # Spark looks for bins in max_bins squared rows: none of the cells is left out.
    max_bins = max(BINS, math.isqrt(size.cells) + 1)
    with ExitStack() as kept:
        table, *bags = [kept.enter_context(kept_rows(scaled(one, scaling, names), COPIES)) for one in written]
        for one in (table, *bags):
            one.count()  # Before many fits ask for it at the same time.
        yield Cells(table, bags[0] if bags else None, scaling, names, label, max_bins)
    discard(*written)


def forest_of(trees: Sequence[RandomForestRegressionModel], params: Mapping[str, object], label: str):
    """One forest of forests with a tree each."""
    first, context = trees[0], SparkContext.getOrCreate()
    gateway, kinds = context._gateway, context._jvm.org.apache.spark.ml.regression
    grown = gateway.new_array(kinds.DecisionTreeRegressionModel, len(trees))
    for place, tree in enumerate(trees):
        grown[place] = tree._java_obj.trees()[0]
    forest = RandomForestRegressionModel(kinds.RandomForestRegressionModel(first.uid, grown, first.numFeatures))
    names = {"featuresCol": FEATURES, "labelCol": label, "predictionCol": PREDICTION}
    return forest._set(numTrees=len(trees), maxDepth=params["rf_maxDepth"], seed=MODEL_SEED, **names)
