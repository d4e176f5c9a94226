"""Seeded random search over three model families."""

from __future__ import annotations

import math
import random
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import ExitStack, contextmanager
from dataclasses import dataclass, field
from functools import cache
from threading import Lock

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import DataFrame

from ..session import in_parallel
from .cells import Cells, cells_of
from .linear_path import Moments, elastic_net, linear_rmse, moments
from .regression import (
    FEATURES,
    dealt_rows,
    feature_stages,
    hash_split,
    kept_rows,
    make_model,
    model_chain,
    regression_metrics,
)


@dataclass(frozen=True)
class SearchSpace:
    """Ranges to draw from; ends included."""

    # Model families and ranges.
    families: tuple[str, ...] = ("lr", "rf", "gbt")
    lr_regParam: tuple[float, float] = (0.001, 10.0)  # log-uniform
    lr_elasticNetParam: tuple[float, float] = (0.0, 1.0)
    rf_numTrees: tuple[int, int] = (10, 100)
    rf_maxDepth: tuple[int, int] = (5, 20)
    gbt_maxIter: tuple[int, int] = (10, 100)
    gbt_maxDepth: tuple[int, int] = (3, 10)

    def draw(self, trial: int, seed: int) -> dict[str, object]:
        """The parameters of one trial, a function of trial number and seed alone."""
        rng = random.Random(f"{seed}/{trial}")
        family = rng.choice(self.families)
        params: dict[str, object] = {"model_type": family}
        if family == "lr":
            low, high = self.lr_regParam
            params["lr_regParam"] = math.exp(rng.uniform(math.log(low), math.log(high)))
            params["lr_elasticNetParam"] = rng.uniform(*self.lr_elasticNetParam)
        elif family == "rf":
            params["rf_numTrees"] = rng.randint(*self.rf_numTrees)
            params["rf_maxDepth"] = rng.randint(*self.rf_maxDepth)
        else:
            params["gbt_maxIter"] = rng.randint(*self.gbt_maxIter)
            params["gbt_maxDepth"] = rng.randint(*self.gbt_maxDepth)
        return params


# Rows of a part that a trial learns from. A fit runs a job for every level of its trees, and each
# part of it sends sums for every node: more parts than the rows need cost more than they save.
PART_ROWS = 50_000


def passes(params: Mapping[str, object]) -> int:
    """Jobs of a fit that follow one another, about."""
    if params["model_type"] == "gbt":
        return params["gbt_maxIter"] * params["gbt_maxDepth"]
    return params["rf_maxDepth"] if params["model_type"] == "rf" else 0


def shared_fits(drawn: Sequence[Mapping[str, object]]) -> list[list[int]]:
    """Trials by the fit that serves them, fits of most jobs in a row first.

    Boosting adds tree to tree, and none depends on those to come: at equal depth, the model of
    fewer rounds is the beginning of the model of more, and its error a step of the other's.
    """
    fits: dict[object, list[int]] = {}
    for trial, params in enumerate(drawn):
        of_fit = trial
        if params["model_type"] == "gbt":
            of_fit = frozenset((name, value) for name, value in params.items() if name != "gbt_maxIter")
        fits.setdefault(of_fit, []).append(trial)
    return sorted(fits.values(), key=lambda of: -max(passes(drawn[trial]) for trial in of))


@contextmanager
def tree_cells(
    dealt: DataFrame, features: Sequence[str], label: str, drawn: Sequence[Mapping[str, object]]
) -> Iterator[Cells | None]:
    """The cells that serve all trials with trees; None if there is no such trial, or little to sum up."""
    if not any(passes(params) for params in drawn):
        yield None
        return
    trees = max(params.get("rf_numTrees", 0) for params in drawn)
    with ExitStack() as kept:
        with kept_rows(dealt) as rows:
            cells = kept.enter_context(cells_of(rows, features, label, trees))
        yield cells


@dataclass
class SearchResult:
    best_params: dict[str, object]
    best_rmse: float
    model: PipelineModel
    trials: list[tuple[dict[str, object], float]] = field(default_factory=list)


def search(
    train: DataFrame,
    features: Sequence[str],
    label: str,
    keys: Sequence[str],
    space: SearchSpace = SearchSpace(),
    trials: int = 20,
    seed: int = 42,
    parallelism: int = 8,
    partitions: int | None = None,
    log: Callable[[int, Mapping[str, object], float | None], None] | None = None,
) -> SearchResult:
    """Fit ``trials`` parameter sets on 70 % of ``train``, keep the lowest RMSE on the
    other 30 %, and refit that set on all of it.

    All trials share one split, so their errors are comparable. Trials with trees share its cells
    (``cells``): the rows are read once, and a fit then costs the same however many there are.
    Where cells would hold few rows, they share one scaled copy of the rows: the assembler and scaler
    run once, and the trials read label and feature vector only, from executor storage that spills
    to disk. ``parallelism`` trials submit their
    jobs at the same time, those with most jobs in a row first, so the tail of one fit does not
    leave the cluster idle. Rows lie in as many parts as they need (``PART_ROWS``), or in
    ``partitions``.
    Linear trials have no job of their own: two aggregates, made when the first comes up, serve
    them all (``linear_path``). Boosted trials of equal depth share a fit (``shared_fits``). ``log`` is called with each trial as it ends, from the thread that ran it. A trial whose
    error is not a finite number cannot win.
    """
    fit_part, check_part = hash_split(train, keys, 7, "validation")
    drawn = [space.draw(trial, seed) for trial in range(trials)]
    dealt = dealt_rows(fit_part.select(label, *features), partitions, PART_ROWS)
    with ExitStack() as kept:
        cells = kept.enter_context(tree_cells(dealt, features, label, drawn))
        if cells is not None:
            check_cells = kept.enter_context(cells.checked(check_part.select(label, *features)))
        else:
            scaling = Pipeline(stages=feature_stages(features)).fit(fit_part)
            fit_rows, check_rows = [
                kept.enter_context(kept_rows(scaling.transform(rows).select(label, FEATURES)))
                for rows in (dealt, check_part)
            ]

        # Penalties are on features at unit deviation, so the scaler's part is no different here.
        one_at_a_time = Lock()

        @cache
        def linear_moments() -> tuple[Moments, Moments]:
            return tuple(moments(part.select(label, *features), features, label) for part in (fit_part, check_part))

        def errors(of_fit: Sequence[int]) -> list[float | None]:
            longest = drawn[max(of_fit, key=lambda trial: passes(drawn[trial]))]
            if longest["model_type"] == "lr":
                with one_at_a_time:
                    learned, checked = linear_moments()
                fit = elastic_net(learned, longest["lr_regParam"], longest["lr_elasticNetParam"])
                return [linear_rmse(checked, fit)]
            if cells is not None:
                model = cells.fit(longest)
                if len(of_fit) == 1:
                    return [check_cells.rmse(model)]
                by_round = check_cells.rmse_by_round(model)
                return [by_round[drawn[trial]["gbt_maxIter"] - 1] for trial in of_fit]
            model = make_model(longest, label).fit(fit_rows)
            if len(of_fit) == 1:
                return [regression_metrics(model.transform(check_rows), label).first()["rmse"]]
            if check_rows.isEmpty():
                return [None] * len(of_fit)
            squared = model.evaluateEachIteration(check_rows, "squared")
            return [math.sqrt(squared[drawn[trial]["gbt_maxIter"] - 1]) for trial in of_fit]

        def attempt(of_fit: Sequence[int]) -> list[float | None]:
            found = errors(of_fit)
            if log is not None:
                for trial, rmse in zip(of_fit, found):
                    log(trial, drawn[trial], rmse)
            return found

        fits = shared_fits(drawn)
        ended = in_parallel(train.sparkSession, attempt, fits, parallelism)
        by_trial = {trial: rmse for of_fit, found in zip(fits, ended) for trial, rmse in zip(of_fit, found)}
        scores = [by_trial[trial] for trial in range(trials)]
    if None in scores:
        raise ValueError("the validation part is empty; too few distinct keys to split")
    finite = [(params, rmse) for params, rmse in zip(drawn, scores) if math.isfinite(rmse)]
    if not finite:
        raise ValueError("no trial gave a finite error")
    best_params, best_rmse = min(finite, key=lambda pair: pair[1])
    dealt = dealt_rows(train.select(label, *features), partitions, PART_ROWS)
    with tree_cells(dealt, features, label, [best_params]) as cells:
        if cells is not None:
            model = PipelineModel([*cells.scaling.stages, cells.fit(best_params)])
        else:
            with kept_rows(dealt) as rows:
                model = model_chain(best_params, features, label).fit(rows)
    return SearchResult(best_params, best_rmse, model, list(zip(drawn, scores)))
