"""Every linear trial of a search from one pass over the rows.

A linear model's fit depends on its rows only through their number, means and covariances. These
are summed up on the map side and merged by Spark; what reaches the driver is a matrix with a row
per feature. Any number of penalties is then solved there by coordinate descent, and the error on
other rows follows from the moments of those. Meant for tens of features, not thousands.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Moments:
    """Number of rows, means and covariances (over n, not n - 1) of the features, the label last."""

    n: int
    means: np.ndarray
    covariances: np.ndarray


@dataclass(frozen=True)
class LinearFit:
    coefficients: np.ndarray
    intercept: float


def moments(df: DataFrame, features: Sequence[str], label: str) -> Moments:
    """One aggregate over rows without nulls."""
    names = [*features, label]
    columns = [F.col(name).cast("double") for name in names]
    pairs = [(i, j) for i in range(len(names)) for j in range(i + 1)]
    row = df.agg(
        F.count(F.lit(1)),
        *[F.avg(c) for c in columns],
        *[F.var_pop(columns[i]) if i == j else F.covar_pop(columns[i], columns[j]) for i, j in pairs],
    ).first()
    n, values = row[0], [math.nan if v is None else v for v in row[1:]]
    covariances = np.zeros((len(names), len(names)))
    for (i, j), value in zip(pairs, values[len(names) :]):
        covariances[i, j] = covariances[j, i] = value
    return Moments(n, np.array(values[: len(names)]), covariances)


def elastic_net(of: Moments, reg: float, mixing: float, tolerance: float = 1e-13, rounds: int = 100_000) -> LinearFit:
    """Least squares over 2n plus ``reg * (mixing * |w|_1 + (1 - mixing) / 2 * |w|_2^2)``, with the
    features at unit deviation and ``reg`` in units of the label, as Spark ML has it.

    Features that never vary get 0, and so do all if the label never varies. Coordinates are
    brought to their own optimum in turn until none moves any more.
    """
    deviation = np.sqrt(np.diag(of.covariances))
    # What rounding alone makes of a value that never varies.
    steady = deviation <= 1e-13 * np.abs(of.means)
    spread, free = 0.0 if steady[-1] else deviation[-1], np.flatnonzero(~steady[:-1])
    weights = np.zeros(len(deviation) - 1)
    if spread > 0 and len(free):
        scale = deviation[free]
        gram = of.covariances[np.ix_(free, free)] / np.outer(scale, scale)
        target = of.covariances[free, -1] / (scale * spread)
        lasso, ridge = reg / spread * mixing, reg / spread * (1 - mixing)
        if lasso == 0:
            found = np.linalg.lstsq(gram + ridge * np.eye(len(free)), target, rcond=None)[0]
        else:
            found = np.zeros(len(free))
            for _ in range(rounds):
                moved = 0.0
                for j in range(len(free)):
                    pull = target[j] - gram[j] @ found + gram[j, j] * found[j]
                    value = math.copysign(max(abs(pull) - lasso, 0.0), pull) / (gram[j, j] + ridge)
                    moved, found[j] = max(moved, abs(value - found[j])), value
                if moved <= tolerance:
                    break
        weights[free] = found * spread / scale
    return LinearFit(weights, float(of.means[-1] - weights @ of.means[:-1]))


def linear_rmse(of: Moments, fit: LinearFit) -> float | None:
    """Root mean squared error of a fit over the rows that ``of`` was summed from; None if none."""
    if not of.n:
        return None
    turned = np.append(-fit.coefficients, 1.0)
    bias = of.means[-1] - fit.coefficients @ of.means[:-1] - fit.intercept
    return math.sqrt(max(turned @ of.covariances @ turned, 0.0) + bias**2)
