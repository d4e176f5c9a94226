"""The feature table: one row per period and area, from four formatted tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from ..operators.features import (
    grouped_total,
    labelled_total,
    left_chain,
    present,
    with_ratios,
)


@dataclass(frozen=True)
class MartColumns:
    """Which columns play which part. The defaults are the built-in formatted tables'."""

    keys: tuple[str, ...] = ("year", "neighborhood_code")
    carried: tuple[str, ...] = ("district_code", "district_name")
    population: str = "population"
    target: str = "RDF_index"
    densities: tuple[str, ...] = ("density", "net_density")
    required_density: str = "net_density"
    immigrant_value: str = "value"
    unemployed_value: str = "count"
    demand: str = "job_demand"
    # The two spellings of "registered as unemployed".
    accepted_demands: tuple[str, ...] = ("Atur Registrat", "Atur registrat")
    total_immigrants: str = "total_immigrants"
    total_unemployed: str = "total_unemployed"
    ratio_immigrants: str = "ratio_immigrants"
    ratio_unemployed: str = "ratio_unemployed"


def build_mart(
    income: DataFrame,
    density: DataFrame,
    immigrants: DataFrame,
    unemployment: DataFrame,
    columns: MartColumns = MartColumns(),
    heavy: DataFrame | None = None,
) -> DataFrame:
    """Income rows with a target, widened by density and two totals, complete rows only.

    The not-null filter behind the left joins lets Catalyst turn them into inner joins
    and filter each side before its shuffle. The unemployed total adds up every month in
    the data, so it counts person-months, not a yearly average.
    """
    c = columns
    keys = list(c.keys)
    sides = [
        density,
        grouped_total(immigrants, keys, c.immigrant_value, c.total_immigrants),
        labelled_total(
            unemployment, keys, c.unemployed_value, c.total_unemployed, c.demand, c.accepted_demands
        ),
    ]
    joined = left_chain(present(income, c.target), sides, keys, heavy)
    complete = present(joined, c.required_density, c.total_immigrants, c.total_unemployed)
    chosen = [*keys, *c.carried, c.population, c.target, *c.densities]
    return with_ratios(
        complete.select(*chosen, c.total_immigrants, c.total_unemployed),
        {
            c.ratio_immigrants: (c.total_immigrants, c.population),
            c.ratio_unemployed: (c.total_unemployed, c.population),
        },
    )
