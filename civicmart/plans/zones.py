"""The four stages: collect, format, transform, train.

Plain functions of a session and paths, so any scheduler can call them. Each stage reads
the zone before it and rebuilds its own; a failed stage raises and can simply be rerun.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.cleaning import apply_rules, apply_rules_beside_raw, rejected_counts
from ..operators.features import drop_incomplete, heavy_keys, unique_side
from ..operators.ingest import FORMATS, collect, read_landing
from ..operators.regression import hash_split, measures, metric_sums
from ..operators.search import SearchResult, SearchSpace, search
from ..operators.sinks import (
    append_runs,
    write_formatted,
    write_model,
    write_predictions,
    write_table,
)
from ..session import in_parallel, materialise
from ..sources.catalog import CATALOG
from ..sources.readers import explode_records, read_named_file, read_table, skip_marked, union_by_name
from ..sources.spec import SourceSpec
from .mart import MartColumns, build_mart


@dataclass(frozen=True)
class Zones:
    """Base paths, on any file system all executors reach."""

    source: str
    landing: str
    formatted: str
    exploitation: str

    def table(self, name: str) -> str:
        return f"{self.formatted}/{name}"

    def json_copy(self, name: str) -> str:
        return f"{self.formatted}/json/{name}"

    @property
    def mart(self) -> str:
        return f"{self.exploitation}/feature_mart"


def collect_stage(
    spark: SparkSession, zones: Zones, specs: Iterable[SourceSpec] = CATALOG
) -> dict[str, str | None]:
    """Copy new files of every category; returns category -> batch id, None if nothing new."""
    return collect(spark, specs, zones.source, zones.landing)


def formatted_frame(
    spark: SparkSession, spec: SourceSpec, landing: str, quality: Observation | None = None
) -> DataFrame:
    """The formatted table of one category, from all its committed batches."""
    # Whatever format a file of the category came in.
    rows = union_by_name(
        read_landing(spark, landing, spec.category, fmt, spec.raw_schema) for fmt in FORMATS
    )
    if spec.only_file is not None:
        rows = read_named_file(rows, spec.only_file)
    if spec.marker is not None:
        rows = skip_marked(rows, spec.marker, "file_name" if spec.whole_file else None)
    parent = None
    if spec.records is not None:
        parent = "record"
        rows = explode_records(rows, spec.records, parent)
    if quality is None:
        return apply_rules(rows, spec.rules, parent)
    both = apply_rules_beside_raw(rows, spec.rules, parent)
    counted = both.observe(quality, *rejected_counts(spec.rules))
    return counted.select(*[rule.target for rule in spec.rules])


def format_stage(
    spark: SparkSession, zones: Zones, specs: Iterable[SourceSpec] = CATALOG
) -> dict[str, dict[str, int]]:
    """Rebuild the formatted tables and their JSON copies.

    Returns, per table, the row count and the unreadable values per numeric column,
    observed during the write.
    """

    def rebuild(spec: SourceSpec) -> dict[str, int]:
        quality = Observation(spec.table)
        frame = formatted_frame(spark, spec, zones.landing, quality)
        write_formatted(frame, zones.table(spec.table), zones.json_copy(spec.table))
        return quality.get

    specs = list(specs)
    return dict(zip([spec.table for spec in specs], in_parallel(spark, rebuild, specs)))


def transform_stage(
    spark: SparkSession, zones: Zones, columns: MartColumns = MartColumns(), repeated_density: str = "keep"
) -> int:
    """Rebuild the feature table; returns its row count, observed during the write.

    Density is joined row by row: a key it repeats gives as many rows ("keep"). With "refuse" such
    a key fails the stage and is named, with "first" its least row is taken (``unique_side``).
    """
    income, density, immigrants, unemployment = [
        read_table(spark, zones.table(name))
        for name in ("income", "density", "immigrants", "unemployment")
    ]
    if repeated_density != "keep":
        density, _ = unique_side(density, columns.keys, repeated_density)
    heavy = materialise(heavy_keys(income, columns.keys), "heavy")
    mart = build_mart(income, density, immigrants, unemployment, columns, heavy)
    counted = Observation("mart")
    write_table(mart.observe(counted, F.count(F.lit(1)).alias("rows")), zones.mart)
    return counted.get["rows"]


# Model inputs of the built-in feature table.
MODEL_FEATURES = ("net_density", "ratio_immigrants", "population", "ratio_unemployed")

SUMS_SCHEMA = "rows bigint, sse double, variance double, spread double"


@dataclass
class TrainingReport:
    run_id: str
    result: SearchResult
    metrics: Mapping[str, float]


def train_stage(
    data: DataFrame,
    output: str,
    features: Sequence[str] = MODEL_FEATURES,
    label: str = "RDF_index",
    keys: Sequence[str] = ("year", "neighborhood_code"),
    space: SearchSpace = SearchSpace(),
    trials: int = 20,
    seed: int = 42,
    parallelism: int = 8,
    partitions: int | None = None,
) -> TrainingReport:
    """Search on 80 % of the rows, test on the rest; write predictions, model and run log.

    Under ``output``: ``predictions`` (CSV), ``model`` (a fitted pipeline) and ``runs``
    (one row per trial, written when the trial ends, and trial -1 for the final test). The
    test's sums are observed while the predictions are written, so the hold-out is scored once.
    """
    spark = data.sparkSession
    clean = drop_incomplete(data, [label, *features])
    train, test = hash_split(clean, keys, 8, "holdout")
    run_id = uuid.uuid4().hex

    def log(trial: int, params: Mapping[str, object], rmse: float | None) -> None:
        measured = {} if rmse is None else {"rmse": rmse}
        append_runs(spark, f"{output}/runs", [(run_id, trial, params, measured)])

    result = search(
        train, features, label, keys, space, trials, seed, parallelism, partitions, log
    )
    sums = Observation("scored")
    scored = result.model.transform(test).observe(sums, *metric_sums(label))
    write_predictions(scored, f"{output}/predictions")
    final = measures(spark.createDataFrame([sums.get], SUMS_SCHEMA)).first()
    metrics = {
        f"test_{name}": final[name] for name in ("rmse", "r2", "nrmse") if final[name] is not None
    }
    write_model(result.model, f"{output}/model")
    append_runs(spark, f"{output}/runs", [(run_id, -1, result.best_params, metrics)])
    return TrainingReport(run_id, result, metrics)


def run_stages(
    spark: SparkSession,
    zones: Zones,
    specs: Sequence[SourceSpec] = CATALOG,
    **training,
) -> TrainingReport:
    """All four stages in order."""
    collect_stage(spark, zones, specs)
    format_stage(spark, zones, specs)
    transform_stage(spark, zones)
    return train_stage(read_table(spark, zones.mart), f"{zones.exploitation}/model", **training)
