"""Totals kept per key and brought up to date by new batches alone.

A table of totals is a published table dealt into parts by a column of its own choosing, a period
for instance. A batch is summed up by key, and of the kept totals only the parts it touches are
read, added up with it, and written anew; the next version names the new folders of these parts
and the old folders of all others. Which batches a version holds is written in it, so a batch that
is added again, after a crash perhaps, changes nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialise
from ..sources.published import forget, new_folder, publish, resolve

PART = "_part"


def _summed(rows: DataFrame, keys: Sequence[str], sums: Sequence[str]) -> DataFrame:
    return rows.groupBy(PART, *keys).agg(*[F.sum(column).alias(column) for column in sums])


def add_batch(
    rows: DataFrame,
    path: str,
    batch_id: str,
    keys: Sequence[str],
    sums: Sequence[str],
    part: Column,
    keep: int = 2,
) -> int:
    """Adds the rows of a batch to the totals at ``path``; gives the number of the version that
    holds them.

    Sums are of whole numbers or doubles; nulls add nothing, and a total of nothing but nulls is
    null. ``part`` is made of key columns: rows of one key have one part. Names of parts pass
    through the driver, so there should be thousands at most. Two writers at a time: one of them
    raises ``VersionTaken`` and can be run again.
    """
    spark = rows.sparkSession
    last = resolve(spark, path)
    if last is not None and batch_id in last.notes["batches"]:
        return last.version
    fresh = materialise(_summed(rows.withColumn(PART, part.cast("string")), keys, sums), "batch-sums")
    fresh = fresh.fillna("none", PART)
    touched = [row[PART] for row in fresh.select(PART).distinct().collect()]
    merged = fresh
    if last is not None:
        kept = last.read(spark, path, touched).withColumn(PART, F.coalesce(part.cast("string"), F.lit("none")))
        # Sums of sums may be wider, and a table keeps its types.
        merged = _summed(fresh.unionByName(kept.select(*fresh.columns)), keys, sums)
    schema = fresh.drop(PART).schema
    merged = merged.select(PART, *[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])
    folder = new_folder()
    merged.write.partitionBy(PART).parquet(f"{path}/{folder}")
    folders = dict(last.folders) if last is not None else {}
    folders |= {name: f"{folder}/{PART}={_escaped(spark, name)}" for name in touched}
    batches = [*(last.notes["batches"] if last is not None else []), batch_id]
    version = publish(
        spark, path, "parquet", schema, folders, {"batches": batches}, after=last.version if last is not None else 0
    )
    forget(spark, path, keep)
    return version


def _escaped(spark: SparkSession, name: str) -> str:
    """A partition's folder name as Spark writes it."""
    return spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(name)


def read_totals(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The totals with all batches added so far, or those of an earlier version."""
    manifest = resolve(spark, path, version)
    if manifest is None:
        raise ValueError(f"no totals at {path}")
    return manifest.read(spark, path)
