"""Sinks. Every write is distributed; no rows pass through the driver."""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterable, Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    MapType,
    StringType,
    StructField,
    StructType,
)

from ..functions.cleaning import FAILED, RAW_TEXT
from ..session import hadoop_path
from ..sources.published import FILE_FORMATS, forget, new_folder, publish, resolve
from ..sources.readers import OWN_CSV_WRITE, TEXT_OPTIONS, read_table

RUNS_SCHEMA = StructType(
    [
        StructField("run_id", StringType()),
        StructField("trial", IntegerType()),
        StructField("params", MapType(StringType(), StringType())),
        StructField("metrics", MapType(StringType(), DoubleType())),
    ]
)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV part files that ``read_own_csv`` gives back to the letter: white space, empty text,
    nulls, quotes and line breaks."""
    df.write.mode("overwrite").options(**OWN_CSV_WRITE).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(**TEXT_OPTIONS).json(path)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", keep: int = 2, **options) -> None:
    """Replace a table, schema included.

    Files are written to a folder of their own, then published as the table's next version by
    one create: a write that fails at any step leaves the former rows, and readers who began with
    them can go on. The last ``keep`` versions stay. Other formats, such as "delta" (pass
    ``overwriteSchema=True``) or a database, replace in their own way.
    """
    if fmt not in FILE_FORMATS:
        df.write.format(fmt).mode("overwrite").options(**options).save(path)
        return
    spark, folder = df.sparkSession, new_folder()
    df.write.format(fmt).options(**options).save(f"{path}/{folder}")
    publish(spark, path, fmt, df.schema, {"": folder})
    forget(spark, path, keep)


def write_split(df: DataFrame, path: str, fatal: Iterable[str] | None = None, keep: int = 2) -> None:
    """Replace a table by the rows of ``df`` (from ``apply_rules_with_failures``) that have no failure,
    or none among the ``fatal`` targets, and keep the others beside it with their raw text.

    One write parts them. ``read_table`` gives the rows kept, ``read_rejected`` the others; both
    belong to one version of the table.
    """
    spark, folder = df.sparkSession, new_folder()
    reasons = F.col(FAILED) if fatal is None else F.array_intersect(FAILED, F.array(*map(F.lit, fatal)))
    df.withColumn("_rejected", F.size(reasons) > 0).write.partitionBy("_rejected").parquet(f"{path}/{folder}")
    kept = df.drop(FAILED, RAW_TEXT).schema
    # Spark writes no folder for a side without rows.
    sides = {"": f"{folder}/_rejected=false", "rejected": f"{folder}/_rejected=true"}
    store = hadoop_path(spark, path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    there = {name: f for name, f in sides.items() if store.exists(hadoop_path(spark, f"{path}/{f}"))}
    folders = {"": there[""]} if "" in there else {}
    publish(spark, path, "parquet", kept, folders, {"rejected": there.get("rejected"), "schema": df.schema.json()})
    forget(spark, path, keep)


def write_bucketed(df: DataFrame, path: str, keys: Sequence[str], buckets: int) -> DataFrame:
    """Store a table in buckets of its keys, sorted, and read it back. Tables with the same number of
    buckets of the same keys join without a shuffle, as often as they are read; the one shuffle is
    here. Rows of one key lie in one bucket: meant for tables that are summed up by the keys.

    Buckets are known to the session's catalog, under the path's last part, not to the files.
    """
    name = re.sub(r"\W", "_", path.rstrip("/").rsplit("/", 1)[-1])
    dealt = df.repartition(buckets, *keys)
    dealt.write.bucketBy(buckets, *keys).sortBy(*keys).option("path", path).mode("overwrite").saveAsTable(name)
    return df.sparkSession.table(name)


def read_rejected(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The rows that ``write_split`` did not keep, with ``FAILED`` and ``RAW_TEXT``."""
    notes = resolve(spark, path, version).notes
    schema = StructType.fromJson(json.loads(notes["schema"]))
    if notes["rejected"] is None:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{path}/{notes['rejected']}")


def write_formatted(
    df: DataFrame, table_path: str, json_path: str, fmt: str = "parquet", **options
) -> None:
    """One frame to two sinks: the formatted table, then its JSON copy.

    The copy is made from the written table, so raw files are scanned and parsed once,
    nothing is held in executor memory, and the two cannot differ.
    """
    write_table(df, table_path, fmt, **options)
    write_json(read_table(df.sparkSession, table_path, fmt, **options), json_path)


def write_predictions(predictions: DataFrame, path: str) -> None:
    """Scored rows as CSV part files; vectors become array text, as CSV has no arrays."""
    columns = []
    for field in predictions.schema.fields:
        if isinstance(field.dataType, VectorUDT):
            columns.append(F.to_json(vector_to_array(field.name)).alias(field.name))
        else:
            columns.append(F.col(field.name))
    write_csv(predictions.select(*columns), path)


def write_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def append_runs(
    spark: SparkSession,
    path: str,
    rows: Iterable[tuple[str, int, Mapping[str, object], Mapping[str, float]]],
) -> None:
    """Append (run_id, trial, params, metrics) rows to the run log table. Each call writes a
    folder of its own, so trials that end at the same time can be logged at the same time."""
    entries = [
        (run_id, trial, {k: str(v) for k, v in params.items()}, dict(metrics))
        for run_id, trial, params, metrics in rows
    ]
    folder = f"{path}/entry-{uuid.uuid4().hex}"
    spark.createDataFrame(entries, RUNS_SCHEMA).coalesce(1).write.parquet(folder)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUNS_SCHEMA).option("recursiveFileLookup", True).parquet(path)
