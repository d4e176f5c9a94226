"""Raw files under names of their own, for queries that collect them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import hadoop_path, scratch_path


def publish(
    spark: SparkSession, rows: DataFrame, folder: str, prefix: str, suffix: str, fmt: str, numbered: bool = True
) -> None:
    """Writes ``rows`` as files ``<prefix>-<i><suffix>`` of a folder, i counting the tasks that had
    rows, or, of rows in one task, as ``<prefix><suffix>``; files of these names are replaced. Only
    names pass through the driver."""
    parts = scratch_path(spark, "parts")
    rows.write.format(fmt).options(**({"header": True} if fmt == "csv" else {})).save(parts)
    names = [name for name in _names(spark, parts) if name.startswith("part-")]
    _move(spark, {f"{parts}/{name}": f"{folder}/{prefix}{f'-{i:05d}' if numbered else ''}{suffix}" for i, name in enumerate(names)})


def rename(spark: SparkSession, folder: str, prefix: str, other: str) -> None:
    """Gives the files ``<prefix>-...`` of a folder another prefix."""
    names = [name for name in _names(spark, folder) if name.startswith(f"{prefix}-")]
    _move(spark, {f"{folder}/{name}": f"{folder}/{other}{name.removeprefix(prefix)}" for name in names})


def _store(spark: SparkSession, path: str):
    return hadoop_path(spark, path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _names(spark: SparkSession, folder: str) -> list[str]:
    return sorted(s.getPath().getName() for s in _store(spark, folder).listStatus(hadoop_path(spark, folder)))


def _move(spark: SparkSession, moves: dict[str, str]) -> None:
    for source, target in moves.items():
        store = _store(spark, target)
        store.mkdirs(hadoop_path(spark, target).getParent())
        store.delete(hadoop_path(spark, target), False)
        store.rename(hadoop_path(spark, source), hadoop_path(spark, target))
