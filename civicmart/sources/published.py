"""Published versions of a table.

``<table>/data-<id>/…`` holds files, and ``<table>/_versions/<number>`` says which folders are a
version of the table. A version is there when its pointer is: pointers are made by one exclusive
create and never changed, so a reader sees the old version or the new one, whatever step a writer
dies at. A pointer whose writer died before its text was complete is passed over.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..session import hadoop_path

FILE_FORMATS = ("parquet", "orc", "json")


class VersionTaken(RuntimeError):
    """Another writer has published the version that this one was about to."""


@dataclass(frozen=True)
class Manifest:
    """``folders``, relative to the table, by the name of the part of the table they hold (one part
    named "" unless the writer deals the table into parts); ``notes`` are the writer's."""

    version: int
    format: str
    schema: str
    folders: dict[str, str]
    notes: dict = field(default_factory=dict)

    def read(self, spark: SparkSession, path: str, parts: Sequence[str] | None = None, **options) -> DataFrame:
        """The rows of the version, or of some parts of it."""
        schema = StructType.fromJson(json.loads(self.schema))
        folders = [f"{path}/{f}" for name, f in self.folders.items() if parts is None or name in parts]
        if not folders:
            return spark.createDataFrame([], schema)
        return spark.read.format(self.format).schema(schema).options(**options).load(folders)


def new_folder() -> str:
    return f"data-{uuid.uuid4().hex}"


def _store(spark: SparkSession, path: str):
    return hadoop_path(spark, path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _numbers(spark: SparkSession, path: str) -> list[int]:
    """Numbers of all pointers, complete or not, highest first."""
    store, folder = _store(spark, path), hadoop_path(spark, f"{path}/_versions")
    if not store.exists(folder):
        return []
    names = [status.getPath().getName() for status in store.listStatus(folder)]
    return sorted((int(name) for name in names if name.isdigit()), reverse=True)


def _manifest(spark: SparkSession, path: str, number: int) -> Manifest | None:
    stream = _store(spark, path).open(hadoop_path(spark, _pointer(path, number)))
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    try:
        return Manifest(**json.loads(text))
    except ValueError:
        return None


def _pointer(path: str, number: int) -> str:
    return f"{path}/_versions/{number:012d}"


def resolve(spark: SparkSession, path: str, version: int | None = None) -> Manifest | None:
    """The version asked for, or the latest; None if the table has never been published."""
    for number in _numbers(spark, path):
        if version in (None, number):
            found = _manifest(spark, path, number)
            if found is not None:
                return found
    if version is not None:
        raise ValueError(f"{path} has no version {version}")
    return None


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the versions that can be read, ascending."""
    found = [number for number in _numbers(spark, path) if _manifest(spark, path, number)]
    return sorted(found)


def publish(
    spark: SparkSession,
    path: str,
    fmt: str,
    schema: StructType,
    folders: dict[str, str],
    notes: dict | None = None,
    after: int | None = None,
) -> int:
    """Publishes complete folders as the next version and gives its number.

    ``after`` is the version that the new one was made from (0 for none): if another writer has
    published since, this one raises ``VersionTaken``. Without it the last writer wins.
    """
    while True:
        highest = max(_numbers(spark, path), default=0)
        if after is not None:
            latest = resolve(spark, path)
            if (latest.version if latest else 0) != after:
                raise VersionTaken(f"{path}: version {latest.version} was published meanwhile")
        number = highest + 1
        manifest = Manifest(number, fmt, schema.json(), folders, notes or {})
        if _create(spark, path, number, json.dumps(asdict(manifest))):
            return number


def _create(spark: SparkSession, path: str, number: int, text: str) -> bool:
    store = _store(spark, path)
    try:
        stream = store.create(hadoop_path(spark, _pointer(path, number)), False)
    except Exception as error:
        # The file system's own exception comes wrapped; whose pointer it is decides.
        if isinstance(error, PySparkException) or not store.exists(hadoop_path(spark, _pointer(path, number))):
            raise
        return False
    stream.write(bytearray(text.encode()))
    stream.close()
    return True


def forget(spark: SparkSession, path: str, keep: int) -> None:
    """Deletes the versions before the last ``keep``, and folders that only they named."""
    store = _store(spark, path)
    found = {number: _manifest(spark, path, number) for number in _numbers(spark, path)}
    whole = [number for number, manifest in found.items() if manifest]
    tops = lambda manifest: {f.split("/")[0] for f in (*manifest.folders.values(), manifest.notes.get("rejected")) if f}
    used = {folder for number in whole[:keep] for folder in tops(found[number])}
    for number in whole[keep:]:
        store.delete(hadoop_path(spark, _pointer(path, number)), False)
        for folder in tops(found[number]) - used:
            store.delete(hadoop_path(spark, f"{path}/{folder}"), True)
