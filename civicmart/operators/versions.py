"""Versions of raw files: which files of a folder are new, changed, the same, or only renamed.

A file is known by category, name and the digest of its content. Content is read only of files
whose length or time of change differs from what the ledger has, by tasks; the driver gets names.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.readers import escape_glob, with_file_name
from ..sources.spec import SourceSpec


@dataclass(frozen=True)
class FileMark:
    """What the ledger keeps of a file beside its name. ``status`` and ``batch_id`` are set for
    files that are entered without being copied."""

    digest: str | None = None
    version: int = 1
    length: int | None = None
    modified: datetime | None = None
    reason: str | None = None
    status: str | None = None
    batch_id: str | None = None


def list_marked_files(spark: SparkSession, folder: str) -> DataFrame:
    """(file_name, path, length, modified) of the visible files of a folder, none of them opened."""
    files = spark.read.format("binaryFile").load(folder)
    return with_file_name(files.select("path", "length", F.col("modificationTime").alias("modified"), "_metadata"))


def digests(spark: SparkSession, paths: Sequence[str], whole: bool) -> DataFrame:
    """(file_name, digest) of files. ``whole`` files are hashed as they are, each by one task, as
    they are read by one anyway. Files of lines are summed up line by line wherever their blocks
    are read: a digest of how many lines there are and of two sums of hashes, which does not see
    in what order lines come. A file without lines has a digest of its own."""
    if whole:
        content = with_file_name(spark.read.format("binaryFile").load(list(paths)).select("content", "_metadata"))
        return content.select("file_name", F.sha2("content", 256).alias("digest"))
    lines = with_file_name(spark.read.text(list(paths)).select("value", "_metadata"))
    wide = lambda column: F.sum(column.cast("decimal(38,0)"))
    sums = F.count(F.lit(1)), wide(F.xxhash64("value")), wide(F.xxhash64(F.lit("again"), "value"))
    return lines.groupBy("file_name").agg(F.sha2(F.concat_ws(":", *sums), 256).alias("digest"))


def fresh_versions(
    spark: SparkSession, spec: SourceSpec, folder: str, ledger: DataFrame
) -> tuple[list[tuple[str, str]], dict[str, FileMark]]:
    """Files to copy as (name, path), and a mark for each of them and for those to enter only.

    To copy are names the ledger does not have, and those whose content it does not have under
    them. A file whose content is that of its last version is entered as unchanged, so that its
    new time is known. A new name with the content of a collected file that has gone from the
    folder is that file, renamed; of several such names, the first.
    """
    # The latest entry of each name that says something about content.
    known = ledger.filter("status in ('collected', 'unchanged', 'renamed', 'rejected')")
    order = F.struct("version", F.col("modified").isNotNull(), "modified", "batch_id")
    last = known.groupBy("file_name").agg(F.max_by(F.struct("digest", "version", "length", "modified", "batch_id"), order).alias("last"))
    listing = list_marked_files(spark, folder)
    last = last.withColumnRenamed("file_name", "known_name")
    both = listing.join(last, listing["file_name"] == last["known_name"], "left")
    same = F.col("length").eqNullSafe(F.col("last.length")) & F.col("modified").eqNullSafe(F.col("last.modified"))
    touched = both.filter(F.col("known_name").isNull() | ~same).select("file_name", "path", "length", "modified", "last").collect()
    if not touched:
        return [], {}
    names = {row.file_name: row for row in touched}
    found = {}
    for whole in (False, True):
        paths = [escape_glob(r.path) for r in touched if whole == (r.file_name.endswith(".json") and spec.multi_line)]
        if paths:
            found |= {row.file_name: row.digest for row in digests(spark, paths, whole).collect()}
    gone = last.join(listing.select(F.col("file_name").alias("known_name")), "known_name", "left_anti")
    gone = {row.last.digest: row for row in gone.filter("last.digest is not null").orderBy(F.desc("known_name")).collect()}
    files, marks = [], {}
    for name in sorted(names):
        row, digest = names[name], found.get(name, "")
        mark = {"digest": digest, "length": row.length, "modified": row.modified}
        if row.last is None and digest and digest in gone:
            old = gone.pop(digest)
            mark |= {"status": "renamed", "reason": f"was {old.known_name}", "version": old.last.version, "batch_id": old.last.batch_id}
        elif row.last is not None and row.last.digest == digest:
            mark |= {"status": "unchanged", "version": row.last.version, "batch_id": row.last.batch_id}
        else:
            files.append((name, row.path))
            mark |= {"version": 1 if row.last is None else row.last.version + 1}
        marks[name] = FileMark(**mark)
    return files, marks


def file_versions(ledger: DataFrame) -> DataFrame:
    """(file_name, version, status, batch_id, reason) of a ledger, every version of every file."""
    return ledger.select("file_name", "version", "status", "batch_id", "reason")
