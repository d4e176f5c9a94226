"""Collecting new raw files into the landing zone, each file (or version of a file) once.

Layout: ``<landing>/<category>/<format>/batch_id=<id>/file_name=<name>/part-*`` plus one
ledger table ``<landing>/_ledger``. A file belongs to the landing zone when its ledger
row exists. The ledger is appended after the data, and readers open only batches the
ledger names, so a run that dies in between leaves an unused folder, not duplicates.

A file that cannot be read does not stop the others: it is entered as quarantined, with the
reason, nothing of it is landed, and the next run tries it again. What a batch's rows look
like is kept beside the ledger: every header and layout found has an id in the registry
``<landing>/_headers``, and the ledger has for each file that of its own header and that of
its batch, so that landed CSV is read back without looking for headers.
"""

from __future__ import annotations

import hashlib
import json
from collections import defaultdict
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime, timezone
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from ..functions.cleaning import quoted
from ..session import hadoop_path, in_parallel
from ..sources.readers import (
    NO_JSON,
    OWN_CSV_WRITE,
    TEXT_OPTIONS,
    csv_headers,
    csv_paths_by_header,
    escape_glob,
    read_csv_by_name,
    read_json_leniently,
    read_json_lines,
    read_own_csv,
    union_by_name,
    with_file_name,
)
from ..sources.spec import SourceSpec, text_fields
from .versions import FileMark, fresh_versions

LEDGER_SCHEMA = text_fields("category", "file_name", "file_format", "batch_id", "status")
# Beside those: why a file is quarantined, or what it was called; ids of its header and of the
# layout of its batch in the registry; its version, and what tells whether it has changed.
DETAILS = StructType(
    [
        *text_fields("reason", "header", "layout", "digest").fields,
        StructField("version", IntegerType()),
        StructField("length", LongType()),
        StructField("modified", TimestampType()),
    ]
)
ENTRIES = StructType(LEDGER_SCHEMA.fields + DETAILS.fields)
LISTING_SCHEMA = text_fields("category", "file_name", "path")
REGISTRY_SCHEMA = StructType([StructField("header", StringType()), StructField("columns", ArrayType(StringType()))])
COLLECTED, REJECTED, QUARANTINED = "collected", "rejected", "quarantined"
UNCHANGED, RENAMED = "unchanged", "renamed"
FORMATS = ("csv", "json")


def new_batch_id() -> str:
    """Sortable, and free of the spaces and colons that break path globs."""
    return datetime.now(timezone.utc).strftime("%Y%m%dT%H%M%S%f")


def list_files(spark: SparkSession, folders: Mapping[str, str]) -> DataFrame:
    """(category, file_name, path) of the visible files directly in each category's folder.

    Uses Spark's own file index, which works on every Hadoop file system and lists large
    folders in parallel; no file is opened. Names starting with "_" or "." are hidden.
    """
    rows = []
    for category, folder in folders.items():
        for uri in spark.read.format("binaryFile").load(folder).inputFiles():
            path = unquote(uri)
            rows.append((category, path.rsplit("/", 1)[-1], path))
    return spark.createDataFrame(rows, LISTING_SCHEMA)


def new_files(listing: DataFrame, ledger: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``listing`` whose keys the ledger does not hold.

    The ledger is reduced to distinct keys first, so a key it holds many times is shuffled
    once per map task.
    """
    return listing.join(ledger.select(*keys).distinct(), list(keys), "left_anti")


def read_ledger(spark: SparkSession, landing: str, category: str | None = None) -> DataFrame:
    """The ledger, or one category's part of it; empty before the first run. An unreadable
    ledger raises: taking it for empty would collect everything twice."""
    path = f"{landing}/_ledger" if category is None else ledger_path(landing, category)
    return _read_log(spark, path, ENTRIES).fillna(1, "version")


def _read_log(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    try:
        return spark.read.schema(schema).option("recursiveFileLookup", True).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def settled(ledger: DataFrame) -> DataFrame:
    """Entries of files that need no other try."""
    return ledger.filter(F.col("status") != QUARANTINED)


def ledger_path(landing: str, category: str) -> str:
    """Each category has its own folder, as two jobs must not append to one at a time."""
    return f"{landing}/_ledger/{category}"


def append_ledger(entries: DataFrame, landing: str, category: str) -> None:
    entries.coalesce(1).write.mode("append").parquet(ledger_path(landing, category))


def file_format(name: str) -> str | None:
    """Format by extension, or None for a file nobody can read."""
    return next((fmt for fmt in FORMATS if name.endswith(f".{fmt}")), None)


# -- the registry of headers ----------------------------------------------------------------


def header_id(columns: Sequence[str]) -> str:
    return hashlib.md5(json.dumps(list(columns)).encode()).hexdigest()


def read_registry(spark: SparkSession, landing: str, category: str) -> DataFrame:
    """(header, columns) of every header and layout of a category."""
    return _read_log(spark, f"{landing}/_headers/{category}", REGISTRY_SCHEMA).dropDuplicates(["header"])


def header_history(spark: SparkSession, landing: str, category: str) -> DataFrame:
    """(header, columns, first_batch, last_batch, n_files, added, removed) of every header that
    collected CSV files of a category have had, with the columns it adds to and lacks against the
    one that came before it."""
    ledger = read_ledger(spark, landing, category).filter(F.col("status") == COLLECTED)
    spans = ledger.filter("header is not null").groupBy("header").agg(
        F.min("batch_id").alias("first_batch"),
        F.max("batch_id").alias("last_batch"),
        F.count(F.lit(1)).alias("n_files"),
    )
    known = spans.join(read_registry(spark, landing, category), "header")
    # As many rows as there are headers, which a person has thought of one by one.
    before = F.lag("columns").over(Window.orderBy("first_batch", "header"))
    none = F.array().cast("array<string>")
    return known.withColumn("before", F.coalesce(before, F.col("columns"))).select(
        "header",
        "columns",
        "first_batch",
        "last_batch",
        "n_files",
        F.coalesce(F.array_except("columns", "before"), none).alias("added"),
        F.coalesce(F.array_except("before", "columns"), none).alias("removed"),
    )


# -- collecting -----------------------------------------------------------------------------


def collect(
    spark: SparkSession,
    specs: Iterable[SourceSpec],
    source: str,
    landing: str,
    batch_id: str | None = None,
) -> dict[str, str | None]:
    """Copy the files the ledger does not know, from ``<source>/<category>`` for each spec.

    Returns category -> batch id, None where nothing was new. One listing and one
    anti-join serve all categories; the categories are then copied at the same time, and
    each is committed to the ledger when its own data is complete. Quarantined files are
    tried again. Of a ``versioned`` category, files whose content has changed are new.
    """
    specs = list(specs)
    plain = [spec for spec in specs if not spec.versioned]
    listing = list_files(spark, {spec.category: f"{source}/{spec.category}" for spec in plain})
    fresh = new_files(listing, settled(read_ledger(spark, landing)), ["category", "file_name"])
    # File names only; Spark's file index holds the same names on the driver.
    found: dict[str, list[tuple[str, str]]] = defaultdict(list)
    for row in fresh.collect():
        found[row.category].append((row.file_name, row.path))
    batch_id = batch_id or new_batch_id()

    def copy(spec: SourceSpec) -> str | None:
        files, marks = found[spec.category], None
        if spec.versioned:
            folder = f"{source}/{spec.category}"
            files, marks = fresh_versions(spark, spec, folder, read_ledger(spark, landing, spec.category))
        if not files and not marks:
            return None
        copy_files(spark, spec, files, landing, batch_id, marks)
        return batch_id if files else None

    return dict(zip([spec.category for spec in specs], in_parallel(spark, copy, specs)))


@dataclass
class _Copied:
    """What came of the files of one format: reasons of those that are quarantined, ids of the
    headers of the others, the layout they were landed in, and entries for the registry."""

    reasons: dict[str, str]
    headers: dict[str, str]
    layout: str | None
    registry: dict[str, Sequence[str]]


def copy_files(
    spark: SparkSession,
    spec: SourceSpec,
    files: Sequence[tuple[str, str]],
    landing: str,
    batch_id: str,
    marks: Mapping[str, FileMark] | None = None,
) -> None:
    """Copy (name, path) files of one category into a batch, then commit it.

    One scan and one write per format, whatever the number of files. Rows stay in the
    tasks that read them: the write is partitioned by file name without a shuffle, so a
    file holding most of the rows is still written by all the tasks that scan it.
    Files of other types are entered in the ledger as rejected and not copied, and files
    that cannot be read as quarantined. ``marks`` has more to enter about a file, and files
    to enter without copying them.
    """
    marks = dict(marks or {})
    entries, registry = [], {}

    def enter(name, fmt, status, batch=batch_id, reason=None, header=None, layout=None):
        mark = marks.get(name, FileMark())
        details = reason or mark.reason, header, layout, mark.digest, mark.version, mark.length, mark.modified
        entries.append((spec.category, name, fmt, batch, status, *details))

    for fmt in FORMATS:
        members = {name: path for name, path in files if file_format(name) == fmt}
        if not members:
            continue
        target = batch_path(landing, spec.category, fmt, batch_id)
        done = (_copy_csv if fmt == "csv" else _copy_json)(spark, spec, members, target)
        registry |= done.registry
        for name in members:
            if name in done.reasons:
                enter(name, fmt, QUARANTINED, reason=done.reasons[name])
            else:
                enter(name, fmt, COLLECTED, header=done.headers.get(name), layout=done.layout)
    names = {name for name, _ in files}
    for name in names:
        if file_format(name) is None:
            enter(name, None, REJECTED)
    for name, mark in marks.items():
        if name not in names:
            enter(name, file_format(name), mark.status, mark.batch_id)
    if registry:
        known = spark.createDataFrame(list(registry.items()), REGISTRY_SCHEMA)
        known.coalesce(1).write.mode("append").parquet(f"{landing}/_headers/{spec.category}")
    append_ledger(spark.createDataFrame(entries, ENTRIES), landing, spec.category)


def _copy_csv(spark: SparkSession, spec: SourceSpec, members: Mapping[str, str], target: str) -> _Copied:
    """Files whose header names a column twice, or comes after a blank block, are quarantined."""
    declared = spec.raw_schema if spec.file_format == "csv" else None
    lines = {"multiLine": True} if spec.quoted_lines else {}
    found, late = csv_headers(spark, [escape_glob(path) for path in members.values()])
    name_of = lambda path: path.rsplit("/", 1)[-1]
    reasons = {name_of(path): "no header in the first block" for path in late}
    good: dict[tuple[str, ...], list[str]] = {}
    for header, paths in found.items():
        twice = sorted({column for column in header if header.count(column) > 1})
        if twice:
            reasons |= {name_of(path): f"columns named twice: {', '.join(twice)}" for path in paths}
        else:
            good[header] = paths
    headers = {name_of(path): header_id(header) for header, paths in good.items() for path in paths}
    registry = {header_id(header): list(header) for header in good}
    groups = {header: [escape_glob(path) for path in paths] for header, paths in good.items()}
    rest = [escape_glob(path) for name, path in members.items() if name not in reasons]
    if not rest:
        return _Copied(reasons, headers, None, registry)
    raw = read_csv_by_name(spark, rest, declared, file_names=True, keep_all=True, headers=groups, **lines)
    columns = write_batch(raw, "csv", target)
    return _Copied(reasons, headers, header_id(columns), registry | {header_id(columns): columns})


def _copy_json(spark: SparkSession, spec: SourceSpec, members: Mapping[str, str], target: str) -> _Copied:
    """Files with text that is no JSON are quarantined; good and bad documents part in one write,
    and the text of the bad ones stays in a folder beside the batch."""
    raw = read_raw(spark, [escape_glob(path) for path in members.values()], "json", spec)
    if NO_JSON not in raw.columns:
        write_batch(raw, "json", target)
        return _Copied({}, {}, None, {})
    base, batch = target.rsplit("/batch_id=", 1)
    kind = F.when(F.col(NO_JSON).isNull(), batch).otherwise(f"quarantine-{batch}")
    writer = raw.withColumn("batch_id", kind).write.mode("overwrite").partitionBy("batch_id", "file_name")
    # Of the folders below, only those of this batch are replaced.
    writer.option("partitionOverwriteMode", "dynamic").options(**TEXT_OPTIONS).json(base)
    aside = f"{base}/batch_id=quarantine-{batch}"
    text = read_json_lines(spark, [aside], text_fields(NO_JSON, "file_name"), basePath=aside)
    bad = text.groupBy("file_name").agg(F.count(F.lit(1)).alias("n"), F.min(F.substring(NO_JSON, 1, 60)).alias("text"))
    reasons = {row.file_name: f"{row.n} not JSON: {row.text}" for row in bad.collect()}
    _delete_files(spark, target, set(reasons))
    return _Copied(reasons, {}, None, {})


def _delete_files(spark: SparkSession, batch: str, names: set[str]) -> None:
    """Deletes the folders of files from a batch that is not committed yet."""
    folder = hadoop_path(spark, batch)
    store = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if store.exists(folder):
        for status in store.listStatus(folder):
            path = status.getPath()
            if unquote(path.getName().removeprefix("file_name=")) in names:
                store.delete(path, True)


def read_raw(spark: SparkSession, paths: Sequence[str], fmt: str, spec: SourceSpec) -> DataFrame:
    """Raw files with all the fields found in them, those the spec declares (for this format)
    first, and ``file_name``. Fields nobody declared are landed too, so that a later spec can
    use them: a file is collected only once. Text that is no JSON is in ``NO_JSON``."""
    declared = spec.raw_schema if spec.file_format == fmt else None
    if fmt == "csv":
        lines = {"multiLine": True} if spec.quoted_lines else {}
        return read_csv_by_name(spark, paths, declared, file_names=True, keep_all=True, **lines)
    return with_file_name(read_json_leniently(spark, paths, spec.multi_line))


def batch_path(landing: str, category: str, fmt: str, batch_id: str) -> str:
    return f"{landing}/{category}/{fmt}/batch_id={batch_id}"


def write_batch(df: DataFrame, fmt: str, path: str) -> list[str]:
    """Overwrites its own batch folder only, so repeating a batch replaces it. Gives the columns
    of the files written."""
    if df.columns == ["file_name"]:
        # Files without any field. Nulls are left out of JSON, and such a CSV has no rows.
        df = df.withColumn("_none", F.lit(None).cast("string"))
    writer = df.write.mode("overwrite").partitionBy("file_name")
    if fmt == "csv":
        writer.options(**OWN_CSV_WRITE).csv(path)
    else:
        writer.options(**TEXT_OPTIONS).json(path)
    return [name for name in df.columns if name != "file_name"]


# -- reading the landing zone -----------------------------------------------------------------


def committed_batches(spark: SparkSession, landing: str, category: str, fmt: str) -> list[str]:
    """Batch ids the ledger names for a category: one per run that found new files."""
    return sorted(_batch_layouts(spark, landing, category, fmt))


def _batch_layouts(spark: SparkSession, landing: str, category: str, fmt: str) -> dict[str, str | None]:
    """Committed batch ids with the id of the layout of their files, if it is known."""
    rows = _collected(spark, landing, category, fmt).groupBy("batch_id").agg(F.max("layout").alias("layout"))
    return {row.batch_id: row.layout for row in rows.collect()}


def _collected(spark: SparkSession, landing: str, category: str, fmt: str) -> DataFrame:
    ledger = read_ledger(spark, landing, category)
    return ledger.filter((F.col("file_format") == fmt) & (F.col("status") == COLLECTED))


def read_landing(
    spark: SparkSession, landing: str, category: str, fmt: str, schema: StructType
) -> DataFrame:
    """All committed batches of a category as one scan, with ``batch_id`` and ``file_name``
    as partition columns. Of a file that was collected in several versions, the latest."""
    names = [StructField(name, StringType()) for name in ("batch_id", "file_name")]
    full = StructType(schema.fields + names)
    batches = _batch_layouts(spark, landing, category, fmt)
    if not batches:
        return spark.createDataFrame([], full)
    base = f"{landing}/{category}/{fmt}"
    paths = {batch: batch_path(landing, category, fmt, batch) for batch in sorted(batches)}
    if fmt == "json":
        rows = read_json_lines(spark, list(paths.values()), full, basePath=base)
    else:
        groups = _landed_headers(spark, landing, category, batches, paths)
        rows = _landed_csv(spark, groups, schema, names, base)
    return _standing(rows, _collected(spark, landing, category, fmt))


def _landed_headers(
    spark: SparkSession, landing: str, category: str, batches: Mapping[str, str | None], paths: Mapping[str, str]
) -> dict[tuple[str, ...], list[str]]:
    """Paths of landed CSV by columns, from the registry; the files of batches that were landed
    before there was one are asked."""
    columns = {row.header: tuple(row.columns) for row in read_registry(spark, landing, category).collect()}
    groups: dict[tuple[str, ...], list[str]] = defaultdict(list)
    old = []
    for batch, path in paths.items():
        if batches[batch] in columns:
            groups[columns[batches[batch]]].append(path)
        else:
            old.append(path)
    for header, files in csv_paths_by_header(spark, old, recursiveFileLookup=True).items():
        groups[header] += files
    return groups


def _landed_csv(
    spark: SparkSession,
    groups: Mapping[tuple[str, ...], list[str]],
    schema: StructType,
    names: list[StructField],
    base: str,
) -> DataFrame:
    """Landed CSV by name: a batch has the declared columns and whatever its files had beside."""
    frames = []
    for header, files in groups.items():
        full = StructType(text_fields(*header).fields + names)
        frame = read_own_csv(spark, files, full, basePath=base)
        absent = {f.name: F.lit(None).cast("string") for f in schema.fields if f.name not in header}
        frame = frame.withColumns(absent)
        columns = [quoted(f.name).cast(f.dataType).alias(f.name) for f in schema.fields]
        frames.append(frame.select(*columns, "batch_id", "file_name"))
    if not frames:
        return spark.createDataFrame([], StructType(schema.fields + names))
    return union_by_name(frames)


def _standing(rows: DataFrame, ledger: DataFrame) -> DataFrame:
    """Rows of each file's latest version, and of the first batch that has it: runs that
    overlapped may have landed a file twice."""
    first = F.min(F.struct(-F.col("version"), F.col("batch_id").alias("batch"))).alias("first")
    stands = ledger.groupBy("file_name").agg(first, F.count_distinct("batch_id").alias("n")).filter("n > 1")
    again = ledger.join(stands, "file_name").filter("batch_id != first.batch")
    again = again.select(F.col("batch_id").alias("_batch"), F.col("file_name").alias("_file")).distinct()
    same = (rows["batch_id"] == again["_batch"]) & (rows["file_name"] == again["_file"])
    return rows.join(again, same, "left_anti")
