"""Readers. Many files are always one multi-path scan, matched by name, never a fold
of per-file unions: the plan stays one scan node for any number of files."""

from __future__ import annotations

import csv
import logging
import re
from collections import defaultdict
from collections.abc import Iterable, Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.cleaning import quoted
from .published import FILE_FORMATS, resolve
from .spec import text_fields

log = logging.getLogger(__name__)

# Doubles keep their shortest exact text; timestamps need the microseconds spelled out.
TEXT_OPTIONS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


# CSV of our own making. A null has a mark of its own, as an empty text is no null; the mark is
# a private-use character that no text of ours stands for.
NULL_MARK = "\ue000"
OWN_CSV = {
    **TEXT_OPTIONS,
    "header": True,
    "quote": '"',
    "escape": '"',
    "nullValue": NULL_MARK,
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}
OWN_CSV_WRITE = {**OWN_CSV, "emptyValue": '""'}
# Line breaks inside quotes: a file is read by one task, and was written by one.
OWN_CSV_READ = {**OWN_CSV, "emptyValue": "", "multiLine": True, "lineSep": "\n"}

# What Spark's CSV reader does not skip as a blank line before the header.
TEXT_IN_LINE = r"[^\x00-\x20\ufeff]"


def as_list(paths: str | Sequence[str]) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


def read_csv(
    spark: SparkSession, paths: str | Sequence[str], schema: StructType | str, **options
) -> DataFrame:
    """CSV files with a header line that all have the columns of ``schema``, in its order.

    The header is checked in the tasks: a file with other columns fails the read instead
    of filling the wrong ones.
    """
    return (
        spark.read.schema(schema)
        .options(header=True, enforceSchema=False, **TEXT_OPTIONS)
        .options(**options)
        .csv(as_list(paths))
    )


def read_own_csv(
    spark: SparkSession, paths: str | Sequence[str], schema: StructType | str, **options
) -> DataFrame:
    """What ``write_csv`` wrote."""
    return read_csv(spark, paths, schema, **OWN_CSV_READ, **options)


def read_csv_by_name(
    spark: SparkSession,
    paths: Sequence[str],
    schema: StructType | None = None,
    file_names: bool = False,
    keep_all: bool = False,
    headers: dict[tuple[str, ...], list[str]] | None = None,
    **options,
) -> DataFrame:
    """CSV files whose headers may differ in order or columns, united by name, all text.

    One scan per distinct header, so a single one where nothing drifted. With a schema
    the result has its columns: those a file lacks are null, and the log says so; others are
    left out unless ``keep_all``. ``file_names`` adds the file name, which is out of reach
    behind a union. A header that names a column twice is refused. ``headers``, paths by header,
    spares the job that finds them.
    """
    groups = csv_paths_by_header(spark, paths) if headers is None else headers
    groups = groups or {tuple(schema.names if schema else ()): list(paths)}
    frames = []
    for header, members in groups.items():
        twice = sorted({name for name in header if header.count(name) > 1})
        if twice:
            raise ValueError(f"columns {twice} are named twice in {members[:3]}")
        frame = read_csv(spark, members, text_fields(*header), **options)
        if file_names:
            frame = with_file_name(frame)
        if schema is not None:
            kept = schema.names + ["file_name"] * file_names
            if keep_all:
                kept += [name for name in frame.columns if name not in kept]
            absent = {name: F.lit(None).cast("string") for name in kept if name not in frame.columns}
            if absent:
                log.warning("%d files such as %s lack columns %s", len(members), members[0], list(absent))
            frame = frame.withColumns(absent).select(*map(quoted, kept))
        frames.append(frame)
    return union_by_name(frames)


def csv_paths_by_header(
    spark: SparkSession, paths: Sequence[str], **options
) -> dict[tuple[str, ...], list[str]]:
    """Paths grouped by header, the first line with text; files without any are left out, and
    one whose header is not in its first block is refused, see ``csv_headers``."""
    headers, late = csv_headers(spark, paths, **options)
    if late:
        raise ValueError(f"no header in the first block of {late[:3]}")
    return {names: [escape_glob(path) for path in found] for names, found in headers.items()}


def csv_headers(
    spark: SparkSession, paths: Sequence[str], **options
) -> tuple[dict[tuple[str, ...], list[str]], list[str]]:
    """Plain paths by header, the first line with text, and paths whose header comes too late.

    One job for all files: the first lines of their first blocks are read as text, and only the
    distinct headers with the names of their files come back. Files whose first block is blank
    are read to their end; should text follow, they come too late, as no reader of blocks would
    take their first line for the header. Files without any text are in neither.
    """
    if not paths:
        return {}, []
    lines = spark.read.options(**options).text(list(paths)).select(
        "value",
        F.col("value").rlike(TEXT_IN_LINE).alias("said"),
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"),
    )
    # Null where no line has text.
    first = F.min_by("value", F.when(F.col("said"), F.col("at"))).alias("line")
    by_path = lines.filter("block = 0").groupBy("path").agg(first)
    by_line = by_path.groupBy("line").agg(F.sort_array(F.collect_list("path")).alias("paths"))
    headers: dict[tuple[str, ...], list[str]] = defaultdict(list)
    late: list[str] = []
    for row in by_line.collect():
        found = [unquote(path) for path in row.paths]
        if row.line is None:
            text = spark.read.text([escape_glob(path) for path in found]).filter(F.col("value").rlike(TEXT_IN_LINE))
            late += [unquote(path) for path, in text.select("_metadata.file_path").distinct().collect()]
            continue
        names = next(csv.reader([row.line.rstrip("\r").removeprefix("\ufeff")]))
        headers[tuple(names)] += found
    return headers, late


def escape_glob(path: str) -> str:
    """Reader paths are globs; file names are not."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def _read_json(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: StructType | None,
    multi_line: bool,
    options: dict,
) -> DataFrame:
    options = {"mode": "FAILFAST", **options}
    reader = spark.read.options(multiLine=multi_line, **TEXT_OPTIONS)
    reader = reader.schema(schema) if schema is not None else reader.options(primitivesAsString=True)
    return reader.options(**options).json(as_list(paths))


def read_json_documents(
    spark: SparkSession, paths: str | Sequence[str], schema: StructType | None = None, **options
) -> DataFrame:
    """One JSON document, or one array of them, per file.

    A malformed file fails the read. Without a schema the fields of all files are merged
    by name with text leaves, at the price of a second pass.
    """
    return _read_json(spark, paths, schema, True, options)


def read_json_lines(
    spark: SparkSession, paths: str | Sequence[str], schema: StructType | None = None, **options
) -> DataFrame:
    """One JSON document per line; the files are splittable."""
    return _read_json(spark, paths, schema, False, options)


# Where text that is no JSON goes if a reader is told to go on; no field of ours.
NO_JSON = "_no_json"


def read_json_leniently(
    spark: SparkSession, paths: Sequence[str], multi_line: bool, **options
) -> DataFrame:
    """JSON with the fields of all files; a document (or line) that is none is a row with its text
    in ``NO_JSON``. That column is there only if there is such a row."""
    lenient = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": NO_JSON, **options}
    rows = _read_json(spark, paths, None, multi_line, lenient)
    if rows.columns == [NO_JSON]:
        # Spark does not give back that column alone.
        rows = _read_json(spark, paths, text_fields("_none", NO_JSON), multi_line, lenient)
    return rows


def read_table(
    spark: SparkSession, path: str, fmt: str = "parquet", version: int | None = None, **options
) -> DataFrame:
    """A formatted or mart table, its latest published version or the one asked for. Any installed
    connector works as ``fmt``: "delta" for a path, "mongodb" with its ``database`` and
    ``collection`` options; a folder of files that was never published is read as it is."""
    if fmt in FILE_FORMATS:
        manifest = resolve(spark, path, version)
        if manifest is not None:
            return manifest.read(spark, path, **options)
    return spark.read.format(fmt).options(**options).load(path)


def read_named_file(df: DataFrame, file_name: str) -> DataFrame:
    """One named file out of all batches. ``file_name`` is a partition column of the
    landing zone, so other files are pruned before any task starts."""
    return df.filter(F.col("file_name") == file_name)


def with_file_name(df: DataFrame) -> DataFrame:
    """Add the plain name of the file each row was read from."""
    encoded = F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B"))
    return df.select("*", F.url_decode(encoded).alias("file_name"))


def union_by_name(frames: Iterable[DataFrame]) -> DataFrame:
    """``UNION ALL`` by column name; a column missing on one side is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def skip_marked(df: DataFrame, marker: str, file_column: str | None = None) -> DataFrame:
    """Leave out what carries ``marker`` (an "error" or "info" field).

    With one document per file the marked row is the file, and a filter is enough. With
    ``file_column`` all rows of a marked file go, found by an anti-join with the distinct
    names, which are read from the marker and the name alone. Rows without a name count as
    one file. Spark broadcasts the names where they are measured to be few.
    """
    if file_column is None:
        return df.filter(quoted(marker).isNull())
    marked = df.filter(quoted(marker).isNotNull()).select(F.col(file_column).alias("_marked"))
    marked = marked.distinct()
    return df.join(marked, df[file_column].eqNullSafe(marked["_marked"]), "left_anti")


def explode_records(df: DataFrame, path: str, alias: str = "record") -> DataFrame:
    """One row per element of a nested array; null and empty arrays give no row."""
    return df.select(F.explode(F.col(path)).alias(alias))
