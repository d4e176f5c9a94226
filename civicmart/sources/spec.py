"""What the stages need to know about one category of raw files."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import StringType, StructField, StructType

from ..functions.cleaning import ColumnRule


def text_fields(*names: str) -> StructType:
    """An all-text schema: sentinels such as "-" must reach the rule that handles them,
    and two files of one category must not differ in type."""
    return StructType([StructField(name, StringType()) for name in names])


@dataclass(frozen=True)
class SourceSpec:
    """One category of raw files and the table made from it.

    ``category``     folder of the raw files, and of their landing copies.
    ``table``        name of the formatted table.
    ``file_format``  "csv" or "json".
    ``raw_schema``   superset of the fields seen over the years; missing ones are null.
                     None: collect whatever fields the files have.
    ``rules``        raw fields to formatted columns.
    ``records``      path of an array to turn into rows, if the file is an envelope.
    ``marker``       field whose presence means "do not use this file".
    ``whole_file``   drop every row of a marked file, not only the marked rows; needed
                     where a file holds more than one document.
    ``only_file``    use just the file of this name, from all batches.
    ``multi_line``   raw JSON is one document (or array) per file, not one per line.
    ``quoted_lines`` raw CSV has line breaks inside quotes; such a file is read by one task.
    ``versioned``    a file republished under its name with other content is collected again, as
                     its next version; otherwise a name is collected once.
    """

    category: str
    table: str
    file_format: str
    raw_schema: StructType | None = None
    rules: tuple[ColumnRule, ...] = ()
    records: str | None = None
    marker: str | None = None
    whole_file: bool = False
    only_file: str | None = None
    multi_line: bool = True
    quoted_lines: bool = False
    versioned: bool = False
