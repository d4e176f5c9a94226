"""Sources: specs of raw files, readers, and the built-in catalog."""

from .catalog import CATALOG
from .readers import (
    explode_records,
    read_csv,
    read_csv_by_name,
    read_json_documents,
    read_json_lines,
    read_named_file,
    read_table,
    skip_marked,
    union_by_name,
    with_file_name,
)
from .spec import SourceSpec, text_fields

__all__ = [
    "CATALOG",
    "SourceSpec",
    "explode_records",
    "read_csv",
    "read_csv_by_name",
    "read_json_documents",
    "read_json_lines",
    "read_named_file",
    "read_table",
    "skip_marked",
    "text_fields",
    "union_by_name",
    "with_file_name",
]
