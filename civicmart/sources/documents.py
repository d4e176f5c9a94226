"""One huge JSON document, read by many tasks.

A document that holds an array of flat records is cut at the places where one record ends and the
next begins, wherever these bytes stand, and Spark deals the pieces over tasks like the lines of a
text file. A cut inside a text would leave both sides unreadable, as each would have a quote
without its partner, so pieces that can all be read were cut in the right places. If one cannot,
the document is read whole, by one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from .readers import TEXT_OPTIONS, as_list, explode_records, read_json_documents

BROKEN = "_broken"


def read_records(
    spark: SparkSession, path: str, fields: StructType, array: str = "records", cut: str = "},", parent: str | None = "result"
) -> DataFrame:
    """Records of the ``array`` of one document, under ``parent`` if there is one, a row each.

    ``cut`` is what stands between two records as the writer has it, with the bracket that closes
    the first; white space behind it does not matter.
    """
    pieces = spark.read.option("lineSep", cut).text(as_list(path))
    # What comes before the first record and after the last is no part of them.
    head = r'(?s)\A.*?"' + array + r'"\s*:\s*\[\s*'
    inner = F.regexp_replace("value", head, "")
    closed = F.regexp_extract(inner, r"(?s)\A(.*?\})\s*\].*\z", 1)
    whole = F.when(closed != "", closed).otherwise(F.concat(inner, F.lit("}")))
    empty = inner.rlike(r"(?s)\A\s*\]")
    lenient = {**TEXT_OPTIONS, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": BROKEN}
    schema = StructType([*fields.fields, StructField(BROKEN, StringType())])
    records = pieces.filter(~empty).select(F.from_json(whole, schema, lenient).alias("record"))
    broken = records.filter(F.col("record").isNull() | F.col(f"record.{BROKEN}").isNotNull())
    if not broken.isEmpty():
        rows = StructType([StructField(array, ArrayType(fields))])
        document = StructType([StructField(parent, rows)]) if parent else rows
        whole_document = read_json_documents(spark, path, document)
        return explode_records(whole_document, f"{parent}.{array}" if parent else array).select("record.*")
    return records.select(*[F.col("record")[f.name].alias(f.name) for f in fields])
