"""Helpers shared by the operators: words, joins on checked sizes, and prefix positions."""

from __future__ import annotations

import string
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from civicmart.session import materialise

# A word: digits, ASCII letters (upper case is lowered first) and every character past ASCII.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Rows of ids (some 50 bytes each once hashed) up to which a key table is broadcast: 50 MB.
BROADCAST_ROWS = 1_000_000


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Sends this package's sources to the executors, once per application, so that functions
    run in tasks find it there whether or not it is installed."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="civicmart-")) / "civicmart_sources.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(root.rglob("*.py")):
            out.write(file, file.relative_to(root.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def words(text: Column) -> Column:
    """Words of a text with A-Z lowered and nothing else; a null text has none."""
    lowered = F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return F.regexp_extract_all(lowered, F.lit(WORD), F.lit(0))


def text_hash(text: Column) -> Column:
    """With ``doc_id`` it tells rows apart where ids repeat; a null text differs from an empty one."""
    return F.xxhash64(text, text.isNull())


def checked_broadcast(table: DataFrame, rows: int | None = None, limit: int = BROADCAST_ROWS):
    """``table`` (a written one of narrow rows) marked for broadcast if it has few enough rows;
    beyond that it is left as it is and Spark joins by shuffle."""
    return F.broadcast(table) if (table.count() if rows is None else rows) <= limit else table


def filter_by_key(docs: DataFrame, keys: DataFrame, keep: bool) -> DataFrame:
    """Rows of ``docs`` whose (doc_id, text) is, or is not, among ``keys``.

    ``keys`` has ``doc_id`` and ``text_hash`` and is a written table. All columns of ``docs``
    stay, whatever their names; nulls match nulls.
    """
    keys = checked_broadcast(keys.select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash")))
    same = docs["doc_id"].eqNullSafe(keys["__id"]) & (text_hash(docs["text"]) == keys["__hash"])
    return docs.join(keys, same, "left_semi" if keep else "left_anti")


def numbered(rows: DataFrame, key: list[str], repeated: DataFrame) -> DataFrame:
    """``rows`` with ``copy``, their number from 0 among rows of the same ``key``, nulls included.

    ``repeated`` has the keys that come more than once. Rows that come once are left where they
    are; of the others, each task counts its own, and a number per task and key puts the counts
    together, so a key repeated without end is no one task's work.
    """
    repeated = repeated.select(*[F.col(c).alias(f"r_{c}") for c in key])
    repeated = checked_broadcast(materialise(repeated, "repeated-keys"))
    same = F.lit(True)
    for c in key:
        same = same & rows[c].eqNullSafe(repeated[f"r_{c}"])
    again = rows.join(repeated, same, "left_semi").withColumn("part", F.spark_partition_id())
    again = materialise(again, "repeated-rows")
    counts = again.groupBy(*key, "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy(*key).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0).cast("bigint")))
    counts = counts.select(*[F.col(c).alias(f"c_{c}") for c in (*key, "part")], "base")
    within = F.row_number().over(Window.partitionBy(*key, "part").orderBy(F.lit(0))) - 1
    again = again.withColumn("within", within)
    on = again["part"] == counts["c_part"]
    for c in key:
        on = on & again[c].eqNullSafe(counts[f"c_{c}"])
    again = again.join(counts, on).withColumn("copy", F.col("base") + F.col("within"))
    once = rows.join(repeated, same, "left_anti").withColumn("copy", F.lit(0).cast("bigint"))
    return once.unionByName(again.select(*once.columns))
