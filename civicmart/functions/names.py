"""Names of places that are spelled in more ways than one."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _plain_letters() -> tuple[str, str]:
    """Lower-case Latin letters with marks, and the letters that are left without them."""
    marked, plain = [], []
    for code in range(0xC0, 0x250):
        letter = chr(code)
        base = unicodedata.normalize("NFD", letter)[0]
        if base != letter and base.isascii() and letter == letter.lower():
            marked.append(letter)
            plain.append(base)
    return "".join(marked), "".join(plain)


def name_key(name: Column) -> Column:
    """What spellings of one name have in common: case, marks on letters, hyphens, apostrophes and
    other signs, and how many spaces there are make no difference. Null for a name without
    letters or digits."""
    marked, plain = _plain_letters()
    # Marks that stand behind their letter, then marked letters.
    text = F.regexp_replace(F.lower(name), r"\p{M}+", "")
    text = F.regexp_replace(F.translate(text, marked, plain), r"[^\p{L}\p{N}]+", " ")
    return F.nullif(F.trim(text), F.lit(""))


def reconcile(rows: DataFrame, name: str, lookup: DataFrame, lookup_name: str, code: str) -> tuple[DataFrame, DataFrame]:
    """``rows`` with the ``code`` that the lookup has for their ``name``, null if it has none or
    several; and the names without a code: (name, n, codes), rows and how many codes there are.

    The lookup is reduced to a row per key. Names are summed up before they are joined, so one
    that most rows have is looked up once, and rows take their code by their own spelling.
    """
    keyed = lookup.select(name_key(F.col(lookup_name)).alias("_key"), F.col(code)).filter("_key is not null").distinct()
    known = keyed.groupBy("_key").agg(F.count(F.lit(1)).alias("codes"), F.min(code).alias("_code"))
    names = rows.groupBy(F.col(name).alias("_name")).agg(F.count(F.lit(1)).alias("n"))
    names = names.withColumn("_key", name_key(F.col("_name"))).join(known, "_key", "left")
    found = F.when(F.col("codes") == 1, F.col("_code")).alias(code)
    spelled = names.select("_name", "n", F.coalesce("codes", F.lit(0)).alias("codes"), found)
    coded = rows.drop(code).join(spelled.select("_name", code), F.col(name) == F.col("_name"), "left").drop("_name")
    missing = spelled.filter(F.col(code).isNull()).select(F.col("_name").alias("name"), "n", "codes")
    return coded, missing
