"""Row bucketing that depends on values only."""

from __future__ import annotations

import random
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from civicmart.functions.cleaning import quoted

# A Mersenne prime; products of two remainders stay below 2**62.
PRIME = 2_147_483_647
# Copies of a row that are spelled out from one array.
RUN = 4096


def hash_coefficients(count: int, salt: str | int) -> tuple[list[int], int]:
    """One multiplier per key and an offset, drawn from the salt alone."""
    rng = random.Random(f"bucket/{salt}")
    return [rng.randrange(1, PRIME) for _ in range(count)], rng.randrange(PRIME)


def hash_bucket(df: DataFrame, keys: Sequence[str], buckets: int, salt: str | int = "") -> Column:
    """Bucket 0..buckets-1 of each row of ``df`` by its key values.

    A universal hash, ((a1*k1 + a2*k2 + ... + b) mod p) mod buckets, with coefficients
    drawn from the salt. The same row lands in the same bucket for any partitioning, retry
    or file order, which ``rand`` and ``randomSplit`` do not promise. Integer keys enter
    as they are, other types through ``xxhash64``; a null key counts as -1.
    """
    multipliers, offset = hash_coefficients(len(keys), salt)
    total = F.lit(offset).cast("bigint")
    for name, multiplier in zip(keys, multipliers):
        key = F.col(name)
        if not isinstance(df.schema[name].dataType, IntegralType):
            key = F.when(key.isNotNull(), F.xxhash64(key))
        remainder = F.pmod(F.coalesce(key.cast("bigint"), F.lit(-1)), F.lit(PRIME))
        total = total + remainder * multiplier % PRIME
    return total % PRIME % buckets


def each_copy(counted: DataFrame, n: str, copy: str, run: int = RUN) -> DataFrame:
    """A row per copy of rows that come ``n`` times, ``copy`` counting from 0.

    ``counted`` is a written table, as it is read twice. Rows with many copies are cut into runs
    of ``run``, and the runs are dealt over tasks before they are spelled out: a row repeated
    without end is neither one long array nor one task's work.
    """
    start, last = F.lit(0).cast("bigint"), F.floor((F.col(n) - 1) / run)
    once = counted.filter(F.col(n) <= run).withColumn(copy, F.explode(F.sequence(start, F.col(n) - 1)))
    runs = counted.filter(F.col(n) > run).withColumn("__run", F.explode(F.sequence(start, last)))
    # A number of parts, as without one AQE merges them by what runs hold before they are spelled out.
    parts = int(counted.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    runs = runs.repartition(parts, "__run", *map(quoted, counted.columns))
    first = F.col("__run") * run
    spelled = F.explode(F.sequence(first, F.least(first + run, F.col(n)) - 1))
    return once.unionByName(runs.withColumn(copy, spelled).drop("__run"))
