"""Uniform shuffle into shards of exact size, by a hypergeometric communication matrix.

The rows lie in partitions by the hash of their contents. How many rows of each partition go to
each shard is drawn first, as a uniform shuffle would have it: a row of the matrix is multivariate
hypergeometric given the room the rows above left. Then each partition is permuted and cut by its
row of the matrix, the pieces are exchanged, and each shard is permuted. Only counts per partition
(a fixed number of them) reach the driver.

Defined results. The law is ``rows``: shard counts differ by one at most. A null text has size 1
and checksum 0. Rows equal in ``doc_id`` and text are counted first and told apart by a running
number, so a row repeated without end is spread like any other. An empty table gives no rows.
The result depends on the rows and the seed alone, not on files, partitions or order.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from civicmart.functions.cleaning import quoted
from civicmart.functions.keys import each_copy
from civicmart.llm.common import checked_broadcast, numbered
from civicmart.session import materialise

PARTITIONS = 4096
# Slots within a shard are numbered in so many pieces, each by its own task.
PIECES = 1024
# Cells of the matrix that are broadcast at most (8 bytes each); a larger one is joined by shuffle.
BROADCAST_CELLS = 1 << 22
# What rows are told apart by, besides their number among equal ones.
KEY = ["doc_id", "size", "text_crc32"]


def _hypergeometric(rng: np.random.Generator, good: int, bad: int, draws: int) -> int:
    """One draw for populations beyond numpy's limit: the ratios of neighbouring
    probabilities are followed from the mode outwards until they vanish."""
    low, high = max(0, draws - bad), min(draws, good)
    mode = min(max((draws + 1) * (good + 1) // (good + bad + 2), low), high)
    sides = []
    for step in (1, -1):
        k, weight, side = mode, 1.0, []
        while low <= k + step <= high and weight > 1e-20:
            if step > 0:
                weight *= (good - k) / (k + 1) * (draws - k) / (bad - draws + k + 1)
            else:
                weight *= k / (good - k + 1) * (bad - draws + k) / (draws - k + 1)
            k += step
            side.append(weight)
        sides.append(side)
    chances = np.array([*reversed(sides[1]), 1.0, *sides[0]])
    place = np.searchsorted(np.cumsum(chances), rng.random() * chances.sum(), side="right")
    return mode - len(sides[1]) + int(min(place, len(chances) - 1))


def communication_matrix(counts: list[int], rooms: list[int], seed: int) -> np.ndarray:
    """Rows sum to ``counts``, columns to ``rooms``; distributed as under a uniform shuffle."""
    rng, left = np.random.default_rng(seed), np.array(rooms, dtype=np.int64)
    matrix = np.zeros((len(counts), len(rooms)), dtype=np.int64)
    for i, n in enumerate(counts):
        if left.sum() < 1_000_000_000:
            matrix[i] = rng.multivariate_hypergeometric(left, n, method="marginals")
        else:
            rest, draws = int(left.sum()), n
            for k, room in enumerate(map(int, left)):
                rest -= room
                matrix[i, k] = _hypergeometric(rng, room, rest, draws) if rest else draws
                draws -= int(matrix[i, k])
        left -= matrix[i]
    return matrix


def _measures() -> list[Column]:
    size = (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("bigint")
    crc = F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0)).cast("bigint")
    return [size.alias("size"), crc.alias("text_crc32")]


def keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, size, text_crc32, copy): a distinct row for every row of ``docs``."""
    counted = docs.select("doc_id", *_measures()).groupBy(*KEY).agg(F.count(F.lit(1)).alias("n"))
    return each_copy(materialise(counted, "shard-counted"), "n", "copy").drop("n")


def assign_shards(docs: DataFrame, shards: int = 8, seed: int = 1) -> DataFrame:
    """(doc_id, size, text_crc32, copy, shard, slot); slots of a shard run from 0 without gaps."""
    spark = docs.sparkSession
    key = (*KEY, "copy")
    rows = keyed(docs).withColumn("h", F.xxhash64(F.lit(seed), *key))
    rows = materialise(rows.withColumn("part", F.pmod("h", F.lit(PARTITIONS)).cast("int")), "shard-rows")
    # At most PARTITIONS counts.
    counts = {r["part"]: r["n"] for r in rows.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect()}
    total, parts = sum(counts.values()), sorted(counts)
    rooms = [total // shards + (k < total % shards) for k in range(shards)]
    ends = communication_matrix([counts[p] for p in parts], rooms, seed).cumsum(axis=1)
    cuts = spark.createDataFrame(
        [(p, [int(x) for x in row]) for p, row in zip(parts, ends)], "part int, ends array<bigint>"
    )
    cuts = checked_broadcast(cuts, len(parts) * shards, BROADCAST_CELLS)
    inside = Window.partitionBy("part").orderBy(F.xxhash64(F.lit("local"), "h"), *key)
    placed = rows.withColumn("at", F.row_number().over(inside) - 1).join(cuts, "part")
    shard = F.size(F.filter("ends", lambda end: end <= F.col("at")))
    again = F.xxhash64(F.lit("shard"), "h")
    placed = placed.select(*key, shard.cast("int").alias("shard"), again.alias("h"))
    placed = placed.withColumn("piece", F.pmod(F.shiftright("h", 32), F.lit(PIECES)).cast("int"))
    placed = materialise(placed, "shard-placed")
    before = Window.partitionBy("shard").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("shard", "piece").agg(F.count(F.lit(1)).alias("n"))
    starts = starts.select("shard", "piece", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    in_piece = Window.partitionBy("shard", "piece").orderBy("h", *key)
    ranked = placed.withColumn("rank", F.row_number().over(in_piece) - 1)
    return ranked.join(starts, ["shard", "piece"]).select(*key, "shard", (F.col("start") + F.col("rank")).alias("slot"))


def shard_report(docs: DataFrame, shards: int = 8, seed: int = 1) -> DataFrame:
    """A row per document with its law, shard and slot; the law ``rows`` has no grown shard."""
    return assign_shards(docs, shards, seed).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def shuffled(docs: DataFrame, shards: int = 8, seed: int = 1) -> DataFrame:
    """``docs`` with ``shard`` and ``slot``, for writing with ``partitionBy("shard")``.

    Columns of ``docs`` that have these names are replaced.
    """
    places = assign_shards(docs, shards, seed)
    again = places.filter("copy = 1").select(*KEY)
    places = places.select(*(F.col(c).alias(f"to_{c}") for c in places.columns))
    # Columns of any name travel as one.
    kept = [quoted(c) for c in docs.columns if c not in ("shard", "slot")]
    rows = numbered(docs.select(F.struct(*kept).alias("row"), "doc_id", *_measures()), KEY, again)
    match = rows["doc_id"].eqNullSafe(places["to_doc_id"])
    for c in (*KEY[1:], "copy"):
        match = match & (rows[c] == places[f"to_{c}"])
    return rows.join(places, match).select("row.*", F.col("to_shard").alias("shard"), F.col("to_slot").alias("slot"))
