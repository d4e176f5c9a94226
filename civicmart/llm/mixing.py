"""Mixing sources to target weights by hash thresholds.

Every document has a fixed place in [0, 2**60), the hash of its id, its text, and its number among
rows that have both in common. A source's target is some
whole passes over the source plus a rest; the rest is the documents below a threshold. The
threshold comes from histograms: tokens are summed by source and hash bucket, the bucket where
the running sum passes the budget is found, and only that bucket is divided again. Nothing is
sorted, and a larger budget always takes a superset of what a smaller one takes.

Defined results. A null text has size 0. A null source is a source of its own, the last one.
A null ``doc_id`` hashes as an empty one. Rows that share id, source and text are counted, and each
copy has a place of its own; which of them is taken is left open. An empty table gives an empty mix. The document that crosses the budget is taken
when that brings the sum nearer to the target.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from civicmart.functions.cleaning import quoted
from civicmart.functions.keys import RUN, each_copy
from civicmart.llm.common import checked_broadcast, numbered
from civicmart.session import materialise

TOKEN = r"[^\x20\x09-\x0D]+"
PLACE_BITS = 60
LEVEL_BITS = 12


def place(doc_id: Column, digest: Column, copy: Column, seed: str = "mix") -> Column:
    """Uniform place of a row in [0, 2**60): of several with one id and text, each has its own."""
    parts = F.coalesce(doc_id.cast("string"), F.lit("")), F.lower(F.hex(digest)), copy.cast("string")
    name = F.concat_ws(":", F.lit(seed), *parts)
    return F.conv(F.substring(F.md5(name), 1, PLACE_BITS // 4), 16, 10).cast("bigint")


def text_digest(text: Column) -> Column:
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def sized(docs: DataFrame, seed: str = "mix") -> DataFrame:
    """(doc_id, source, digest, size, copy, place) of every document. Equal rows are counted on the
    map side and told apart by number."""
    size = F.coalesce(F.regexp_count("text", F.lit(TOKEN)), F.lit(0)).cast("bigint").alias("size")
    rows = docs.select("doc_id", "source", text_digest(F.col("text")).alias("digest"), size)
    counted = materialise(rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("n")), "mix-counted")
    rows = each_copy(counted, "n", "copy", RUN).drop("n")
    return rows.withColumn("place", place(F.col("doc_id"), F.col("digest"), F.col("copy"), seed))


def targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3) -> DataFrame:
    """(source, source_size, target), a row per source.

    Sources in code point order, null last, take the weights in turn and share the sum of all
    sizes; no target passes ``most`` times its source. Shared out again and again, the excess
    ends as target = least(cap, weight * level), and the level is found in one pass over the
    sources in the order in which they reach their caps.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source"))
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    sources = sources.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), turn + 1))
    sources = sources.withColumn("cap", F.col("source_size") * most)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), F.col("source"))
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    share = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    sources = sources.withColumn("level", left / share)
    under = F.when(F.col("cap") / F.col("weight") >= F.col("level"), F.col("level"))
    whole = by_cap.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = F.first(under, ignorenulls=True).over(whole)
    cap = F.col("cap").cast("double")
    target = F.coalesce(F.least(cap, F.col("weight") * level), cap)
    return sources.select("source", "source_size", target.alias("target"))


def thresholds(sizes: DataFrame, goals: DataFrame) -> DataFrame:
    """``goals`` with ``passes`` over the whole source and ``below``, the place under which
    documents are taken once more. ``sizes`` and ``goals`` are written tables."""
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    goals = goals.withColumn("passes", passes.cast("bigint"))
    state = goals.select(
        F.col("source").alias("of"),
        F.lit(0).cast("bigint").alias("prefix"),
        (F.col("target") - F.col("passes") * F.col("source_size")).alias("need"),
    )
    n_sources, found, shift = goals.count(), None, PLACE_BITS
    while shift > 0:
        here = checked_broadcast(state, n_sources)
        inside = sizes["source"].eqNullSafe(here["of"]) & (F.shiftright(sizes["place"], shift) == here["prefix"])
        shift -= LEVEL_BITS
        histogram = (
            sizes.join(here, inside)
            .groupBy("of", "need", F.shiftright("place", shift).alias("bucket"))
            .agg(F.sum("size").alias("size"), F.min("place").alias("first"), F.max("place").alias("last"))
        )
        upto = Window.partitionBy("of").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
        running = histogram.withColumn("sum", F.sum("size").over(upto)).filter(F.col("sum") > F.col("need"))
        crossing = running.groupBy("of").agg(
            F.min_by(F.struct("bucket", "need", "sum", "size", "first", "last"), "bucket").alias("at")
        )
        crossing = materialise(crossing.select("of", "at.*"), "mix-level")
        one = F.col("first") == F.col("last")
        before = F.col("sum") - F.col("size")
        nearer = F.col("sum") - F.col("need") < F.col("need") - before
        done = crossing.filter(one).select("of", (F.col("first") + nearer.cast("bigint")).alias("below"))
        found = done if found is None else found.unionByName(done)
        state = crossing.filter(~one).select("of", F.col("bucket").alias("prefix"), (F.col("need") - before).alias("need"))
        if state.isEmpty():
            break
    return (
        goals.join(found, goals["source"].eqNullSafe(found["of"]), "left")
        .withColumn("below", F.coalesce("below", F.lit(1 << PLACE_BITS)))
        .drop("of")
    )


def plan(docs: DataFrame, seed: str = "mix") -> tuple[DataFrame, DataFrame]:
    """The sized documents and the thresholds per source, both written tables."""
    sizes = materialise(sized(docs, seed), "mix-sizes")
    goals = materialise(targets(sizes), "mix-targets")
    return sizes, materialise(thresholds(sizes, goals), "mix-thresholds")


def mix_report(docs: DataFrame, seed: str = "mix") -> DataFrame:
    """A row per document: (doc_id, size, source_size, target, taken)."""
    sizes, limits = plan(docs, seed)
    limits = checked_broadcast(limits.withColumnRenamed("source", "of"))
    copies = F.col("passes") + (F.col("place") < F.col("below")).cast("bigint")
    return sizes.join(limits, sizes["source"].eqNullSafe(limits["of"])).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * copies).alias("taken")
    )


def mix(docs: DataFrame, seed: str = "mix") -> DataFrame:
    """The mix itself: rows of ``docs``, each as often as it is taken, columns unchanged."""
    sizes, limits = plan(docs, seed)
    limits = checked_broadcast(limits.select(F.col("source").alias("of"), "passes", "below"))
    # Columns of any name travel as one.
    row = F.struct(*map(quoted, docs.columns)).alias("row")
    rows = docs.select(row, "doc_id", "source", text_digest(F.col("text")).alias("digest"))
    key = ["doc_id", "source", "digest"]
    rows = numbered(rows, key, sizes.filter("copy = 1").select(*key))
    spot = place(F.col("doc_id"), F.col("digest"), F.col("copy"), seed)
    times = (F.col("passes") + (spot < F.col("below")).cast("bigint")).cast("int")
    taken = rows.join(limits, rows["source"].eqNullSafe(limits["of"])).withColumn("times", times)
    taken = taken.filter("times > 0").select("row", F.explode(F.array_repeat(F.lit(0), F.col("times"))).alias("nth"))
    return taken.select("row.*")
