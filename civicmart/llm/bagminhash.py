"""Near-duplicate texts by weighted minhash over bags of word shingles.

A text is a bag: every run of five words with how often it occurs. Its signature follows
BagMinHash: over each shingle lies a Poisson process in the plane of weight and time. The weight
axis is cut at 0, 1, 2, 4, 8, ... into strips whose processes are independent; a strip is looked
at only as far as the weight reaches into it, and a point counts if its weight lies below the
shingle's. Each point falls to one of the components, and a component keeps its earliest point.
Two texts agree in a component with a chance that is their weighted Jaccard similarity. Points
come in order of time, so nearly all of them are never made.

Equal texts are one class from the start. Bands of the signatures give buckets, and what is in a
bucket is compared exactly, by the bags. First every member is compared with a leader, in two
rounds: the least member, then one of the bucket's largest component, to which most others link
if they link to any. Members of one component need no more comparing. Buckets that still
hold several components are dealt into tiles of bounded size, whose tasks compare the rest and
give back a forest of links. So no pair in a bucket is left open, and none is spelled out as a row
but those with a leader.

Defined results. Similarity is 1 for equal texts, empty ones too; texts without words are like
nothing else. A null text is like nothing. What is compared and linked are the distinct texts, by
their md5; ids only name the classes. So several texts with one ``doc_id``, or with none, are each
in the class of their own near copies. A class is named by its least id, null if no row of it has
one, and one row stands for it: that with the least id, and of the texts with that id one chosen
by the order of the written texts. Rows with null text all stand for themselves. Other columns
are ignored, and kept by ``drop_near_copies``; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicmart.functions.keys import each_copy
from civicmart.llm.common import checked_broadcast, filter_by_key, text_hash
from civicmart.llm.components import components
from civicmart.llm.shingles import mix, shingle_hashes, text_slices
from civicmart.session import materialise

THRESHOLD = 0.8
# A pair at the threshold shares no bucket with chance (1 - 0.8**4)**24, about 3 in a million.
BANDS, ROWS = 24, 4
# Rounds of leaders before the tiles, and bytes of bags in a block of a tile.
LEADERS = 2
BLOCK_BYTES = 8_000_000
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def bags(shingles: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (text, shingle) with their counts, by text."""
    text = np.repeat(np.arange(len(counts)), counts)
    order = np.lexsort((shingles, text))
    text, shingles = text[order], shingles[order]
    new = np.ones(len(text), dtype=bool)
    new[1:] = (text[1:] != text[:-1]) | (shingles[1:] != shingles[:-1])
    at = np.flatnonzero(new)
    return text[at], shingles[at], np.diff(np.append(at, len(text)))


def _uniform(x: np.ndarray) -> np.ndarray:
    """In (0, 1]."""
    return ((x >> np.uint64(11)).astype(np.float64) + 1) * 2.0**-53


def _strips(weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each shingle, the strips of the weight axis that its weight reaches: 0 is [0, 1),
    k is [2**(k-1), 2**k). Gives indices of shingles and strips."""
    at, strip, k = [np.arange(len(weights))], [np.zeros(len(weights), dtype=np.uint64)], 1
    while True:
        more = np.flatnonzero(weights > 1 << (k - 1))
        if not len(more):
            return np.concatenate(at), np.concatenate(strip)
        at.append(more)
        strip.append(np.full(len(more), k, dtype=np.uint64))
        k += 1


def signatures(text: np.ndarray, shingles: np.ndarray, weights: np.ndarray, n: int, m: int) -> np.ndarray:
    """Earliest times, (n, m); equal times are the same point. Texts without shingles keep inf."""
    at, strip = _strips(weights)
    text, weights = text[at], weights[at]
    seed = mix(shingles[at] + (strip + np.uint64(1)) * _GOLD)
    low = np.where(strip == 0, 0.0, 2.0 ** (strip.astype(np.float64) - 1))
    width = np.maximum(low, 1.0)
    total = np.bincount(text, np.minimum(weights - low, width), minlength=n)
    out = np.full(n * m, np.inf)
    # By this time a component is empty with chance exp(-5) / m; texts with an empty one start
    # again with twice the time, and find the same points and later ones.
    limit = m * (np.log(m) + 5) / np.maximum(total, 1e-9)
    live = np.arange(len(text))
    while len(live):
        time, turn = np.zeros(len(text)), np.zeros(1, dtype=np.uint64)
        while len(live):
            turn += _GOLD
            draw = mix(seed[live] + turn)
            time[live] -= np.log(_uniform(draw)) / width[live]
            early = time[live] <= limit[text[live]]
            live, draw = live[early], draw[early]
            other = mix(draw ^ _GOLD)
            counts = low[live] + _uniform(mix(other)) * width[live] <= weights[live]
            key = text[live] * m + (other % np.uint64(m)).astype(np.int64)
            np.minimum.at(out, key[counts], time[live][counts])
        limit *= 2
        empty = np.isinf(out.reshape(n, m)).any(axis=1)
        live = np.flatnonzero(empty[text])
    return out.reshape(n, m)


def _band_keys(times: np.ndarray) -> np.ndarray:
    """(n, BANDS) hashes of the rows of each band."""
    bits = times.view(np.uint64).reshape(len(times), BANDS, ROWS)
    keys = np.arange(BANDS, dtype=np.uint64)[None, :] * _GOLD
    for r in range(ROWS):
        keys = mix(keys ^ mix(bits[:, :, r] + np.uint64(r)))
    return keys.view(np.int64)


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row, n, words, counts in text_slices(batch["text"]):
            hashes, per_text = shingle_hashes(words, counts)
            text, shingles, weights = bags(hashes, per_text)
            keys = _band_keys(signatures(text, shingles, weights, n, BANDS * ROWS))
            some = np.flatnonzero(per_text)
            lists = pa.ListArray.from_arrays(
                np.arange(0, BANDS * len(some) + 1, BANDS, dtype=np.int32), keys[some].reshape(-1)
            )
            here = batch.slice(row, n).take(pa.array(some))
            yield pa.RecordBatch.from_arrays([here["copy_of"], lists], names=["copy_of", "keys"])


def _bag_values(hashes: np.ndarray, n: int) -> np.ndarray:
    """A bag as a sorted set: the k-th occurrence of a shingle is a value of its own."""
    hashes = np.sort(hashes)
    new = np.ones(n, dtype=bool)
    new[1:] = hashes[1:] != hashes[:-1]
    nth = np.arange(n) - np.maximum.accumulate(np.where(new, np.arange(n), 0))
    return np.sort(mix(hashes + nth.astype(np.uint64) * _GOLD))


def _bag_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        names = batch["node"]
        for row, n, words, counts in text_slices(batch["text"]):
            hashes, per_text = shingle_hashes(words, counts)
            ends = np.cumsum(per_text)
            data = [_bag_values(hashes[e - k : e], k) for e, k in zip(ends, per_text)]
            values = np.concatenate(data).view(np.int64) if data else np.zeros(0, dtype=np.int64)
            lists = pa.ListArray.from_arrays(pa.array([0, *ends.tolist()], pa.int32()), pa.array(values))
            yield pa.RecordBatch.from_arrays([names.slice(row, n), lists], names=["node", "bag"])


def _bags(rows: DataFrame, names: DataFrame) -> DataFrame:
    """(node, bag) of the texts ``names`` (node, copy_of, least), written."""
    names = checked_broadcast(names.select("node", F.col("copy_of").alias("of"), "least"))
    # Of equal texts those with the least id are read.
    same = (rows["copy_of"] == names["of"]) & rows["doc_id"].eqNullSafe(names["least"])
    found = rows.join(names, same).select("node", "text").mapInArrow(_bag_rows, "node bigint, bag array<bigint>")
    return materialise(found.groupBy("node").agg(F.first("bag").alias("bag")), "bags")


def _verified(bags_of: DataFrame, pairs: DataFrame, threshold: float) -> DataFrame:
    """Those of the pairs (a, b) of representatives whose bags are similar enough, written. A bag
    has no value twice, so what two share is the size of their intersection; both stay in the JVM."""
    a = bags_of.select(F.col("node").alias("a"), F.col("bag").alias("a_bag"))
    b = bags_of.select(F.col("node").alias("b"), F.col("bag").alias("b_bag"))
    sizes = F.size("a_bag"), F.size("b_bag")
    near = F.least(*sizes) >= threshold * F.greatest(*sizes) - 1e-9
    both = pairs.join(a, "a").join(b, "b").filter(near)
    shared = F.size(F.array_intersect("a_bag", "b_bag"))
    alike = shared >= threshold * (sizes[0] + sizes[1] - shared) - 1e-9
    return materialise(both.filter(alike).select("a", "b"), "links")


def _tile(threshold: float):
    """Links across components between two blocks of a bucket, as a forest."""

    def run(table: pa.Table) -> pa.Table:
        names, block, component = (table[c].to_pylist() for c in ("rep", "block", "component"))
        order = sorted(range(len(names)), key=lambda i: (block[i], names[i]))
        bags_of = [table["bag"][i].values.to_numpy().view(np.uint64) for i in order]
        names, block, component = ([column[i] for i in order] for column in (names, block, component))
        low, high = table["low"][0].as_py(), table["high"][0].as_py()
        root: dict[int, int] = {}

        def find(x: int) -> int:
            while root.setdefault(x, x) != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        sizes = np.array([len(x) for x in bags_of])
        ends = np.cumsum(sizes)
        values = np.concatenate(bags_of)
        in_high = np.array(block) == high
        edges = []
        for i, bag in enumerate(bags_of):
            if block[i] != low:
                continue
            here = find(component[i])
            # Sizes alone rule out most of what is left.
            near = np.minimum(sizes, len(bag)) >= threshold * np.maximum(sizes, len(bag)) - 1e-9
            near &= in_high & (np.arange(len(names)) > i if low == high else True)
            others = [j for j in np.flatnonzero(near).tolist() if find(component[j]) != here]
            if not others or not len(bag):
                continue
            if len(others) * 2 < len(names):
                parts = np.concatenate([values[ends[j] - sizes[j] : ends[j]] for j in others])
                starts = np.cumsum(sizes[others]) - sizes[others]
            else:
                parts, starts = values, ends - sizes
            at = np.minimum(np.searchsorted(bag, parts), len(bag) - 1)
            shared = np.add.reduceat((bag[at] == parts).astype(np.int64), np.minimum(starts, len(parts) - 1))
            if parts is values:
                shared = shared[others]
            both = np.where(sizes[others] > 0, shared, 0)
            for k in np.flatnonzero(both >= threshold * (len(bag) + sizes[others] - both) - 1e-9).tolist():
                x, y = find(component[i]), find(component[others[k]])
                if x != y:
                    root[max(x, y)] = min(x, y)
                    edges.append((names[i], names[others[k]]))
        return pa.table({c: pa.array([e[k] for e in edges], pa.int64()) for k, c in enumerate("ab")})

    return run


def _tile_links(members: DataFrame, bags_of: DataFrame, threshold: float) -> DataFrame:
    """Links among ``members`` (key, rep, component), the buckets that leaders left open."""
    # Members are dealt by the sizes of their bags, and the bags join them in their tiles: neither a
    # large bucket's members nor their bags come together under its key.
    sizes = bags_of.select(F.col("node").alias("of"), (8 * F.size("bag")).alias("bytes"))
    slim = members.join(sizes, members["rep"] == sizes["of"]).drop("of")
    blocks = slim.groupBy("key").agg(F.ceil(F.sum("bytes") / BLOCK_BYTES).cast("int").alias("blocks"))
    blocks = materialise(blocks.filter("blocks > 1").withColumnRenamed("key", "large"), "large-buckets")
    dealt = members.join(blocks, members["key"] == blocks["large"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    tiles = dealt.select("key", "rep", "component", "block", other)
    bags_of = bags_of.withColumnRenamed("node", "of")
    tiles = tiles.join(bags_of, tiles["rep"] == bags_of["of"]).drop("of")
    tiles = tiles.select("*", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"))
    found = tiles.drop("other").groupBy("key", "low", "high").applyInArrow(_tile(threshold), "a bigint, b bigint")
    return materialise(found, "tile-links")


def _open_buckets(members: DataFrame, roots: DataFrame) -> DataFrame:
    """``members`` (key, rep) of the buckets that hold several components, with ``component``."""
    members = members.select("key", "rep")
    apart = members.join(roots, members["rep"] == roots["node"], "left")
    apart = materialise(apart.select("key", "rep", F.coalesce("component", "rep").alias("component")), "placed-members")
    mixed = apart.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    mixed = materialise(mixed.filter("low != high").select("key"), "mixed-buckets")
    return materialise(apart.join(mixed, "key", "left_semi"), "mixed-members")


def _bucket_roots(bags_of: DataFrame, members: DataFrame, threshold: float) -> DataFrame:
    """(node, component) by all similar pairs in common buckets, written."""
    links = None
    for turn in range(LEADERS):
        if turn == 0:
            leaders = members.groupBy("key").agg(F.min("rep").alias("leader"))
        else:
            some = F.min_by("rep", F.xxhash64(F.lit(turn), "rep")).alias("leader")
            parts = members.groupBy("key", "component").agg(F.count(F.lit(1)).alias("n"), some)
            first = F.max_by(F.struct("leader", F.col("component").alias("of")), F.struct("n", "leader"))
            leaders = parts.groupBy("key").agg(first.alias("first")).select("key", "first.*")
        stars = members.join(materialise(leaders, "leaders"), "key")
        stars = stars.filter("component != of" if turn else "rep != leader")
        pairs = materialise(stars.select(F.col("leader").alias("a"), F.col("rep").alias("b")).distinct(), "pairs")
        found = _verified(bags_of, pairs, threshold)
        links = found if links is None else links.unionByName(found)
        roots = materialise(components(links), "roots")
        members = _open_buckets(members, roots)
        if members.isEmpty():
            return roots
    return materialise(components(links.unionByName(_tile_links(members, bags_of, threshold))), "roots")


def near_classes(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, text_hash, component_id, stands, copies, has_text): a row per distinct (doc_id, text);
    ``stands`` is true for the one that stands for its class."""
    # 128 bits tell texts apart; a number for each is made where the distinct ones are written.
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.unhex(F.md5("text")).alias("copy_of")
    )
    slim = rows.groupBy("doc_id", "copy_of", text_hash(F.col("text")).alias("text_hash")).agg(F.count(F.lit(1)).alias("copies"))
    slim = materialise(slim, "texts")
    first = slim.filter("copy_of is not null").groupBy("copy_of").agg(F.min("doc_id").alias("least"))
    first = materialise(first.withColumn("node", F.monotonically_increasing_id()), "copies")
    signed = rows.filter("copy_of is not null").select("copy_of", "text")
    signed = materialise(signed.mapInArrow(_sign, "copy_of binary, keys array<bigint>"), "signatures")
    # Only one signature of equal texts goes on; most copies go before the shuffle.
    once = signed.groupBy("copy_of").agg(F.first("keys").alias("keys"))
    entries = once.join(first, "copy_of").select(F.col("node").alias("rep"), F.explode("keys").alias("key"))
    buckets = entries.groupBy("key").agg(F.min("rep").alias("low"), F.max("rep").alias("high"))
    buckets = materialise(buckets.filter("low != high").select("key"), "buckets")
    members = materialise(entries.join(buckets, "key").select("key", "rep").distinct(), "bucket-members")
    names = members.select(F.col("rep").alias("node")).distinct().join(first, "node")
    roots = _bucket_roots(_bags(rows, materialise(names, "bucket-names")), members, threshold)
    # Of each component the least id, and the text that stands for it.
    top = F.min(F.struct(F.col("least").isNull().alias("unnamed"), "least", "node")).alias("top")
    tops = roots.join(first, "node").groupBy("component").agg(top)
    tops = materialise(tops.select(F.col("component").alias("of"), "top.least", "top.node"), "tops")
    tops = tops.select("of", F.col("least").alias("top_id"), F.col("node").alias("top_node"))
    named = slim.join(first, "copy_of", "left").join(roots, "node", "left")
    named = named.join(tops, named["component"] == tops["of"], "left")
    alone = F.col("of").isNull()
    has_text = F.col("copy_of").isNotNull()
    id_of_class = F.when(~has_text, F.col("doc_id")).when(alone, F.col("least")).otherwise(F.col("top_id"))
    of_top = (alone | (F.col("node") == F.col("top_node"))) & F.col("doc_id").eqNullSafe(F.col("least"))
    return named.select(
        "doc_id", "text_hash", id_of_class.alias("component_id"), (~has_text | of_top).alias("stands"), "copies",
        has_text.alias("has_text"),
    )


def near_copy_report(docs: DataFrame, threshold: float = THRESHOLD, null_ids: bool = False) -> DataFrame:
    """A row per document: (doc_id, component_id, kept), kept as by ``drop_near_copies``. Rows with a
    null id have their part in the classes; they are rows of the report with ``null_ids``."""
    classes = near_classes(docs, threshold)
    rows = classes if null_ids else classes.filter("doc_id is not null")
    rows = each_copy(materialise(rows, "classes"), "copies", "copy")
    return rows.select("doc_id", "component_id", F.expr("stands and (copy = 0 or not has_text)").alias("kept"))


def drop_near_copies(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row of each class, that with the least id; rows with a null text all stay."""
    classes = materialise(near_classes(docs, threshold), "classes")
    dropped = classes.filter("not stands").select("doc_id", "text_hash")
    kept = filter_by_key(docs, materialise(dropped, "dropped"), keep=False)
    repeated = classes.filter("copies > 1 and stands and has_text").select("doc_id", "text_hash")
    repeated = materialise(repeated, "repeated")
    once = filter_by_key(kept, repeated, keep=False)
    again = filter_by_key(kept, repeated, keep=True).dropDuplicates(["doc_id", "text"])
    return once.unionByName(again)
