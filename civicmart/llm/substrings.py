"""Removal of byte strings that occur more than once, wherever they begin.

The question for every position is whether the ``LENGTH`` bytes from there occur again. Prefix
doubling answers it by sorting positions under ranks of growing length, and dropping those whose
rank is unique. Ranking every byte of a corpus would move a dozen times its size through the
shuffle, so only sampled positions are ranked, and lengths grow around them:

* Of all ``GRAM``-byte strings within a string of ``LENGTH`` bytes, the one with the least hash
  (the leftmost of equals) is its anchor. Equal strings have their anchor at the same offset, so
  an anchor stands for the run of positions that it is the anchor of, some 85 on average.
* Round 0 ranks anchors by their ``GRAM`` bytes; unique ones are dropped, with all they stand for.
  An anchor whose whole run reads as another's is settled: all of its positions repeat.
* Round 1 ranks what is left, for every ``NODE`` neighbouring offsets, by the 185 bytes that the
  strings of those offsets share; unique ones are dropped, and equal ones settled as before.
* Round 2 ranks single positions by all ``LENGTH`` bytes.

Each round groups by rank (sums before the shuffle, no group is ever collected) and joins the
repeated ranks back, so a passage in a third of all documents is only a large number. Ranks are
hashes, of 128 bits wherever they decide.

Defined results. A null text counts as empty. Matches lie within one document; rows equal in
``doc_id`` and text are different documents, and copies of each other. Texts shorter than
``LENGTH`` bytes lose nothing. Other columns are ignored, and kept by ``remove_repeats``, in whose
texts a character that lost some of its bytes goes as a whole. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from civicmart.functions.cleaning import quoted
from civicmart.llm.common import filter_by_key, text_hash
from civicmart.llm.shingles import mix
from civicmart.session import discard, materialise

LENGTH = 200
GRAM = 32
WINDOW = LENGTH - GRAM + 1
NODE = 16
# Positions handled at once; they must fit the low bits of a key.
SLICE = 1 << 20
POSITION_BITS = np.uint64(24)
POSITION = np.uint64((1 << 24) - 1)

ANCHORS = "doc_id bigint, text_hash bigint, p int, low int, high int, gram bigint, u1 bigint, u2 bigint"
_rng = np.random.default_rng(7_919)
_BYTES = _rng.integers(1, 1 << 63, (2, 256), dtype=np.uint64)
_BASES = [int(x) | 1 for x in _rng.integers(1 << 62, size=2)]
_powers: list[tuple[np.ndarray, np.ndarray]] = []


def _power_tables(n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For both bases, the powers of the base and of its inverse modulo 2**64."""
    if not _powers or len(_powers[0][0]) < n:
        size, found = max(n, SLICE + 4 * LENGTH), []
        for base in _BASES:
            rows = []
            for b in (base, pow(base, -1, 1 << 64)):
                row = np.full(size, b, dtype=np.uint64)
                row[0] = 1
                rows.append(np.multiply.accumulate(row))
            found.append(tuple(rows))
        _powers[:] = found
    return _powers


def _sliding_least(keys: np.ndarray, width: int) -> np.ndarray:
    """Least of every ``width`` neighbours, by least from either end of blocks."""
    n = len(keys)
    blocks = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    blocks[:n] = keys
    blocks = blocks.reshape(-1, width)
    upto = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    onward = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(onward[: n - width + 1], upto[width - 1 : n])


def anchors(data: np.ndarray, bounds: np.ndarray) -> dict[str, np.ndarray]:
    """Anchors of texts that lie end to end: the text, the place in ``data``, the first and last
    position each stands for, and hashes of its gram and of all bytes of its run."""
    n, tables = len(data), _power_tables(len(data) + 1)
    sums = []
    for table, (up, _) in zip(_BYTES, tables):
        total = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(table[data] * up[:n], out=total[1:])
        sums.append(total)
    down = [t[1] for t in tables]
    grams = mix((sums[0][GRAM:] - sums[0][:-GRAM]) * down[0][: n - GRAM + 1])
    places = np.arange(len(grams), dtype=np.uint64)
    least = _sliding_least((grams & ~POSITION) | places, WINDOW) & POSITION
    sizes = np.diff(bounds)
    text = np.repeat(np.arange(len(sizes)), sizes)[: len(least)]
    starts = np.flatnonzero(np.arange(len(least)) <= (bounds[1:] - LENGTH)[text])
    of = least[starts].astype(np.int64)
    new = np.ones(len(of), dtype=bool)
    new[1:] = of[1:] != of[:-1]
    at = np.flatnonzero(new)
    first, last, place = starts[at], starts[np.append(at[1:], len(of)) - 1] if len(at) else at, of[at]
    run = (last - first).astype(np.uint64)
    whole = [mix((s[last + LENGTH] - s[first]) * d[first] + run) for s, d in zip(sums, down)]
    return {"text": text[first], "place": place, "first": first, "last": last, "gram": grams[place], "u1": whole[0], "u2": whole[1]}


def _pieces(offsets: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
    """Parts of a batch: (first row, rows, begin, end) in bytes. A text longer than a slice is cut
    into overlapping parts, so that each of its positions is whole in one."""
    row, n = 0, len(offsets) - 1
    while row < n:
        end = int(np.searchsorted(offsets, offsets[row] + SLICE, side="right")) - 1
        if end > row:
            yield row, end - row, int(offsets[row]), int(offsets[end])
            row = end
            continue
        for at in range(int(offsets[row]), int(offsets[row + 1]) - LENGTH + 1, SLICE):
            yield row, 1, at, min(at + SLICE + LENGTH - 1, int(offsets[row + 1]))
        row += 1


def _text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int32)[column.offset : column.offset + len(column) + 1]
    whole = column.buffers()[2]
    data = np.frombuffer(whole, dtype=np.uint8) if whole is not None and whole.size else np.zeros(0, dtype=np.uint8)
    return offsets.astype(np.int64), data


def _find_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        offsets, data = _text_bytes(batch["text"])
        for row, n, begin, end in _pieces(offsets):
            if end - begin < LENGTH:
                continue
            bounds = offsets[row : row + n + 1] - begin if n > 1 or end == offsets[row + 1] and begin == offsets[row] else np.array([0, end - begin])
            found = anchors(data[begin:end], bounds)
            rows = row + found["text"]
            place = found["place"]
            here = batch.select(["doc_id", "text_hash"]).take(pa.array(rows))
            yield pa.RecordBatch.from_arrays(
                [
                    *here.columns,
                    pa.array((place + begin - offsets[rows]).astype(np.int32)),
                    pa.array((place - found["last"]).astype(np.int32)),
                    pa.array((place - found["first"]).astype(np.int32)),
                    *(pa.array(found[c].view(np.int64)) for c in ("gram", "u1", "u2")),
                ],
                names=["doc_id", "text_hash", "p", "low", "high", "gram", "u1", "u2"],
            )


def _cut_contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of each asked-for run: from the first position to the end of the last string."""
    for batch in batches:
        for text, asked in zip(batch["text"], batch["asked"].to_pylist()):
            data = text.as_buffer().to_pybytes()
            columns = {c: [a[c] for a in asked] for c in ("u1", "u2", "n", "low", "high")}
            kinds = [pa.int64()] * 3 + [pa.int32()] * 2
            arrays = [pa.array(v, k) for v, k in zip(columns.values(), kinds)]
            bytes_of = [data[a["p"] - a["high"] : a["p"] - a["low"] + LENGTH] for a in asked]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(bytes_of, pa.binary())], names=[*columns, "context"])


CONTEXTS = "u1 bigint, u2 bigint, n bigint, low int, high int, context binary"
NODES = "u1 bigint, u2 bigint, n bigint, low int, high int, core bigint, whole binary"
POSITIONS = "u1 bigint, u2 bigint, n bigint, a int, rank binary"


def _nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per run and group of ``NODE`` offsets: the offsets it has there, the hash of the bytes
    that all strings of the group share, and that of the bytes of its own strings."""
    for batch in batches:
        rows, lows, highs, cores, wholes = [], [], [], [], []
        for i, (low, high, context) in enumerate(zip(batch["low"].to_pylist(), batch["high"].to_pylist(), batch["context"])):
            context = context.as_py()
            for node in range(low // NODE, high // NODE + 1):
                a, b = node * NODE, node * NODE + NODE - 1
                rows.append(i)
                # Signed, and told apart by the node, as offsets must be equal too.
                core = xxhash.xxh3_64_intdigest(context[high - a : high - b + LENGTH], node)
                cores.append(core - (1 << 64) if core >> 63 else core)
                a, b = max(a, low), min(b, high)
                lows.append(a)
                highs.append(b)
                wholes.append(xxhash.xxh3_128_digest(context[high - b : high - a + LENGTH]) + bytes((a, b)))
        here = batch.select(["u1", "u2", "n"]).take(pa.array(rows, pa.int64()))
        yield pa.RecordBatch.from_arrays(
            [*here.columns, pa.array(lows, pa.int32()), pa.array(highs, pa.int32()), pa.array(cores, pa.int64()), pa.array(wholes, pa.binary())],
            names=["u1", "u2", "n", "low", "high", "core", "whole"],
        )


def _positions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per position of the asked-for nodes, ranked by all ``LENGTH`` bytes."""
    for batch in batches:
        rows, offsets, ranks = [], [], []
        for i, (high, context, asked) in enumerate(zip(batch["high"].to_pylist(), batch["context"], batch["asked"].to_pylist())):
            context = context.as_py()
            for node in asked:
                for a in range(node["low"], node["high"] + 1):
                    rows.append(i)
                    offsets.append(a)
                    ranks.append(xxhash.xxh3_128_digest(context[high - a : high - a + LENGTH]) + bytes((a,)))
        here = batch.select(["u1", "u2", "n"]).take(pa.array(rows, pa.int64()))
        yield pa.RecordBatch.from_arrays(
            [*here.columns, pa.array(offsets, pa.int32()), pa.array(ranks, pa.binary())], names=["u1", "u2", "n", "a", "rank"]
        )


def _once(texts: DataFrame, rows: DataFrame) -> DataFrame:
    """``texts`` with one row for each (doc_id, text). Only rows that are repeated are moved."""
    repeated = rows.groupBy("doc_id", "text_hash").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    repeated = materialise(repeated.select("doc_id", "text_hash"), "repeated-rows")
    again = filter_by_key(texts, repeated, keep=True)
    again = again.groupBy("doc_id", text_hash(F.col("text")).alias("h")).agg(F.first("text").alias("text"))
    return filter_by_key(texts, repeated, keep=False).unionByName(again.select("doc_id", "text"))


def repeated_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, start, stop): the maximal byte runs that repeated strings cover."""
    run = ["u1", "u2"]
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_hash(F.col("text")).alias("text_hash"), "text")
    rows = rows.filter(F.octet_length("text") >= LENGTH)
    every = materialise(rows.mapInArrow(_find_anchors, ANCHORS), "anchors")
    # Round 0. Tables are deleted as soon as nothing reads them any more.
    again = every.groupBy("gram").agg(F.count(F.lit(1)).alias("k")).filter("k > 1").select("gram")
    again = materialise(again, "repeated-grams")
    found = materialise(every.join(again, "gram", "left_semi"), "repeated-anchors")
    discard(every, again)
    place = F.struct("doc_id", "text_hash", "p", "low", "high", "gram")
    classes = found.groupBy(*run).agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("at"))
    classes = materialise(classes.select(*run, "n", "at.*"), "runs")
    settled = found.join(classes.filter("n > 1").select(*run), run, "left_semi")
    spans = settled.select(
        "doc_id", "text_hash", (F.col("p") - F.col("high")).alias("start"), (F.col("p") - F.col("low") + LENGTH).alias("stop")
    )
    # Runs that are still open, and all that they may repeat.
    meet = classes.groupBy("gram").agg(F.count(F.lit(1)).alias("k"), F.min("n").alias("least"))
    meet = materialise(meet.filter("k > 1 and least = 1").select("gram"), "open-grams")
    asked = materialise(classes.join(meet, "gram", "left_semi"), "open-runs")
    per_doc = asked.groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("u1", "u2", "n", "p", "low", "high")).alias("asked"))
    per_doc = per_doc.select(F.col("doc_id").alias("of"), F.col("text_hash").alias("of_hash"), "asked")
    names = materialise(asked.select("doc_id", "text_hash").distinct(), "open-texts")
    texts = _once(filter_by_key(rows.select("doc_id", "text"), names, keep=True), rows)
    same = texts["doc_id"].eqNullSafe(per_doc["of"]) & (text_hash(texts["text"]) == per_doc["of_hash"])
    contexts = texts.join(per_doc, same).select("text", "asked").mapInArrow(_cut_contexts, CONTEXTS)
    contexts = materialise(contexts, "contexts")
    # Round 1.
    cut = materialise(contexts.mapInArrow(_nodes, NODES), "nodes")
    cores = cut.groupBy("core").agg(F.count(F.lit(1)).alias("k"), F.min("n").alias("least"))
    cores = materialise(cores.filter("k > 1 and least = 1").select("core"), "repeated-cores")
    nodes = materialise(cut.join(cores, "core", "left_semi"), "repeated-nodes")
    discard(cut, cores)
    wholes = nodes.groupBy("whole").agg(F.count(F.lit(1)).alias("k")).filter("k > 1")
    wholes = materialise(wholes.select("whole"), "repeated-wholes")
    sure = materialise(nodes.filter("n = 1").join(wholes, "whole", "left_semi"), "settled-nodes")
    open_cores = nodes.filter("n = 1").join(wholes, "whole", "left_anti").select("core").distinct()
    open_cores = materialise(open_cores, "open-cores")
    asked_nodes = nodes.join(open_cores, "core", "left_semi")
    # Round 2.
    per_run = asked_nodes.groupBy(*run).agg(F.collect_list(F.struct("low", "high")).alias("asked"))
    ranked = contexts.join(per_run, run).select(*run, "n", "high", "context", "asked")
    ranked = materialise(ranked.mapInArrow(_positions, POSITIONS), "positions")
    discard(contexts, nodes, wholes, open_cores)
    ranks = ranked.groupBy("rank").agg(F.count(F.lit(1)).alias("k"), F.min("n").alias("least"))
    ranks = materialise(ranks.filter("k > 1 and least = 1").select("rank"), "repeated-ranks")
    single = ranked.filter("n = 1").join(ranks, "rank", "left_semi").select(*run, F.col("a").alias("low"), F.col("a").alias("high"))
    # An open run is one anchor, so its class says where it lies.
    where = asked.filter("n = 1").select(*run, "doc_id", "text_hash", "p")
    late = sure.select(*run, "low", "high").unionByName(single).join(where, run)
    late = late.select(
        "doc_id", "text_hash", (F.col("p") - F.col("high")).alias("start"), (F.col("p") - F.col("low") + LENGTH).alias("stop")
    )
    # Overlapping and touching spans become one.
    spans = spans.unionByName(late).distinct()
    in_doc = Window.partitionBy("doc_id", "text_hash").orderBy("start", "stop")
    reach = F.max("stop").over(in_doc.rowsBetween(Window.unboundedPreceding, -1))
    spans = spans.withColumn("new", F.coalesce((F.col("start") > reach).cast("int"), F.lit(1)))
    spans = spans.withColumn("nth", F.sum("new").over(in_doc.rowsBetween(Window.unboundedPreceding, 0)))
    spans = spans.groupBy("doc_id", "text_hash", "nth").agg(F.min("start").alias("start"), F.max("stop").alias("stop"))
    spans = materialise(spans.drop("nth"), "repeated-spans")
    discard(found, classes, meet, asked, names, sure, ranked, ranks)
    return spans


def _per_document(spans: DataFrame) -> DataFrame:
    """(of, of_hash, spans, removed): the sorted spans of each document, and how many bytes."""
    per_doc = spans.groupBy("doc_id", "text_hash").agg(
        F.array_sort(F.collect_list(F.struct("start", "stop"))).alias("spans"),
        F.sum(F.col("stop") - F.col("start")).cast("bigint").alias("removed"),
    )
    return per_doc.select(F.col("doc_id").alias("of"), F.col("text_hash").alias("of_hash"), "spans", "removed")


def _kept(data: bytes, spans: list[dict]) -> bytes:
    kept, at = [], 0
    for span in spans:
        kept.append(data[at : span["start"]])
        at = span["stop"]
    return b"".join([*kept, data[at:]])


def _kept_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        digests = [
            hashlib.sha256(_kept(text.as_buffer().to_pybytes(), spans)).hexdigest()
            for text, spans in zip(batch["text"], batch["spans"].to_pylist())
        ]
        yield pa.RecordBatch.from_arrays([batch["of"], batch["of_hash"], pa.array(digests, pa.string())], names=["of", "of_hash", "kept"])


def _with_spans(docs: DataFrame, per_doc: DataFrame, how: str) -> DataFrame:
    same = docs["doc_id"].eqNullSafe(per_doc["of"]) & (text_hash(docs["text"]) == per_doc["of_hash"])
    return docs.join(per_doc, same, how)


def repeat_report(docs: DataFrame) -> DataFrame:
    """A row per document: bytes, bytes removed, maximal removed runs, digest of what is left."""
    per_doc = materialise(_per_document(repeated_spans(docs)), "document-spans")
    text = F.coalesce("text", F.lit("")).cast("binary")
    base = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        text_hash(F.col("text")).alias("text_hash"),
        F.octet_length(text).cast("bigint").alias("n_bytes"),
        F.sha2(text, 256).alias("whole"),
    )
    same = base["doc_id"].eqNullSafe(per_doc["of"]) & (base["text_hash"] == per_doc["of_hash"])
    base = base.join(per_doc, same, "left")
    base = materialise(
        base.select("doc_id", "text_hash", "n_bytes", "whole", F.coalesce("removed", F.lit(0)).alias("removed"), F.coalesce(F.size("spans"), F.lit(0)).alias("n_spans")),
        "document-bytes",
    )
    # Texts are needed again only where some bytes go and some stay.
    partly = base.filter("removed > 0 and removed < n_bytes").select("doc_id", "text_hash").distinct()
    partly = materialise(partly, "partly-removed")
    texts = filter_by_key(docs.select("doc_id", "text"), partly, keep=True)
    digests = _with_spans(texts, per_doc, "inner").select("of", "of_hash", "text", "spans")
    digests = digests.mapInArrow(_kept_digests, "of bigint, of_hash bigint, kept string").distinct()
    same = base["doc_id"].eqNullSafe(digests["of"]) & (base["text_hash"] == digests["of_hash"])
    nothing = hashlib.sha256(b"").hexdigest()
    kept = F.when(F.col("removed") == 0, F.col("whole")).when(F.col("removed") == F.col("n_bytes"), F.lit(nothing)).otherwise(F.col("kept"))
    return base.join(digests, same, "left").select(
        "doc_id",
        "n_bytes",
        F.col("removed").cast("bigint").alias("n_removed"),
        F.col("n_spans").cast("bigint").alias("n_spans"),
        kept.alias("kept_sha256"),
    )


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with the repeated bytes cut out of ``text``."""
    per_doc = materialise(_per_document(repeated_spans(docs)), "document-spans")
    per_doc = per_doc.select(*(F.col(c).alias(f"__{c}") for c in per_doc.columns))
    # Columns of any name travel as one.
    rows = docs.select(F.struct(*map(quoted, docs.columns)).alias("row"), "doc_id", "text")
    same = rows["doc_id"].eqNullSafe(per_doc["__of"]) & (text_hash(rows["text"]) == per_doc["__of_hash"])

    @F.pandas_udf("string")
    def cut(texts, spans):
        import pandas as pd

        keep = [t if s is None else _kept(t.encode(), list(s)).decode("utf-8", "ignore") for t, s in zip(texts, spans)]
        return pd.Series(keep, dtype=object)

    text: Column = F.when(per_doc["__spans"].isNull(), rows["text"]).otherwise(cut(F.coalesce(rows["text"], F.lit("")), per_doc["__spans"]))
    return rows.join(per_doc, same, "left").select(F.col("row").withField("text", text).alias("row")).select("row.*")
