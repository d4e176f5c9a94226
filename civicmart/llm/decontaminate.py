"""Benchmark decontamination by windows of words.

The windows of the benchmark form a hash set that is broadcast; every window of every document
is hashed and looked up, and a hit counts only if the words are equal. The corpus is read once
and only hits leave the scan. Should the set pass its size bound, Spark joins by shuffle instead.

Defined results. Null and empty texts have no words and no windows. An item of fewer than ten
words, but not none, is one window. Items may repeat; a null ``item_id`` counts as one item
with an empty name. Rows equal in ``doc_id`` and text come out as often as they went in. Empty
tables on either side give clean documents, or none. Other columns are ignored, and kept by
``remove_documents`` and ``remove_spans``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicmart.functions.cleaning import quoted
from civicmart.functions.keys import each_copy
from civicmart.llm.common import checked_broadcast, filter_by_key, text_hash, words
from civicmart.session import materialise

WINDOW = 10
# A window takes some 100 bytes as words and another 100 in the hash relation: 100 MB at most.
WINDOWS_BROADCAST = 500_000


def benchmark_windows(benchmark: DataFrame, size: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """The distinct windows (window, gram, n, h) and the items of each (window, item)."""
    items = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), words(F.col("text")).alias("words")
    ).filter(F.size("words") > 0)
    n = F.least(F.size("words"), F.lit(size))
    starts = F.sequence(F.lit(1), F.size("words") - n + 1)
    grams = items.select("item", n.alias("n"), F.explode(F.transform(starts, lambda i: F.slice("words", i, n))).alias("gram"))
    grams = materialise(grams.distinct(), "benchmark-grams")
    windows = grams.select("gram", "n").distinct()
    windows = windows.withColumn("window", F.monotonically_increasing_id()).withColumn("h", F.xxhash64("gram"))
    windows = materialise(windows, "benchmark-windows")
    return windows, materialise(grams.join(windows, ["gram", "n"]).select("window", "item"), "benchmark-items")


def find_windows(docs: DataFrame, windows: DataFrame) -> DataFrame:
    """(doc_id, text_hash, n_words, pos, n, window): one row per hit, and for every row of
    ``docs`` one with null ``pos``, ``n`` and ``window``.

    Windows are generated as codes pos * step + n, arithmetic sequences that need no array of
    their own; code 0 stands for the document itself.
    """
    # At most ten lengths.
    lengths = sorted(r["n"] for r in windows.select("n").distinct().collect())
    step = max(lengths, default=0) + 1
    texts = docs.select("doc_id", text_hash(F.col("text")).alias("text_hash"), words(F.col("text")).alias("words"))
    codes = [F.array(F.lit(0))]
    for n in lengths:
        last = (F.size("words") - n) * step + n
        codes.append(F.when(F.size("words") >= n, F.sequence(F.lit(n), last, F.lit(step))).otherwise(F.array().cast("array<int>")))
    texts = texts.select("*", F.size("words").alias("n_words"), F.explode(F.concat(*codes)).alias("code"))
    gram = F.slice("words", F.floor(F.col("code") / step).cast("int") + 1, F.col("code") % step)
    # Rows for whole documents get hashes of their own, so that they don't meet in one task.
    h = F.when(F.col("code") > 0, F.xxhash64(gram)).otherwise(F.col("text_hash"))
    texts = texts.withColumn("key", h)
    windows = windows.select("window", "h", F.col("n").alias("length"), F.col("gram").alias("words_of"))
    windows = checked_broadcast(windows, limit=WINDOWS_BROADCAST)
    # The words are compared behind the join: as a second key they would be copied for each row.
    hit = (F.col("code") > 0) & (gram == F.col("words_of"))
    found = texts.join(windows, texts["key"] == windows["h"], "left").filter((F.col("code") == 0) | hit)
    in_text = lambda column: F.when(F.col("code") > 0, column)
    return found.select(
        "doc_id",
        "text_hash",
        "n_words",
        in_text(F.floor(F.col("code") / step).cast("int")).alias("pos"),
        in_text(F.col("length")).alias("n"),
        in_text(F.col("window")).alias("window"),
    )


def _covered(spans: Column) -> Column:
    """Number of words in any of the sorted (pos, n) spans."""
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))

    def add(state: Column, span: Column) -> Column:
        end = F.greatest(state["end"], span["pos"] + span["n"])
        return F.struct(end.alias("end"), (state["n"] + end - F.greatest(state["end"], F.least(span["pos"], end))).alias("n"))

    return F.aggregate(spans, zero, add, lambda state: state["n"])


def scan(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> tuple[DataFrame, DataFrame, DataFrame]:
    """What ``find_windows`` gives, written; its hits by document with sorted ``spans``; items."""
    windows, items = benchmark_windows(benchmark, size)
    found = materialise(find_windows(docs, windows), "benchmark-hits")
    span = F.when(F.col("pos").isNotNull(), F.struct("pos", "n"))
    by_doc = found.groupBy("doc_id", "text_hash").agg(
        F.count(F.when(F.col("pos").isNull(), 1)).alias("copies"),
        F.max("n_words").alias("n_words"),
        F.array_sort(F.collect_set(span)).alias("spans"),
    )
    return found, by_doc, items


def contamination_report(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """A row per document: words, words hit, items found, their digest, and the verdict."""
    found, by_doc, items = scan(docs, benchmark, size)
    pairs = found.filter("window is not null").select("doc_id", "text_hash", "window").distinct()
    named = pairs.join(items, "window").groupBy("doc_id", "text_hash").agg(F.array_sort(F.collect_set("item")).alias("items"))
    named = named.select(F.col("doc_id").alias("of"), F.col("text_hash").alias("of_hash"), "items")
    same = by_doc["doc_id"].eqNullSafe(named["of"]) & (by_doc["text_hash"] == named["of_hash"])
    items = F.coalesce("items", F.array().cast("array<string>"))
    n_hit = _covered(F.col("spans"))
    report = by_doc.join(named, same, "left").select(
        "doc_id",
        F.col("n_words").cast("bigint").alias("n_words"),
        n_hit.cast("bigint").alias("n_hit"),
        F.size(items).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(items, ",").cast("binary"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
        "copies",
    )
    return each_copy(materialise(report, "contamination"), "copies", "copy").drop("copies", "copy")


def remove_documents(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """``docs`` without those in which a window of the benchmark occurs."""
    windows, _ = benchmark_windows(benchmark, size)
    hits = find_windows(docs, windows).filter("window is not null").select("doc_id", "text_hash").distinct()
    return filter_by_key(docs, materialise(hits, "contaminated"), keep=False)


def remove_spans(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """``docs`` with the words of found windows, and what follows each up to the next word, cut
    out of ``text``; documents without hits stay as they are."""
    _, by_doc, _ = scan(docs, benchmark, size)
    hit = by_doc.filter(F.size("spans") > 0).select("doc_id", "text_hash", "spans")
    hit = materialise(hit.select(*(F.col(c).alias(f"__{c}") for c in hit.columns)), "benchmark-spans")
    hit = checked_broadcast(hit)
    # Columns of any name travel as one.
    rows = docs.select(F.struct(*map(quoted, docs.columns)).alias("row"), "doc_id", "text")
    same = rows["doc_id"].eqNullSafe(hit["__doc_id"]) & (text_hash(rows["text"]) == hit["__text_hash"])
    word = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
    other = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
    pieces = F.regexp_extract_all(rows["text"], F.lit(f"{word}+{other}*"), F.lit(0))
    lead = F.regexp_extract(rows["text"], f"^{other}*", 0)
    inside = lambda i: F.exists(hit["__spans"], lambda s: (i >= s["pos"]) & (i < s["pos"] + s["n"]))
    cut = F.concat(lead, F.array_join(F.filter(pieces, lambda _, i: ~inside(i)), ""))
    text = F.when(hit["__spans"].isNull(), rows["text"]).otherwise(cut)
    return rows.join(hit, same, "left").select(F.col("row").withField("text", text).alias("row")).select("row.*")
