"""Quality by compression: texts are compressed with a dictionary of good and one of bad texts.

A text is cut into pieces of fixed size, so that a long one does not become its own dictionary,
and all pieces are compressed with both. The difference of the two sizes, divided by the length
of the text, becomes a score by isotonic calibration on labelled texts that are in neither
dictionary, mixed with a little of a logistic curve so that it rises everywhere.

Only the fit is bounded: so many labelled rows per class make the dictionaries and so many the
curve, chosen by a hash of their id. A text too long for a dictionary gives it pieces from all over
its length. Scoring is one pass over whole texts, without a shuffle.

Defined results. A null text counts as empty; its difference is 0. Labels that are null or are
neither 0 nor 1 are not used; a repeated label counts each time. Of an id with several texts, the
least one goes into a dictionary. Where a class has no labelled
text, every score is the smoothed share of good labels. A null ``doc_id`` is in no fold but the
learning one, and has no label. Repeated rows get equal scores. Empty tables give no rows;
other columns are ignored, and kept by ``accept``.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Bounds of the fit: labelled rows per class in a dictionary, pieces that a long text gives to one,
# and rows for the curve. At most 100 million characters reach the driver, some 10 of usual texts.
DICTIONARY_ROWS = 1500
DICTIONARY_PIECES = 32
CURVE_ROWS = 20_000
DICTIONARY_BYTES = 256 * 1024
PIECE = 1000
LEVEL = 3
ACCEPT = 0.3
FOLDS = 5
# The curve is fitted to counts in bins of the difference.
BINS = 4000
LOGISTIC = 0.02


def fold(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(FOLDS)), F.lit(1))


@dataclass(frozen=True)
class Model:
    """Two dictionaries and the curve from difference to score."""

    good: bytes
    bad: bytes
    slope: float
    offset: float
    knots: tuple[tuple[float, float], ...] = ()

    def curve(self, x: np.ndarray) -> np.ndarray:
        logistic = 1 / (1 + np.exp(-np.clip(self.slope * x + self.offset, -500, 500)))
        if not self.knots:
            return logistic
        at, value = zip(*self.knots)
        return (1 - LOGISTIC) * np.interp(x, at, value) + LOGISTIC * logistic

    def score(self, text: Column) -> Column:
        if not self.good or not self.bad:
            return F.lit(float(self.curve(np.zeros(1))[0]))

        @F.pandas_udf("double")
        def run(texts: pd.Series) -> pd.Series:
            x = [text_difference(t, self.good, self.bad) for t in texts]
            return pd.Series(self.curve(np.array(x, dtype=float)))

        return run(F.coalesce(text, F.lit("")))


@lru_cache(maxsize=4)
def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    data = zstandard.ZstdCompressionDict(dictionary)
    data.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(dict_data=data, write_content_size=False, write_dict_id=False)


def text_difference(text: str | None, good: bytes, bad: bytes) -> float:
    """By how much the good dictionary serves the text better, per byte."""
    data, total = (text or "").encode("utf-8", "surrogatepass"), 0
    with_good, with_bad = _compressor(good).compress, _compressor(bad).compress
    for k in range(0, len(data), PIECE):
        piece = data[k : k + PIECE]
        total += len(with_bad(piece)) - len(with_good(piece))
    return total / max(1, len(data))


def difference(text: Column, good: bytes, bad: bytes) -> Column:
    @F.pandas_udf("double")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: text_difference(t, good, bad)).astype("float64")

    return run(F.coalesce(text, F.lit("")))


def sample_of(text: Column) -> Column:
    """A text as it is, or of a long one pieces at even distances, the first and the last included."""
    last = F.length(text) - PIECE
    starts = F.sequence(F.lit(0), F.lit(DICTIONARY_PIECES - 1))
    at = lambda i: F.floor(i * last / (DICTIONARY_PIECES - 1)).cast("int") + 1
    pieces = F.transform(starts, lambda i: F.substr(text, at(i), F.lit(PIECE)))
    return F.when(F.length(text) <= DICTIONARY_PIECES * PIECE, F.array(text)).when(text.isNotNull(), pieces)


def build_dictionary(texts: list[str]) -> bytes:
    data = [t.encode("utf-8", "surrogatepass") for t in texts]
    pieces = [d[k : k + PIECE] for d in data for k in range(0, len(d), PIECE)]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, pieces).as_bytes()
    except zstandard.ZstdError:  # too few or too short samples: the texts themselves
        return b"".join(pieces)[-DICTIONARY_BYTES:]


def fit_curve(counts: list[tuple[float, int, int]]) -> tuple[float, float]:
    """Slope and offset of a logistic curve through (difference, bad, good) counts, by Newton's
    method on smoothed targets, so that classes that don't overlap still give a finite slope."""
    if not counts:
        return 0.0, 0.0
    x, n0, n1 = (np.array(c, dtype=float) for c in zip(*counts))
    low, high = 1 / (n0.sum() + 2), (n1.sum() + 1) / (n1.sum() + 2)
    n, hits = n0 + n1, n0 * low + n1 * high
    scale = max(float(np.abs(x).max()), 1e-9)
    z, w = np.column_stack([x / scale, np.ones_like(x)]), np.zeros(2)
    loss = lambda w: float((n * np.logaddexp(0, z @ w) - hits * (z @ w)).sum())
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -500, 500)))
        slope = z.T @ (n * p - hits)
        bend = (z * (n * p * (1 - p))[:, None]).T @ z + 1e-6 * np.eye(2)
        step, size = np.linalg.solve(bend, slope), 1.0
        while loss(w - size * step) > loss(w) and size > 1e-6:
            size /= 2
        w = w - size * step
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0] / scale), float(w[1])


def fit_knots(counts: list[tuple[float, int, int]]) -> tuple[tuple[float, float], ...]:
    """Isotonic shares of good texts, by pooling neighbours that fall; a knot per pool."""
    pools: list[list[float]] = []  # sum of differences, rows, good rows
    for x, bad, good in counts:
        pools.append([x * (bad + good), bad + good, good])
        while len(pools) > 1 and pools[-2][2] * pools[-1][1] >= pools[-1][2] * pools[-2][1]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last)]
    total = sum(p[1] for p in pools)
    share = sum(p[2] for p in pools) / max(1, total)
    value = np.maximum.accumulate([(good + share) / (n + 1) for _, n, good in pools])
    return tuple((s / n, float(v)) for (s, n, _), v in zip(pools, value))


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Learns from labels whose id is not in the held-out fold."""
    known = labels.filter("quality in (0, 1) and doc_id is not null").filter(fold(F.col("doc_id")) != 0)
    known = known.select("doc_id", F.col("quality").cast("int").alias("quality"), F.xxhash64("doc_id").alias("h"))
    # A third of the labels is for the curve; the same id is never in both.
    for_curve = F.pmod("h", F.lit(3)) == 0
    classes = [
        known.filter((F.col("quality") == c) & ~for_curve).orderBy("h", "doc_id").limit(DICTIONARY_ROWS)
        for c in (0, 1)
    ]
    # At most 2 * DICTIONARY_ROWS ids.
    chosen = F.broadcast(classes[0].unionByName(classes[1]).distinct())
    texts = docs.select("doc_id", sample_of(F.col("text")).alias("parts")).filter("parts is not null").join(chosen, "doc_id")
    # One row per id and label comes back, however often the id repeats.
    texts = texts.groupBy("h", "doc_id", "quality").agg(F.min("parts").alias("parts"))
    samples = sorted((r["h"], r["doc_id"], r["parts"], r["quality"]) for r in texts.collect())
    bad, good = (build_dictionary([part for s in samples if s[3] == c for part in s[2]]) for c in (0, 1))
    if not good or not bad:
        n = known.groupBy("quality").count().collect()
        n = {r["quality"]: r["count"] for r in n}
        share = (n.get(1, 0) + 1) / (n.get(0, 0) + n.get(1, 0) + 2)
        return Model(b"", b"", 0.0, math.log(share / (1 - share)))
    rest = known.filter(for_curve).orderBy("h", "doc_id").limit(CURVE_ROWS)
    # At most CURVE_ROWS ids, and at most BINS rows back.
    rated = docs.select("doc_id", "text").join(F.broadcast(rest), "doc_id")
    x = difference(F.col("text"), good, bad)
    rated = rated.select("quality", F.floor((F.greatest(F.lit(-1.0), F.least(F.lit(1.0), x)) + 1) * (BINS / 2)).alias("bin"))
    sums = rated.groupBy("bin").agg(F.count(F.when(F.col("quality") == 0, 1)).alias("n0"), F.count(F.when(F.col("quality") == 1, 1)).alias("n1"))
    counts = sorted(((r["bin"] + 0.5) / (BINS / 2) - 1, r["n0"], r["n1"]) for r in sums.collect())
    if not sum(c[1] for c in counts) or not sum(c[2] for c in counts):
        # All labelled texts are in the dictionaries: the curve has to do with those.
        counts = sorted(
            (text_difference("".join(parts), good, bad), int(quality == 0), int(quality == 1)) for _, _, parts, quality in samples
        )
    return Model(good, bad, *fit_curve(counts), fit_knots(counts))


def quality_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """A row per document: (doc_id, held_out, score, predicted)."""
    model = fit(docs, labels)
    held_out = (fold(F.col("doc_id")) == 0).alias("held_out")
    scored = docs.select("doc_id", held_out, model.score(F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= ACCEPT).cast("int"))


def accept(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without those the classifier rejects."""
    model = fit(docs, labels)
    return docs.filter(model.score(docs["text"]) >= ACCEPT)
