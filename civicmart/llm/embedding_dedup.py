"""Embedding near-duplicates by int8 tile products with error bounds.

Each vector is scaled to unit length and rounded to int8 steps of its own; the length of what
rounding took away is kept beside it. For two vectors u = s*p + e, v = t*q + f (p, q integers)

    |u.v - s*t*p.q| <= |s*p||f| + |e||t*q| + |e||f|,

so a pair whose product lies further below the threshold than that cannot link. Only the other
pairs are computed again, in double precision from the vectors as they came.

Within a label, equal vectors are one class. Classes are dealt by hash into blocks of bounded
size, and each pair of blocks is one task's tile. A tile does not give its pairs but, per class,
the number of linked vectors, and a forest that spans its links; components follow from those.

Defined results. Vectors that are null, empty, zero or hold null or non-finite components, and
those without a label, link with nothing. Vectors of different lengths don't link. Every row is a
vector of its own, whether its ``vec_id`` is reused or null. A component is named by the least id in
it, null if no row has one, and rows with that id are kept. Other columns are ignored; an empty table
gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicmart.llm.components import components
from civicmart.session import materialise

THRESHOLD = 0.98
# Classes per block: two blocks of 768-dimensional floats are some 12 MB.
BLOCK = 2048
# Rows of a tile multiplied at once; bounds the product matrix.
STRIP = 512
# Sums of so many products of int8 values are whole numbers that float32 holds exactly.
EXACT = 2**24 // 127**2
TILE_ROWS = "a long, b long, n long"


def quantise(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Unit vectors, their int8 codes, steps, and the length of the rounding error, rounded up."""
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    step = np.abs(unit).max(axis=1) / 127
    codes = np.rint(unit / step[:, None])
    error = np.linalg.norm(unit - codes * step[:, None], axis=1) * (1 + 1e-9) + 1e-12
    return unit, codes.astype(np.int8), step, error


def _code_products(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Exact products of int8 codes, by float32 matrix products of slices that can't round."""
    total = np.zeros((len(p), len(q)))
    for k in range(0, p.shape[1], EXACT):
        total += p[:, k : k + EXACT].astype(np.float32) @ q[:, k : k + EXACT].astype(np.float32).T
    return total


def linked(left: np.ndarray, right: np.ndarray, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (i, j) with cosine(left[i], right[j]) >= threshold, strip by strip."""
    _, p, s, e = quantise(left)
    _, q, t, f = quantise(right)
    left_norm, right_norm = np.linalg.norm(left, axis=1), np.linalg.norm(right, axis=1)
    # |s*p| <= 1 + |e| and |t*q| <= 1 + |f|.
    slack = lambda a, b: (1 + a)[:, None] * b[None, :] + a[:, None] * (1 + b)[None, :] + a[:, None] * b[None, :]
    for k in range(0, len(left), STRIP):
        at = slice(k, k + STRIP)
        rough = _code_products(p[at], q) * s[at, None] * t[None, :]
        i, j = np.nonzero(rough + slack(e[at], f) >= threshold - 1e-9)
        for m in range(0, len(i), 1 << 18):
            a, b = i[m : m + (1 << 18)] + k, j[m : m + (1 << 18)]
            cosine = np.einsum("ij,ij->i", left[a], right[b]) / (left_norm[a] * right_norm[b])
            sure = cosine >= threshold
            if sure.any():
                yield a[sure], b[sure]


def _tile(threshold: float):
    def run(table: pa.Table) -> pa.Table:
        # Blocks and classes in a fixed order, whatever order the rows arrived in.
        block, of = table["block"].to_numpy(), table["rep"].to_numpy()
        order = np.lexsort((of, block))
        block, of, copies = block[order], of[order], table["copies"].to_numpy()[order]
        flat = table["vector"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
        vectors = flat.reshape(len(of), -1).astype(np.float64)[order]
        # By a power of two, so that no square overflows or vanishes and no digit is lost.
        vectors = np.ldexp(vectors, -np.frexp(np.abs(vectors).max(axis=1))[1][:, None])
        low, high = table["low"][0].as_py(), table["high"][0].as_py()
        a = np.flatnonzero(block == low)
        b = np.flatnonzero(block == high)
        links, root = np.zeros(len(of), dtype=np.int64), np.arange(len(of))

        def find(x: int) -> int:
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        edges = []
        for i, j in linked(vectors[a], vectors[b], threshold):
            i, j = a[i], b[j]
            if low == high:
                i, j = i[i < j], j[i < j]
            np.add.at(links, i, copies[j])
            np.add.at(links, j, copies[i])
            for x, y in zip(i.tolist(), j.tolist()):
                x_root, y_root = find(x), find(y)
                if x_root != y_root:
                    root[max(x_root, y_root)] = min(x_root, y_root)
                    edges.append((of[x], of[y]))
        some = np.flatnonzero(links)
        return pa.table(
            {
                "a": pa.array([*of[some].tolist(), *(int(x) for x, _ in edges)], pa.int64()),
                "b": pa.array([*[None] * len(some), *(int(y) for _, y in edges)], pa.int64()),
                "n": pa.array([*links[some].tolist(), *[0] * len(edges)], pa.int64()),
            }
        )

    return run


def near_vectors(embeddings: DataFrame, threshold: float = THRESHOLD, block: int = BLOCK) -> DataFrame:
    """A row per row of ``embeddings``: (vec_id, n_links, component_id, kept)."""
    vector = F.col("embedding").cast("array<double>")
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable = F.col("label").isNotNull() & (F.size(vector) > 0) & ~bad & F.exists(vector, lambda x: x != 0)
    rows = embeddings.select(F.col("vec_id").cast("bigint").alias("vec_id"), "label", "embedding")
    one = rows.withColumn("usable", F.coalesce(usable, F.lit(False)))
    one = materialise(one.withColumn("node", F.monotonically_increasing_id()), "vectors")
    # Equal vectors of a label are one class, whatever their ids.
    group = ["label", F.col("embedding").alias("vector")]
    least = F.min("vec_id").alias("least")
    classes = one.filter("usable").groupBy(*group).agg(F.min("node").alias("rep"), least, F.count(F.lit(1)).alias("copies"))
    classes = classes.withColumn("dim", F.size("vector"))
    classes = materialise(classes, "vector-classes")
    # Blocks per label and dimension; hashing keeps each near its bound however the ids run.
    blocks = classes.groupBy("label", "dim").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
    dealt = classes.join(blocks, ["label", "dim"])
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    # Each block meets every block of its group once: as the lower or as the higher of a tile.
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    tiles = dealt.select("label", "dim", "block", "rep", "copies", "vector", other)
    tiles = tiles.select("*", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"))
    schema = TILE_ROWS
    found = tiles.groupBy("label", "dim", "low", "high").applyInArrow(_tile(threshold), schema)
    found = materialise(found, "tile-links")
    links = found.filter("b is null").groupBy("a").agg(F.sum("n").alias("links"))
    roots = components(found.filter("b is not null").select("a", "b"))
    # A component is named by the least id in it.
    placed = classes.join(roots, classes["rep"] == roots["node"])
    names = placed.groupBy("component").agg(F.min("least").alias("name"))
    roots = materialise(roots.join(names, "component").select("node", F.col("name").alias("component"), F.lit(True).alias("linked")), "component-names")
    summed = classes.select("label", "vector", "rep", "least", "copies")
    summed = summed.join(links, summed["rep"] == links["a"], "left").join(roots, summed["rep"] == roots["node"], "left")
    summed = summed.select(
        F.col("label").alias("of_label"),
        "vector",
        (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("links"),
        F.when(F.col("linked"), F.col("component")).otherwise(F.col("least")).alias("component"),
        F.lit(True).alias("in_class"),
    )
    summed = materialise(summed, "vector-components")
    member = one["usable"] & (one["label"] == summed["of_label"]) & (one["embedding"] == summed["vector"])
    component = F.when(F.col("in_class"), F.col("component")).otherwise(F.col("vec_id"))
    return one.join(summed, member, "left").select(
        "vec_id",
        F.coalesce("links", F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
