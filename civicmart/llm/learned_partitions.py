"""Approximate nearest neighbours by cosine, with partitions learned from a neighbour graph.

A sample of at most ``SAMPLE`` vectors is brought to the driver and its graph of nearest
neighbours is cut into partitions of nearly equal size with few edges between them: halves along
the widest direction, again and again, then moves of vertices to where most of their neighbours
are, as long as there is room. A small network learns to tell from a vector in which partitions
its neighbours are. It places every row of the table in its most probable partition, and routes a
query to several of them, whose rows are compared exactly. How many is learned as well: the least
number that finds ``RECALL`` of the neighbours of held-out sample vectors.

Only the network and that number come from the sample; every row is in the index. A partition is
dealt into blocks of bounded size, its queries too, and a task compares one block of each. Of rows
with the very same vector in a batch only the k + 1 with the least ids go on: the others cannot be
among the nearest k of anything, since ties go to the smaller id and one row is the query's own.

Defined results. Vectors that are null, empty, zero or hold null or non-finite components take no
part, neither as queries nor as candidates. Vectors are compared with those of the same length.
Every row is a vector of its own, ids repeated or null included; a query does not find its own
row, and null ids are ranked after others and are no queries. Scores are cosines in double
precision of the vectors as they are (scaled by a power of two, so that no square overflows).
Equal scores go to the smaller id. A query with fewer than k candidates in its partitions gets all
of them; a table without usable vectors gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from civicmart.session import materialise

K = 5
# Vectors the network and the number of partitions looked at are learned from: a bounded sample.
SAMPLE = 8192
PARTS = 32
NEIGHBOURS = 10
RECALL = 0.95
# Rows of a partition, and queries, that one task compares.
BLOCK, ASKED = 8192, 2048
ROWS = "row bigint, vec_id bigint, v binary"


def _unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def nearest(of: np.ndarray, among: np.ndarray, k: int, same: bool = False) -> np.ndarray:
    """Places of the k nearest unit vectors, (n, k), a block of rows at a time."""
    found = []
    for at in range(0, len(of), 1024):
        near = of[at : at + 1024] @ among.T
        if same:
            near[np.arange(len(near)), np.arange(at, at + len(near))] = -np.inf
        found.append(np.argpartition(-near, min(k, near.shape[1]) - 1, axis=1)[:, :k])
    return np.concatenate(found)


def balanced_parts(vectors: np.ndarray, graph: np.ndarray, parts: int, rounds: int = 20) -> np.ndarray:
    """Partition of each vertex: at most 5 % above the equal share, few edges between them."""
    n = len(vectors)
    part = np.zeros(n, dtype=np.int64)
    for _ in range(max(parts - 1, 0).bit_length()):
        for p in np.unique(part).tolist():
            at = np.flatnonzero(part == p)
            centred = vectors[at] - vectors[at].mean(axis=0)
            widest = np.linalg.eigh(centred.T @ centred)[1][:, -1]
            upper = at[np.argsort(centred @ widest, kind="stable")][len(at) // 2 :]
            part[upper] = p + parts
        part = np.unique(part, return_inverse=True)[1]
        if part.max() + 1 >= parts:
            break
    part %= parts
    # Edges count both ways.
    a = np.repeat(np.arange(n), graph.shape[1])
    a, b = np.concatenate((a, graph.reshape(-1))), np.concatenate((graph.reshape(-1), a))
    room = int(np.ceil(1.05 * n / parts))
    sizes = np.bincount(part, minlength=parts)
    for _ in range(rounds):
        edges = np.bincount(a * parts + part[b], minlength=n * parts).reshape(n, parts)
        gain = edges.max(axis=1) - edges[np.arange(n), part]
        moved = 0
        for i in np.argsort(-gain, kind="stable")[: int((gain > 0).sum())].tolist():
            to = int(np.argmax(edges[i]))
            if sizes[to] < room:
                sizes[part[i]] -= 1
                sizes[to] += 1
                part[i], moved = to, moved + 1
        if not moved:
            break
    return part


@dataclass(frozen=True)
class Router:
    """A network with one hidden layer, and how many partitions a query is routed to."""

    inner: np.ndarray
    outer: np.ndarray
    probes: int

    def logits(self, vectors: np.ndarray) -> np.ndarray:
        return _hidden(vectors, self.inner) @ self.outer

    def routes(self, vectors: np.ndarray, probes: int) -> np.ndarray:
        """The most probable partitions, (n, probes), in that order."""
        return np.argsort(-self.logits(_fitted(vectors, len(self.inner) - 1)), axis=1, kind="stable")[:, :probes]


def _fitted(vectors: np.ndarray, size: int) -> np.ndarray:
    """Vectors of another length than the sample's are cut or filled up, to be routed only."""
    if vectors.shape[1] >= size:
        return vectors[:, :size]
    return np.pad(vectors, ((0, 0), (0, size - vectors.shape[1])))


def _hidden(vectors: np.ndarray, inner: np.ndarray) -> np.ndarray:
    top = np.maximum(vectors @ inner[:-1] + inner[-1], 0)
    return np.concatenate((top, vectors, np.ones((len(vectors), 1))), axis=1)


def train(vectors: np.ndarray, targets: np.ndarray, width: int = 64, epochs: int = 40) -> tuple[np.ndarray, np.ndarray]:
    """Weights of the network that gives ``targets``, shares of each partition, by Adam steps."""
    rng = np.random.default_rng(5)
    n, size = vectors.shape
    weights = [rng.normal(0, size**-0.5, (size + 1, width)) * 4, np.zeros((width + size + 1, targets.shape[1]))]
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    step = 0
    for _ in range(epochs):
        order = rng.permutation(n)
        for at in range(0, n, 256):
            rows = order[at : at + 256]
            x, hidden = vectors[rows], _hidden(vectors[rows], weights[0])
            logits = hidden @ weights[1]
            shares = np.exp(logits - logits.max(axis=1, keepdims=True))
            shares /= shares.sum(axis=1, keepdims=True)
            wrong = (shares - targets[rows]) / len(rows)
            back = (wrong @ weights[1][:width].T) * (hidden[:, :width] > 0)
            slopes = [np.concatenate((x, np.ones((len(x), 1))), axis=1).T @ back, hidden.T @ wrong]
            step += 1
            for w, g, m, v in zip(weights, slopes, first, second):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                w -= 0.01 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return weights[0], weights[1]


def fit(sample: np.ndarray, parts: int = PARTS, k: int = K, recall: float = RECALL) -> Router:
    """Partitions and router from a sample of distinct vectors of one length."""
    vectors = _unit(sample)
    parts = max(1, min(parts, len(vectors) // 64))
    held = np.arange(len(vectors)) % 5 == 0
    learned, asked = vectors[~held], vectors[held]
    if parts == 1:
        return Router(np.zeros((vectors.shape[1] + 1, 1)), np.zeros((vectors.shape[1] + 2, 1)), 1)
    graph = nearest(learned, learned, min(NEIGHBOURS, len(learned) - 1), same=True)
    part = balanced_parts(learned, graph, parts)
    around = np.concatenate((np.arange(len(learned))[:, None], graph), axis=1)
    targets = np.zeros((len(learned), parts))
    np.add.at(targets, (np.arange(len(learned))[:, None], part[around]), 1 / around.shape[1])
    router = Router(*train(learned, targets), probes=parts)
    # Rows are placed by the network, so it is its partitions that are to be found.
    truth = router.routes(learned, 1)[:, 0][nearest(asked, learned, min(k, len(learned)))]
    routes = router.routes(asked, parts)
    place = np.argsort(routes, axis=1)[np.arange(len(asked))[:, None], truth]
    found = np.array([(place < p).mean() for p in range(1, parts + 1)])
    return Router(router.inner, router.outer, int(np.flatnonzero(found >= recall)[0]) + 1)


def _clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with usable vectors, these as bytes of doubles with the largest between 0.5 and 1."""
    for batch in batches:
        keep, data = [], []
        for i, value in enumerate(batch["v"]):
            if not value.is_valid or not len(value):
                continue
            v = value.values.to_numpy(zero_copy_only=False).astype(np.float64)
            if np.isfinite(v).all() and v.any():
                keep.append(i)
                data.append(np.ldexp(v, -int(np.frexp(np.abs(v).max())[1])).tobytes())
        some = batch.take(pa.array(keep, pa.int32()))
        yield pa.RecordBatch.from_arrays([some["row"], some["vec_id"], pa.array(data, pa.binary())], names=["row", "vec_id", "v"])


def _by_length(values: pa.Array) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Places and (n, length) vectors of each length in a column of bytes."""
    data = values.to_pylist()
    lengths = np.array([len(x) for x in data])
    groups = {}
    for size in np.unique(lengths).tolist():
        at = np.flatnonzero(lengths == size)
        groups[size // 8] = at, np.frombuffer(b"".join(data[i] for i in at.tolist())).reshape(len(at), -1)
    return groups


def _first_copies(batch: pa.RecordBatch, copies: int) -> pa.RecordBatch:
    """Without the rows of a vector that has more than ``copies`` others with smaller ids."""
    held: dict[bytes, list[tuple[bool, int, int, int]]] = {}
    for i, (v, vec_id, row) in enumerate(zip(*(batch[c].to_pylist() for c in ("v", "vec_id", "row")))):
        held.setdefault(v, []).append((vec_id is None, vec_id or 0, row, i))
    some = sorted(x[3] for group in held.values() for x in sorted(group)[: copies + 1])
    return batch.take(pa.array(some, pa.int32()))


def _routed(router: Router, probes: int, copies: int | None) -> Callable:
    """Rows with the partitions they go to, one row each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if copies is not None:
                batch = _first_copies(batch, copies)
            routes = np.zeros((batch.num_rows, probes), dtype=np.int32)
            for at, vectors in _by_length(batch["v"]).values():
                routes[at] = router.routes(_unit(vectors), probes)
            rows = batch.take(pa.array(np.repeat(np.arange(batch.num_rows), probes)))
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(routes.reshape(-1))], names=["row", "vec_id", "v", "part"])

    return run


def _compare(k: int) -> Callable:
    """The k nearest rows of a block for every query of a block."""

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        asks = np.array(table["asks"])
        ids, rows = table["vec_id"].to_pylist(), np.array(table["row"])
        found: list[tuple[int, int, int | None, int, float]] = []
        for at, vectors in _by_length(table["v"]).values():
            norms = np.sqrt((vectors * vectors).sum(axis=1))
            here, there = np.flatnonzero(asks[at]), np.flatnonzero(~asks[at])
            if not len(here) or not len(there):
                continue
            others = vectors[there] / norms[there, None]
            for cut in range(0, len(here), 256):
                some = here[cut : cut + 256]
                near = (vectors[some] / norms[some, None]) @ others.T
                near[rows[at[some]][:, None] == rows[at[there]][None, :]] = -np.inf
                last = np.partition(near, -min(k, len(there)), axis=1)[:, -min(k, len(there))]
                # What may be among the k by exact scores, ties and rounding included.
                q, c = np.nonzero((near >= last[:, None] - 1e-9) & np.isfinite(near))
                scores = (vectors[some[q]] * vectors[there[c]]).sum(axis=1) / (norms[some[q]] * norms[there[c]])
                best: dict[int, list] = {}
                for i, j, score in zip(at[some[q]].tolist(), at[there[c]].tolist(), scores.tolist()):
                    best.setdefault(i, []).append((-score, ids[j] is None, ids[j] or 0, int(rows[j]), j))
                found += [(int(rows[i]), ids[i], ids[x[4]], x[3], -x[0]) for i, hits in best.items() for x in sorted(hits)[:k]]
        types = {"asker": pa.int64(), "query_id": pa.int64(), "vec_id": pa.int64(), "row": pa.int64(), "score": pa.float64()}
        return pa.table({c: pa.array([f[i] for f in found], t) for i, (c, t) in enumerate(types.items())})

    return run


def _blocks(rows: DataFrame, size: int, parts: int) -> list[int]:
    """How many blocks each partition needs; a number per partition reaches the driver."""
    counts = {r.part: r.n for r in rows.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect()}
    return [max(1, -(-counts.get(p, 0) // size)) for p in range(parts)]


def build_index(vectors: DataFrame, router: Router, k: int) -> DataFrame:
    """Every row with its partition, written."""
    return materialise(vectors.mapInArrow(_routed(router, 1, k), f"{ROWS}, part int"), "partitions")


def search(
    embeddings: DataFrame,
    asks: Column,
    k: int = K,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    parts: int = PARTS,
    recall: float = RECALL,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found for every row whose id fulfils
    ``asks``, a condition on the column ``vec_id``."""
    rows = embeddings.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_column).cast("bigint").alias("vec_id"),
        F.col(vector_column).cast("array<double>").alias("v"),
    )
    vectors = materialise(rows.mapInArrow(_clean, ROWS), "vectors")
    few = vectors.orderBy(F.xxhash64("vec_id", "v"), "row").limit(SAMPLE).select("v").collect()
    seen = sorted({bytes(r.v) for r in few})
    if not seen:
        return vectors.limit(0).selectExpr("vec_id as query_id", "1 as rank", "vec_id", "0D as score")
    sizes = [len(v) for v in seen]
    size = max(sorted(set(sizes)), key=sizes.count)
    router = fit(np.frombuffer(b"".join(v for v in seen if len(v) == size)).reshape(-1, size // 8), parts, k, recall)
    index = build_index(vectors, router, k)
    asked = vectors.filter(asks).mapInArrow(_routed(router, router.probes, None), f"{ROWS}, part int")
    asked = materialise(asked, "routed-queries")
    parts = router.outer.shape[1]
    held, wanted = _blocks(index, BLOCK, parts), _blocks(asked, ASKED, parts)
    number = lambda blocks: F.element_at(F.array(*map(F.lit, blocks)), F.col("part") + 1)
    own = lambda blocks: F.pmod(F.xxhash64("row"), number(blocks)).cast("int")
    every = lambda blocks: F.explode(F.sequence(F.lit(0), number(blocks) - 1))
    tiles = index.select("*", F.lit(False).alias("asks"), own(held).alias("held"), every(wanted).alias("wanted"))
    tiles = tiles.unionByName(
        asked.select("*", F.lit(True).alias("asks"), own(wanted).alias("wanted"), every(held).alias("held"))
    )
    found = tiles.groupBy("part", "held", "wanted").applyInArrow(
        _compare(k), "asker bigint, query_id bigint, vec_id bigint, row bigint, score double"
    )
    nearest_first = (F.desc("score"), F.asc_nulls_last("vec_id"), F.asc("row"))
    place = F.row_number().over(Window.partitionBy("asker").orderBy(*nearest_first))
    ranked = found.withColumn("rank", place).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
