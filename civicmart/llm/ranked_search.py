"""Ranked lexical search of a query set over all documents, by per-term geometric blocking.

Documents are dealt into shards of bounded size. In a shard every posting list that some query may
have to open is clustered by the similarity of its documents, and each cluster is a block that
keeps the coordinatewise maximum of its documents' term impacts: its summary. A query multiplied
with a summary bounds the score of every document in the block, so a block is skipped only if that
bound is below the query's threshold. What is left is scored exactly, so results are exact.

Steps, each a Spark pass whose table is written: (1) term counts of every document, kept for the
queries' terms only, as no other term can add to a score; (2) document frequencies and sizes;
(3) a first threshold per query, the k-th score among all documents that hold one of its rarest
terms; with it and the greatest impact of each term, MaxScore tells the lists that a query must
open, as a document found in the others alone stays below; (4) the index, a row per shard;
(5) the search, each task with thresholds that rise as it goes, and the best k of all tasks.
A summary has the coordinates of the queries that may open its list, no others.

Queries are taken in blocks of ``QUERY_BYTES`` of text (a longer one is a block of its own), as the
terms of a block are sent to the tasks; each block is one pass over the documents.

Scores. Terms are runs of ASCII letters and digits and of all characters past ASCII, A-Z lowered.
A document's sum runs over the query's terms, repeats included, of
``w * ((1000000000 * tf) div (1000 * tf + 12 * m))``, ``w = floor(1000 * ln((2N + 2) / (2df + 1)))``
and ``m = 75 + (25 * n * N) div L``.

Defined results. A null text has no terms, an empty one neither; such documents are not counted in
N, and such queries find nothing. Every row of the queries is a query and every row of the
documents a document, ids repeated or null included; equal scores go by ascending ``doc_id``, null
last. Fewer than k rows come back where fewer documents score above 0; empty tables give no rows.
Other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from civicmart.session import materialise

K = 20
# Bytes of query texts handled in one pass: some 150,000 terms at most.
QUERY_BYTES = 1 << 20
# Cells of a shard's dense (document, term) table of 32-bit impacts, and its most documents.
SHARD_CELLS, SHARD_DOCS = 1 << 24, 1024
# Documents in a block, on average, and numbers in the sketch that clusters them.
BLOCK, SKETCH = 8, 32
# A query's rarest terms are looked at first, until this many documents per result hold them.
FIRST_LOOK = 20
# Bytes of text split into words at once.
PIECE = 1 << 20

_TERM_BYTES = frozenset([*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)])
_SPACED = bytes(b if b in _TERM_BYTES else 32 for b in range(256)).lower()

VECTORS = "doc_id bigint, n bigint, terms array<int>, counts array<int>"
# Numbers of a shard end to end, each kind in a column.
PACKED = {"ends": np.int32, "terms": np.int32, "impacts": np.int32, "lists": np.int32, "blocks": np.int32, "members": np.int16, "summaries": np.int32}
INDEX = "doc_ids array<bigint>, " + ", ".join(f"{name} binary" for name in PACKED)


def count_terms(text: bytes) -> Counter:
    """How often each term occurs in a UTF-8 text. Long texts are cut between words."""
    found: Counter = Counter()
    at = 0
    while at < len(text):
        piece = text[at : at + PIECE].translate(_SPACED)
        end = len(piece) if at + PIECE >= len(text) else piece.rfind(b" ") + 1
        if not end:  # a term longer than a piece
            end = PIECE
            while at + end < len(text) and text[at + end] in _TERM_BYTES:
                end += 1
            piece = text[at : at + end].translate(_SPACED)
        found.update(piece[:end].split())
        at += end
    return found


@dataclass(frozen=True)
class Queries:
    """A block of queries: ``rows[q]`` is a row number, ``terms[q]`` and ``times[q]`` its distinct
    terms by number and how often it holds them; ``vocabulary`` numbers the terms."""

    rows: list[int]
    terms: list[np.ndarray]
    times: list[np.ndarray]
    vocabulary: dict[bytes, int]

    @staticmethod
    def of(texts: list[tuple[int, str | None]]) -> Queries:
        vocabulary: dict[bytes, int] = {}
        rows, terms, times = [], [], []
        for row, text in texts:
            counts = count_terms((text or "").encode())
            if not counts:
                continue
            rows.append(row)
            numbers = [vocabulary.setdefault(term, len(vocabulary)) for term in counts]
            terms.append(np.array(numbers, dtype=np.int64))
            times.append(np.array(list(counts.values()), dtype=np.int64))
        return Queries(rows, terms, times, vocabulary)


@dataclass(frozen=True)
class Statistics:
    """Documents, all their terms, and per term of the vocabulary the documents that hold it."""

    documents: int
    length: int
    df: np.ndarray

    def weights(self) -> np.ndarray:
        top = 2 * self.documents + 2
        return np.array([math.floor(1000 * math.log(top / (2 * int(d) + 1))) for d in self.df], dtype=np.int64)

    def impacts(self, counts: np.ndarray, n: np.ndarray) -> np.ndarray:
        m = 75 + (25 * n * self.documents) // max(self.length, 1)
        return (1_000_000_000 * counts) // (1000 * counts + 12 * m)


def _vectors(vocabulary: dict[bytes, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, ends, terms, counts = [], [0], [], []
            for text in batch["text"].cast(pa.binary()):
                found = count_terms(text.as_buffer().to_pybytes()) if text.is_valid else {}
                sizes.append(sum(found.values()))
                known = sorted((vocabulary[t], c) for t, c in found.items() if t in vocabulary)
                terms += [t for t, _ in known]
                counts += [c for _, c in known]
                ends.append(len(terms))
            ends = pa.array(ends, pa.int32())
            lists = [pa.ListArray.from_arrays(ends, pa.array(x, pa.int32())) for x in (terms, counts)]
            columns = [batch["doc_id"], pa.array(sizes, pa.int64()), *lists]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "terms", "counts"])

    return run


def _flat(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list column end to end, and where each row ends."""
    starts = column.offsets.to_numpy()
    return column.flatten().to_numpy().astype(np.int64), (starts[1:] - starts[0]).astype(np.int64)


def _tally(size: int):
    """(term, n): documents per term; documents and their terms under -1 and -2."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, documents, length = np.zeros(size, dtype=np.int64), 0, 0
        for batch in batches:
            df += np.bincount(_flat(batch["terms"])[0], minlength=size)
            n = batch["n"].to_numpy()
            documents, length = documents + int((n > 0).sum()), length + int(n.sum())
        at = np.flatnonzero(df)
        terms, counts = [-1, -2, *at.tolist()], [documents, length, *df[at].tolist()]
        yield pa.RecordBatch.from_arrays([pa.array(terms, pa.int32()), pa.array(counts, pa.int64())], names=["term", "n"])

    return run


def statistics(vectors: DataFrame, size: int) -> Statistics:
    """Sums over all documents; what reaches the driver has a number per term of the queries."""
    sums = vectors.mapInArrow(_tally(size), "term int, n bigint").groupBy("term").agg(F.sum("n").alias("n"))
    found = {row.term: row.n for row in sums.collect()}
    df = np.array([found.get(t, 0) for t in range(size)], dtype=np.int64)
    return Statistics(found.get(-1, 0), found.get(-2, 0), df)


class Best:
    """The best k (score, doc_id) of one query, and the score that the next has to reach."""

    def __init__(self, k: int, floor: int):
        self.k, self.floor = k, floor
        self.rows: list[tuple[int, bool, int]] = []

    def add(self, scores: np.ndarray, ids: list[int | None]) -> None:
        """Rows below the floor are left out; so are those with a score of 0."""
        at = np.flatnonzero(scores >= max(self.floor, 1)).tolist()
        if at:
            self.rows += [(-int(scores[i]), ids[i] is None, ids[i] or 0) for i in at]
            self.rows.sort()
            del self.rows[self.k :]
            if len(self.rows) == self.k:
                self.floor = max(self.floor, -self.rows[-1][0])


def _best_rows(bests: dict[int, Best]) -> pa.RecordBatch:
    found = [(q, -s, None if none else i) for q, best in bests.items() for s, none, i in best.rows]
    columns = [pa.array([r[c] for r in found], t) for c, t in enumerate((pa.int32(), pa.int64(), pa.int64()))]
    return pa.RecordBatch.from_arrays(columns, names=["q", "score", "doc_id"])


def _first_look(queries: Queries, stats: Statistics, rare: list[np.ndarray], k: int):
    """(q, score): the best scores among a task's documents that hold a rare term of q, and
    (-1 - term, impact): the greatest impact of each term there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = len(queries.vocabulary)
        weights, greatest = stats.weights(), np.zeros(size, dtype=np.int64)
        holders: dict[int, list[int]] = {}
        for q, terms in enumerate(rare):
            for t in terms.tolist():
                holders.setdefault(t, []).append(q)
        wanted = np.zeros(size, dtype=bool)
        wanted[list(holders)] = True
        scratch = np.zeros(size, dtype=np.int64)
        bests: dict[int, Best] = {}
        for batch in batches:
            terms, ends = _flat(batch["terms"])
            lengths = np.diff(ends, prepend=0)
            counts = _flat(batch["counts"])[0]
            impacts = stats.impacts(counts, np.repeat(batch["n"].to_numpy(), lengths))
            np.maximum.at(greatest, terms, impacts)
            at = np.flatnonzero(wanted[terms])
            owner = np.repeat(np.arange(len(ends)), lengths)[at].tolist()
            pairs = {(q, d) for d, t in zip(owner, terms[at].tolist()) for q in holders[t]}
            by_query: dict[int, list[int]] = {}
            for q, d in pairs:
                by_query.setdefault(q, []).append(d)
            for q, docs in by_query.items():
                scratch[queries.terms[q]] = weights[queries.terms[q]] * queries.times[q]
                spans = [slice(ends[d] - lengths[d], ends[d]) for d in docs]
                scores = [int((scratch[terms[s]] * impacts[s]).sum()) for s in spans]
                scratch[queries.terms[q]] = 0
                bests.setdefault(q, Best(k, 1)).add(np.array(scores), [None] * len(docs))
        at = np.flatnonzero(greatest).tolist()
        keys = [q for q, best in bests.items() for _ in best.rows] + [-1 - t for t in at]
        values = [-s for best in bests.values() for s, _, _ in best.rows] + greatest[at].tolist()
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int32()), pa.array(values, pa.int64())], names=["q", "score"])

    return run


def _rarest(queries: Queries, df: np.ndarray, documents: int) -> list[np.ndarray]:
    """Of each query its rarest terms, as many as it takes for ``documents`` occurrences."""
    chosen = []
    for terms in queries.terms:
        terms = terms[df[terms] > 0]
        order = terms[np.argsort(df[terms], kind="stable")]
        chosen.append(order[: int(np.searchsorted(np.cumsum(df[order]), documents)) + 1])
    return chosen


def thresholds(
    vectors: DataFrame, queries: Queries, stats: Statistics, k: int
) -> tuple[np.ndarray, np.ndarray]:
    """For each query a score that k documents reach (1 if the first look finds fewer), and the
    greatest impact of each term in any document."""
    look = _first_look(queries, stats, _rarest(queries, stats.df, FIRST_LOOK * k), k)
    found = vectors.mapInArrow(look, "q int, score bigint")
    place = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score")))
    last = found.select("q", "score", place.alias("place")).filter("q >= 0 and place = %d" % k)
    greatest = found.filter("q < 0").groupBy("q").agg(F.max("score").alias("score"))
    floors, tops = np.ones(len(queries.rows), dtype=np.int64), np.zeros(len(stats.df), dtype=np.int64)
    for row in last.select("q", "score").unionByName(greatest).collect():
        if row.q >= 0:
            floors[row.q] = row.score
        else:
            tops[-1 - row.q] = row.score
    return floors, tops


@dataclass(frozen=True)
class Plan:
    """What the tasks of the index and of the search are told about a block of queries.

    ``order[q]`` has the query's terms (as places in ``terms[q]``) by ascending greatest gain, and
    ``gains[q]`` the running sums of these gains: terms whose sum stays below the threshold need
    not be opened. ``coordinates[t]`` has the terms of the queries that may open the list of t.
    """

    queries: Queries
    stats: Statistics
    weights: list[np.ndarray]
    floors: np.ndarray
    order: list[np.ndarray]
    gains: list[np.ndarray]
    coordinates: dict[int, np.ndarray]

    @staticmethod
    def of(queries: Queries, stats: Statistics, floors: np.ndarray, tops: np.ndarray) -> Plan:
        each = stats.weights()
        weights = [each[t] * n for t, n in zip(queries.terms, queries.times)]
        gain = [w * tops[t] for t, w in zip(queries.terms, weights)]
        order = [np.argsort(g, kind="stable") for g in gain]
        gains = [np.cumsum(g[o]) for g, o in zip(gain, order)]
        plan = Plan(queries, stats, weights, floors, order, gains, {})
        beside: dict[int, set[int]] = {}
        for q, terms in enumerate(queries.terms):
            some = terms[tops[terms] > 0].tolist()
            for t in plan.opened(q, int(floors[q])):
                beside.setdefault(int(t), set()).update(some)
        plan.coordinates.update({t: np.array(sorted(c)) for t, c in beside.items()})
        return plan

    def opened(self, q: int, floor: int) -> np.ndarray:
        """Terms one of which every document with a score of ``floor`` or more holds."""
        first = int(np.searchsorted(self.gains[q], floor, side="left"))
        return self.queries.terms[q][self.order[q][first:]]


def _clusters(sketches: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Documents of a list in an order that puts those most like one of some of them next to each
    other, and where each such block begins."""
    n = len(sketches)
    if n <= BLOCK:
        return np.arange(n), np.zeros(1, dtype=np.int64)
    heads = sketches[::BLOCK]
    nearest = np.argmax(sketches @ heads.T, axis=1)
    order = np.argsort(nearest, kind="stable")
    nearest = nearest[order]
    return order, np.flatnonzero(np.concatenate(([True], nearest[1:] != nearest[:-1])))


def _shard(
    plan: Plan, signs: np.ndarray, n: np.ndarray, terms: np.ndarray, counts: np.ndarray, ends: np.ndarray
) -> dict[str, np.ndarray]:
    """One row of the index."""
    lengths = np.diff(ends, prepend=0)
    impacts = plan.stats.impacts(counts, np.repeat(n, lengths))
    doc = np.repeat(np.arange(len(n)), lengths)
    dense = np.zeros((len(n), len(signs)), dtype=np.int32)
    dense[doc, terms] = impacts
    sketches = np.zeros((len(n), SKETCH))
    some = np.flatnonzero(lengths)
    if len(some):
        parts = signs[terms] * impacts[:, None]
        sketches[some] = np.add.reduceat(parts, ends[some] - lengths[some], axis=0)
        sketches /= np.maximum(np.linalg.norm(sketches, axis=1, keepdims=True), 1e-9)
    order = np.argsort(terms, kind="stable")
    cuts = np.searchsorted(terms[order], np.arange(len(signs) + 1))
    lists, blocks, members, summaries = [], [], [], []
    for t, beside in plan.coordinates.items():
        held = doc[order[cuts[t] : cuts[t + 1]]]
        if not len(held):
            continue
        place, starts = _clusters(sketches[held])
        held = held[place]
        top = np.maximum.reduceat(dense[held[:, None], beside[None, :]], starts, axis=0)
        lists.append((t, len(starts)))
        blocks.append(np.concatenate((starts[1:], [len(held)])) - starts)
        members.append(held)
        summaries.append(top.reshape(-1))
    join = lambda parts: np.concatenate(parts) if parts else np.zeros(0, dtype=np.int64)
    return {
        "ends": ends,
        "terms": terms,
        "impacts": impacts,
        "lists": np.array(lists, dtype=np.int64).reshape(-1),
        "blocks": join(blocks),
        "members": join(members),
        "summaries": join(summaries),
    }


def _indexer(plan: Plan):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = len(plan.queries.vocabulary)
        signs = np.random.default_rng(11).choice([-1.0, 1.0], (size, SKETCH))
        signs *= plan.stats.weights()[:, None]
        docs = max(1, min(SHARD_DOCS, SHARD_CELLS // max(size, 1)))
        for batch in batches:
            for at in range(0, batch.num_rows, docs):
                part = batch.slice(at, docs)
                terms, ends = _flat(part["terms"])
                row = _shard(plan, signs, part["n"].to_numpy(), terms, _flat(part["counts"])[0], ends)
                ids = pa.ListArray.from_arrays(pa.array([0, part.num_rows], pa.int32()), part["doc_id"])
                packed = [pa.array([row[name].astype(kind).tobytes()], pa.binary()) for name, kind in PACKED.items()]
                yield pa.RecordBatch.from_arrays([ids, *packed], names=["doc_ids", *PACKED])

    return run


def build_index(vectors: DataFrame, plan: Plan) -> DataFrame:
    """A row per shard of documents, written: their vectors, and for every list that a query may
    open its blocks with their documents and summaries. Holds every document."""
    return materialise(vectors.mapInArrow(_indexer(plan), INDEX), "search-index")


def _search_shard(
    plan: Plan, ids: list[int | None], shard: dict[str, np.ndarray], bests: dict[int, Best], k: int
) -> tuple[int, int]:
    """Adds a shard's documents to the best of each query; gives blocks seen and blocks skipped."""
    size = len(plan.queries.vocabulary)
    ends, blocks, members, summaries = (shard[name] for name in ("ends", "blocks", "members", "summaries"))
    lists = shard["lists"].reshape(-1, 2).tolist()
    dense = np.zeros((len(ids), size), dtype=np.int32)
    dense[np.repeat(np.arange(len(ids)), np.diff(ends, prepend=0)), shard["terms"]] = shard["impacts"]
    where, block, member, cell = {}, 0, 0, 0
    for t, n in lists:
        width = len(plan.coordinates[t])
        sizes = blocks[block : block + n]
        held = members[member : member + int(sizes.sum())]
        where[t] = sizes, held, summaries[cell : cell + n * width].reshape(n, width)
        block, member, cell = block + n, member + len(held), cell + n * width
    scratch = np.zeros(size, dtype=np.int64)
    seen = skipped = 0
    for q, own in enumerate(plan.queries.terms):
        best = bests.setdefault(q, Best(k, int(plan.floors[q])))
        weights = plan.weights[q]
        scratch[own] = weights
        found = []
        for t in plan.opened(q, best.floor).tolist():
            if t not in where:
                continue
            sizes, held, top = where[t]
            fails = top.astype(np.int64) @ scratch[plan.coordinates[t]] < best.floor
            seen, skipped = seen + len(sizes), skipped + int(fails.sum())
            if not fails.all():
                found.append(held[np.repeat(~fails, sizes)])
        scratch[own] = 0
        if found:
            docs = np.unique(np.concatenate(found))
            scores = dense[docs[:, None], own[None, :]].astype(np.int64) @ weights
            best.add(scores, [ids[d] for d in docs.tolist()])
    return seen, skipped


def _searcher(plan: Plan, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bests: dict[int, Best] = {}
        seen = skipped = 0
        for batch in batches:
            for i in range(batch.num_rows):
                shard = {name: np.frombuffer(batch[name][i].as_buffer(), kind) for name, kind in PACKED.items()}
                more = _search_shard(plan, batch["doc_ids"][i].as_py(), shard, bests, k)
                seen, skipped = seen + more[0], skipped + more[1]
        rows = _best_rows(bests)
        # One row more tells how many blocks the task saw and skipped.
        task = pa.RecordBatch.from_arrays(
            [pa.array([-1], pa.int32()), pa.array([seen], pa.int64()), pa.array([skipped], pa.int64())], names=["q", "score", "doc_id"]
        )
        yield from (rows, task)

    return run


def _numbered(queries: DataFrame, id_column: str) -> tuple[DataFrame, int]:
    """(item_id, text, query, part): rows numbered and dealt into parts of bounded text, written."""
    rows = queries.select(F.col(id_column).alias("item_id"), "text")
    rows = materialise(rows.withColumn("query", F.monotonically_increasing_id()), "queries")
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-total // QUERY_BYTES))
    return rows.withColumn("part", F.pmod(F.xxhash64("query"), F.lit(parts))), parts


def search(docs: DataFrame, queries: DataFrame, k: int = K, id_column: str = "item_id") -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents for every row of ``queries``
    (``id_column``, text); exact, see the module."""
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    rows, parts = _numbered(queries, id_column)
    found = None
    for part in range(parts):
        asked = Queries.of([(r.query, r.text) for r in rows.filter(F.col("part") == part).collect()])
        if not asked.rows:
            continue
        hits = search_block(docs, asked, k)
        found = hits if found is None else found.unionByName(hits)
    if found is None:
        return rows.limit(0).selectExpr("item_id", "1 as rank", "0L as doc_id", "0L as score")
    place = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
    ranked = found.select("query", "score", "doc_id", place.alias("rank")).filter(F.col("rank") <= k)
    return ranked.join(rows, "query").select("item_id", "rank", "doc_id", "score")


def search_block(docs: DataFrame, queries: Queries, k: int, report: list | None = None) -> DataFrame:
    """(query, score, doc_id), written: of every task the best k it has for each query of a block.
    ``report`` receives (blocks that came up, blocks skipped)."""
    vectors = materialise(docs.mapInArrow(_vectors(queries.vocabulary), VECTORS), "term-counts")
    stats = statistics(vectors, len(queries.vocabulary))
    floors, tops = thresholds(vectors, queries, stats, k)
    plan = Plan.of(queries, stats, floors, tops)
    index = build_index(vectors, plan)
    found = materialise(index.mapInArrow(_searcher(plan, k), "q int, score bigint, doc_id bigint"), "found")
    if report is not None:
        report.append(tuple(found.filter("q < 0").agg(F.sum("score"), F.sum("doc_id")).first()))
    rows = list(enumerate(queries.rows))
    names = docs.sparkSession.createDataFrame(rows, "q int, query bigint")
    return found.join(names, "q").select("query", "score", "doc_id")
