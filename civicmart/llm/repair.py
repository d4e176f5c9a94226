"""Conversation structure repair: the cheapest edits that give user and assistant in turn.

A conversation is repaired by keeping, deleting, re-roling and inserting rows until the initials
of its roles read ``(s?(ua)+)?``. Reading one row is a step between four states (nothing yet, after
the system row, after a user row, after an assistant row), so the cheapest edits are a shortest
path, found by the Viterbi recursion; of several, the one whose edit letters come first in ASCII.

The recursion runs in parallel over chunks of a conversation, by rank convergence. A chunk's steps
act on a vector with a cost for each state, and after a few rows vectors that began differently
differ by a constant only. So every chunk is run at once, backward, from a speculative vector (that
of the end of a conversation). In fix-up passes a chunk runs again if its successor arrived at a
vector that is not, up to a constant, the one it began with; passes end when none has to. The
constants add up to the conversation's cost. The same passes, forward, stitch the states at the
chunks' ends, and tracing follows in each chunk the least edit whose cost the backward vectors
confirm. A conversation holding most rows is many chunks, dealt like those of any other.

Rows are laid in order by one range partitioning over (conversation, turn, role, text), equal rows
counted as one beforehand, and chunks are cut from the partitions: some ``CHUNK`` rows, or
``CHUNK_BYTES`` of text. What is bounded by a conversation, not by a chunk: its audit, which is one
value of the result, and the digest of its repaired rows, which is one stream through one task, in
constant memory.

Defined results. Null roles and texts are one space; a null turn sorts first. Rows of one turn go by
role, then text, by code points. Conversations without an id are one conversation. An initial is the
first character of the role; rows with another one than s, u or a can only be deleted or re-roled.
Empty tables give no rows, other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator
from functools import cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicmart.operators.features import heavy_keys, left_chain
from civicmart.session import materialise

CHUNK, CHUNK_BYTES = 4096, 4_000_000
BLANK, DUPLICATE, TRUNCATED = "blank", "duplicate", "truncated"
# Costs of the edits, and of an undeleted truncated row.
REROLE, DELETE, INSERT, UNMENDED = 2, 3, 2, 1
# States: nothing yet, after the system row, after a user row, after an assistant row.
START, SYSTEM, USER, ASSISTANT = range(4)
TAKES_USER = (START, SYSTEM, ASSISTANT)
Vector = tuple[int, int, int, int]


# -- damage, and what it leaves -----------------------------------------------------------


def _known(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(" "))


def damaged(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, n): the rows left of ``conversations`` after its damage, which
    a checksum of conversation and turn decides; n is how often a row comes."""
    kind = F.crc32(F.concat(_known("conv_id"), F.lit(":"), _known("turn"))) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(_known("text"), "[.!?]", "")).otherwise(_known("text"))
    role = F.when(kind == 4, "user").otherwise(_known("role"))
    left = rows.filter(kind != 0)
    return left.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.when(kind == 3, 2).otherwise(1).alias("n"))


def classified(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, n, fault) of rows (conv_id, turn, role, text, n), equal rows as
    one. ``fault`` is that of the first of them; the others are blank or duplicates."""
    rows = rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("n").alias("n"))
    # Null ids are a key of their own, and join.
    keys = {"conv": F.coalesce(F.col("conv_id").cast("string"), F.lit("")), "none": F.col("conv_id").isNull(), "digest": F.unhex(F.md5(F.concat("role", F.lit(":"), "text")))}
    names = list(keys)
    rows = materialise(rows.withColumns(keys), "turns")
    # The least turn, null before all.
    first = rows.groupBy(*names).agg(F.min(F.struct(F.col("turn").isNotNull().alias("has"), F.col("turn").alias("at"))).alias("first"))
    heavy = materialise(heavy_keys(rows, names), "heavy-turns")
    rows = left_chain(rows, [first], names, heavy)
    last = F.regexp_extract("text", r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z", 1)
    fault = (
        F.when(~F.col("text").rlike(r"[^\x20\x09-\x0D]"), BLANK)
        .when(~F.col("turn").eqNullSafe(F.col("first.at")), DUPLICATE)
        .when(~last.isin(".", "!", "?"), TRUNCATED)
    )
    return rows.select("conv_id", "turn", "role", "text", "n", fault.alias("fault"))


# -- steps over one chunk -------------------------------------------------------------------
# A symbol is (initial, fault, n): a row and n - 1 more like it, which have to go.


def _vector(costs: list[int]) -> tuple[Vector, int]:
    least = min(costs)
    return tuple(c - least for c in costs), least


def _with_inserts(costs: list[int]) -> list[int]:
    """Costs to go if rows may be inserted before."""
    costs = list(costs)
    for _ in range(3):
        for state in TAKES_USER:
            costs[state] = min(costs[state], costs[USER] + INSERT)
        costs[USER] = min(costs[USER], costs[ASSISTANT] + INSERT)
    return costs


END, _ = _vector(_with_inserts([0, 99, 99, 0]))


def _edits(initial: str, fault: str | None) -> list[tuple[str, dict[int, int], int]]:
    """(letter, state -> next state, cost) of the edits that take a row, letters in order."""
    after = {state: USER for state in TAKES_USER} | {USER: ASSISTANT}
    found = [("D", {s: s for s in range(4)}, DELETE)]
    if fault in (BLANK, DUPLICATE):
        return found
    more = UNMENDED if fault == TRUNCATED else 0
    keep = {"s": {START: SYSTEM}, "u": {s: USER for s in TAKES_USER}, "a": {USER: ASSISTANT}}.get(initial, {})
    return found + [("K", keep, more), ("R", after, REROLE + more)]


@cache
def _back(vector: Vector, initial: str, fault: str | None) -> tuple[Vector, int]:
    """Costs to go before a row, from those after it."""
    costs = []
    for state in range(4):
        ways = [vector[to[state]] + cost for _, to, cost in _edits(initial, fault) if state in to]
        costs.append(min(ways))
    return _vector(_with_inserts(costs))


def backward(symbols: list, vector: Vector) -> tuple[list[Vector], int]:
    """Vectors before each symbol and after the last, each up to a constant; the constants' sum."""
    vectors, total = [vector], 0
    for initial, fault, n in reversed(symbols):
        vector, cost = _back(vector, initial, fault)
        total += cost + DELETE * (n - 1)
        vectors.append(vector)
    return vectors[::-1], total


@cache
def _choice(state: int, before: Vector, after: Vector, initial: str, fault: str | None) -> tuple[str, int]:
    """Letters up to the one that takes the row, and the state then: at each point the least
    letter on a cheapest path, D before I, K and R. Small i and r give an assistant row."""
    letters = ""
    lift = _back(after, initial, fault)[1]
    while True:
        owed = before[state] + lift
        for letter, to, cost in _edits(initial, fault):
            inserted = None if letter == "D" else _inserted(state, before)
            if inserted is not None:
                letters, state = letters + ("I" if inserted == USER else "i"), inserted
                break
            if state in to and after[to[state]] + cost == owed:
                return letters + ("r" if letter == "R" and to[state] == ASSISTANT else letter), to[state]


def _inserted(state: int, costs: Vector) -> int | None:
    """The state after an insertion, if it is on a cheapest path."""
    to = USER if state in TAKES_USER else ASSISTANT
    return to if costs[to] + INSERT == costs[state] else None


def trace(symbols: list, vectors: list[Vector], state: int, ends: bool) -> tuple[list[str], int]:
    """The letters of each symbol and, if a conversation ends here, those after the last; the
    state at the end."""
    pieces = []
    for i, (initial, fault, n) in enumerate(symbols):
        letters, state = _choice(state, vectors[i], vectors[i + 1], initial, fault)
        pieces.append(letters + "D" * (n - 1))
    if ends:
        tail = ""
        while state not in (START, ASSISTANT):
            state = _inserted(state, END)
            tail += "I" if state == USER else "i"
        pieces.append(tail)
    return pieces, state


# -- chunks ---------------------------------------------------------------------------------


def _cut(size: int) -> Callable:
    """Rows of a sorted partition with partition, chunk, and place in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        chunk, place, held, last = -1, 0, 0, None
        for batch in batches:
            chunks, places = [], []
            for conv, length in zip(batch["conv_id"].to_pylist(), batch["bytes"].to_pylist()):
                if chunk < 0 or conv != last or place + 1 >= size or held + length > CHUNK_BYTES:
                    chunk, place, held, last = chunk + 1, -1, 0, conv
                place, held = place + 1, held + length
                chunks.append(chunk)
                places.append(place)
            where = [pa.array([part] * len(chunks), pa.int32()), pa.array(chunks, pa.int64()), pa.array(places, pa.int32())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *where], names=[*batch.schema.names, "part", "chunk", "place"])

    return run


def _symbols(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per chunk: its symbols as text, and its rows whose role does not follow the last's."""
    held: list = []
    key = None

    def closed() -> pa.RecordBatch:
        initials = [s[0] for s in held]
        illegal = sum(s[2] - 1 for s in held) + sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        row = {"g": key[0], "conv_id": key[1], "symbols": json.dumps(held), "first": initials[0], "last": initials[-1], "illegal": illegal}
        return pa.RecordBatch.from_pylist([row], schema=kinds)

    kinds = None
    for batch in batches:
        kinds = kinds or pa.schema(
            [("g", pa.int64()), ("conv_id", batch.schema.field("conv_id").type)]
            + [(c, pa.string()) for c in ("symbols", "first", "last")]
            + [("illegal", pa.int64())]
        )
        columns = [batch[c].to_pylist() for c in ("g", "conv_id", "initial", "fault", "n")]
        for g, conv, *symbol in zip(*columns):
            if key is not None and key[0] != g:
                yield closed()
                held = []
            key = g, conv
            held.append(symbol)
    if held:
        yield closed()


def _ordered(rows: DataFrame, chunk: int) -> DataFrame:
    """``rows`` in order, with ``g``, the number of the chunk, and ``place`` in it, written. Chunks
    are numbered without gaps in the order of their rows."""
    order = [F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), F.asc("role"), F.asc("text")]
    size = F.octet_length("role") + F.octet_length("text")
    laid = rows.withColumn("bytes", size).repartitionByRange(*order).sortWithinPartitions(*order)
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in laid.schema)
    laid = materialise(laid.mapInArrow(_cut(chunk), f"{fields}, part int, chunk bigint, place int"), "ordered")
    # A number per partition reaches the driver.
    starts, at = [], 0
    for row in laid.groupBy("part").agg(F.max("chunk").alias("top")).orderBy("part").collect():
        starts.append((row.part, at))
        at += row.top + 1
    starts = rows.sparkSession.createDataFrame(starts, "part int, start bigint")
    initial = F.substring("role", 1, 1).alias("initial")
    g = (F.col("start") + F.col("chunk")).alias("g")
    return laid.join(starts, "part").select("conv_id", "turn", "role", "text", "n", "fault", "place", initial, g)


def _chunks(ordered: DataFrame) -> DataFrame:
    """A row per chunk, written: (g, conv_id, symbols, illegal, begins, ends)."""
    kind = ordered.schema["conv_id"].dataType.simpleString()
    rows = ordered.select("g", "place", "conv_id", "initial", "fault", "n").repartition("g").sortWithinPartitions("g", "place")
    found = rows.mapInArrow(_symbols, f"g bigint, conv_id {kind}, symbols string, first string, last string, illegal bigint")
    found = materialise(found, "chunks")
    near = {}
    for name, step in (("before", 1), ("after", -1)):
        near[name] = found.select((F.col("g") + step).alias("g"), F.struct("conv_id", "first", "last").alias(name))
    both = found.join(near["before"], "g", "left").join(near["after"], "g", "left")
    same = lambda side: F.col(side).isNotNull() & F.col("conv_id").eqNullSafe(F.col(f"{side}.conv_id"))
    # One pair more where the conversation goes on from the chunk before.
    broken = same("before") & ~F.concat("before.last", "first").isin("su", "ua", "au")
    both = both.select(
        "g", "conv_id", "symbols", (F.col("illegal") + broken.cast("bigint")).alias("illegal"), (~same("before")).alias("begins"), (~same("after")).alias("ends")
    )
    return materialise(both, "linked-chunks")


# -- passes ---------------------------------------------------------------------------------


def _each(function: Callable[[dict], dict], schema: str) -> Callable[[DataFrame], DataFrame]:
    """Runs ``function`` on every row of a table of chunks."""
    kinds = {"bigint": pa.int64(), "array<int>": pa.list_(pa.int32()), "array<string>": pa.list_(pa.string())}
    fields = pa.schema([(name, kinds[kind]) for name, kind in (field.split() for field in schema.split(", "))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_pylist([function(row) for row in batch.to_pylist()], schema=fields)

    return lambda rows: rows.mapInArrow(run, schema)


def _run_back(row: dict) -> dict:
    vectors, cost = backward(json.loads(row["symbols"]), tuple(row["given"]))
    return {"g": row["g"], "given": row["given"], "gives": list(vectors[0]), "cost": cost}


def _run_trace(row: dict) -> dict:
    symbols = json.loads(row["symbols"])
    vectors, _ = backward(symbols, tuple(row["end"]))
    letters, state = trace(symbols, vectors, row["given"][0], row["ends"])
    return {"g": row["g"], "given": row["given"], "gives": [state], "letters": letters}


def converge(
    chunks: DataFrame, step: int, open_end: str, first: Column, run: Callable[[DataFrame], DataFrame], name: str
) -> DataFrame:
    """(g, given, gives, ...) of every chunk, written, once no chunk was given anything but what its
    neighbour gives. ``step`` is 1 if a chunk gives to the next one, -1 if to the one before;
    ``open_end`` marks chunks without a giver, and ``first`` is what chunks begin with.

    A pass runs only the chunks whose giver has changed, and whether there are any is all that
    reaches the driver. Results are the true ones from the open end on, and from wherever a wrong
    beginning has been forgotten, so passes end after a few, at the latest when all are reached.
    """
    done = materialise(run(chunks.withColumn("given", first)), name)
    while True:
        gives = done.select((F.col("g") + step).alias("g"), F.col("gives").alias("wanted"))
        stale = chunks.filter(~F.col(open_end)).join(done.select("g", "given"), "g").join(gives, "g")
        stale = stale.filter("given != wanted").drop("given").withColumnRenamed("wanted", "given")
        stale = materialise(stale, f"{name}-again")
        if stale.isEmpty():
            return done
        kept = done.join(stale.select("g"), "g", "left_anti")
        done = materialise(kept.unionByName(run(stale)), name)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(conv_id, repaired_sha256) from the lines of conversations, which come in order."""
    key, digest, schema = None, None, None

    def closed() -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([{"conv_id": key, "repaired_sha256": digest.hexdigest()}], schema=schema)

    for batch in batches:
        schema = pa.schema([batch.schema.field("conv_id"), ("repaired_sha256", pa.string())])
        for conv, line in zip(batch["conv_id"].to_pylist(), batch["line"].to_pylist()):
            if digest is None or conv != key:
                if digest is not None:
                    yield closed()
                key, digest = conv, hashlib.sha256(line.encode())
            else:
                digest.update(b"\n" + line.encode())
    if digest is not None:
        yield closed()


def _edited(ordered: DataFrame, traced: DataFrame, chunks: DataFrame) -> DataFrame:
    """(conv_id, g, place, i, role, text) of the rows that are kept, re-roled or inserted; i puts
    the insertions before the row at that place."""
    pieces = traced.select("g", F.posexplode("letters").alias("place", "letters"))
    pieces = pieces.withColumn("letters", F.regexp_replace("letters", "D", "")).filter("letters != ''")
    placed = pieces.join(chunks.select("g", "conv_id"), "g")
    placed = placed.join(ordered.select("g", "place", "role", "text"), ["g", "place"], "left")
    each = F.posexplode(F.regexp_extract_all("letters", F.lit("."), F.lit(0))).alias("i", "letter")
    rows = placed.select("conv_id", "g", "place", "role", "text", each)
    letter = F.col("letter")
    role = F.when(letter == "K", F.col("role")).when(letter.isin("I", "R"), "user").otherwise("assistant")
    text = F.when(F.upper(letter) == "I", "").otherwise(F.col("text"))
    return rows.select("conv_id", "g", "place", "i", role.alias("role"), text.alias("text"))


def _faults(known: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated) per conversation."""
    wide = lambda column: column.cast("decimal(38,0)")
    distinct = known.groupBy("conv_id", "turn").agg(
        F.sum(F.when(F.col("fault") == BLANK, F.col("n"))).alias("blank"),
        F.sum(F.when(F.col("fault") == DUPLICATE, F.col("n")).when(F.col("fault").eqNullSafe(BLANK), 0).otherwise(F.col("n") - 1)).alias("duplicate"),
        F.sum(F.when(F.col("fault") == TRUNCATED, 1)).alias("truncated"),
    )
    count = lambda name: F.coalesce(F.sum(name), F.lit(0)).cast("bigint").alias(name)
    gaps = wide(F.max("turn")) - wide(F.min("turn")) + 1 - F.count("turn")
    return distinct.groupBy("conv_id").agg(
        F.coalesce(gaps.try_cast("bigint"), F.lit(0).cast("bigint")).alias("gaps"), *map(count, (BLANK, DUPLICATE, TRUNCATED))
    )


def repair(rows: DataFrame, chunk: int = CHUNK) -> tuple[DataFrame, DataFrame]:
    """Repairs conversations (conv_id, turn, role, text, n), n rows alike, in chunks of ``chunk``
    rows. Gives the repaired rows,
    in order by (conv_id, g, place, i), with role and text, and a report per conversation: conv_id,
    gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256."""
    known = materialise(classified(rows), "faults")
    ordered = _ordered(known, chunk)
    chunks = _chunks(ordered)
    ending = F.array(*map(F.lit, END))
    back = converge(
        chunks, -1, "ends", ending, _each(_run_back, "g bigint, given array<int>, gives array<int>, cost bigint"), "backward"
    )
    ready = materialise(chunks.join(back.select("g", F.col("given").alias("end")), "g"), "stitched")
    start = F.array(F.when(F.col("begins"), START).otherwise(ASSISTANT))
    run = _each(_run_trace, "g bigint, given array<int>, gives array<int>, letters array<string>")
    traced = converge(ready, 1, "begins", start, run, "traced")
    edited = materialise(_edited(ordered, traced, chunks), "repaired")

    parts = chunks.select("g", "conv_id", "illegal", "begins").join(back.select("g", "gives", "cost"), "g")
    parts = parts.join(traced.select("g", F.upper(F.array_join("letters", "")).alias("letters")), "g")
    # What the constants leave out is the cost to go from the first state at the very beginning.
    cost = F.col("cost") + F.when(F.col("begins"), F.col("gives")[START]).otherwise(0)
    pieces = F.array_sort(F.collect_list(F.struct("g", "letters")))
    costs = parts.groupBy("conv_id").agg(
        F.sum("illegal").alias("illegal"),
        F.sum(cost).alias("cost"),
        F.array_join(F.transform(pieces, lambda piece: piece["letters"]), "").alias("audit"),
    )
    lines = edited.select("conv_id", "g", "place", "i", F.concat("role", F.lit(":"), "text").alias("line"))
    lines = lines.repartition("conv_id").sortWithinPartitions("conv_id", "g", "place", "i")
    kind = rows.schema["conv_id"].dataType.simpleString()
    digests = lines.mapInArrow(_digests, f"conv_id {kind}, repaired_sha256 string")
    report = costs
    for side in (_faults(known), digests):
        side = side.withColumnRenamed("conv_id", "of")
        report = report.join(side, report["conv_id"].eqNullSafe(side["of"]), "left").drop("of")
    empty = F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256")
    return edited, report.select("conv_id", "gaps", BLANK, DUPLICATE, TRUNCATED, "illegal", "cost", "audit", empty)


def repair_report(conversations: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """The report of the damaged rows of ``conversations``, for each of its conversations; one of
    which nothing is left has zeros, an empty audit and the digest of nothing."""
    named = conversations.select("conv_id").distinct().withColumnRenamed("conv_id", "original")
    report = repair(damaged(conversations), chunk)[1]
    counts = [F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in ("gaps", BLANK, DUPLICATE, TRUNCATED, "illegal", "cost")]
    audit = F.coalesce("audit", F.lit("")).alias("audit")
    digest = F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256")
    found = named.join(report, named["original"].eqNullSafe(report["conv_id"]), "left")
    return found.select(F.col("original").alias("conv_id"), *counts, audit, digest)
