"""Secret scans with one automaton for all rules.

The rules are compiled together, by subset construction and minimisation, into one array of
transitions. One pass over the bytes of a text finds where matches of any rule may end; only
there a rule's own automata go back to the leftmost start and on to the longest end.

Matches are leftmost, longest and don't overlap within a rule; one whose body is too short is
dropped, but its characters are used up. Spans are code points, the end exclusive.

Defined results. A null text counts as empty, an empty one has no spans. Every row gives a row,
repeated ones too; other columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from civicmart.llm import automaton


@dataclass(frozen=True)
class Rule:
    """A match is ``head`` then ``body``; the body must have ``least`` characters."""

    kind: str
    head: str
    body: str
    least: int = 1
    fold: bool = False  # letters of the head in either case


BASE = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?""", r"[A-Za-z0-9+/_.=\x2d]+", 6, True),
    Rule("access", "AKIA", "[A-Z0-9]+", 16),
    # A run is a match of its own, so its least length can be part of the pattern.
    Rule("hex", "", "[0-9a-f]{24,}"),
)
# Public token formats.
MORE = (
    Rule("github", "gh[pousr]_", "[A-Za-z0-9]+", 36),
    Rule("slack", r"xox[abprs]\x2d", r"[A-Za-z0-9\x2d]+", 10),
    Rule("google", "AIza", r"[A-Za-z0-9_\x2d]+", 35),
    Rule("stripe", "sk_live_", "[A-Za-z0-9]+", 24),
    Rule("jwt", "eyJ", r"[A-Za-z0-9_.\x2d]+", 40),
    Rule("private_key", r"\x2d\x2d\x2d\x2d\x2dBEGIN ", r"[A-Z ]*PRIVATE KEY\x2d\x2d\x2d\x2d\x2d"),
)
RULES = BASE + MORE


class Scanner:
    """Compiled rules. No rule may have a match that begins before another one and first ends
    behind it; where a rule's first possible end is, there is then its leftmost match."""

    def __init__(self, rules: tuple[Rule, ...] = RULES) -> None:
        self.rules = rules
        heads = [automaton.parse(r.head, r.fold) for r in rules]
        wholes = [("seq", head, automaton.parse(r.body)) for head, r in zip(heads, rules)]
        self.all = automaton.anywhere(wholes)
        # Rows of the array instead of states: one addition less per byte.
        self.rows = [256 * state for state in self.all.table]
        self.heads = [automaton.anchored(t) for t in heads]
        self.wholes = [automaton.anchored(t) for t in wholes]
        self.back = [automaton.backwards(t) for t in wholes]

    def ends(self, data: bytes) -> dict[int, list[int]]:
        """By rule, where matches may end. This is the one pass over the bytes."""
        rows, row, hits = self.rows, 256 * self.all.start, 256 * self.all.hits
        found: dict[int, list[int]] = {}
        for i, byte in enumerate(data, 1):
            row = rows[row + byte]
            if row >= hits:
                for rule in self.all.rules[(row - hits) >> 8]:
                    found.setdefault(rule, []).append(i)
        return found

    def _start(self, rule: int, data: bytes, end: int, floor: int) -> int:
        """Leftmost start, not before ``floor``, of a match that ends at ``end``; -1 if none."""
        back = self.back[rule]
        state, best = back.start, -1
        for i in range(end - 1, floor - 1, -1):
            state = back.table[state * 256 + data[i]]
            if not state:
                break
            if state >= back.hits:
                best = i
        return best

    def spans(self, data: bytes) -> list[tuple[int, int, int]]:
        """Sorted (start, rule, end) in bytes."""
        found = []
        for rule, ends in self.ends(data).items():
            used = 0
            for end in ends:
                if end <= used:
                    continue
                start = self._start(rule, data, end, used)
                if start < 0:
                    continue
                used = self.wholes[rule].longest(data, start)
                body = self.heads[rule].longest(data, start, used)
                if used - max(body, start) >= self.rules[rule].least:
                    found.append((start, rule, used))
        return sorted(found)

    def scan(self, text: str) -> list[tuple[str, int, int]]:
        """(kind, start, end) in code points, by start, then in the order of the rules."""
        data = text.encode("utf-8", "surrogatepass")
        spans = self.spans(data)
        if len(data) == len(text):
            return [(self.rules[k].kind, s, e) for s, k, e in spans]
        marks, at, points = {}, 0, 0
        for mark in sorted({x for s, _, e in spans for x in (s, e)}):
            points += len(data[at:mark].decode("utf-8", "surrogatepass"))
            marks[mark], at = points, mark
        return [(self.rules[k].kind, marks[s], marks[e]) for s, k, e in spans]


@lru_cache(maxsize=4)
def scanner_for(rules: tuple[Rule, ...]) -> Scanner:
    """Compiled once per worker process."""
    return Scanner(rules)


SCHEMA = (
    "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string"
)


def _joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def secret_report(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """A row per document: base counts, the digest of the base spans, and all spans.

    No shuffle: each task scans the rows it reads.
    """
    base = {rule.kind for rule in BASE}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = scanner_for(rules)
        for batch in batches:
            columns: list[list] = [[] for _ in range(6)]
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"]):
                spans = scanner.scan(text.as_py() or "")
                kept = [s for s in spans if s[0] in base]
                counts = [sum(s[0] == kind for s in kept) for kind in ("assign", "access", "hex")]
                digest = hashlib.sha256(_joined(kept).encode()).hexdigest()
                for column, value in zip(columns, (doc_id, *counts, digest, _joined(spans))):
                    column.append(value)
            kinds = [pa.int64()] * 4 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)],
                names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)
