"""Small regular expressions to minimal byte automata: parse, subset construction, minimise.

Patterns are literals, escapes ``\\xHH`` and ``\\.``, classes ``[a-z0-9_]``, groups, ``|``, and
the repeats ``? * + {m} {m,}``; all of them are over ASCII. Two or more patterns make one
automaton whose states say which of them match up to here.
"""

from __future__ import annotations

import re

import numpy as np

TOKEN = re.compile(r"\\x[0-9A-Fa-f]{2}|\\.|\[(?:\\.|[^\]])+\]|\{\d+,?\}|.", re.S)


class _Nfa:
    def __init__(self) -> None:
        self.free: list[list[int]] = []  # moves without a byte
        self.moves: list[tuple[frozenset[int], int] | None] = []

    def state(self) -> int:
        self.free.append([])
        self.moves.append(None)
        return len(self.free) - 1


def _one(token: str) -> int:
    if token.startswith("\\x"):
        return int(token[2:], 16)
    return ord(token[1] if token.startswith("\\") else token)


def _bytes(token: str, fold: bool) -> frozenset[int]:
    if token.startswith("["):
        parts = re.findall(r"\\x[0-9A-Fa-f]{2}|\\.|.", token[1:-1], re.S)
        found, i = set(), 0
        while i < len(parts):
            if i + 2 < len(parts) and parts[i + 1] == "-":
                found |= set(range(_one(parts[i]), _one(parts[i + 2]) + 1))
                i += 3
            else:
                found.add(_one(parts[i]))
                i += 1
    else:
        found = {_one(token)}
    if fold:
        found |= {ord(chr(b).swapcase()) for b in found if chr(b).isalpha()}
    return frozenset(found)


def parse(pattern: str, fold: bool = False) -> tuple:
    """Tree of ("byte", set), ("seq", ...), ("alt", ...) and ("rep", tree, least, endless)."""
    tokens, at = TOKEN.findall(pattern), 0

    def alternatives() -> tuple:
        nonlocal at
        found = [sequence()]
        while at < len(tokens) and tokens[at] == "|":
            at += 1
            found.append(sequence())
        return ("alt", *found) if len(found) > 1 else found[0]

    def sequence() -> tuple:
        nonlocal at
        found = []
        while at < len(tokens) and tokens[at] not in "|)":
            token = tokens[at]
            at += 1
            if token == "(":
                item = alternatives()
                at += 1
            else:
                item = ("byte", _bytes(token, fold))
            if at < len(tokens) and (tokens[at] in "?*+" or tokens[at][0] == "{" and len(tokens[at]) > 1):
                repeat = tokens[at]
                at += 1
                if repeat == "?":
                    item = ("alt", item, ("seq",))
                elif repeat in "*+":
                    item = ("rep", item, int(repeat == "+"), True)
                else:
                    item = ("rep", item, int(re.search(r"\d+", repeat)[0]), "," in repeat)
            found.append(item)
        return ("seq", *found)

    return alternatives()


def _reverse(tree: tuple) -> tuple:
    if tree[0] == "byte":
        return tree
    if tree[0] == "rep":
        return ("rep", _reverse(tree[1]), *tree[2:])
    inner = [_reverse(t) for t in tree[1:]]
    return (tree[0], *(inner[::-1] if tree[0] == "seq" else inner))


def shortest(tree: tuple) -> tuple:
    """The tree without the endless repeat at its end: it matches where a match can first end."""
    if tree[0] == "rep":
        return (*tree[:3], False)
    return (*tree[:-1], shortest(tree[-1])) if tree[0] == "seq" and len(tree) > 1 else tree


def _build(nfa: _Nfa, tree: tuple, start: int) -> int:
    if tree[0] == "byte":
        end = nfa.state()
        nfa.moves[start] = (tree[1], end)
        return end
    if tree[0] == "alt":
        end = nfa.state()
        for inner in tree[1:]:
            begin = nfa.state()
            nfa.free[start].append(begin)
            nfa.free[_build(nfa, inner, begin)].append(end)
        return end
    parts = tree[1:] if tree[0] == "seq" else [tree[1]] * tree[2]
    for inner in parts:
        begin = nfa.state()
        nfa.free[start].append(begin)
        start = _build(nfa, inner, begin)
    if tree[0] == "rep" and tree[3]:
        loop, begin = nfa.state(), nfa.state()
        nfa.free[start].append(loop)
        nfa.free[loop].append(begin)
        nfa.free[_build(nfa, tree[1], begin)].append(loop)
        return loop
    return start


class Automaton:
    """``table[state * 256 + byte]`` is the next state; state 0 is dead. States from ``hits`` on
    accept, and ``rules[state - hits]`` says which patterns."""

    def __init__(self, trees: list[tuple], anywhere: bool = False) -> None:
        nfa = _Nfa()
        first = nfa.state()
        ends = {}
        for k, tree in enumerate(trees):
            begin = nfa.state()
            nfa.free[first].append(begin)
            ends[_build(nfa, tree, begin)] = k

        def closure(states) -> frozenset[int]:
            seen, todo = set(states), list(states)
            while todo:
                for to in nfa.free[todo.pop()]:
                    if to not in seen:
                        seen.add(to)
                        todo.append(to)
            # Only states with a move or an end tell sets apart.
            return frozenset(s for s in seen if nfa.moves[s] or s in ends)

        # Subset construction over all 256 bytes.
        start = closure([first])
        sets, todo, rows = {frozenset(): 0, start: 1}, [start], {0: [0] * 256}
        while todo:
            here = todo.pop()
            targets: dict[int, set[int]] = {}
            for s in here | start if anywhere else here:
                if nfa.moves[s]:
                    for b in nfa.moves[s][0]:
                        targets.setdefault(b, set()).add(nfa.moves[s][1])
            rest = start if anywhere else frozenset()
            cache: dict[frozenset[int], int] = {}
            row = []
            for b in range(256):
                key = frozenset(targets.get(b, ()))
                if key not in cache:
                    to = closure(key) | rest
                    if to not in sets:
                        sets[to] = len(sets)
                        todo.append(to)
                    cache[key] = sets[to]
                row.append(cache[key])
            rows[sets[here]] = row
        if anywhere:
            rows[0] = [0] * 256
        table = np.array([rows[i] for i in range(len(sets))])
        accepts = [()] * len(sets)
        for states, i in sets.items():
            accepts[i] = tuple(sorted({ends[s] for s in states if s in ends}))
        self._minimise(table, accepts)

    def _minimise(self, table: np.ndarray, accepts: list[tuple]) -> None:
        """States are split by what they accept, then by where their bytes lead, until nothing splits."""
        names = {a: i for i, a in enumerate(sorted(set(accepts)))}
        part = np.array([names[a] for a in accepts])
        while True:
            _, new = np.unique(np.column_stack([part, part[table]]), axis=0, return_inverse=True)
            if new.max() == part.max():
                break
            part = new.reshape(-1)
        # The dead state first, then the silent ones, then those that accept.
        first = {int(p): i for i, p in reversed(list(enumerate(part)))}
        order = sorted(first, key=lambda p: (p != part[0], bool(accepts[first[p]]), first[p]))
        number = {p: i for i, p in enumerate(order)}
        self.start = number[int(part[1])] if len(part) > 1 else 0
        renamed = np.array([number[int(p)] for p in part])
        self.table = renamed[table[[first[p] for p in order]]].reshape(-1).tolist()
        kinds = [accepts[first[p]] for p in order]
        self.hits = next((i for i, a in enumerate(kinds) if a), len(kinds))
        self.rules = kinds[self.hits :]

    def longest(self, data: bytes, start: int, stop: int | None = None) -> int:
        """End of the longest match that begins at ``start``, or -1."""
        table, state, hits, end = self.table, self.start, self.hits, -1
        if state >= hits:
            end = start
        for i in range(start, len(data) if stop is None else stop):
            state = table[state * 256 + data[i]]
            if not state:
                break
            if state >= hits:
                end = i + 1
        return end


def anywhere(patterns: list[tuple]) -> Automaton:
    """One automaton that, fed a whole text, is in a hit state wherever a match may first end.
    Leaving out endless repeats behind that keeps the product of the patterns small."""
    return Automaton([shortest(p) for p in patterns], anywhere=True)


def anchored(tree: tuple) -> Automaton:
    return Automaton([tree])


def backwards(tree: tuple) -> Automaton:
    """Reads a match from its end to its start."""
    return Automaton([_reverse(tree)])
