import hashlib
import random
import re
import zlib

import pytest
from llm_fixtures import shipped  # noqa: F401

from civicmart.llm import repair as rp

SCHEMA = "conv_id bigint, turn bigint, role string, text string, g string, n string, place string, `a.b` string"
FIELDS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def table(spark, turns):
    return spark.createDataFrame([(*t, "g", "n", "p", "d") for t in turns], SCHEMA)


def damage(turns):
    for conv, turn, role, text in turns:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        row = conv, turn, "user" if kind == 4 else role, text
        yield from [row] * (0 if kind == 0 else 2 if kind == 3 else 1)


def cheapest(rows):
    """(cost, audit, lines) of the least repair, by all paths over rows and states."""
    after = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}
    best = {0: (0, "", [])}

    def inserted(best):
        for _ in range(3):
            for state, (cost, audit, lines) in list(best.items()):
                to, role = (3, "assistant") if state == 2 else (2, "user")
                way = cost + 2, audit + "I", lines + [f"{role}:"]
                if to not in best or way[:2] < best[to][:2]:
                    best[to] = way
        return best

    for role, text, fault in rows:
        ways = {}
        for state, (cost, audit, lines) in inserted(dict(best)).items():
            more = fault == "truncated"
            options = [(state, 3, "D", [])]
            if fault not in ("blank", "duplicate"):
                if (role[:1], state) in after:
                    options.append((after[role[:1], state], more, "K", [f"{role}:{text}"]))
                to, other = (3, "assistant") if state == 2 else (2, "user")
                options.append((to, 2 + more, "R", [f"{other}:{text}"]))
            for to, paid, letter, line in options:
                way = cost + paid, audit + letter, lines + line
                if to not in ways or way[:2] < ways[to][:2]:
                    ways[to] = way
        best = ways
    return min((way for state, way in inserted(dict(best)).items() if state in (0, 3)), key=lambda w: w[:2])


def brute(turns):
    out = []
    for conv in {t[0] for t in turns}:
        rows = sorted((r for r in damage(turns) if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
        seen, faults = set(), []
        for _, _, role, text in rows:
            said = re.findall(r"[^\x20\x09-\x0D]", text)
            faults.append("blank" if not said else "duplicate" if (role, text) in seen else None if said[-1] in ".!?" else "truncated")
            seen.add((role, text))
        known = [r[1] for r in rows if r[1] is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        initials = [r[2][:1] for r in rows]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit, lines = cheapest([(r[2], r[3], f) for r, f in zip(rows, faults)])
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out.append((conv, gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest))
    return sorted(out, key=repr)


def found(df):
    return sorted((tuple(r) for r in df.select(*FIELDS).collect()), key=repr)


def conversations(seed, n, longest=14):
    rng = random.Random(seed)
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None, "agent"]
    texts = ["Well.", "so", "Why?", "é no!  ", " \t", None, "", "x\ny.", "third"]
    turns = []
    for conv in range(n):
        for turn in range(rng.randrange(1, longest)):
            at = rng.choice([turn, turn, turn, turn, turn + 3, None])
            turns.append((conv, at, rng.choice(roles), rng.choice(texts)))
    return turns


@pytest.mark.parametrize("chunk", [1, 3, 4096])
def test_report_equals_brute_force(spark, chunk):
    turns = conversations(chunk, 120)
    turns += [(None, 1, "user", "a."), (None, 2, "assistant", "b."), (None, None, "system", "c")]
    turns += [(10**15, -(2**63), "user", "a."), (10**15, 2**62, "assistant", "b.")]
    assert found(rp.repair_report(table(spark, turns).repartition(3), chunk)) == brute(turns)


def test_a_conversation_over_many_chunks_and_partitions(spark):
    rng = random.Random(9)
    turns = [(1, i, rng.choice(["user", "assistant", "system"]), f"t{rng.randrange(400)}{rng.choice('.!?x')}") for i in range(900)]
    turns += [(1, 4, "user", "again.")] * 40 + [(2, 0, "user", "q?"), (2, 1, "assistant", "a.")]
    assert found(rp.repair_report(table(spark, turns), 16)) == brute(turns)


def test_conversations_without_rows_left(spark):
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    empty = hashlib.sha256(b"").hexdigest()
    report = found(rp.repair_report(table(spark, [(gone, 0, "user", "a.")])))
    assert report == [(gone, 0, 0, 0, 0, 0, 0, "", empty)] == brute([(gone, 0, "user", "a.")])
    assert found(rp.repair_report(table(spark, []))) == []


def test_repaired_rows_follow_the_pattern(spark):
    turns = spark.createDataFrame(
        [(c, t, r, x, 1) for c, t, r, x in conversations(5, 40) if r is not None and x is not None],
        "conv_id bigint, turn bigint, role string, text string, n bigint",
    )
    edited, _ = rp.repair(turns, 4)
    roles = {}
    for row in edited.orderBy("conv_id", "g", "place", "i").collect():
        roles[row.conv_id] = roles.get(row.conv_id, "") + row.role[0]
    assert roles and all(re.fullmatch("(s?(ua)+)?", r) for r in roles.values())


def test_vectors_of_unlike_beginnings_converge():
    rng = random.Random(3)
    symbols = [[rng.choice("sua"), rng.choice([None, None, "truncated"]), 1] for _ in range(200)]
    ends = [rp.backward(symbols, start)[0][0] for start in ((0, 4, 2, 0), (9, 0, 7, 3), (0, 0, 0, 0))]
    assert ends[0] == ends[1] == ends[2]
