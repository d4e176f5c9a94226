import hashlib
import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_fixtures import awkward, documents, rows, shipped  # noqa: F401

from civicmart.llm import automaton, secrets

ASSIGN = re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
OTHERS = {
    "github": re.compile(r"gh[pousr]_([A-Za-z0-9]+)"),
    "slack": re.compile(r"xox[abprs]-([A-Za-z0-9-]+)"),
    "google": re.compile(r"AIza([A-Za-z0-9_-]+)"),
    "stripe": re.compile(r"sk_live_([A-Za-z0-9]+)"),
    "jwt": re.compile(r"eyJ([A-Za-z0-9_.-]+)"),
    "private_key": re.compile(r"-----BEGIN ([A-Z ]*PRIVATE KEY-----)"),
}
SCANNER = secrets.Scanner()


def brute(text):
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if m.end() - m.start() >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if m.end() - m.start() >= 24]
    for k, rule in enumerate(secrets.MORE, 3):
        found += [(m.start(), k, m.end()) for m in OTHERS[rule.kind].finditer(text) if len(m[1]) >= rule.least]
    return [(secrets.RULES[k].kind, a, b) for a, k, b in sorted(found)]


PARTS = ["token", "Password", "secret", "api_key", "apikey", "=", ":", " ", '"', "'", "AKIA", "A1B2C3D4E5F6G7H8", "deadbeef"]
PARTS += ["0123456789abcdef", "é", "😀", "x", "-", "_", ".\n", "ghp_", "Z" * 18, "eyJ", "AIza", "sk_live_", "xoxb-"]
PARTS += ["-----BEGIN ", "RSA ", "PRIVATE KEY-----"]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=14))
def test_scan_equals_regular_expressions(parts):
    assert SCANNER.scan("".join(parts)) == brute("".join(parts))


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab01", max_size=12), st.sampled_from(["a(b|ba)*0?", "(a|b0)+1", "[ab]{2,}0", "a{3}", "b?a*1"]))
def test_automata_equal_regular_expressions(text, pattern):
    tree = automaton.parse(pattern)
    wanted = max((e for e in range(len(text) + 1) if re.fullmatch(pattern, text[:e])), default=-1)
    assert automaton.anchored(tree).longest(text.encode(), 0) == wanted


def test_minimal_automata_are_small():
    assert len(automaton.anchored(automaton.parse("(abc|xbc|ybc)")).table) // 256 == 5
    assert len(SCANNER.all.table) // 256 < 2000


def test_report(documents, awkward):
    rng = random.Random(8)
    pairs = [(i, "".join(rng.choices(PARTS, k=20))) for i in range(50)]
    pairs += [(r.doc_id, r.text) for r in awkward.collect()]
    expected = []
    for doc_id, text in pairs:
        spans = brute(text or "")
        base = [s for s in spans if s[0] in ("assign", "access", "hex")]
        join = lambda found: ",".join(f"{k}:{a}:{b}" for k, a, b in found)
        counts = [sum(s[0] == kind for s in base) for kind in ("assign", "access", "hex")]
        expected.append((doc_id, *counts, hashlib.sha256(join(base).encode()).hexdigest(), join(spans)))
    assert rows(secrets.secret_report(documents(pairs))) == sorted(expected, key=repr)
    assert secrets.secret_report(documents(pairs).limit(0)).count() == 0


@pytest.mark.parametrize("text", ["", "a" * 100_000, "token=" + "é" * 9 + " token = abcdef"])
def test_long_and_plain_texts(text):
    assert SCANNER.scan(text) == brute(text)
