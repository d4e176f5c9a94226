import hashlib
import random
import re

import pytest
from llm_fixtures import awkward, documents, rows, shipped  # noqa: F401
from pyspark.sql import functions as F

from civicmart.llm import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def low(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def brute(docs, items):
    grams = {}
    for item, text in items:
        words = WORD.findall(low(text))
        n = min(10, len(words))
        for i in range(len(words) - n + 1) if words else ():
            grams.setdefault(tuple(words[i : i + n]), set()).add(str(item) if item is not None else "")
    out = []
    for doc_id, text in docs:
        words, hit, found = WORD.findall(low(text)), set(), set()
        for n in {len(g) for g in grams}:
            for i in range(len(words) - n + 1):
                if tuple(words[i : i + n]) in grams:
                    hit.update(range(i, i + n))
                    found |= grams[tuple(words[i : i + n])]
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc_id, len(words), len(hit), len(found), digest, bool(hit)))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def items(spark):
    pairs = [
        (1, "One two THREE four five six seven eight nine ten eleven twelve"),
        (10, "two three four five six seven eight nine ten eleven"),
        (2, "É short"),
        (3, "... !!"),
        (4, None),
        (None, "Kelvin K sign"),
        (2, "É short"),
    ]
    return pairs, spark.createDataFrame(pairs, "item_id bigint, text string")


def test_report_equals_brute_force(spark, documents, items):
    rng = random.Random(3)
    vocabulary = "one two three four five six seven eight nine ten eleven twelve É é short kelvin".split()
    pairs = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(0, 40)))) for i in range(60)]
    pairs += [
        (100, "x one, two-three four five six seven eight nine ten eleven twelve y"),
        (101, "two three four five six seven eight nine ten eleven twelve thirteen"),
        (102, "é short É SHORT"),
        (103, "KK kelvin k sign; Kelvin K sign"),
        (104, None),
        (104, None),
        (105, ""),
    ]
    got = decontaminate.contamination_report(documents(pairs), items[1])
    assert rows(got) == sorted(brute(pairs, items[0]), key=repr)


def test_awkward_rows(awkward, items):
    got = decontaminate.contamination_report(awkward, items[1])
    assert rows(got) == brute([(r.doc_id, r.text) for r in awkward.collect()], items[0])


def test_empty_tables(documents, items):
    none = documents([(1, "a")]).limit(0)
    assert decontaminate.contamination_report(none, items[1]).count() == 0
    report = decontaminate.contamination_report(documents([(1, "a b")]), items[1].limit(0)).collect()
    assert [(r.n_words, r.n_hit, r.contaminated) for r in report] == [(2, 0, False)]


def test_a_window_past_the_broadcast_bound_is_joined_by_shuffle(documents, items, monkeypatch):
    docs = documents([(1, "x É short y"), (2, "nothing")])
    before = rows(decontaminate.contamination_report(docs, items[1]))
    monkeypatch.setattr(decontaminate, "WINDOWS_BROADCAST", 0)
    monkeypatch.setattr(decontaminate.checked_broadcast, "__defaults__", (None, 0))
    assert rows(decontaminate.contamination_report(docs, items[1])) == before


def test_documents_and_spans_are_removed(documents, items):
    text = "Before -- ONE two three four five six seven eight nine ten eleven twelve, after."
    docs = documents([(1, text), (2, "clean one two"), (3, None)])
    kept = decontaminate.remove_documents(docs, items[1])
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [2, 3]
    cut = {r.doc_id: r.text for r in decontaminate.remove_spans(docs, items[1]).collect()}
    assert cut == {1: "Before -- after.", 2: "clean one two", 3: None}


def test_no_python_and_no_cross_join(documents, items):
    df = decontaminate.contamination_report(documents([(1, "a b c")]), items[1])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_hits_on_both_sides_of_a_long_text(documents, items):
    filler = " ".join(["filler"] * 50_000)
    docs = documents([(1, f"É short {filler} É short")])
    row = decontaminate.contamination_report(docs, items[1]).first()
    assert (row.n_words, row.n_hit, row.n_items) == (50_004, 4, 1)
    assert docs.filter(F.length("text") > 300_000).count() == 1
