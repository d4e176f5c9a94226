import math
import random
import re
from collections import Counter

import pytest
from llm_fixtures import awkward, documents, rows, shipped  # noqa: F401

from civicmart.llm import ranked_search as rs

TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
ITEM = "item_id bigint, text string, doc_id string, score int, rank string, query string"


def terms(text):
    return TERM.findall((text or "").encode().lower())


def brute(docs, items, k=20):
    bags = [(i, Counter(terms(t))) for i, t in docs]
    bags = [(i, bag) for i, bag in bags if bag]
    n_docs, length = len(bags), sum(sum(bag.values()) for _, bag in bags)
    df = Counter(t for _, bag in bags for t in bag)
    out = []
    for item, text in items:
        found = []
        for i, bag in bags:
            m = 75 + 25 * sum(bag.values()) * n_docs // length
            score = 0
            for t, times in Counter(terms(text)).items():
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                score += times * w * (1_000_000_000 * bag[t] // (1000 * bag[t] + 12 * m))
            if score > 0:
                found.append((-score, i is None, i or 0))
        out += [(item, r, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=repr)


def prose(seed, n, words=40, common=300):
    rng = random.Random(seed)
    pick = lambda: f"w{int(common * rng.random() ** 3)}"
    return [" ".join(pick() for _ in range(rng.randrange(1, words))) for _ in range(n)]


def items_of(spark, items):
    return spark.createDataFrame([(i, t, "x", 1, "y", "z") for i, t in items], ITEM)


@pytest.mark.parametrize("k", [1, 20])
def test_search_equals_brute_force(spark, documents, k):
    docs = list(enumerate(prose(1, 700)))
    docs += [(10_000 + i, docs[3][1]) for i in range(50)] + [(5, "w1 w2"), (5, "w1 w2"), (None, "w1 w2"), (None, docs[3][1])]
    items = list(enumerate(prose(2, 25, 30))) + [(99, docs[3][1]), (99, None), (None, "w1 W1 absent"), (7, "?!")]
    found = rs.search(documents(docs).repartition(5), items_of(spark, items), k)
    assert rows(found.select("item_id", "rank", "doc_id", "score")) == brute(docs, items, k)


def test_small_blocks_of_queries_and_shards_change_nothing(spark, documents, monkeypatch):
    docs, items = list(enumerate(prose(3, 300))), list(enumerate(prose(4, 40)))
    monkeypatch.setattr(rs, "QUERY_BYTES", 500)
    found = rs.search(documents(docs), items_of(spark, items))
    assert rows(found.select("item_id", "rank", "doc_id", "score")) == brute(docs, items)


def test_awkward_rows(spark, awkward):
    docs = [(r.doc_id, r.text) for r in awkward.collect()]
    items = [(1, "the same row and wordé5"), (2, "words"), (3, "")]
    found = rs.search(awkward, items_of(spark, items))
    assert rows(found.select("item_id", "rank", "doc_id", "score")) == brute(docs, items)


def test_empty_tables(spark, documents):
    none, some = items_of(spark, []), items_of(spark, [(1, "a b")])
    for docs, items in ((documents([]), some), (documents([(1, "a b")]), none), (documents([(1, None)]), some)):
        found = rs.search(docs, items)
        assert found.columns == ["item_id", "rank", "doc_id", "score"] and found.count() == 0


def test_blocks_are_skipped_by_their_summaries(spark, documents):
    docs = list(enumerate(prose(5, 3000, 60, 2000)))
    asked = rs.Queries.of([(i, docs[i][1]) for i in range(0, 300, 10)])
    report = []
    rs.search_block(documents(docs).select("doc_id", "text"), asked, 5, report)
    seen, skipped = report[0]
    assert 0 < skipped < seen


def test_long_texts_are_cut_between_terms(monkeypatch):
    text = ("ab É1 x-y " * 50 + "q" * 100).encode()
    whole = rs.count_terms(text)
    monkeypatch.setattr(rs, "PIECE", 7)
    assert rs.count_terms(text) == whole == Counter(terms(text.decode()))
