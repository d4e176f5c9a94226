import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from llm_fixtures import awkward, documents, rows, shipped  # noqa: F401

from civicmart.llm import bagminhash as bm
from civicmart.llm import shingles

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def bag(text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text))
    n = min(5, len(words))
    return Counter(tuple(words[i : i + n]) for i in range(len(words) - n + 1)) if words else Counter()


def brute(pairs):
    """Component by id, of non-null texts."""
    texts = {(i, t) for i, t in pairs if t is not None}
    bags = {x: bag(x[1]) for x in texts}
    near = {i: {i} for i, _ in pairs}
    for x in texts:
        for y in texts:
            both, either = sum((bags[x] & bags[y]).values()), sum((bags[x] | bags[y]).values())
            if x[1] == y[1] or both and both * 5 >= 4 * either:
                near[x[0]].add(y[0])
    root = {}
    for i in sorted(near):
        todo = [i] if i not in root else []
        while todo:
            x = todo.pop()
            if x not in root:
                root[x] = i
                todo += near[x]
    return root


def corpus(seed, n=150):
    rng = random.Random(seed)
    words = ["Wort", "été", "the", "of", "and", "x1", "Ünder"] + [f"w{i}" for i in range(300)]
    texts = []
    for _ in range(n):
        if texts and rng.random() < 0.6:
            said = rng.choice(texts).split(" ")
            for _ in range(rng.randint(0, max(1, len(said) // 12))):
                said[rng.randrange(len(said))] = rng.choice(words)
            texts.append(" ".join(said))
        else:
            texts.append(" ".join(rng.choices(words, k=rng.choice([1, 3, 5, 20, 80, 200]))))
    return list(enumerate(texts))


def test_classes_equal_brute_force(documents):
    pairs = corpus(1)
    got = {r.doc_id: r.component_id for r in bm.near_copy_report(documents(pairs)).collect()}
    assert got == brute(pairs)


def test_multiplicity_counts(documents):
    # The same five-word runs, but one text has them far more often.
    once, often = "a b c d e " * 3, "a b c d e " * 40
    got = {r.doc_id: r.component_id for r in bm.near_copy_report(documents([(1, once), (2, often), (3, often + " f")])).collect()}
    assert got == brute([(1, once), (2, often), (3, often + " f")]) == {1: 1, 2: 2, 3: 2}


def test_large_group_of_near_copies(documents):
    rng, base = random.Random(5), [f"b{i}" for i in range(120)]
    pairs = []
    for i in range(200):
        said = list(base)
        said[rng.randrange(120)] = "changed"
        if i % 3 == 0:
            said[rng.randrange(120)] = f"again{i}"
        pairs.append((i, " ".join(said)))
    pairs += [(500 + i, pairs[0][1]) for i in range(50)]
    report = bm.near_copy_report(documents(pairs)).collect()
    assert {r.doc_id: r.component_id for r in report} == brute(pairs)
    assert sum(r.kept for r in report) == len(set(brute(pairs).values()))


def test_awkward_rows(awkward):
    report = bm.near_copy_report(awkward).collect()
    pairs = [(r.doc_id, r.text) for r in awkward.collect() if r.doc_id is not None]
    assert Counter(r.doc_id for r in report) == Counter(i for i, _ in pairs)
    assert {r.doc_id: r.component_id for r in report} == brute(pairs)
    kept = bm.drop_near_copies(awkward)
    assert kept.columns == awkward.columns
    assert sorted((r.doc_id, r.text or "") for r in kept.filter("doc_id < 6 and doc_id != 3").collect()) == [
        (1, ""),
        (2, ""),
        (4, "?! ... --"),
        (5, "the same row again and again and again"),
    ]
    assert kept.filter("doc_id is null").count() == 1 and kept.filter("doc_id = 7").count() == 0


def near_copies(seed):
    """Two near copies, unlike those of other seeds."""
    said = [f"t{seed}x{i}" for i in range(60)]
    return " ".join(said), " ".join([*said[:-1], "changed"])


def test_texts_of_one_id_have_their_own_near_copies(documents):
    (a, a2), (b, b2), (c, c2) = (near_copies(i) for i in range(3))
    # The longer text of id 7 is like that of id 1, the shorter ones like those of 9 and 3.
    docs = documents([(7, a + " " + a), (1, a + " " + a2), (7, b), (9, b2), (7, c), (3, c2), (8, a)])
    report = bm.near_copy_report(docs).collect()
    assert sorted(map(tuple, report)) == [
        (1, 1, True), (3, 3, True), (7, 1, False), (7, 3, False), (7, 7, True), (8, 8, True), (9, 7, False),
    ]
    kept = [(r.doc_id, r.text) for r in bm.drop_near_copies(docs).collect()]
    assert sorted(kept) == sorted([(1, a + " " + a2), (3, c2), (7, b), (8, a)])


def test_rows_without_id_have_classes_too(documents):
    (a, a2), (b, b2), (c, _) = (near_copies(i) for i in range(3))
    # a: a null id beside ids. b: null ids only. c: exact copies only. Null texts are no copies.
    pairs = [(None, a), (5, a2), (4, a2), (None, b), (None, b2), (None, b), (None, c), (None, c), (None, None), (None, None)]
    docs = documents(pairs)
    report = bm.near_copy_report(docs, null_ids=True).collect()
    assert len(report) == len(pairs)
    assert Counter((r.doc_id, r.component_id, r.kept) for r in report) == {
        (None, 4, False): 1, (5, 4, False): 1, (4, 4, True): 1,
        (None, None, True): 4, (None, None, False): 3,
    }
    kept = Counter((r.doc_id, r.text) for r in bm.drop_near_copies(docs).collect())
    assert kept[None, b] + kept[None, b2] == 1
    assert {k: n for k, n in kept.items() if k[1] not in (b, b2)} == {(4, a2): 1, (None, c): 1, (None, None): 2}


def test_the_least_of_a_class_may_be_a_reused_id(documents):
    a, a2 = near_copies(1)
    docs = documents([(1, a), (1, a2), (1, "other words"), (2, a)])
    report = sorted(map(tuple, bm.near_copy_report(docs).collect()))
    assert report == [(1, 1, False), (1, 1, True), (1, 1, True), (2, 1, False)]
    assert bm.drop_near_copies(docs).count() == 2


def test_empty_table(documents):
    none = documents([(1, "a")]).limit(0)
    assert bm.near_copy_report(none).count() == 0 and bm.drop_near_copies(none).count() == 0


@pytest.mark.parametrize("a, b", [({1: 1, 2: 1, 3: 1}, {2: 1, 3: 1, 4: 1}), ({1: 9, 2: 3}, {1: 5, 2: 7, 3: 2}), ({1: 1000}, {1: 900, 2: 30})])
def test_signatures_estimate_weighted_jaccard(a, b):
    m, agree = 96, []
    for shift in range(60):
        text = np.array([0] * len(a) + [1] * len(b))
        names = shingles.mix(np.array([*a, *b], dtype=np.uint64) + np.uint64(1000 * shift))
        weights = np.array([*a.values(), *b.values()])
        order = np.lexsort((names, text))
        times = bm.signatures(text[order], names[order], weights[order], 2, m)
        assert np.isfinite(times).all()
        agree.append((times[0] == times[1]).mean())
    both = sum(min(a.get(k, 0), b.get(k, 0)) for k in {*a, *b})
    wanted = both / (sum(a.values()) + sum(b.values()) - both)
    assert abs(np.mean(agree) - wanted) < 4 * np.sqrt(wanted * (1 - wanted) / m / 60) + 1e-9


def test_bags_of_texts_in_a_batch(monkeypatch):
    texts = ["a b c d e f", None, "", "...", "A-B", "é é é é é é é", "word " * 3000, "x" * 9000, "a b c d e f"]

    def counts():
        out = {}
        for row, n, words, per_text in shingles.text_slices(pa.array(texts)):
            hashes, runs = shingles.shingle_hashes(words, per_text)
            text, names, weights = bm.bags(hashes, runs)
            for t in range(n):
                out[row + t] = dict(zip(names[text == t].tolist(), weights[text == t].tolist()))
        return out

    whole = counts()
    assert [sorted(c.values()) for c in whole.values()] == [sorted(bag(t or "").values()) for t in texts]
    assert whole[0] == whole[8] != whole[4]
    monkeypatch.setattr(shingles, "SLICE", 64)  # nearly every text is a long one
    assert counts() == whole


def test_empty_reports_keep_rows(documents):
    assert rows(bm.near_copy_report(documents([(3, None), (2, None)])).select("doc_id", "component_id")) == [(2, 2), (3, 3)]
