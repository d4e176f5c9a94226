import re
from collections import defaultdict

import pytest
from llm_fixtures import rows
from pyspark.sql import functions as F

from civicmart.llm import mixing

TOKEN = re.compile(r"[^\x20\x09-\x0D]+")


def water(sizes):
    """Targets by sharing the excess again until none is above its cap."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    target, free, left = {}, set(order), float(sum(sizes.values()))
    while free:
        level = left / sum(weight[s] for s in free)
        full = {s for s in free if weight[s] * level > 3 * sizes[s]}
        if not full:
            return target | {s: weight[s] * level for s in free}
        for s in full:
            target[s] = 3.0 * sizes[s]
            left -= target[s]
        free -= full
    return target


def check(df, pairs, tolerance):
    report = df.collect()
    assert len(report) == len(pairs)
    source = {i: s for i, _, s in pairs}
    sizes = defaultdict(int)
    for _, text, s in pairs:
        sizes[s] += len(TOKEN.findall(text or ""))
    goals, taken = water(sizes), defaultdict(int)
    for r in report:
        s = source[r.doc_id]
        assert r.source_size == sizes[s] and r.target == pytest.approx(goals[s])
        assert r.size == 0 and r.taken == 0 or r.taken % r.size == 0 and r.taken <= 3 * r.size
        taken[s] += r.taken
    for s, goal in goals.items():
        assert abs(taken[s] - goal) <= tolerance


@pytest.fixture
def corpus(spark):
    pairs = []
    for i in range(900):
        s = "a" if i % 3 == 0 else (None, "b", "Ωmega", "c d", "B")[i % 5]
        pairs.append((i, " ".join(["w"] * (i * 7 % 40)), s))
    pairs += [(1000, None, "empty"), (1001, "", "empty"), (1002, "x y z", "tiny")]
    return pairs, spark.createDataFrame(pairs, "doc_id bigint, text string, source string")


def test_taken_words_come_near_the_targets(corpus):
    check(mixing.mix_report(corpus[1]), corpus[0], tolerance=40)


def test_reruns_agree_under_any_partitioning(corpus):
    assert rows(mixing.mix_report(corpus[1])) == rows(mixing.mix_report(corpus[1].repartition(7)))


def test_the_mix_holds_each_row_as_often_as_reported(corpus):
    docs = corpus[1].withColumns({"__copy": F.lit(1), "place": F.lit("p"), "size": F.lit("s"), "passes": F.lit(0)})
    mixed = mixing.mix(docs.select(*[c for c in docs.columns if c != "__copy"]))
    assert mixed.columns == docs.drop("__copy").columns
    counts = {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    for r in mixing.mix_report(corpus[1]).filter("size > 0").collect():
        assert counts.get(r.doc_id, 0) * r.size == r.taken


@pytest.mark.parametrize("same_text", [False, True])
def test_rows_without_id_come_near_their_targets(spark, same_text):
    pairs = [(None, "a b" if same_text else f"a b{i}", s) for s in ("p", "q", "r") for i in range(1000)]
    docs = spark.createDataFrame(pairs, "doc_id bigint, text string, source string")
    taken = {r.source: r.taken for r in mixing.mix(docs).groupBy("source").agg(F.count("*").alias("taken")).collect()}
    assert all(abs(2 * taken[s] - goal) <= 6 for s, goal in (("p", 1000), ("q", 2000), ("r", 3000)))
    report = mixing.mix_report(docs)
    sums = {r.target: r.taken for r in report.groupBy("target").agg(F.sum("taken").alias("taken")).collect()}
    assert report.count() == 3000 and all(abs(n - goal) <= 6 for goal, n in sums.items())
    assert rows(report) == rows(mixing.mix_report(docs.repartition(5)))
    mixed = mixing.mix(docs.repartition(5)).groupBy("source").agg(F.count("*").alias("taken")).collect()
    assert {r.source: r.taken for r in mixed} == taken


def test_many_copies_of_a_row_and_names_of_any_kind(spark, monkeypatch):
    monkeypatch.setattr(mixing, "RUN", 7)
    pairs = [(1, "x y", "s", i) for i in range(100)] + [(2, "z", "s", 0), (None, None, None, 1)]
    docs = spark.createDataFrame(pairs, "doc_id bigint, text string, source string, `a.b` int")
    docs = docs.withColumns({"row": F.lit(1), "copy": F.lit(2), "__copies": F.lit(3)})
    report = mixing.mix_report(docs)
    assert report.count() == 102
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    assert mixed.filter("doc_id = 1").count() * 2 == report.filter("doc_id = 1").agg(F.sum("taken")).first()[0]


def test_empty_table(corpus):
    assert mixing.mix_report(corpus[1].limit(0)).count() == 0
