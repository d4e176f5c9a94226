import numpy as np
from llm_fixtures import rows, shipped  # noqa: F401
from pyspark.sql import functions as F

from civicmart.llm import learned_partitions as lp

SCHEMA = "vec_id bigint, embedding array<double>, part string, row string, asks string, score string"


def table(spark, vectors):
    return spark.createDataFrame([(i, v, "p", "r", "a", "s") for i, v in vectors], SCHEMA)


def usable(v):
    return v is not None and len(v) and None not in v and np.isfinite(v).all() and np.any(v)


def brute(vectors, every=50, k=5):
    """Rows (query_id, rank, vec_id, score); every row of the list is a vector of its own."""
    good = [(n, i, np.array(v, float) / np.abs(np.array(v, float)).max()) for n, (i, v) in enumerate(vectors) if usable(v)]
    out = []
    for n, i, v in good:
        if i is None or i % every:
            continue
        near = [(-float(v @ w / np.sqrt((v @ v) * (w @ w))), j is None, j or 0, m) for m, j, w in good if m != n and len(w) == len(v)]
        out += [(i, r, None if x[1] else x[2], -x[0]) for r, x in enumerate(sorted((round(x[0], 12), *x[1:]) for x in near)[:k], 1)]
    return out


def clouds(seed, n, dim=16, centres=40, spread=0.35):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(centres, dim))
    return (middle[rng.integers(0, centres, n)] + spread * rng.normal(size=(n, dim))).tolist()


def search(spark, vectors, **options):
    return lp.search(table(spark, vectors), F.col("vec_id") % 50 == 0, **options)


def test_recall_on_clouds_with_a_third_in_copies(spark):
    vectors = clouds(1, 4000)
    vectors += [vectors[7]] * 2000
    rng = np.random.default_rng(2)
    table_rows = [(int(i), vectors[i]) for i in rng.permutation(len(vectors))]
    found = search(spark, table_rows)
    got, want = {}, {}
    for r in found.collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    for q, _, i, _ in brute(table_rows):
        want.setdefault(q, set()).add(i)
    hits = sum(len(got[q] & want[q]) for q in want)
    assert set(got) == set(want) and hits / sum(map(len, want.values())) >= 0.9
    # Copies are found by their least ids.
    copies = sorted([7, *range(4000, 6000)])
    assert got[4050] == set(copies[:5])
    assert all(abs(r.score - 1) < 1e-12 for r in found.filter("query_id = 4050").collect())


def test_fewer_partitions_than_all_are_looked_at(spark):
    vectors = np.array(clouds(3, 4000, centres=64, spread=0.1))
    router = lp.fit(vectors)
    placed = np.bincount(router.routes(lp._unit(vectors), 1)[:, 0], minlength=lp.PARTS)
    assert router.outer.shape[1] == lp.PARTS and router.probes < lp.PARTS // 4
    assert placed.max() < 0.15 * len(vectors)


def test_partitions_are_balanced_and_follow_the_graph():
    vectors = lp._unit(np.array(clouds(4, 1000, centres=16, spread=0.05)))
    graph = lp.nearest(vectors, vectors, 10, same=True)
    part = lp.balanced_parts(vectors, graph, 8)
    assert np.bincount(part, minlength=8).max() <= np.ceil(1.05 * 1000 / 8)
    assert (part[graph] == part[:, None]).mean() > 0.8


def test_awkward_vectors(spark):
    vectors = [
        (0, [1e200, 0.0]),
        (1, [2e200, 0.0]),
        (2, [1e-300, 1e-300]),
        (50, [0.0, 1.0]),
        (50, [0.0, 2.0]),
        (None, [0.0, 3.0]),
        (100, None),
        (101, []),
        (102, [0.0, 0.0]),
        (103, [1.0, None]),
        (104, [1.0, float("nan")]),
        (105, [float("inf"), 0.0]),
        (150, [1.0, 0.0, 0.0]),
        (151, [1.0, 1.0, 0.0]),
    ]
    found = rows(search(spark, vectors).withColumn("score", F.round("score", 12)))
    want = sorted(((q, r, i, round(s, 12)) for q, r, i, s in brute(vectors)), key=repr)
    assert found == want and (0, 1, 1, 1.0) in found and (50, 2, None, 1.0) in found


def test_small_blocks_change_nothing(spark, monkeypatch):
    vectors = list(enumerate(clouds(5, 900)))
    whole = rows(search(spark, vectors, recall=1.0).select("query_id", "rank", "vec_id"))
    monkeypatch.setattr(lp, "BLOCK", 20)
    monkeypatch.setattr(lp, "ASKED", 2)
    assert rows(search(spark, vectors, recall=1.0).select("query_id", "rank", "vec_id")) == whole


def test_empty_and_unusable_tables(spark):
    for vectors in ([], [(0, None), (50, [0.0])], [(0, [1.0])], [(1, [1.0]), (2, [1.0])]):
        found = search(spark, vectors)
        assert found.columns == ["query_id", "rank", "vec_id", "score"] and found.count() == 0
