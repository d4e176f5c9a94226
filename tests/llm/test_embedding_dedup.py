import random

import numpy as np
from llm_fixtures import rows, shipped  # noqa: F401

from civicmart.llm import embedding_dedup as ed
from civicmart.llm.components import components

SCHEMA = "vec_id bigint, embedding array<float>, label int, block string, rep string"


def table(spark, vectors):
    return spark.createDataFrame([(i, v, label, "b", "r") for i, v, label in vectors], SCHEMA)


def brute(vectors):
    """Every row is a vector of its own."""
    good = {}
    for n, (_, v, label) in enumerate(vectors):
        a = None if v is None or any(x is None for x in v) else np.array(v, dtype=float)
        if label is not None and a is not None and len(a) and np.isfinite(a).all() and a.any():
            good[n] = (label, a / np.abs(a).max())
    links = {n: set() for n in range(len(vectors))}
    for i, (p, a) in good.items():
        for j, (q, b) in good.items():
            if i != j and p == q and len(a) == len(b) and a @ b / np.sqrt((a @ a) * (b @ b)) >= 0.98:
                links[i].add(j)
    name = {}
    for i in links:
        if i in name:
            continue
        seen, todo = set(), [i]
        while todo:
            x = todo.pop()
            if x not in seen:
                seen.add(x)
                todo += links[x]
        least = min((vectors[x][0] for x in seen), key=lambda v: (v is None, v or 0))
        name.update(dict.fromkeys(seen, least))
    out = [(vectors[n][0], len(links[n]), name[n], vectors[n][0] == name[n]) for n in links]
    return sorted(out, key=repr)


def cloud(seed, n, dim=24):
    rng = np.random.default_rng(seed)
    centres, out = rng.normal(size=(12, dim)), []
    for i in range(n):
        spread = rng.choice([0.0, 0.05, 0.11, 0.2, 1.0])
        v = centres[rng.integers(12)] + spread * rng.normal(size=dim)
        out.append((i, [float(x) for x in np.float32(v)], int(rng.integers(3)) or 1))
    return out


def test_equals_brute_force_over_many_tiles(spark):
    vectors = cloud(1, 500)
    got = ed.near_vectors(table(spark, vectors), block=40)
    assert rows(got) == brute(vectors)


def test_awkward_vectors(spark):
    base = [float(x) for x in range(1, 9)]
    nan, inf = float("nan"), float("inf")
    vectors = [
        (1, base, 1),
        (2, base, 1),
        (3, [2 * x for x in base], 1),
        (4, base, 2),
        (5, base, None),
        (6, None, 1),
        (7, [], 1),
        (8, [0.0] * 8, 1),
        (9, [nan, *base[1:]], 1),
        (10, [inf, *base[1:]], 1),
        (11, base[:7], 1),
        (12, [None, *base[1:]], 1),
        (13, [-x for x in base], 1),
        (14, [1e30 * x for x in base], 1),
    ]
    assert rows(ed.near_vectors(table(spark, vectors))) == brute(vectors)
    # Reused and missing ids are vectors of their own.
    again = [*vectors, *vectors[:3], (None, base, 1), (None, [1.0, -1.0], 1), (None, None, 1), (1, [1.0, -1.0], 1), (20, base, 2), (4, [5.0], 2)]
    assert rows(ed.near_vectors(table(spark, again))) == brute(again)


def test_large_and_tiny_components_neither_overflow_nor_vanish(spark):
    vectors = [(1, [1e200, 0.0], 1), (2, [2e200, 0.0], 1), (3, [1e-200, 1e-201], 1), (4, [1e-200, 0.0], 1), (5, [0.0, 1e-300], 1)]
    df = spark.createDataFrame(vectors, "vec_id bigint, embedding array<double>, label int")
    assert rows(ed.near_vectors(df)) == brute(vectors)
    assert [r.n_links for r in ed.near_vectors(df).orderBy("vec_id").collect()] == [3, 3, 3, 3, 0]


def test_large_class_of_copies_and_a_chain(spark):
    rng = random.Random(4)
    vectors = [(i, [1.0, 2.0, 3.0], 1) for i in range(300)]
    vectors += [(1000 + i, [float(np.cos(i * 0.15)), float(np.sin(i * 0.15)), 0.0], 2) for i in range(35)]
    rng.shuffle(vectors)
    assert rows(ed.near_vectors(table(spark, vectors), block=16)) == brute(vectors)


def test_empty_table(spark):
    assert ed.near_vectors(table(spark, [(1, [1.0], 1)]).limit(0)).count() == 0


def test_bound_holds_for_all_pairs():
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.normal(size=(60, 40)), rng.normal(size=(20, 40)) * 10.0 ** rng.integers(-9, 9, size=(20, 40))])
    unit, codes, step, error = ed.quantise(x)
    rough = ed._code_products(codes, codes) * step[:, None] * step[None, :]
    slack = (1 + error)[:, None] * error[None, :] + error[:, None] * (1 + error)[None, :] + np.outer(error, error)
    assert (np.abs(unit @ unit.T - rough) <= slack + 1e-12).all()


def test_code_products_are_exact_for_long_vectors():
    p = np.full((2, 5000), 127, dtype=np.int8)
    assert (ed._code_products(p, p) == 5000 * 127 * 127).all()


def test_components_of_a_chain_a_star_and_loops(spark):
    edges = [(i, i + 1) for i in range(1, 60)] + [(1000, 1000 + i) for i in range(1, 200)] + [(7, 7), (1000, 1001), (None, 3)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {i: 1 for i in range(1, 61)} | {i: 1000 for i in range(1000, 1200)}
