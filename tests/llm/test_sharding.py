import zlib
from collections import Counter

import numpy as np
import pytest
from llm_fixtures import awkward, documents, rows, shipped  # noqa: F401

from civicmart.llm import sharding


def checked(docs, shards=8):
    report = sharding.shard_report(docs, shards).collect()
    expected = Counter((r.doc_id, len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode())) for r in docs.collect())
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in report) == expected
    counts = Counter(r.shard for r in report)
    n = sum(expected.values())
    assert all(counts[k] in (n // shards, -(-n // shards)) for k in range(shards))
    for k in range(shards):
        assert sorted(r.slot for r in report if r.shard == k) == list(range(counts[k]))
    assert {(r.law, r.grown_shard) for r in report} <= {("rows", None)}
    return report


def test_exact_shards(documents):
    report = checked(documents([(i, f"text {i} é") for i in range(1003)]))
    # Ids are not in order within a shard, and neighbours part.
    first = [r.doc_id for r in sorted(report, key=lambda r: r.slot) if r.shard == 0]
    assert first != sorted(first) and len({r.shard for r in report if r.doc_id < 20}) > 3


def test_awkward_rows(awkward):
    checked(awkward)


def test_a_row_repeated_without_end_is_spread(documents):
    report = checked(documents([(1, "same")] * 700 + [(i, "x") for i in range(300)]))
    assert len({r.shard for r in report if r.doc_id == 1}) == 8


def test_reruns_agree_under_any_partitioning(documents):
    docs = documents([(i, str(i)) for i in range(300)])
    assert rows(sharding.shard_report(docs)) == rows(sharding.shard_report(docs.repartition(9)))


def test_rows_keep_their_columns(documents):
    docs = documents([(i % 40, f"t{i % 45}") for i in range(100)])
    out = sharding.shuffled(docs)
    assert out.columns == [*docs.columns, "shard", "slot"]
    assert Counter((r.doc_id, r.text) for r in out.collect()) == Counter((r.doc_id, r.text) for r in docs.collect())
    assert len({(r.shard, r.slot) for r in out.collect()}) == 100


def test_empty_table(documents):
    assert sharding.shard_report(documents([(1, "a")]).limit(0)).count() == 0


def test_matrix_has_the_margins_and_the_mean():
    counts, rooms = [50, 0, 7, 143], [67, 67, 66]
    total = np.zeros((4, 3))
    for seed in range(400):
        matrix = sharding.communication_matrix(counts, rooms, seed)
        assert (matrix.sum(axis=1) == counts).all() and (matrix.sum(axis=0) == rooms).all() and (matrix >= 0).all()
        total += matrix
    assert np.abs(total / 400 - np.outer(counts, rooms) / 200).max() < 0.5


@pytest.mark.parametrize("good, bad, draws", [(30, 70, 20), (5, 3, 6), (0, 9, 4), (9, 0, 4), (1000, 10, 500)])
def test_own_hypergeometric_draws(good, bad, draws):
    rng = np.random.default_rng(5)
    mine = [sharding._hypergeometric(rng, good, bad, draws) for _ in range(4000)]
    theirs = rng.hypergeometric(good, bad, draws, 4000)
    assert abs(np.mean(mine) - theirs.mean()) < 0.15 and abs(np.std(mine) - theirs.std()) < 0.15


def test_populations_beyond_numpy():
    matrix = sharding.communication_matrix([10**10, 3 * 10**9], [65 * 10**8, 65 * 10**8], 1)
    assert matrix.sum(axis=1).tolist() == [10**10, 3 * 10**9] and abs(matrix[0, 0] - 5 * 10**9) < 10**6
