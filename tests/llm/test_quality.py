import random
import zlib

import numpy as np
import pytest
import zstandard
from llm_fixtures import awkward, documents, rows, shipped  # noqa: F401

from pyspark.sql import functions as F

from civicmart.llm import quality


def corpus(seed, n=600):
    rng = random.Random(seed)
    good, bad = [f"word{i}" for i in range(80)], ["BUY", "!!", "$$$", "CLICK", "%%%", "win"]
    pairs, labels = [], []
    for i in range(n):
        q = int(rng.random() < 0.7)
        text = " ".join(rng.choices(good if q else bad + good[:10], k=rng.randint(5, 120)))
        pairs.append((i, text))
        if i % 2:
            labels.append((i, q, 0))
    return pairs, labels


@pytest.fixture(scope="module")
def trained(spark, documents):
    pairs, labels = corpus(1)
    return pairs, labels, documents(pairs), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")


def held(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


def test_held_out_accuracy_and_calibration(trained):
    report = {r.doc_id: r for r in quality.quality_report(*trained[2:]).collect()}
    assert set(report) == {i for i, _ in trained[0]}
    truth = {i: q for i, q, _ in trained[1]}
    assert all(r.held_out == held(i) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for i, r in report.items())
    unseen = [i for i in truth if held(i)]
    assert np.mean([report[i].predicted == truth[i] for i in unseen]) > 0.95
    assert abs(np.mean([report[i].score for i in unseen]) - np.mean([truth[i] for i in unseen])) < 0.1


def test_scores_equal_those_of_a_plain_scorer(trained):
    """Dictionaries and curve as fitted; every text compressed here, whole, piece by piece."""
    pairs, _, docs, table = trained
    model = quality.fit(docs, table)

    def size(data, dictionary):
        packer = zstandard.ZstdCompressor(
            level=quality.LEVEL, dict_data=zstandard.ZstdCompressionDict(dictionary), write_content_size=False, write_dict_id=False
        )
        return sum(len(packer.compress(data[k : k + quality.PIECE])) for k in range(0, len(data), quality.PIECE))

    at, value = zip(*model.knots)
    want = {}
    for i, text in pairs[:150]:
        data = text.encode()
        x = (size(data, model.bad) - size(data, model.good)) / max(1, len(data))
        logistic = 1 / (1 + np.exp(-(model.slope * x + model.offset)))
        want[i] = (1 - quality.LOGISTIC) * np.interp(x, at, value) + quality.LOGISTIC * logistic
    got = {r.doc_id: r.score for r in quality.quality_report(docs, table).collect()}
    assert all(abs(got[i] - want[i]) < 1e-9 for i in want)


def test_a_class_of_long_texts_is_learned_from(spark, documents):
    pairs, labels = corpus(4, 200)
    pairs = [(i, " ".join([t] * 400) if any(j == i and not q for j, q, _ in labels) else t) for i, t in pairs]
    # One id of the class comes again and again.
    pairs += [next(p for p in pairs if len(p[1]) > 40_000)] * 50
    docs = documents(pairs)
    report = quality.quality_report(docs, spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"))
    truth = {i: q for i, q, _ in labels}
    scores = {r.doc_id: r.score for r in report.collect()}
    assert len(set(scores.values())) > 10
    assert np.mean([(scores[i] >= 0.3) == truth[i] for i in truth]) > 0.9


def test_samples_of_texts(spark):
    long = "".join(chr(0x100 + i % 5000) for i in range(100_000))
    df = spark.createDataFrame([("short",), ("",), (None,), (long,)], "t string").select(quality.sample_of(F.col("t")).alias("p"))
    short, empty, none, parts = (r.p for r in df.collect())
    assert (short, empty, none) == (["short"], [""], None)
    assert len(parts) == quality.DICTIONARY_PIECES and parts[0] == long[:1000] and parts[-1] == long[-1000:]


def test_held_out_labels_lang_and_source_do_not_matter(spark, trained, documents):
    pairs, labels, docs, table = trained
    turned = [(i, 1 - q if held(i) else q, 1) for i, q, _ in labels]
    other = spark.createDataFrame(turned, "doc_id bigint, quality int, toxic int")
    before = rows(quality.quality_report(docs, table))
    assert rows(quality.quality_report(documents(pairs, source="elsewhere"), other)) == before


def test_awkward_rows_and_repeats(trained, awkward):
    report = quality.quality_report(awkward, trained[3]).collect()
    assert len(report) == awkward.count() and all(0 <= r.score <= 1 for r in report)
    assert len({r.score for r in report if r.doc_id in (1, 2, 7)}) == 1


def test_missing_classes_and_empty_tables(spark, trained, documents):
    docs, labels = trained[2], trained[3]
    assert {r.score for r in quality.quality_report(docs, labels.limit(0)).collect()} == {0.5}
    good = quality.quality_report(docs, labels.filter("quality = 1")).collect()
    assert len({r.score for r in good}) == 1 and good[0].score > 0.9
    odd = spark.createDataFrame([(1, None, 0), (None, 1, 0), (2, 7, 0)], "doc_id bigint, quality int, toxic int")
    assert {r.score for r in quality.quality_report(docs, odd).collect()} == {0.5}
    assert quality.quality_report(docs.limit(0), labels).count() == 0
    few = spark.createDataFrame([(1, 0, 0), (2, 1, 0)], "doc_id bigint, quality int, toxic int")
    assert quality.quality_report(documents([(1, "ab"), (2, "xyz")]), few).count() == 2


def test_accept_keeps_columns_and_good_texts(trained):
    pairs, labels, docs, table = trained
    kept = quality.accept(docs, table)
    assert kept.columns == docs.columns
    ids, truth = {r.doc_id for r in kept.collect()}, {i: q for i, q, _ in labels}
    assert np.mean([i in ids for i, q in truth.items() if q]) > 0.97
    assert np.mean([i in ids for i, q in truth.items() if not q]) < 0.1


def test_curves():
    assert quality.fit_knots([(0.0, 1, 0), (1.0, 0, 1), (2.0, 1, 0), (3.0, 0, 9)])[-1][1] > 0.9
    knots = quality.fit_knots([(x / 10, 10 - x, x) for x in range(11)])
    assert [v for _, v in knots] == sorted(v for _, v in knots)
    slope, offset = quality.fit_curve([(x, 100 - round(100 / (1 + np.exp(-(3 * x - 1)))), round(100 / (1 + np.exp(-(3 * x - 1))))) for x in np.linspace(-2, 2, 41)])
    assert abs(slope - 3) < 0.3 and abs(offset + 1) < 0.2
    slope, _ = quality.fit_curve([(-1.0, 50, 0), (1.0, 0, 50)])
    assert np.isfinite(slope) and slope > 0
