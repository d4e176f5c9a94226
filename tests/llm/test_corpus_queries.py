"""The registered corpus queries over the given tables, against SQL where there is some."""

import os

import pytest
from llm_fixtures import shipped  # noqa: F401
from oracle import differences

import __spark_entry__ as contract
import corpus_pipeline
from civicmart.llm import queries

TABLES = os.environ.get("CIVICMART_TABLES", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(TABLES), reason="tables not present")


def test_every_operator_is_registered_once():
    names = [n for n in contract.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in contract.queries() and set(queries.ORACLES) <= set(queries.QUERIES)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, name):
    assert differences(spark, queries.QUERIES[name], queries.ORACLES[name], TABLES) is None


# A row per document; the search over vectors has rows per query.
DOCUMENT_QUERIES = sorted(set(queries.QUERIES) - set(queries.ORACLES) - {"op12_learned_partitions"})


@pytest.mark.parametrize("name", DOCUMENT_QUERIES)
def test_query_gives_a_row_per_document(spark, name):
    documents = spark.read.parquet(f"{TABLES}/documents.parquet").count()
    assert queries.QUERIES[name](spark, TABLES).count() == documents


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = spark.read.parquet(f"{TABLES}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.materialise(stage(spark, docs, TABLES), f"test-{name}")
        out.append(docs)
    return out


def test_stages_keep_the_columns_of_documents(spark, stages):
    columns = spark.read.parquet(f"{TABLES}/documents.parquet").columns
    assert all(df.columns == columns for df in stages[:-1])


def test_stages_do_what_their_operators_report(spark, stages):
    documents = spark.read.parquet(f"{TABLES}/documents.parquet")
    ids = [{r.doc_id for r in df.select("doc_id").collect()} for df in [documents, *stages]]
    report = queries.QUERIES["op3_quality"](spark, TABLES)
    assert ids[1] == {r.doc_id for r in report.filter("predicted = 1").collect()}
    from civicmart.llm.bagminhash import near_copy_report
    from civicmart.llm.decontaminate import contamination_report
    from civicmart.llm.mixing import mix_report

    assert ids[2] == {r.doc_id for r in near_copy_report(stages[0]).filter("kept").collect()}
    items = spark.read.parquet(f"{TABLES}/benchmark.parquet")
    assert ids[3] == {r.doc_id for r in contamination_report(stages[1], items).filter("not contaminated").collect()}
    assert ids[4] == {r.doc_id for r in mix_report(stages[2]).filter("taken > 0").collect()}
    assert stages[4].count() == stages[3].count()


def test_run_agrees_with_itself(spark):
    first, second = (sorted(map(tuple, corpus_pipeline.run(spark, TABLES).collect())) for _ in range(2))
    assert first == second and first


def test_stages_on_missing_ids_repeated_rows_and_no_rows(spark, tmp_path):
    """No stage fails; a row without id or text is a row like any other until the mix takes it."""
    text = "one two three four five six seven eight nine ten"
    pairs = [(None, text), (None, None), (1, text), (1, text), (2, None), (3, ""), (3, "other words"), (4, "more words " * 40)]
    rows = [(i, t, "en", None if i == 4 else "s", None) for i, t in pairs]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    for k, chosen in enumerate((rows, [])):
        folder = f"{tmp_path}/{k}"
        spark.createDataFrame(chosen, schema).write.parquet(f"{folder}/documents.parquet")
        for table in ("labels", "benchmark"):
            spark.read.parquet(f"{TABLES}/{table}.parquet").write.parquet(f"{folder}/{table}.parquet")
        out = corpus_pipeline.run(spark, folder).collect()
        assert len({(r.shard, r.slot) for r in out}) == len(out)
        assert {r.doc_id for r in out} <= {i for i, _ in pairs}


def test_columns_of_any_name_stay(spark):
    from civicmart.llm import decontaminate, sharding, substrings

    passage = " ".join(f"w{i}" for i in range(80))
    docs = spark.createDataFrame([(1, f"before {passage}", 5), (2, f"{passage} after", 6), (2, None, 7)], "doc_id bigint, text string, `a.b` int")
    docs = docs.selectExpr("*", "0 AS row", "0 AS copy", "0 AS __spans", "0 AS size")
    items = spark.createDataFrame([("i", " ".join(f"w{i}" for i in range(12)))], "item_id string, text string")
    for out in (sharding.shuffled(docs).drop("shard", "slot"), decontaminate.remove_spans(docs, items), substrings.remove_repeats(docs)):
        assert out.columns == docs.columns
        assert sorted(r["a.b"] for r in out.collect()) == [5, 6, 7]
