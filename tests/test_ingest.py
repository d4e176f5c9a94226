import json
import os
import shutil
from dataclasses import replace

import pytest
from conftest import rows
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from civicmart.operators import ingest
from civicmart.operators.ingest import (
    LEDGER_SCHEMA,
    batch_path,
    collect,
    committed_batches,
    file_format,
    header_history,
    list_files,
    new_files,
    read_landing,
    read_ledger,
    read_raw,
    write_batch,
)
from civicmart.operators.versions import file_versions
from civicmart.sources.spec import SourceSpec, text_fields
from civicmart.streaming import collect_stream

FIELDS = text_fields("a", "b")
CSV = SourceSpec("sheets", "sheets", "csv", FIELDS)
DOCS = SourceSpec("docs", "docs", "json", FIELDS)


def drop(tmp_path, spec, name, content):
    folder = tmp_path / "raw" / spec.category
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(content, encoding="utf-8")


def run(spark, tmp_path, specs=(CSV, DOCS)):
    for spec in specs:
        (tmp_path / "raw" / spec.category).mkdir(parents=True, exist_ok=True)
    return collect(spark, specs, str(tmp_path / "raw"), str(tmp_path / "landing"))


def landed(spark, tmp_path, spec, *columns):
    df = read_landing(spark, str(tmp_path / "landing"), spec.category, spec.file_format, FIELDS)
    return rows(df.select(*(columns or ("a", "b", "file_name"))))


def test_files_are_collected_once(spark, tmp_path):
    drop(tmp_path, CSV, "one.csv", "a,b\n1,x\n2,-\n")
    drop(tmp_path, DOCS, "one.json", json.dumps([{"a": 1, "b": "é"}, {"a": None}]))
    first = run(spark, tmp_path)
    assert first["sheets"] == first["docs"] is not None
    assert run(spark, tmp_path) == {"sheets": None, "docs": None}

    drop(tmp_path, CSV, "two.csv", "b,a\ny,3\n")
    second = run(spark, tmp_path)
    assert second["docs"] is None and second["sheets"] > first["sheets"]
    assert landed(spark, tmp_path, CSV) == [("1", "x", "one.csv"), ("2", "-", "one.csv"), ("3", "y", "two.csv")]
    assert landed(spark, tmp_path, DOCS) == [("1", "é", "one.json"), (None, None, "one.json")]
    ledger = read_ledger(spark, str(tmp_path / "landing")).select("category", "file_name", "status")
    assert rows(ledger) == [
        ("docs", "one.json", "collected"),
        ("sheets", "one.csv", "collected"),
        ("sheets", "two.csv", "collected"),
    ]


def test_files_of_one_batch_may_differ_in_their_headers(spark, tmp_path):
    drop(tmp_path, CSV, "one.csv", "a,b\n1,x\n")
    drop(tmp_path, CSV, "two.csv", "b,c,a\ny,0,2\n")
    drop(tmp_path, CSV, "void.csv", "")
    run(spark, tmp_path, (CSV,))
    assert landed(spark, tmp_path, CSV) == [("1", "x", "one.csv"), ("2", "y", "two.csv")]
    assert run(spark, tmp_path, (CSV,))["sheets"] is None


@pytest.mark.parametrize(
    "start, quoted_lines",
    [("\n", False), ("\r\n  \r\n", False), ("\ufeff\n\n", False), ("\n", True), ("\ufeff\n\n", True)],
)
def test_blank_lines_before_the_header(spark, tmp_path, start, quoted_lines):
    spec = replace(CSV, quoted_lines=quoted_lines)
    drop(tmp_path, spec, "one.csv", "a,b\n1,x\n")
    drop(tmp_path, spec, "two.csv", f"{start}b,a\ny,2\n\nz,3\n")
    drop(tmp_path, spec, "void.csv", f"{start}\n")
    run(spark, tmp_path, (spec,))
    assert landed(spark, tmp_path, spec) == [("1", "x", "one.csv"), ("2", "y", "two.csv"), ("3", "z", "two.csv")]


def test_a_header_behind_a_blank_block_is_quarantined_not_lost(spark, tmp_path):
    drop(tmp_path, CSV, "one.csv", "\n" * 5000 + "a,b\n1,x\n")
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        run(spark, tmp_path, (CSV,))
        assert states(spark, tmp_path) == [("one.csv", "quarantined", "no header in the first block")]
        assert landed(spark, tmp_path, CSV) == []
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    run(spark, tmp_path, (CSV,))
    assert landed(spark, tmp_path, CSV) == [("1", "x", "one.csv")]


def test_a_republished_name_is_not_collected_again(spark, tmp_path):
    drop(tmp_path, CSV, "one.csv", "a,b\n1,x\n")
    run(spark, tmp_path)
    drop(tmp_path, CSV, "one.csv", "a,b\n9,z\n")
    assert run(spark, tmp_path)["sheets"] is None
    assert landed(spark, tmp_path, CSV) == [("1", "x", "one.csv")]


def test_the_same_name_in_two_categories_is_two_files(spark, tmp_path):
    other = replace(CSV, category="more")
    drop(tmp_path, CSV, "one.csv", "a,b\n1,x\n")
    run(spark, tmp_path)
    drop(tmp_path, other, "one.csv", "a,b\n2,y\n")
    assert run(spark, tmp_path, (CSV, other))["more"] is not None
    assert landed(spark, tmp_path, other) == [("2", "y", "one.csv")]


def test_other_types_are_rejected_visibly_and_hidden_files_ignored(spark, tmp_path):
    drop(tmp_path, CSV, "notes.txt", "hello")
    drop(tmp_path, CSV, ".hidden.csv", "a,b\n1,x\n")
    drop(tmp_path, CSV, "_SUCCESS", "")
    assert run(spark, tmp_path, (CSV,))["sheets"] is not None
    ledger = read_ledger(spark, str(tmp_path / "landing"))
    assert rows(ledger.select("file_name", "status")) == [("notes.txt", "rejected")]
    assert run(spark, tmp_path, (CSV,))["sheets"] is None
    assert landed(spark, tmp_path, CSV) == []


@pytest.mark.parametrize("name", ["a b+c.csv", "é%20x.csv", "[g]{h}*.csv", "k=v.csv"])
def test_awkward_file_names(spark, tmp_path, name):
    drop(tmp_path, CSV, name, "a,b\n1,x\n")
    drop(tmp_path, CSV, "g.csv", "a,b\n2,y\n")
    run(spark, tmp_path, (CSV,))
    assert landed(spark, tmp_path, CSV) == [("1", "x", name), ("2", "y", "g.csv")]
    assert run(spark, tmp_path, (CSV,))["sheets"] is None


def test_a_batch_without_ledger_rows_is_not_read(spark, tmp_path):
    """A run that dies between data and ledger: the next one collects the file again."""
    drop(tmp_path, CSV, "one.csv", "a,b\n1,x\n")
    source = str(tmp_path / "raw" / "sheets" / "one.csv")
    landing = str(tmp_path / "landing")
    lost = batch_path(landing, "sheets", "csv", "20200101T000000000000")
    write_batch(read_raw(spark, [source], "csv", CSV), "csv", lost)
    assert landed(spark, tmp_path, CSV) == []
    run(spark, tmp_path, (CSV,))
    assert landed(spark, tmp_path, CSV) == [("1", "x", "one.csv")]


def test_a_repeated_batch_replaces_itself(spark, tmp_path):
    path = batch_path(str(tmp_path), "sheets", "csv", "b1")
    df = spark.createDataFrame([("1", "x", "one.csv")], "a string, b string, file_name string")
    write_batch(df, "csv", path)
    write_batch(df, "csv", path)
    assert spark.read.option("header", True).csv(path).count() == 1


def test_missing_folder_and_unreadable_ledger_raise(spark, tmp_path):
    with pytest.raises(AnalysisException):
        collect(spark, [CSV], str(tmp_path / "nowhere"), str(tmp_path / "landing"))
    drop(tmp_path, CSV, "one.csv", "a,b\n1,x\n")
    run(spark, tmp_path, (CSV,))
    ledger = tmp_path / "landing" / "_ledger" / "sheets"
    shutil.rmtree(ledger)
    ledger.mkdir()
    (ledger / "part-0.parquet").write_text("not parquet")
    with pytest.raises(Exception, match="(?i)parquet"):
        run(spark, tmp_path, (CSV,))


def test_one_failing_category_leaves_the_others_committed(spark, tmp_path):
    drop(tmp_path, CSV, "one.csv", "a,b\n1,x\n")
    drop(tmp_path, DOCS, "one.json", '{"a": 1}')
    (tmp_path / "landing" / "_ledger" / "docs").mkdir(parents=True)
    (tmp_path / "landing" / "_ledger" / "docs" / "part-0.parquet").write_text("not parquet")
    ledger = tmp_path / "landing" / "_ledger" / "docs" / "part-0.parquet"
    with pytest.raises(Exception, match="(?i)parquet"):
        run(spark, tmp_path)
    ledger.unlink()
    run(spark, tmp_path)
    assert landed(spark, tmp_path, CSV) == [("1", "x", "one.csv")]
    assert landed(spark, tmp_path, DOCS) == [("1", None, "one.json")]


def states(spark, tmp_path, category=None):
    ledger = read_ledger(spark, str(tmp_path / "landing"), category)
    return rows(ledger.select("file_name", "status", "reason"))


def test_a_broken_document_is_quarantined_alone_and_tried_again(spark, tmp_path):
    drop(tmp_path, CSV, "one.csv", "a,b\n1,x\n")
    drop(tmp_path, DOCS, "bad.json", '{"a": ')
    drop(tmp_path, DOCS, "number.json", "3")
    drop(tmp_path, DOCS, "good.json", '{"a": 1, "b": {"c": "d"}}')
    drop(tmp_path, DOCS, "notes.txt", "hello")
    run(spark, tmp_path)
    first = [
        ("bad.json", "quarantined", '1 not JSON: {"a": '),
        ("good.json", "collected", None),
        ("notes.txt", "rejected", None),
        ("number.json", "quarantined", "1 not JSON: 3"),
    ]
    assert states(spark, tmp_path, "docs") == first
    assert landed(spark, tmp_path, CSV) == [("1", "x", "one.csv")]
    assert landed(spark, tmp_path, DOCS) == [("1", '{"c":"d"}', "good.json")]
    drop(tmp_path, DOCS, "bad.json", '{"a": 5}')
    assert run(spark, tmp_path)["sheets"] is None
    assert landed(spark, tmp_path, DOCS) == [("1", '{"c":"d"}', "good.json"), ("5", None, "bad.json")]
    again = states(spark, tmp_path, "docs")
    assert again == sorted(first + [("bad.json", "collected", None), first[3]], key=repr)


def test_only_broken_documents(spark, tmp_path):
    drop(tmp_path, DOCS, "bad.json", '{"a": ')
    run(spark, tmp_path, (DOCS,))
    assert states(spark, tmp_path) == [("bad.json", "quarantined", '1 not JSON: {"a": ')]
    assert landed(spark, tmp_path, DOCS) == []


def test_a_bad_line_takes_out_its_file_with_the_good_ones(spark, tmp_path):
    lines = replace(DOCS, multi_line=False)
    drop(tmp_path, lines, "half %.json", '{"a": 1}\nnothing\n{"a": 2}\n{"a"\n')
    drop(tmp_path, lines, "good.json", '{"a": 3}\n\n{"a": 4}\n')
    run(spark, tmp_path, (lines,))
    assert landed(spark, tmp_path, lines, "a", "file_name") == [("3", "good.json"), ("4", "good.json")]
    assert states(spark, tmp_path)[1] == ("half %.json", "quarantined", "2 not JSON: nothing")


def test_a_column_named_twice_quarantines_the_file_only(spark, tmp_path):
    drop(tmp_path, CSV, "one.csv", "a,b\n1,x\n")
    drop(tmp_path, CSV, "two.csv", "a,b,a\n1,x,2\n")
    run(spark, tmp_path, (CSV,))
    assert landed(spark, tmp_path, CSV) == [("1", "x", "one.csv")]
    assert states(spark, tmp_path)[1] == ("two.csv", "quarantined", "columns named twice: a")


def test_the_stream_treats_foreign_and_broken_files_as_the_listing_does(spark, tmp_path):
    drop(tmp_path, DOCS, "one.json", '{"a": 1}')
    drop(tmp_path, DOCS, "two.csv", "a,b\n2,y\n")
    drop(tmp_path, DOCS, "bad.json", "{")
    drop(tmp_path, DOCS, "notes.txt", "hello")
    stream(spark, tmp_path, DOCS)
    by_stream = states(spark, tmp_path)
    shutil.rmtree(tmp_path / "landing")
    run(spark, tmp_path, (DOCS,))
    assert by_stream == states(spark, tmp_path)
    assert [state for _, state, _ in by_stream] == ["quarantined", "rejected", "collected", "collected"]


VERSIONED = replace(CSV, versioned=True)
DOC_VERSIONS = replace(DOCS, versioned=True)


def versions(spark, tmp_path, category):
    found = file_versions(read_ledger(spark, str(tmp_path / "landing"), category))
    return rows(found.select("file_name", "version", "status", "reason"))


@pytest.mark.parametrize("spec", [VERSIONED, DOC_VERSIONS])
def test_versions_of_changed_unchanged_and_renamed_files(spark, tmp_path, spec):
    kind = spec.file_format
    text = (lambda a: f"a,b\n{a},x\n") if kind == "csv" else (lambda a: json.dumps({"a": a, "b": "x"}))
    names = {n: f"{n}.{kind}" for n in ("changed", "same", "gone", "new", "copy")}
    for n, a in (("changed", 1), ("same", 2), ("gone", 3)):
        drop(tmp_path, spec, names[n], text(a))
    run(spark, tmp_path, (spec,))
    assert run(spark, tmp_path, (spec,))[spec.category] is None
    folder = tmp_path / "raw" / spec.category
    drop(tmp_path, spec, names["changed"], text(9))
    os.utime(folder / names["same"], (1, 1))
    (folder / names["gone"]).rename(folder / names["new"])
    drop(tmp_path, spec, names["copy"], text(2))
    assert run(spark, tmp_path, (spec,))[spec.category] is not None
    want = sorted([("9", "x", names["changed"]), ("2", "x", names["same"]), ("3", "x", names["gone"]), ("2", "x", names["copy"])])
    assert landed(spark, tmp_path, spec) == want
    assert versions(spark, tmp_path, spec.category) == sorted(
        [
            (names["changed"], 1, "collected", None),
            (names["changed"], 2, "collected", None),
            (names["same"], 1, "collected", None),
            (names["same"], 1, "unchanged", None),
            (names["gone"], 1, "collected", None),
            (names["new"], 1, "renamed", f"was {names['gone']}"),
            (names["copy"], 1, "collected", None),
        ],
        key=repr,
    )
    assert run(spark, tmp_path, (spec,))[spec.category] is None
    # Back to an earlier content: a version again.
    drop(tmp_path, spec, names["changed"], text(1))
    run(spark, tmp_path, (spec,))
    assert ("1", "x", names["changed"]) in landed(spark, tmp_path, spec)


def test_headers_are_kept_and_read_back_without_looking_at_files(spark, tmp_path, monkeypatch):
    drop(tmp_path, CSV, "one.csv", "a,b\n1,x\n")
    drop(tmp_path, CSV, "two.csv", "a,b\n2,y\n")
    run(spark, tmp_path, (CSV,))
    drop(tmp_path, CSV, "three.csv", "b,a,c\nz,3,0\n")
    run(spark, tmp_path, (CSV,))
    landing = str(tmp_path / "landing")
    history = header_history(spark, landing, "sheets").orderBy("first_batch")
    found = [(r["columns"], r.n_files, r.added, r.removed) for r in history.collect()]
    assert found == [(["a", "b"], 2, [], []), (["b", "a", "c"], 1, ["c"], [])]
    monkeypatch.setattr(ingest, "csv_paths_by_header", lambda spark, paths, **o: {} if not paths else 1 / 0)
    assert landed(spark, tmp_path, CSV) == [("1", "x", "one.csv"), ("2", "y", "two.csv"), ("3", "z", "three.csv")]


def test_batches_landed_without_a_registry_are_read(spark, tmp_path):
    drop(tmp_path, CSV, "one.csv", "a,b\n1,x\n")
    run(spark, tmp_path, (CSV,))
    shutil.rmtree(tmp_path / "landing" / "_headers")
    assert landed(spark, tmp_path, CSV) == [("1", "x", "one.csv")]


def test_undeclared_fields_are_all_kept(spark, tmp_path):
    spec = SourceSpec("any", "any", "csv")
    drop(tmp_path, spec, "one.csv", "p,q\n1,2\n")
    drop(tmp_path, spec, "two.csv", "q,r\n20,30\n")
    drop(tmp_path, spec, "three.json", '[{"p": 100, "deep": {"x": [1, 2]}}]')
    run(spark, tmp_path, (spec,))
    landing = str(tmp_path / "landing")
    sheets = read_landing(spark, landing, "any", "csv", text_fields("p", "q", "r"))
    assert rows(sheets.select("p", "q", "r")) == [("1", "2", None), (None, "20", "30")]
    docs = read_landing(spark, landing, "any", "json", text_fields("p", "deep"))
    assert rows(docs.select("p", "deep")) == [("100", '{"x":["1","2"]}')]


def test_no_batches_give_an_empty_frame(spark, tmp_path):
    landing = str(tmp_path / "landing")
    assert committed_batches(spark, landing, "sheets", "csv") == []
    empty = read_landing(spark, landing, "sheets", "csv", FIELDS)
    assert empty.columns == ["a", "b", "batch_id", "file_name"] and empty.count() == 0


def test_listing_and_anti_join(spark, tmp_path):
    drop(tmp_path, CSV, "one.csv", "")
    drop(tmp_path, CSV, "two.csv", "")
    listing = list_files(spark, {"sheets": str(tmp_path / "raw" / "sheets")})
    assert rows(listing.select("category", "file_name")) == [("sheets", "one.csv"), ("sheets", "two.csv")]
    seen = spark.createDataFrame([("sheets", "one.csv", "csv", "b", "collected")] * 3, LEDGER_SCHEMA)
    fresh = new_files(listing, seen, ["category", "file_name"])
    assert rows(fresh.select("file_name")) == [("two.csv",)]


def test_format_by_extension():
    assert [file_format(n) for n in ("a.csv", "a.json", "a.CSV", "a.csv.gz", "csv")] == [
        "csv", "json", None, None, None,
    ]


def test_batch_ids_sort_by_time_and_suit_paths():
    first, second = ingest.new_batch_id(), ingest.new_batch_id()
    assert first < second and first.isalnum()


def stream(spark, tmp_path, spec):
    collect_stream(
        spark,
        spec,
        str(tmp_path / "raw" / spec.category),
        str(tmp_path / "landing"),
        str(tmp_path / "checkpoint" / spec.category),
        files_per_batch=2,
    ).awaitTermination()


def test_the_stream_lands_what_the_listing_lands(spark, tmp_path):
    for i in range(5):
        drop(tmp_path, CSV, f"f {i}%.csv", f"a,b\n{i},x\n")
    drop(tmp_path, DOCS, "d.json", '[{"a": 1},\n {"a": 2}]')
    drop(tmp_path, DOCS, "notes.txt", "hello")
    for spec in (CSV, DOCS):
        stream(spark, tmp_path, spec)
        stream(spark, tmp_path, spec)
    assert landed(spark, tmp_path, CSV) == [(str(i), "x", f"f {i}%.csv") for i in range(5)]
    assert landed(spark, tmp_path, DOCS) == [("1", None, "d.json"), ("2", None, "d.json")]
    drop(tmp_path, CSV, "g.csv", "a,b\n9,y\n")
    stream(spark, tmp_path, CSV)
    assert ("9", "y", "g.csv") in landed(spark, tmp_path, CSV)
    ledger = read_ledger(spark, str(tmp_path / "landing"))
    assert ledger.groupBy("category", "file_name").count().filter("count > 1").count() == 0
    # The ledger is shared: the listing collector finds nothing left of these files.
    assert run(spark, tmp_path, (CSV,))["sheets"] is None


def test_the_stream_lands_undeclared_fields_and_quoted_lines(spark, tmp_path):
    quoted = replace(CSV, raw_schema=FIELDS, quoted_lines=True)
    docs = replace(DOCS, raw_schema=FIELDS)
    drop(tmp_path, CSV, "one.csv", 'a,b\n1,"x\ny"\n')
    drop(tmp_path, CSV, "two.csv", "b,c,a\ny,0,2\n")
    drop(tmp_path, DOCS, "one.json", '[{"a": 1, "c": "new", "deep": {"x": [1, 2]}}]')
    drop(tmp_path, DOCS, "two.json", '{"a": 2}')
    for spec in (quoted, docs):
        stream(spark, tmp_path, spec)
    landing = str(tmp_path / "landing")
    sheets = read_landing(spark, landing, "sheets", "csv", text_fields("a", "b", "c"))
    assert rows(sheets.select("a", "b", "c")) == [("1", "x\ny", None), ("2", "y", "0")]
    found = read_landing(spark, landing, "docs", "json", text_fields("a", "c", "deep"))
    assert rows(found.select("a", "c", "deep")) == [("1", "new", '{"x":["1","2"]}'), ("2", None, None)]
    assert run(spark, tmp_path, (quoted, docs)) == {"sheets": None, "docs": None}


def test_the_stream_lands_files_without_fields(spark, tmp_path):
    drop(tmp_path, DOCS, "none.json", "[]")
    drop(tmp_path, DOCS, "void.json", "{}")
    stream(spark, tmp_path, replace(DOCS, raw_schema=FIELDS))
    assert landed(spark, tmp_path, DOCS) == [(None, None, "void.json")]
    assert run(spark, tmp_path, (DOCS,))["docs"] is None


def test_a_hot_file_is_written_by_every_task_that_scans_it(spark, tmp_path):
    """No shuffle between scan and write, so one big file cannot end up in one task."""
    df = spark.range(0, 1000, 1, 4).select(F.col("id").cast("string").alias("a"), F.lit("x").alias("b"))
    write_batch(df.withColumn("file_name", F.lit("big.csv")), "csv", str(tmp_path / "out"))
    assert len(list((tmp_path / "out" / "file_name=big.csv").glob("part-*.csv"))) == 4
