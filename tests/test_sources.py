import json
import re
from dataclasses import replace

import pytest
from conftest import rows

from civicmart.functions.cleaning import apply_rules
from civicmart.sources import readers
from civicmart.sources.catalog import DENSITY, INCOME, UNEMPLOYMENT
from civicmart.sources.readers import (
    explode_records,
    csv_paths_by_header,
    read_csv,
    read_csv_by_name,
    read_own_csv,
    read_csv_by_name,
    read_json_documents,
    read_json_lines,
    skip_marked,
    union_by_name,
    with_file_name,
)
from civicmart.sources.spec import text_fields

INCOME_HEADER = '"Any","Codi_Districte","Nom_Districte","Codi_Barri","Nom_Barri","Població","Índex RFD Barcelona = 100"'


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")
    return str(path)


def envelope(spelling, *counts):
    return json.dumps(
        {
            "help": "h",
            "success": True,
            "result": {
                "resource_id": "r",
                "records": [
                    {"_id": i, "Any": "2014", "Codi_Barri": str(i), spelling: "Atur registrat", "Nombre": c}
                    for i, c in enumerate(counts)
                ],
            },
        },
        indent=1,
    )


def test_sentinel_in_one_of_two_csv_files(spark, tmp_path):
    """A file without "-" would be read as numbers if types were inferred per file."""
    paths = [
        write(tmp_path / "a.csv", f'{INCOME_HEADER}\r\n2008,1,"C",1,"el Raval",47431,"62.6"\r\n'),
        write(tmp_path / "b.csv", f'{INCOME_HEADER}\r\n2007,99,"No consta",99,"No consta",879,"-"\r\n'),
    ]
    out = apply_rules(read_csv(spark, paths, INCOME.raw_schema), INCOME.rules)
    expected = [
        (99, None, 2007, None, 99, None, 879),
        (1, "C", 2008, 62.6, 1, "el Raval", 47431),
    ]
    assert rows(out, "year") == expected
    assert rows(apply_rules(read_csv(spark, paths[::-1], INCOME.raw_schema), INCOME.rules), "year") == expected


def test_a_reordered_csv_header_fails_instead_of_mixing_columns(spark, tmp_path):
    path = write(tmp_path / "a.csv", "b,a\n1,2\n")
    with pytest.raises(Exception, match="header does not conform"):
        read_csv(spark, path, text_fields("a", "b")).collect()


def test_drifted_csv_headers_are_read_by_name(spark, tmp_path):
    paths = [
        write(tmp_path / "a.csv", "a,b\n1,2\n"),
        write(tmp_path / "b.csv", "b,extra,a\n20,0,10\n"),
        write(tmp_path / "c.csv", "b\n200\n"),
        write(tmp_path / "d.csv", ""),
    ]
    out = read_csv_by_name(spark, paths, text_fields("a", "b"))
    assert out.columns == ["a", "b"]
    assert rows(out) == [("1", "2"), ("10", "20"), (None, "200")]
    assert read_csv_by_name(spark, paths[3:], text_fields("a", "b")).collect() == []


def test_without_a_schema_csv_files_unite_by_name(spark, tmp_path):
    paths = [
        write(tmp_path / "a.csv", "x,y\n1,2\n"),
        write(tmp_path / "b.csv", "y,x\n20,10\n"),
        write(tmp_path / "c.csv", "x,z\n100,300\n"),
        write(tmp_path / "d.csv", "x,y\n-,\n"),
    ]
    out = read_csv_by_name(spark, paths)
    got = sorted(((r["x"], r["y"], r["z"]) for r in out.collect()), key=str)
    assert got == sorted(
        [("1", "2", None), ("10", "20", None), ("100", None, "300"), ("-", None, None)], key=str
    )


@pytest.mark.parametrize("flip", [False, True])
def test_envelopes_of_both_spellings_in_any_order(spark, tmp_path, flip):
    paths = [
        write(tmp_path / "2014.json", envelope("Demanda_ocupació", "10", "20")),
        write(tmp_path / "2019.json", envelope("Demanda_ocupacio", "30")),
        write(tmp_path / "2015.json", '{"success": false, "error": {"message": "no", "__type": "x"}}'),
        write(tmp_path / "2016.json", envelope("Demanda_ocupacio")),
        write(tmp_path / "2017.json", '{"success": true, "result": {"records": null}}'),
    ]
    documents = read_json_documents(spark, paths[::-1] if flip else paths, UNEMPLOYMENT.raw_schema)
    assert documents.count() == 5
    records = explode_records(skip_marked(documents, "error"), "result.records")
    out = apply_rules(records, UNEMPLOYMENT.rules, "record")
    assert rows(out.select("count", "job_demand"), "count") == [
        (10, "Atur registrat"),
        (20, "Atur registrat"),
        (30, "Atur registrat"),
    ]


def test_arrays_and_empty_files(spark, tmp_path):
    paths = [
        write(tmp_path / "a.json", '[{"a": 1, "b": "x"}, {"a": null}]'),
        write(tmp_path / "b.json", "[]"),
        write(tmp_path / "c.json", ""),
    ]
    out = read_json_documents(spark, paths, text_fields("a", "b"))
    assert rows(out) == [("1", "x"), (None, None)]
    assert set(read_json_documents(spark, paths).columns) == {"a", "b"}


def test_a_malformed_document_fails(spark, tmp_path):
    path = write(tmp_path / "a.json", '{"a": ')
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        read_json_documents(spark, path, text_fields("a")).collect()


def marked_files(spark, tmp_path):
    write(tmp_path / "file_name=flat.json" / "p.json", '{"Any": "2014"}\n{"Any": "2015"}\n')
    write(tmp_path / "file_name=nested.json" / "p.json", '{"Any": "2016"}\n{"info": {"a": 1}}\n')
    from pyspark.sql.types import StringType, StructField, StructType

    schema = StructType(DENSITY.raw_schema.fields + [StructField("file_name", StringType())])
    return read_json_lines(spark, str(tmp_path), schema)


def test_one_marked_row_takes_out_its_file(spark, tmp_path):
    out = skip_marked(marked_files(spark, tmp_path), "info", "file_name")
    assert rows(out.select("Any")) == [("2014",), ("2015",)]


@pytest.mark.parametrize("nameless", [False, True])
def test_rows_without_a_file_name_are_one_file(spark, nameless):
    data = [(1, "a", None), (2, "a", "x"), (3, "b", None), (4, None, None), (5, None, "x" if nameless else None)]
    df = spark.createDataFrame(data, "n int, file_name string, info string")
    out = skip_marked(df, "info", "file_name")
    assert rows(out.select("n")) == ([(3,)] if nameless else [(3,), (4,), (5,)])


def test_headers_of_many_files_are_one_job(spark, tmp_path):
    for i in range(200):
        write(tmp_path / f"f{i}.csv", "a,b\n1,2\n" if i % 2 else '"b","a"\n2,1\n')
    write(tmp_path / "empty.csv", "")
    paths = [str(tmp_path / f"f{i}.csv") for i in range(200)] + [str(tmp_path / "empty.csv")]
    spark.sparkContext.setJobGroup("headers", "headers")
    try:
        groups = csv_paths_by_header(spark, paths)
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("headers")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert {k: len(v) for k, v in groups.items()} == {("a", "b"): 100, ("b", "a"): 100}
    assert len(jobs) < 8


def test_a_column_named_twice_is_refused(spark, tmp_path):
    write(tmp_path / "x.csv", "a,a,b\n1,2,3\n")
    with pytest.raises(ValueError, match="twice"):
        read_csv_by_name(spark, [str(tmp_path / "x.csv")])


TEXTS = ["", " ", None, "  padded  ", "a\nb", "a\r\nb", 'say "x"', "back\\slash", '\\"', ",", "null", "\t", "é😀", "#x", "'"]


def test_own_csv_keeps_every_text(spark, tmp_path):
    from civicmart.operators.sinks import write_csv

    df = spark.createDataFrame([(i, a, b) for i, a in enumerate(TEXTS) for b in TEXTS], "n int, a string, b string")
    write_csv(df, str(tmp_path / "out"))
    assert rows(read_own_csv(spark, str(tmp_path / "out"), df.schema)) == rows(df)


def test_without_a_file_column_only_marked_rows_go(spark, tmp_path):
    out = skip_marked(marked_files(spark, tmp_path), "info")
    assert rows(out.select("Any")) == [("2014",), ("2015",), ("2016",)]


def test_union_is_by_name_and_keeps_duplicates(spark):
    a = spark.createDataFrame([(1, "x")], "n int, t string")
    b = spark.createDataFrame([("x", 1), ("y", 2)], "t string, n int")
    c = spark.createDataFrame([(3,)], "n int")
    out = union_by_name([a, b, c]).select("n", "t")
    assert rows(out, "n", "t") == [(1, "x"), (1, "x"), (2, "y"), (3, None)]


@pytest.mark.parametrize("name", ["a b+c.csv", "é%20x.csv", "[g]{h}.csv", "k=v.csv"])
def test_file_names_come_back_plain(spark, tmp_path, name):
    write(tmp_path / name, "x\n1\n")
    out = with_file_name(read_csv(spark, str(tmp_path), text_fields("x")))
    assert rows(out) == [("1", name)]


def test_spec_can_be_varied():
    assert replace(UNEMPLOYMENT, multi_line=False).records == "result.records"
