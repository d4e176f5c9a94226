"""Published versions, totals kept from batch to batch, rejected rows, unique sides."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from civicmart.functions.cleaning import FAILED, RAW_TEXT, ColumnRule, apply_rules_with_failures
from civicmart.operators import features as ops
from civicmart.operators import incremental, sinks
from civicmart.operators.incremental import add_batch, read_totals
from civicmart.operators.sinks import read_rejected, write_split, write_table
from civicmart.sources import published
from civicmart.sources.published import VersionTaken, publish, resolve, versions
from civicmart.sources.readers import read_table


def frame(spark, *pairs):
    return spark.createDataFrame(list(pairs), "a int, b string")


class Killed(Exception):
    pass


def die(*args, **kwargs):
    raise Killed


# Steps of a write: the data, the pointer's create, its text, and the old versions' end.
@pytest.mark.parametrize("step, left", [("data", "old"), ("publish", "old"), ("text", "old"), ("forget", "new")])
def test_a_write_killed_at_any_step_leaves_the_old_or_the_new_table(spark, tmp_path, monkeypatch, step, left):
    path = str(tmp_path / "t")
    write_table(frame(spark, (1, "old")), path)
    new = frame(spark, (2, "new"))
    if step == "data":
        new = new.withColumn("a", F.raise_error(F.lit("killed")).cast("int"))
    elif step == "text":
        def empty(spark, path, number, text):
            published._store(spark, path).create(published.hadoop_path(spark, published._pointer(path, number)), False).close()
            raise Killed

        monkeypatch.setattr(published, "_create", empty)
    else:
        monkeypatch.setattr(sinks, step, die)
    with pytest.raises(Exception, match="killed" if step == "data" else None):
        write_table(new, path)
    monkeypatch.undo()
    assert [r.b for r in read_table(spark, path).collect()] == [left]
    write_table(frame(spark, (3, "next")), path)
    assert [r.b for r in read_table(spark, path).collect()] == ["next"]


def test_versions_are_read_by_number_and_old_ones_go(spark, tmp_path):
    path = str(tmp_path / "t")
    for i in range(4):
        write_table(spark.range(i + 1).withColumn(f"c{i}", F.lit(i)), path, keep=3)
    assert versions(spark, path) == [2, 3, 4]
    assert read_table(spark, path, version=2).columns == ["id", "c1"] and read_table(spark, path).count() == 4
    with pytest.raises(ValueError, match="no version 1"):
        read_table(spark, path, version=1)
    assert len(list((tmp_path / "t").glob("data-*"))) == 3


def test_a_version_made_from_an_older_one_is_refused(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(frame(spark, (1, "x")), path)
    last = resolve(spark, path)
    write_table(frame(spark, (2, "y")), path)
    with pytest.raises(VersionTaken):
        publish(spark, path, "parquet", frame(spark).schema, last.folders, after=last.version)
    assert read_table(spark, path).first().b == "y"


def test_an_empty_table_and_a_folder_never_published(spark, tmp_path):
    write_table(frame(spark), str(tmp_path / "empty"))
    assert read_table(spark, str(tmp_path / "empty")).columns == ["a", "b"]
    frame(spark, (1, "x")).write.parquet(str(tmp_path / "plain"))
    assert read_table(spark, str(tmp_path / "plain")).count() == 1


# -- totals -------------------------------------------------------------------------------


def add(spark, path, batch, *sales):
    df = spark.createDataFrame(list(sales), "shop string, year int, amount bigint, paid double")
    return add_batch(df, path, batch, ["shop", "year"], ["amount", "paid"], F.col("year"))


def test_totals_over_batches_equal_one_sum(spark, tmp_path):
    path = str(tmp_path / "totals")
    batches = [
        [("a", 2020, 1, 0.5), ("a", 2020, 2, None), ("b", 2021, 3, None), (None, None, 4, 1.0)],
        [("a", 2021, 10, 0.25), (None, None, 5, None)],
        [("a", 2020, 100, 0.25), ("c", 2021, None, None)],
    ]
    for i, batch in enumerate(batches):
        add(spark, path, f"b{i}", *batch)
        add(spark, path, f"b{i}", *batch)
    whole = spark.createDataFrame(sum(batches, []), "shop string, year int, amount bigint, paid double")
    want = whole.groupBy("shop", "year").agg(F.sum("amount"), F.sum("paid"))
    assert rows(read_totals(spark, path)) == rows(want)
    assert resolve(spark, path).notes["batches"] == ["b0", "b1", "b2"]


def test_untouched_parts_are_neither_read_nor_written(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "totals")
    add(spark, path, "b0", ("a", 2020, 1, 1.0), ("a", 2021, 1, 1.0))
    before = resolve(spark, path).folders
    seen = []
    read = published.Manifest.read
    monkeypatch.setattr(
        published.Manifest, "read", lambda self, spark, path, parts=None, **o: seen.append(parts) or read(self, spark, path, parts, **o)
    )
    add(spark, path, "b1", ("a", 2021, 1, 1.0))
    after = resolve(spark, path).folders
    assert seen == [["2021"]] and after["2020"] == before["2020"] and after["2021"] != before["2021"]
    # The folder of the first version stays as long as a part of it is in use.
    for i in range(2, 6):
        add(spark, path, f"b{i}", ("a", 2021, 1, 1.0))
    assert rows(read_totals(spark, path)) == [("a", 2020, 1, 1.0), ("a", 2021, 6, 6.0)]


def test_a_batch_sum_scans_that_batch_only(spark, tmp_path):
    from civicmart.plans.kept_queries import batch_sums, write_batches

    write_batches(spark, "/root/testdata/sf0.001", str(tmp_path))
    plan = batch_sums(spark, str(tmp_path), 1)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [isnotnull(batch") == 2 and plan.count("(batch#") >= 2
    files = {f for name in ("orders", "lineitem") for f in spark.read.parquet(f"{tmp_path}/{name}").filter("batch = 1").inputFiles()}
    assert files


def test_a_crash_before_publishing_adds_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "totals")
    add(spark, path, "b0", ("a", 2020, 1, 1.0))
    monkeypatch.setattr(incremental, "publish", die)
    with pytest.raises(Killed):
        add(spark, path, "b1", ("a", 2020, 5, 1.0))
    monkeypatch.undo()
    assert rows(read_totals(spark, path)) == [("a", 2020, 1, 1.0)]
    add(spark, path, "b1", ("a", 2020, 5, 1.0))
    assert rows(read_totals(spark, path)) == [("a", 2020, 6, 2.0)]


# -- rejected rows, unique sides --------------------------------------------------------------

RULES = [ColumnRule(("n",), "n", "int"), ColumnRule(("p", "q"), "p", "double"), ColumnRule(("t",), "t")]


def test_rejected_rows_carry_rules_and_text(spark, tmp_path):
    raw = spark.createDataFrame(
        [("1", "2.5", None, "a"), ("-", "..", None, None), (None, None, "x", "b"), (None, None, None, "c"), ("3", None, "4", "d")],
        "n string, p string, q string, t string",
    )
    path = str(tmp_path / "t")
    write_split(apply_rules_with_failures(raw, RULES), path)
    assert rows(read_table(spark, path)) == [(1, 2.5, "a"), (3, 4.0, "d"), (None, None, "c")]
    found = read_rejected(spark, path).select("t", FAILED, RAW_TEXT)
    assert rows(found) == [("b", ["p"], (None, "x", "b")), (None, ["n", "p"], ("-", "..", None))]
    write_split(apply_rules_with_failures(raw, RULES), path, fatal=["n"])
    assert read_rejected(spark, path).count() == 1 and read_table(spark, path).count() == 4


@pytest.mark.parametrize("values", [[], [("1",)], [("x",)]])
def test_a_side_without_rows(spark, tmp_path, values):
    raw = spark.createDataFrame(values, "n string").selectExpr("n", "n as p", "n as q", "n as t")
    for _ in range(3):
        write_split(apply_rules_with_failures(raw, RULES), str(tmp_path / "t"))
    good = sum(v == ("1",) for v in values)
    assert read_table(spark, str(tmp_path / "t")).count() == good
    assert read_rejected(spark, str(tmp_path / "t")).count() == len(values) - good


def test_unique_sides(spark):
    side = spark.createDataFrame([(1, "b"), (1, "a"), (2, "c"), (None, "d"), (None, "e")], "k int, v string")
    first, repeated = ops.unique_side(side, ["k"], "first")
    assert rows(first) == [(1, "a"), (2, "c")] and rows(repeated) == [(1, 2)]
    with pytest.raises(Exception, match=r"rows repeat key \(k\) = \(1\)"):
        ops.unique_side(side, ["k"])
    only, none = ops.unique_side(side.filter("v > 'b'"), ["k"])
    assert rows(only) == [(2, "c")] and none.count() == 0
    keys_only, again = ops.unique_side(side.select("k"), ["k"], "first")
    assert rows(keys_only) == [(1,), (2,)] and rows(again) == [(1, 2)]
