"""Copies of counted rows, and intermediate tables that are deleted early."""

from pathlib import Path
from urllib.parse import urlparse

from civicmart.functions.keys import each_copy
from civicmart.session import discard, materialise


def test_each_copy_spells_out_every_row(spark):
    counted = spark.createDataFrame([(None, 1), ("a", 7), ("b", 8), ("c", 50)], "`k.x` string, n bigint")
    copies = each_copy(counted, "n", "copy", run=7)
    assert copies.columns == ["k.x", "n", "copy"]
    rows = sorted(((r[0] or "", r[2]) for r in copies.collect()))
    assert rows == [("", 0), *[("a", i) for i in range(7)], *[("b", i) for i in range(8)], *[("c", i) for i in range(50)]]


def test_long_runs_are_dealt_over_tasks(spark):
    counted = spark.createDataFrame([("a", 4000)], "k string, n bigint")
    parts = each_copy(counted, "n", "copy", run=10).rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
    assert sum(parts) == 4000 and max(parts) < 2000


def test_each_copy_of_nothing(spark):
    assert each_copy(spark.createDataFrame([], "k string, n bigint"), "n", "copy").count() == 0


def test_discarded_tables_are_gone_and_others_stay(spark):
    first, second = (materialise(spark.range(5), name) for name in ("first", "second"))
    file = Path(urlparse(first.inputFiles()[0]).path)
    assert file.exists()
    kept = materialise(first.join(second, "id"), "kept")
    discard(first)
    assert kept.count() == 5 and second.count() == 5
    assert not file.parent.exists()
