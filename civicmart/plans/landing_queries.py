"""Queries over the landing zone: files that are broken, foreign, republished, or of a new header.

Raw files are written from the given tables under names that stay the same from run to run, as a
portal republishes its files.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ingest import collect, header_history, read_landing, read_ledger
from ..session import materialise, scratch_path
from ..sources.spec import SourceSpec
from .file_queries import CSV_EVENTS, EVENT_FIELDS, JSON_EVENTS
from .raw_files import publish, rename
from .registry import load, query


def _states(spark: SparkSession, landing: str, spec: SourceSpec, name: str) -> DataFrame:
    """(kind, state, rows) of the files ``<kind>-...``, by their latest entry, with rows landed."""
    kind = F.split_part("file_name", F.lit("-"), F.lit(1)).alias("kind")
    ledger = read_ledger(spark, landing, spec.category)
    states = ledger.groupBy("file_name").agg(F.max_by("status", "batch_id").alias("state"))
    states = states.groupBy(kind).agg(F.max("state").alias(f"{name}_state"))
    rows = read_landing(spark, landing, spec.category, spec.file_format, EVENT_FIELDS)
    rows = rows.groupBy(kind).agg(F.count(F.lit(1)).alias("n"))
    counted = F.coalesce("n", F.lit(0).cast("bigint")).alias(f"{name}_rows")
    return materialise(states.join(rows, "kind", "left").select("kind", f"{name}_state", counted), "states")


@query("""
with kinds as (
  select case event_type when 'error' then 'foreign' when 'signup' then 'broken' when 'view' then 'good' else 'more' end as kind
  from events)
select kind, case kind when 'foreign' then 'rejected' when 'broken' then 'quarantined' else 'collected' end as first_state,
  case kind when 'foreign' then 'rejected' else 'collected' end as last_state,
  case when kind in ('foreign', 'broken') then 0 else count(*) end as first_rows,
  case kind when 'foreign' then 0 else count(*) end as last_rows
from kinds group by kind
""")
def quarantine_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON files of which some are broken and some of a foreign type. The good
    ones are landed, the others entered with their state; mended, broken ones are landed by the
    next run, which leaves the rest alone."""
    events = load(spark, sf_dir, "events").select(*EVENT_FIELDS.names)
    root = scratch_path(spark, "quarantine")
    folder, landing = f"{root}/{JSON_EVENTS.category}", f"{root}/landing"
    event = F.col("event_type")
    kind = F.when(event == "error", "foreign").when(event == "signup", "broken").when(event == "view", "good").otherwise("more")
    line = F.to_json(F.struct(*EVENT_FIELDS.names)).alias("line")
    # Lines that have lost their end.
    torn = F.expr("left(line, length(line) - 1)")
    for name, suffix in (("good", ".json"), ("more", ".json"), ("foreign", ".txt"), ("broken", ".json")):
        lines = events.filter(kind == name).select(line)
        publish(spark, lines.select(torn) if name == "broken" else lines, folder, name, suffix, "text")
    collect(spark, [JSON_EVENTS], root, landing)
    first = _states(spark, landing, JSON_EVENTS, "first")
    publish(spark, events.filter(kind == "broken").select(line), folder, "broken", ".json", "text")
    collect(spark, [JSON_EVENTS], root, landing)
    return first.join(_states(spark, landing, JSON_EVENTS, "last"), "kind")


@query("""
select event_id, event_type, value, props, case event_type when 'click' then 2 else 1 end as version from events
""")
def ingest_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three runs over files of which some are republished with other content, some with
    the same, and some under another name. Read back are the latest versions, each row once."""
    events = load(spark, sf_dir, "events").select(*EVENT_FIELDS.names)
    spec = replace(CSV_EVENTS, versioned=True)
    root = scratch_path(spark, "versions")
    folder, landing = f"{root}/{spec.category}", f"{root}/landing"
    event = F.coalesce(F.col("event_type"), F.lit("none"))
    parts = {"click": event == "click", "view": event == "view", "error": event == "error"}
    parts["rest"] = ~event.isin("click", "view", "error")
    for name, some in parts.items():
        rows = events.filter(some)
        publish(spark, rows.withColumn("value", F.col("value") + 1) if name == "click" else rows, folder, name, ".csv", "csv")
    collect(spark, [spec], root, landing)
    publish(spark, events.filter(parts["click"]), folder, "click", ".csv", "csv")
    publish(spark, events.filter(parts["view"]), folder, "view", ".csv", "csv")
    rename(spark, folder, "error", "fault")
    collect(spark, [spec], root, landing)
    collect(spark, [spec], root, landing)
    rows = read_landing(spark, landing, spec.category, "csv", EVENT_FIELDS)
    collected = read_ledger(spark, landing, spec.category).filter("status = 'collected'")
    version = collected.groupBy("file_name").agg(F.max("version").alias("version"))
    return rows.join(version, "file_name").select(
        F.col("event_id").cast("bigint").alias("event_id"),
        "event_type",
        F.col("value").cast("double").alias("value"),
        "props",
        "version",
    )


@query("""
with landed as (
  select case when value < 10 then 1 when value < 50 then 2 else 3 end as round from events),
rounds as (
  select *, row_number() over (order by round) as i
  from (select round, count(*) as n_rows from landed group by round))
select case round when 1 then 'event_id,event_type,value,props' when 2 then 'value,event_type,event_id'
    else 'event_id,event_type,value,props,source' end as columns,
  case when i = 1 or round = 2 then '' else 'props,source' end as added,
  case when i > 1 and round = 2 then 'props' else '' end as removed, n_rows
from rounds
""", name="header_history")
def landed_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The headers that CSV files of one category have had, with what each added and
    removed, and the rows landed under it; rows are read back through the registry."""
    events = load(spark, sf_dir, "events").select(*EVENT_FIELDS.names)
    root = scratch_path(spark, "headers")
    folder, landing = f"{root}/{CSV_EVENTS.category}", f"{root}/landing"
    value = F.coalesce("value", F.lit(100.0))
    rounds = (
        events.filter(value < 10),
        events.filter((value >= 10) & (value < 50)).select("value", "event_type", "event_id"),
        events.filter(value >= 50).withColumn("source", F.lit("third")),
    )
    for i, rows in enumerate(rounds):
        publish(spark, rows, folder, f"round{i}", ".csv", "csv")
        collect(spark, [CSV_EVENTS], root, landing)
    rows = read_landing(spark, landing, CSV_EVENTS.category, "csv", EVENT_FIELDS)
    files = read_ledger(spark, landing, CSV_EVENTS.category).select("file_name", "header")
    counts = rows.join(files, "file_name").groupBy("header").agg(F.count(F.lit(1)).alias("n_rows"))
    listed = [F.array_join(c, ",").alias(c) for c in ("columns", "added", "removed")]
    return header_history(spark, landing, CSV_EVENTS.category).join(counts, "header").select(*listed, "n_rows")
