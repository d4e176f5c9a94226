"""Queries that go through files: raw formats, landing batches, zones and round trips.

Each writes its input, derived from the given tables, to a fresh folder under the shared
scratch path and returns what the library reads back.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from ..functions.cleaning import ColumnRule, apply_rules
from ..operators.features import heavy_keys, left_chain, present
from ..operators.ingest import batch_path, collect, read_landing, write_batch
from ..operators.sinks import write_csv, write_formatted, write_json, write_table
from ..session import in_parallel, materialise, scratch_path
from ..sources.documents import read_records
from ..sources.catalog import DENSITY, IMMIGRANTS, INCOME, LOOKUP_TABLES, UNEMPLOYMENT
from ..sources.readers import (
    explode_records,
    read_json_documents,
    read_json_lines,
    read_named_file,
    read_own_csv,
    read_table,
    skip_marked,
)
from ..sources.spec import SourceSpec, text_fields
from ..streaming import collect_stream
from .mart import build_mart
from .raw_files import publish
from .registry import load, query
from .table_queries import MART_SQL, TRADE_COLUMNS
from .trade import cells, customer_year_facts, mart_inputs, target_index
from .zones import Zones, collect_stage, format_stage, transform_stage

# -- raw formats ------------------------------------------------------------------------

RECORD_FIELDS = text_fields("event_id", "kind", "amount")
ENVELOPE = StructType(
    [
        # As text: an error may be a structure or a sentence.
        StructField("error", StringType()),
        StructField("result", StructType([StructField("records", ArrayType(RECORD_FIELDS))])),
    ]
)
RECORD_RULES = (
    ColumnRule(("event_id",), "event_id", "int"),
    ColumnRule(("kind",), "kind"),
    ColumnRule(("amount",), "amount", "double"),
)


def prop_k() -> Column:
    return F.get_json_object("props", "$.k")


def record(kind: str, amount: Column) -> Column:
    return F.struct(
        F.col("event_id").cast("string").alias("event_id"),
        F.lit(kind).alias("kind"),
        amount.cast("string").alias("amount"),
    )


@query("""
select cast(event_id as int) as event_id, 'value' as kind, value as amount from events
where event_type not in ('error', 'signup')
union all
select cast(event_id as int), 'k', try_cast(json_extract_string(props, '$.k') as double)
from events where event_type not in ('error', 'signup')
""", name="explode_records")
def exploded_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON-lines envelopes of two records, of none, and without the array."""
    kind = F.col("event_type")
    two = F.array(record("value", F.col("value")), record("k", prop_k()))
    records = F.when(kind == "signup", F.slice(two, 1, 0)).when(kind != "error", two)
    path = scratch_path(spark, "envelopes")
    write_json(
        load(spark, sf_dir, "events").select(F.struct(records.alias("records")).alias("result")), path
    )
    lines = read_json_lines(spark, path, ENVELOPE)
    return apply_rules(explode_records(lines, "result.records"), RECORD_RULES, "record")


def record_of(kind: Column, amount: Column) -> Column:
    return F.struct(F.col("event_id").cast("string").alias("event_id"), kind.alias("kind"), amount.cast("string").alias("amount"))


# Opens the array of a document and is no event.
FIRST_RECORD = -1


def document_lines(spark: SparkSession, lines: DataFrame) -> DataFrame:
    """The text of one document whose array holds the lines, in one part and in order. The part is
    never sorted or held: what opens and closes the document goes with the first and the last line
    it comes by, whichever they are."""
    head = f'{{"success": true, "result": {{"records": [{{"event_id": "{FIRST_RECORD}"}}'
    tail = '], "total": 0}}'
    count = lines.count()
    if not count:
        return spark.range(1).coalesce(1).select(F.lit(f"{head}\n{tail}").alias("line"))
    # In a single part the ids are the lines' places.
    place = F.col("place")
    placed = lines.coalesce(1).withColumn("place", F.monotonically_increasing_id())
    opened, closed = F.when(place == 0, F.lit(head)), F.when(place == count - 1, F.lit(tail))
    return placed.select(F.concat_ws("\n", opened, F.concat(F.lit(","), "line"), closed).alias("line"))


def write_document(spark: SparkSession, lines: DataFrame, path: str) -> None:
    """One file with one document whose array holds the lines. One task writes it, line by line, as
    a portal's export would."""
    document_lines(spark, lines).write.text(path)


# Events of a scan task per document.
DOCUMENT_ROWS = 10_000


@query("""
select cast(event_id as int) as event_id, event_type as kind, value as amount
from events where event_type <> 'error' and event_type <> 'signup'
""")
def skip_error_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One multi-line document per file, some of them error envelopes.

    A scan task's events of a type are cut into documents of equal length by their place in the
    task's own order, so documents are bounded, copies of an event included, and their number
    follows the rows and the tasks, whatever the ids. Error envelopes carry a structure, a text
    (signup events) or, where there is no error, a null.
    """
    events = load(spark, sf_dir, "events").select("event_id", "event_type", "value")
    events = events.withColumn("row", F.monotonically_increasing_id())
    # The row's task is in the upper bits, and the place within the task in the lower 33.
    chunk = F.floor(F.col("row") / DOCUMENT_ROWS)
    task = F.shiftright("row", 33)
    records = F.collect_list(
        F.struct(
            F.col("event_id").cast("string").alias("event_id"),
            F.col("event_type").alias("kind"),
            F.col("value").cast("string").alias("amount"),
        )
    )
    grouped = events.groupBy(task.alias("task"), chunk.alias("chunk"), "event_type")
    grouped = grouped.agg(records.alias("records"))
    kind = F.col("event_type")
    result = F.to_json(F.struct("records"), {"pretty": "true"})
    document = (
        F.when(kind == "error", F.lit('{"success": false,\n "error": {"message": "not found"}}'))
        .when(kind == "signup", F.lit('{"success": false,\n "error": "not found"}'))
        .otherwise(F.concat(F.lit('{"error": null,\n "result": '), result, F.lit("}")))
    )
    path = scratch_path(spark, "documents")
    # One document per file: a writer of one record a file, not a folder for each.
    documents = grouped.select(document.alias("document"))
    documents.write.option("maxRecordsPerFile", 1).text(path)
    rows = explode_records(skip_marked(read_json_documents(spark, path, ENVELOPE), "error"), "result.records")
    return apply_rules(rows, RECORD_RULES, "record")


@query("""
select cast(event_id as int) as event_id, event_type as kind, value as amount from events
""")
def split_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document with all events in its array, in one file, read by as many tasks as the
    file has shares."""
    events = load(spark, sf_dir, "events")
    kind = F.coalesce("event_type", F.lit("none"))
    lines = events.select(F.to_json(record_of(kind, F.col("value"))).alias("line"))
    path = scratch_path(spark, "document")
    write_document(spark, lines, path)
    rows = read_records(spark, path, RECORD_FIELDS, cut="}\n,").filter(F.col("event_id") != FIRST_RECORD)
    return apply_rules(rows, RECORD_RULES)


@query("""
with named as (
  select event_id, event_type, value,
         case when event_type <> 'error' then event_type end as file_name,
         coalesce(event_type = 'signup' and value > 50 or event_type = 'error' and value > 90, false)
           as marked
  from events)
select event_id, event_type, value from named
where not exists (
  select 1 from named m where m.marked and m.file_name is not distinct from named.file_name)
""")
def skip_marked_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One marked row takes its whole file out; files are folders of the landing zone,
    and rows without a file name are a file of their own."""
    kind = F.col("event_type")
    marked = (kind == "signup") & (F.col("value") > 50) | (kind == "error") & (F.col("value") > 90)
    events = load(spark, sf_dir, "events").select(
        "event_id",
        "event_type",
        "value",
        F.when(marked, "nested").alias("info"),
        F.when(kind != "error", F.concat(kind, F.lit(".json"))).alias("file_name"),
    )
    path = scratch_path(spark, "marked")
    write_batch(events, "json", path)
    rows = read_json_lines(spark, path, events.schema)
    return skip_marked(rows, "info", "file_name").select("event_id", "event_type", "value")


@query("select event_id, event_type as action, value from events")
def coalesce_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """U1 over files: one scan of two folders whose field is spelled differently."""
    events = load(spark, sf_dir, "events")
    early = F.col("event_type").isin("view", "click")
    paths = [scratch_path(spark, "accented"), scratch_path(spark, "plain")]
    spelled = F.col("event_type")
    write_json(events.filter(early).select("event_id", spelled.alias("Acció"), "value"), paths[0])
    write_json(events.filter(~early).select("value", spelled.alias("Accio"), "event_id"), paths[1])
    schema = "event_id bigint, `Acció` string, Accio string, value double"
    action = ColumnRule(("Acció", "Accio"), "action")
    return read_json_lines(spark, paths, schema).select("event_id", action.column(), "value")


# -- collecting -------------------------------------------------------------------------

EVENT_FIELDS = text_fields("event_id", "event_type", "value", "props")
CSV_EVENTS = SourceSpec("csv_events", "csv_events", "csv", EVENT_FIELDS)
JSON_EVENTS = SourceSpec("json_events", "json_events", "json", EVENT_FIELDS, multi_line=False)
EVENT_SPECS = (CSV_EVENTS, JSON_EVENTS)


def collected_events(
    spark: SparkSession, sf_dir: str, collect_new: Callable[[str, str], None]
) -> DataFrame:
    """Drop event files in two rounds, collect after each and once more, read it all back."""
    events = load(spark, sf_dir, "events").select(*EVENT_FIELDS.names)
    as_csv = F.col("event_type").isin("view", "click")
    small = F.coalesce(F.col("value") < 10, F.lit(False))
    root = scratch_path(spark, "collecting")
    landing = f"{root}/landing"
    for drop in (events.filter(small), events.filter(~small), None):
        if drop is not None:
            drop.filter(as_csv).write.mode("append").csv(f"{root}/csv_events", header=True)
            drop.filter(~as_csv).write.mode("append").json(f"{root}/json_events")
        collect_new(root, landing)
    landed = [
        read_landing(spark, landing, spec.category, spec.file_format, EVENT_FIELDS)
        for spec in EVENT_SPECS
    ]
    return landed[0].unionByName(landed[1]).select(
        F.col("event_id").cast("bigint").alias("event_id"),
        "event_type",
        F.col("value").cast("double").alias("value"),
        "props",
    )


COLLECTED_SQL = "select event_id, event_type, value, props from events"


@query(COLLECTED_SQL)
def ingest_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated runs land every file once."""

    def collect_new(source: str, landing: str) -> None:
        collect(spark, EVENT_SPECS, source, landing)

    return collected_events(spark, sf_dir, collect_new)


@query(COLLECTED_SQL)
def ingest_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S8 with the file stream source, mixed with listings: a listing after the first drop,
    streams that have lost their checkpoints after the second and third, and a listing again.
    The ledger keeps every file to one landing."""
    rounds = iter(("listing", "first", "second"))

    def collect_new(source: str, landing: str) -> None:
        how = next(rounds)
        if how != "listing":
            running = []
            for spec in EVENT_SPECS:
                memory = f"{landing}/_checkpoints/{how}/{spec.category}"
                folder = f"{source}/{spec.category}"
                running.append(collect_stream(spark, spec, folder, landing, memory))
            for stream in running:
                stream.awaitTermination()
        if how != "first":
            collect(spark, EVENT_SPECS, source, landing)

    return collected_events(spark, sf_dir, collect_new)


@query("""
select c_custkey, c_name, c_acctbal, c_mktsegment from customer
where c_mktsegment = 'BUILDING'
""")
def named_file_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One file name over two batches; the other files are pruned unread."""
    customers = load(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_acctbal", "c_mktsegment"
    )
    named = customers.withColumn(
        "file_name", F.concat(F.lower("c_mktsegment"), F.lit(".csv"))
    )
    positive = F.coalesce(F.col("c_acctbal") > 0, F.lit(False))
    root = scratch_path(spark, "batches")
    for batch_id, rows in (("b1", named.filter(positive)), ("b2", named.filter(~positive))):
        write_batch(rows, "csv", batch_path(root, "customers", "csv", batch_id))
    base = f"{root}/customers/csv"
    schema = f"{_ddl(customers)}, batch_id string, file_name string"
    scan = read_own_csv(spark, base, schema)
    return read_named_file(scan, "building.csv").select(*customers.columns)


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"{field.name} {field.dataType.simpleString()}" for field in df.schema)


# -- round trips ------------------------------------------------------------------------


@query("""
select 'document' as kind, doc_id as id, text, source as name, cast(n_chars as double) as number
from documents
union all select 'turn', conv_id, text, role, cast(turn as double) from conversations
union all select 'part', p_partkey, p_name, p_type, p_retailprice from part
""")
def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts of any kind, line breaks and quotes included, come back to the letter."""
    documents = load(spark, sf_dir, "documents").selectExpr(
        "'document' as kind", "doc_id as id", "text", "source as name", "cast(n_chars as double) as number"
    )
    turns = load(spark, sf_dir, "conversations").selectExpr(
        "'turn'", "conv_id", "text", "role", "cast(turn as double)"
    )
    parts = load(spark, sf_dir, "part").selectExpr(
        "'part'", "p_partkey", "p_name", "p_type", "p_retailprice"
    )
    rows = documents.union(turns).union(parts)
    path = scratch_path(spark, "csv")
    write_csv(rows, path)
    return read_own_csv(spark, path, rows.schema)


@query("select event_id, ts, user_id, event_type, value, props from events")
def json_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3, K2, microseconds included."""
    events = load(spark, sf_dir, "events")
    path = scratch_path(spark, "json")
    write_json(events, path)
    return read_json_lines(spark, path, events.schema)


CUSTOMER_COLUMNS = "c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment"


@query(f"""
select 'table' as copy, {CUSTOMER_COLUMNS} from customer
union all select 'json', {CUSTOMER_COLUMNS} from customer
""")
def formatted_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both copies of a formatted table hold the same rows."""
    customers = load(spark, sf_dir, "customer")
    root = scratch_path(spark, "formatted")
    write_formatted(customers, f"{root}/customer", f"{root}/json/customer")
    copies = {
        "table": read_table(spark, f"{root}/customer"),
        "json": read_json_lines(spark, f"{root}/json/customer", customers.schema),
    }
    tagged = [rows.select(F.lit(name).alias("copy"), "*") for name, rows in copies.items()]
    return tagged[0].unionByName(tagged[1])


@query(MART_SQL)
def mart_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second write replaces the table together with its schema."""
    path = scratch_path(spark, "mart")
    inputs = mart_inputs(spark, sf_dir)
    write_table(inputs[0], path)
    write_table(build_mart(*inputs, TRADE_COLUMNS), path)
    return read_table(spark, path)


# -- the zones end to end ---------------------------------------------------------------


def text(value: Column, missing: str) -> Column:
    """A number as raw text, with the portal's mark where it is missing."""
    return F.coalesce(value.cast("string"), F.lit(missing))


def write_raw_files(spark: SparkSession, sf_dir: str, source: str) -> None:
    """The five raw categories, in the portal's formats, from orders and line items.

    Income and density come per year and area. Immigrants and unemployment come per
    customer and year, the second as envelopes in both spellings with error envelopes
    among them. The lookup has two files, of which one is used.
    """
    facts = materialise(customer_year_facts(spark, sf_dir), "facts")
    cell_rows = materialise(cells(facts), "cells")
    nations = load(spark, sf_dir, "nation").join(
        load(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    places = nations.select(
        F.col("n_nationkey").alias("area"),
        F.col("n_regionkey").cast("string").alias("Codi_Districte"),
        F.concat(F.col("r_name"), F.lit("-"), F.col("n_regionkey")).alias("Nom_Districte"),
        F.col("n_nationkey").cast("string").alias("Codi_Barri"),
        F.col("n_name").alias("Nom_Barri"),
    )
    year = F.col("year").cast("string").alias("Any")
    place = ["Codi_Districte", "Nom_Districte", "Codi_Barri", "Nom_Barri"]

    located = cell_rows.join(places, "area")
    income = located.withColumn("index", target_index(cell_rows)).select(
        year,
        *place,
        F.col("population").cast("string").alias("Població"),
        text(F.col("index"), "-").alias("Índex RFD Barcelona = 100"),
    )
    unknown = F.lit("No consta")
    unplaced = cell_rows.groupBy("year").agg(F.sum("population").alias("population")).select(
        year,
        F.lit("99").alias("Codi_Districte"),
        unknown.alias("Nom_Districte"),
        F.lit("99").alias("Codi_Barri"),
        unknown.alias("Nom_Barri"),
        F.col("population").cast("string").alias("Població"),
        F.lit("-").alias("Índex RFD Barcelona = 100"),
    )
    raw_income = income.unionByName(unplaced)

    density = located.select(
        year,
        *place,
        text(F.col("quantity"), "-").alias("Densitat (hab/ha)"),
        text(F.try_divide("quantity", "lines"), "-").alias("Densitat neta (hab/ha)"),
    )

    # A nation may hold a third of the customers: its rows are dealt over several tasks.
    heavy = materialise(heavy_keys(facts, ["area"]), "heavy")
    by_customer = present(left_chain(facts, [places], ["area"], heavy), "Codi_Barri")
    immigrants = by_customer.select(
        year, *place, text(F.col("returned"), "..").alias("Valor")
    )

    late = F.col("year") >= 1998
    record_of = lambda label, count: F.struct(
        year,
        *place,
        F.when(~late, label).alias("Demanda_ocupació"),
        F.when(late, label).alias("Demanda_ocupacio"),
        count.cast("string").alias("Nombre"),
    )
    registered = F.when(late, "Atur Registrat").otherwise("Atur registrat")
    envelope = F.struct(
        F.array(
            record_of(registered, F.col("finished")),
            record_of(F.lit("Demanda no aturats"), F.col("orders") - F.col("finished")),
        ).alias("records")
    )
    no_error = F.lit(None).cast("struct<message:string>")
    good = by_customer.select(no_error.alias("error"), envelope.alias("result"))
    bad = cell_rows.select(F.struct(F.lit("Not found").alias("message")).alias("error"))
    unemployment = good.unionByName(bad, allowMissingColumns=True)

    names = places.select(
        F.col("Nom_Districte").alias("district"),
        F.col("Nom_Barri").alias("neighborhood"),
        *[F.col("Nom_Districte").alias(c) for c in ("district_n_reconciled", "district_n")],
        F.col("Codi_Districte").alias("district_id"),
        *[F.col("Nom_Barri").alias(c) for c in ("neighborhood_n_reconciled", "neighborhood_n")],
        F.col("Codi_Barri").alias("neighborhood_id"),
    )
    lookup = f"{source}/{LOOKUP_TABLES.category}"
    used, unused = LOOKUP_TABLES.only_file.removesuffix(".csv"), "other_extended"

    writes = [
        lambda: publish(spark, names.coalesce(1), lookup, used, ".csv", "csv", numbered=False),
        lambda: publish(spark, names.coalesce(1), lookup, unused, ".csv", "csv", numbered=False),
        lambda: raw_income.write.csv(f"{source}/income", header=True),
        lambda: density.write.json(f"{source}/density"),
        lambda: immigrants.write.json(f"{source}/immigrants"),
        lambda: unemployment.write.json(f"{source}/unemployment"),
    ]
    in_parallel(spark, lambda write: write(), writes)


# The catalog's specs, for files of one JSON document per line.
LINE_SPECS = (
    INCOME,
    replace(DENSITY, multi_line=False),
    replace(IMMIGRANTS, multi_line=False),
    replace(UNEMPLOYMENT, multi_line=False),
    LOOKUP_TABLES,
)


@query("""
with o as (
  select o_orderkey, o_custkey, o_orderstatus, cast(year(o_orderdate) as int) as "year",
         c_nationkey as area, cast(round(o_totalprice * 100) as bigint) as cents
  from orders join customer on o_custkey = c_custkey),
t as (select cast(sum(cents) as bigint) as tc, count(*) as tn from o),
base as (
  select "year", area, count(distinct o_custkey) as population,
         cast(sum(cents) as bigint) as sc, count(*) as n
  from o group by "year", area),
mid as (
  select "year", area, sum(l_quantity) as density, sum(l_quantity) / count(*) as net_density
  from o join lineitem on o_orderkey = l_orderkey group by "year", area),
ret as (
  select "year", area,
         sum(case when l_returnflag = 'R' then l_quantity else 0 end) as total_immigrants
  from o left join lineitem on o_orderkey = l_orderkey group by "year", area),
un as (
  select "year", area, count(*) filter (where o_orderstatus in ('F', 'f')) as total_unemployed
  from o group by "year", area)
select "year", area as neighborhood_code, n_regionkey as district_code,
       concat(r_name, ' ', n_regionkey) as district_name, cast(population as int) as population,
       (sc / n) / (tc / tn) * 100 as "RDF_index", density, net_density, total_immigrants,
       total_unemployed, total_immigrants / nullif(population, 0) as ratio_immigrants,
       total_unemployed / nullif(population, 0) as ratio_unemployed, n_name as neighborhood_name
from base cross join t join mid using ("year", area) join ret using ("year", area)
     join un using ("year", area) join nation on area = n_nationkey
     join region on n_regionkey = r_regionkey
where sc is not null and net_density is not null
""")
def zones_end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stages 1-3: raw files with sentinels, drift and error envelopes to the mart, and the names that
    the lookup has for its areas."""
    root = scratch_path(spark, "zones")
    zones = Zones(f"{root}/raw", f"{root}/landing", f"{root}/formatted", f"{root}/exploitation")
    write_raw_files(spark, sf_dir, zones.source)
    collect_stage(spark, zones, LINE_SPECS)
    format_stage(spark, zones, LINE_SPECS)
    transform_stage(spark, zones)
    lookup = read_table(spark, zones.table(LOOKUP_TABLES.table))
    names = lookup.select(F.col("neighborhood_id").cast("int").alias("neighborhood_code"), "neighborhood_name")
    return read_table(spark, zones.mart).join(names, "neighborhood_code")
