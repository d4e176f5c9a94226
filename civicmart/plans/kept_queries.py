"""Queries over tables that are kept: totals per key, published versions, rejected rows, unique sides."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.cleaning import FAILED, RAW_TEXT, ColumnRule, apply_rules_with_failures
from ..functions.names import reconcile
from ..operators import features as ops
from ..operators.incremental import add_batch, read_totals
from ..operators.sinks import read_rejected, write_bucketed, write_split, write_table
from ..session import scratch_path
from ..sources.readers import read_table
from .mart import build_mart
from .registry import load, query
from .table_queries import MART_SQL, TRADE_COLUMNS
from .trade import customer_year_sums, order_lines, order_year, roles, with_area

CUSTOMER_YEAR = ("o_custkey", "year")
SUMS = ("orders", "cents", "finished", "lines", "quantity", "returned")


def trade_batch(order_key: str, year: Column) -> Column:
    """Batches of years; one order in ten comes late, with the last."""
    late = F.pmod(F.col(order_key), F.lit(10)) == 0
    return F.when(late | year.isNull(), 2).otherwise(F.pmod(year, F.lit(3)))


def write_batches(spark: SparkSession, sf_dir: str, root: str) -> None:
    """Orders and their line items as batches 0 to 2, each in folders of its own."""
    orders = load(spark, sf_dir, "orders").withColumn("batch", trade_batch("o_orderkey", order_year()))
    batch_of = orders.select(F.col("o_orderkey").alias("l_orderkey"), "batch").dropDuplicates(["l_orderkey"])
    lines = load(spark, sf_dir, "lineitem").join(batch_of, "l_orderkey")
    orders.write.partitionBy("batch").parquet(f"{root}/orders")
    lines.write.partitionBy("batch").parquet(f"{root}/lineitem")


def batch_sums(spark: SparkSession, root: str, batch: int) -> DataFrame:
    """Sums of one batch; the folders of the others are pruned."""
    tables = (spark.read.parquet(f"{root}/{name}") for name in ("orders", "lineitem"))
    return customer_year_sums(*[table.filter(F.col("batch") == batch) for table in tables])


@query(MART_SQL)
def mart_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer-year totals kept from batch to batch, each batch read once and
    only the years it touches written anew; the mart of the third version is that of a rebuild. One
    batch is added twice, as by a run that did not know it had succeeded."""
    root = scratch_path(spark, "incremental")
    write_batches(spark, sf_dir, root)
    for batch in (0, 1, 1, 2):
        add_batch(batch_sums(spark, root, batch), f"{root}/totals", f"b{batch}", CUSTOMER_YEAR, SUMS, F.col("year"))
    facts = with_area(read_totals(spark, f"{root}/totals"), spark, sf_dir)
    return build_mart(*roles(facts), TRADE_COLUMNS)


@query("""
select 1 as version, c_custkey, c_name, c_acctbal, c_mktsegment from customer where c_acctbal > 0
union all
select 2, c_custkey, c_name, c_acctbal, null from customer
""")
def table_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two versions of a table, of different rows and columns, each read back."""
    customers = load(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    path = scratch_path(spark, "versions")
    write_table(customers.filter("c_acctbal > 0"), path)
    write_table(customers.drop("c_mktsegment"), path)
    first, second = read_table(spark, path, version=1), read_table(spark, path)
    versions = first.select(F.lit(1).alias("version"), "*").unionByName(
        second.select(F.lit(2).alias("version"), "*"), allowMissingColumns=True
    )
    return versions


@query("""
with raw as (
  select o_orderkey, case when o_orderstatus = 'O' then '..' else o_totalprice::varchar end as price,
    case when o_orderpriority = '4-NOT SPECIFIED' then '-' else o_custkey::varchar end as customer
  from orders),
marked as (
  select *, concat_ws(',', case when try_cast(customer as int) is null and customer is not null then 'customer' end,
    case when try_cast(price as double) is null and price is not null then 'price' end) as failed
  from raw)
select o_orderkey, try_cast(customer as int) as customer, try_cast(price as double) as price, failed,
  case when failed <> '' then customer end as raw_customer, case when failed like '%price%' then price end as raw_price
from marked
""")
def rejected_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with an unreadable number are kept apart with the rules they failed and the
    text that could not be read; both sides come from one write."""
    raw = load(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "O", "..").otherwise(F.col("o_totalprice").cast("string")).alias("Preu (€)"),
        F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "-").otherwise(F.col("o_custkey").cast("string")).alias("Client"),
    )
    rules = [
        ColumnRule(("o_orderkey",), "o_orderkey"),
        ColumnRule(("Client",), "customer", "int"),
        ColumnRule(("Preu (€)",), "price", "double"),
    ]
    path = scratch_path(spark, "rejected")
    write_split(apply_rules_with_failures(raw, rules), path)
    numbers = ("customer", "price")
    kept = read_table(spark, path).select(
        "o_orderkey", *numbers, F.lit("").alias("failed"), *[F.lit(None).cast("string").alias(f"raw_{n}") for n in numbers]
    )
    texts = [F.col("raw_customer"), F.when(F.array_contains(FAILED, "price"), F.col("raw_price")).alias("raw_price")]
    rejected = read_rejected(spark, path).select(
        "o_orderkey", *numbers, FAILED, *[F.col(RAW_TEXT)[n].alias(f"raw_{n}") for n in numbers]
    )
    rejected = rejected.select("o_orderkey", *numbers, F.array_join(FAILED, ",").alias("failed"), *texts)
    return kept.unionByName(rejected)


@query("""
with sides as (
  select l_orderkey, l_linenumber, count(*) as n, min(l_quantity) as quantity
  from lineitem group by l_orderkey, l_linenumber)
select o_orderkey, l_linenumber, quantity, case when n > 1 then n end as repeated
from orders join sides on l_orderkey = o_orderkey
""")
def unique_side_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A side whose keys repeat joins once per key, and the keys that repeat are listed with how
    often they came, from the same pass."""
    lines = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_quantity").alias("quantity"))
    keys = ["l_orderkey", "l_linenumber"]
    side, repeated = ops.unique_side(lines, keys, "first")
    orders = load(spark, sf_dir, "orders").select("o_orderkey")
    joined = orders.join(side, F.col("o_orderkey") == F.col("l_orderkey"))
    return joined.join(repeated, keys, "left").select("o_orderkey", "l_linenumber", "quantity", F.col("n").alias("repeated"))


def bucketed_sides(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Orders, and their line items summed up in two roles, each stored in buckets of its key."""
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", order_year().alias("year"))
    lines = order_lines(load(spark, sf_dir, "lineitem"))
    roles = [orders, lines.select("o_orderkey", "lines", "quantity"), lines.filter("returned > 0").select("o_orderkey", "returned")]
    return [write_bucketed(rows, scratch_path(spark, "bucketed"), ["o_orderkey"], BUCKETS) for rows in roles]


BUCKETS = 8


@query("""
with sides as (
  select l_orderkey, count(*) as lines, sum(l_quantity) as quantity,
    sum(case when l_returnflag = 'R' then l_quantity end) as returned
  from lineitem group by l_orderkey)
select o_orderkey, o_custkey, cast(year(o_orderdate) as int) as "year", lines, quantity,
  case when returned > 0 then returned end as returned
from orders left join sides on l_orderkey = o_orderkey
""")
def bucketed_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A chain of left joins over tables stored in buckets of the join's key, so that no
    row moves between scan and join."""
    base, *sides = bucketed_sides(spark, sf_dir)
    return ops.left_chain(base, [side.hint("merge") for side in sides], ["o_orderkey"])


VARIANT = """case when c_custkey % 7 = 0 then concat(lower(n_name), ' (nou)')
  when c_custkey % 3 = 0 then translate(lower(n_name), 'aeiou', 'àéíòü')
  when c_custkey % 3 = 1 then replace(n_name, ' ', '-') else concat('  ', n_name, '.') end"""


@query(f"""
select {VARIANT} as name, case when c_custkey % 7 <> 0 then n_nationkey end as code, count(*) as n
from customer join nation on c_nationkey = n_nationkey group by all
""")
def reconcile_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers whose nation is spelled in several ways get its code by name; names that the
    lookup does not have come with how often they are used."""
    nations = load(spark, sf_dir, "nation")
    customers = load(spark, sf_dir, "customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    rows = customers.select("c_custkey", F.expr(VARIANT).alias("name"))
    coded, missing = reconcile(rows, "name", nations.withColumnRenamed("n_nationkey", "code"), "n_name", "code")
    known = coded.filter("code is not null").groupBy("name", "code").agg(F.count(F.lit(1)).alias("n"))
    return known.unionByName(missing.select("name", F.lit(None).cast("bigint").alias("code"), "n"))
