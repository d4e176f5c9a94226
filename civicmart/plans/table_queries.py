"""Queries that need no files: marts, joins, totals, cleaning, splits and metrics."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.cleaning import (
    ColumnRule,
    apply_rules,
    apply_rules_beside_raw,
    rejected_counts,
    hyphens_to_spaces,
    safe_ratio,
    text_to_null,
    to_double,
    to_int,
)
from ..functions.keys import PRIME, hash_coefficients
from ..operators import features as ops
from ..operators.ingest import new_files
from ..operators.regression import (
    FEATURES,
    feature_stages,
    hash_split as split_by_hash,
    in_first_part,
    kept_rows,
    model_chain,
    regression_metrics,
)
from ..session import materialise
from ..sources.readers import union_by_name
from .mart import MartColumns, build_mart
from .registry import load, query
from .trade import FINISHED, cents, mart_inputs, order_lines, order_year

TRADE_COLUMNS = MartColumns(
    keys=("year", "area"),
    carried=(),
    target="target_index",
    densities=("density",),
    required_density="density",
    demand="status",
    accepted_demands=FINISHED,
    total_immigrants="total_a",
    total_unemployed="total_b",
    ratio_immigrants="ratio_a",
    ratio_unemployed="ratio_b",
)

MART_SQL = """
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
  select "year", area, sum(l_quantity) as density,
         sum(coalesce(case when l_returnflag = 'R' then l_quantity end, 0)) as total_a
  from o join lineitem on o_orderkey = l_orderkey group by "year", area),
un as (
  select "year", area, count(*) as total_b from o
  where o_orderstatus in ('F', 'f') group by "year", area)
select "year", area, population, (sc / n) / (tc / tn) * 100 as target_index, density,
       total_a, total_b, total_a / nullif(population, 0) as ratio_a,
       total_b / nullif(population, 0) as ratio_b
from base cross join t left join mid using ("year", area) left join un using ("year", area)
where sc is not null and density is not null and total_a is not null and total_b is not null
"""


@query(MART_SQL)
def feature_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four role tables to one feature table."""
    return build_mart(*mart_inputs(spark, sf_dir), TRADE_COLUMNS)


@query("""
with o as (
  select o_orderkey, o_custkey as custkey, cast(year(o_orderdate) as int) as "year",
         o_orderstatus
  from orders),
base as (select custkey, "year", count(*) as n_orders from o group by custkey, "year"),
ln as (
  select custkey, "year", sum(l_quantity) as quantity
  from o join lineitem on o_orderkey = l_orderkey group by custkey, "year"),
fin as (
  select custkey, "year", count(*) as n_finished from o
  where o_orderstatus = 'F' group by custkey, "year"),
op as (
  select custkey, "year", count(*) as n_open from o
  where o_orderstatus = 'O' group by custkey, "year")
select custkey, "year", n_orders, quantity, n_finished, n_open
from base join ln using (custkey, "year") join fin using (custkey, "year")
     join op using (custkey, "year")
where quantity is not null
""")
def left_chain_then_notnull(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1-J3, F2 at customer and year: orders by state, and the quantities of their line items."""
    keys = ["custkey", "year"]
    orders = load(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_custkey").alias("custkey"), order_year().alias("year"), "o_orderstatus"
    )
    status = F.col("o_orderstatus")
    cells = materialise(
        orders.groupBy(*keys).agg(
            F.count(F.lit(1)).alias("n_orders"),
            F.count(F.when(status == "F", 1)).alias("n_finished"),
            F.count(F.when(status == "O", 1)).alias("n_open"),
        ),
        "customer-years",
    )
    lines = orders.drop("o_orderstatus").join(order_lines(load(spark, sf_dir, "lineitem")), "o_orderkey")
    quantities = lines.groupBy(*keys).agg(F.sum("quantity").alias("quantity"))

    def side(column: str, present: str) -> DataFrame:
        return cells.filter(present).select(*keys, column)

    sides = [
        quantities,
        side("n_finished", "n_finished > 0"),
        side("n_open", "n_open > 0"),
    ]
    joined = ops.left_chain(cells.select(*keys, "n_orders"), sides, keys)
    return ops.present(joined, "quantity", "n_finished", "n_open")


@query("""
select o_orderkey, n_lines, quantity
from orders left join (
  select l_orderkey, count(*) as n_lines, sum(l_quantity) as quantity
  from lineitem group by l_orderkey) on o_orderkey = l_orderkey
""")
def left_join_keep_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1 without the filter behind it: orders without lines stay, with nulls."""
    lines = order_lines(load(spark, sf_dir, "lineitem")).select(
        "o_orderkey", F.col("lines").alias("n_lines"), "quantity"
    )
    return ops.left_chain(load(spark, sf_dir, "orders").select("o_orderkey"), [lines], ["o_orderkey"])


@query("""
select cast(year(l_shipdate) as int) as ship_year, l_returnflag,
       sum(coalesce(case when l_returnflag <> 'R' then l_quantity end, 0)) as total
from lineitem group by 1, 2
""")
def grouped_sum_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The value is null throughout the groups flagged 'R', which total 0."""
    rows = load(spark, sf_dir, "lineitem").select(
        F.year("l_shipdate").alias("ship_year"),
        "l_returnflag",
        F.when(F.col("l_returnflag") != "R", F.col("l_quantity")).alias("value"),
    )
    return ops.grouped_total(rows, ["ship_year", "l_returnflag"], "value", "total")


@query("""
select cast(year(o_orderdate) as int) as "year", o_orderpriority,
       cast(sum(coalesce(cast(round(o_totalprice * 100) as bigint), 0)) as bigint) as total
from orders where o_orderstatus in ('F', 'f') group by 1, 2
""")
def filtered_grouped_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two accepted spellings, then an integer sum over two keys."""
    rows = load(spark, sf_dir, "orders").select(
        order_year().alias("year"),
        "o_orderpriority",
        "o_orderstatus",
        cents("o_totalprice").alias("cents"),
    )
    return ops.labelled_total(
        rows, ["year", "o_orderpriority"], "cents", "total", "o_orderstatus", FINISHED
    )


@query("select count(*) as row_count from lineitem")
def row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3."""
    return ops.row_count(load(spark, sf_dir, "lineitem"))


@query("""
select max(l_extendedprice) as max_value, min(l_extendedprice) as min_value from lineitem
""")
def min_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4."""
    return ops.value_range(load(spark, sf_dir, "lineitem"), "l_extendedprice")


@query("""
select o_orderkey, o_custkey, o_totalprice from orders
order by o_orderkey, o_custkey, o_totalprice limit 1
""")
def first_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L1, made deterministic by an order."""
    rows = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return ops.first_row(rows, *rows.columns)


@query("""
select try_cast(replace(p_brand, 'Brand#', '') as int) as brand_code, p_name as part_name,
       p_size as size, p_retailprice as price
from part
""")
def rename_project_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text columns under awkward raw names to typed, renamed ones."""
    raw = load(spark, sf_dir, "part").select(
        F.replace("p_brand", F.lit("Brand#"), F.lit("")).alias("Índex marca = 100"),
        F.col("p_name").alias("Nom (peça)"),
        F.col("p_size").cast("string").alias("Mida (cm/ha)"),
        F.col("p_retailprice").cast("string").alias("Preu. net"),
    )
    rules = [
        ColumnRule(("Índex marca = 100",), "brand_code", "int"),
        ColumnRule(("Nom (peça)",), "part_name"),
        ColumnRule(("Mida (cm/ha)",), "size", "int"),
        ColumnRule(("Preu. net",), "price", "double"),
    ]
    return apply_rules(raw, rules)


@query("""
select o_orderkey, try_cast(o_orderpriority as int) as priority_code,
       case when o_orderstatus <> 'P' then cast(o_custkey as int) end as customer_code,
       case when o_orderstatus <> 'O' then o_totalprice end as price
from orders
""")
def malformed_to_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C4, C6: "-", ".." and other text in numeric columns becomes null, not an error."""
    status = F.col("o_orderstatus")
    code = F.when(status != "P", F.col("o_custkey").cast("string")).otherwise("-")
    price = F.when(status != "O", F.col("o_totalprice").cast("string")).otherwise("..")
    return load(spark, sf_dir, "orders").select(
        "o_orderkey",
        to_int(F.col("o_orderpriority")).alias("priority_code"),
        to_int(code).alias("customer_code"),
        to_double(price).alias("price"),
    )


@query("""
select count(*) as "rows",
       count(*) filter (where o_orderpriority is not null and try_cast(o_orderpriority as int) is null)
         as rejected_priority,
       count(*) filter (where o_orderstatus = 'O') as rejected_price
from orders
""")
def rejected_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many values the casts turned into null, per column."""
    price = F.when(F.col("o_orderstatus") == "O", "..").otherwise(F.col("o_totalprice").cast("string"))
    raw = load(spark, sf_dir, "orders")
    rules = [
        ColumnRule(("o_orderpriority",), "priority", "int"),
        ColumnRule(("price",), "price", "double"),
    ]
    both = apply_rules_beside_raw(raw.withColumn("price", price), rules)
    return both.agg(*rejected_counts(rules))


@query("""
select o_orderkey, regexp_replace(o_orderpriority, '-', ' ', 'g') as priority from orders
""")
def hyphen_to_space(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C1."""
    return load(spark, sf_dir, "orders").select(
        "o_orderkey", hyphens_to_spaces(F.col("o_orderpriority")).alias("priority")
    )


@query("""
select o_orderkey, nullif(replace(o_orderpriority, '-', ' '), '4 NOT SPECIFIED') as priority
from orders
""")
def sentinel_to_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C2, C3, C5, and their order: hyphens are replaced before the sentinel is compared."""
    rule = ColumnRule(("o_orderpriority",), "priority", hyphens=True, sentinel="4 NOT SPECIFIED")
    return load(spark, sf_dir, "orders").select("o_orderkey", rule.column())


@query("""
select c_custkey, c_acctbal as balance, c_mktsegment as segment from customer
where c_acctbal >= 0 and c_mktsegment <> 'HOUSEHOLD'
""")
def drop_null_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with a null in either listed column go."""
    rows = load(spark, sf_dir, "customer").select(
        "c_custkey",
        F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("balance"),
        text_to_null(F.col("c_mktsegment"), "HOUSEHOLD").alias("segment"),
    )
    return ops.drop_incomplete(rows, ["balance", "segment"])


@query("""
select c_custkey, n_orders, n_urgent, n_orders / nullif(n_urgent, 0) as ratio
from customer left join (
  select o_custkey, count(*) as n_orders,
         count(*) filter (where o_orderpriority = '1-URGENT') as n_urgent
  from orders group by o_custkey) on c_custkey = o_custkey
""", name="safe_ratio")
def safe_ratio_by_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Null for customers without orders and for those without urgent ones."""
    counts = (
        load(spark, sf_dir, "orders")
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(
            F.count(F.lit(1)).alias("n_orders"),
            F.count_if(F.col("o_orderpriority") == "1-URGENT").alias("n_urgent"),
        )
    )
    joined = ops.left_chain(
        load(spark, sf_dir, "customer").select("c_custkey"), [counts], ["c_custkey"]
    )
    return joined.withColumn("ratio", safe_ratio(F.col("n_orders"), F.col("n_urgent")))


@query("""
select event_id, event_type as action, value, user_id from events
where event_type in ('view', 'click')
union all by name
select value, event_id, event_type as action from events
where event_type not in ('view', 'click')
""")
def union_drifted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two layouts in different column order, one lacking a column, united by name."""
    events = load(spark, sf_dir, "events").withColumnRenamed("event_type", "action")
    early = F.col("action").isin("view", "click")
    return union_by_name(
        [
            events.filter(early).select("event_id", "action", "value", "user_id"),
            events.filter(~early).select("value", "event_id", "action"),
        ]
    )


@query("""
select o_orderkey from orders
where not exists (select 1 from lineitem where l_orderkey = o_orderkey)
""")
def ledger_new_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the listing holds and the ledger does not."""
    listing = load(spark, sf_dir, "orders").select("o_orderkey")
    ledger = load(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return new_files(listing, ledger, ["o_orderkey"])


# -- splits, scaling, models' closed forms ----------------------------------------------

MODEL_INPUTS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
LABEL = "revenue"
LINE_KEYS = ["l_orderkey", "l_linenumber", "l_partkey"]


def revenue() -> Column:
    return F.col("l_extendedprice") * (1 - F.col("l_discount"))


def labelled_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with a label the inputs determine, as the raw price is unrelated."""
    return load(spark, sf_dir, "lineitem").select(
        *LINE_KEYS, *MODEL_INPUTS, revenue().alias(LABEL)
    )


def _bucket_sql(salt: str) -> str:
    multipliers, offset = hash_coefficients(len(LINE_KEYS), salt)
    terms = [f"cast({k} as bigint) % {PRIME} * {m} % {PRIME}" for k, m in zip(LINE_KEYS, multipliers)]
    return f"(({' + '.join(terms)} + {offset}) % {PRIME} % 10)"


@query(f"""
select l_orderkey, l_linenumber, l_partkey,
       case when {_bucket_sql('holdout')} >= 8 then 'test'
            when {_bucket_sql('validation')} < 7 then 'train' else 'validation' end as part
from lineitem
""")
def hash_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M3, M4: 80/20 hold-out, then 70/30 inside the training part, by key values."""
    lines = load(spark, sf_dir, "lineitem")
    learning = in_first_part(lines, LINE_KEYS, 8, "holdout")
    fitting = in_first_part(lines, LINE_KEYS, 7, "validation")
    part = F.when(~learning, "test").when(fitting, "train").otherwise("validation")
    return lines.select(*LINE_KEYS, part.alias("part"))


@query("""
select l_orderkey, l_linenumber, l_partkey,
       round(l_quantity / sq, 6) as scaled_quantity,
       round(l_extendedprice / sp, 6) as scaled_extendedprice,
       round(l_discount / sd, 6) as scaled_discount,
       round(l_tax / st, 6) as scaled_tax
from lineitem, (
  select stddev_samp(l_quantity) as sq, stddev_samp(l_extendedprice) as sp,
         stddev_samp(l_discount) as sd, stddev_samp(l_tax) as st
  from lineitem)
""")
def scale_std(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1, M2: one vector per row, each part divided by its sample standard deviation."""
    lines = labelled_lines(spark, sf_dir)
    scaled = Pipeline(stages=feature_stages(MODEL_INPUTS)).fit(lines).transform(lines)
    values = vector_to_array(FEATURES)
    return scaled.select(
        *LINE_KEYS,
        *[
            F.round(values[i], 6).alias(name.replace("l_", "scaled_", 1))
            for i, name in enumerate(MODEL_INPUTS)
        ],
    )


def _least_squares(spark: SparkSession, sf_dir: str, inputs: list[str], digits: int) -> DataFrame:
    """Coefficients, intercept and R² of an unpenalised fit, as one row."""
    lines = labelled_lines(spark, sf_dir)
    assembler = VectorAssembler(inputCols=inputs, outputCol=FEATURES)
    regression = LinearRegression(featuresCol=FEATURES, labelCol=LABEL, regParam=0.0, solver="normal")
    model = Pipeline(stages=[assembler, regression]).fit(lines).stages[-1]
    values = [*model.coefficients.toArray(), model.intercept, model.summary.r2]
    names = [f"slope_{name[2:]}" for name in inputs] + ["intercept", "r2"]
    row = [round(float(value), digits) for value in values]
    return spark.createDataFrame([row], ", ".join(f"{name} double" for name in names))


@query("""
select round(regr_slope(y, x), 4) as slope_extendedprice,
       round(regr_intercept(y, x), 4) as intercept, round(regr_r2(y, x), 4) as r2
from (select l_extendedprice * (1 - l_discount) as y, l_extendedprice as x from lineitem)
""")
def ols_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M5, M8: the least-squares line against the closed form."""
    return _least_squares(spark, sf_dir, ["l_extendedprice"], 4)


@query("""
with m as (
  select var_pop(a) as saa, var_pop(b) as sbb, covar_pop(a, b) as sab, covar_pop(y, a) as say,
         covar_pop(y, b) as sby, var_pop(y) as syy, avg(a) as ma, avg(b) as mb, avg(y) as my
  from (select l_extendedprice as a, l_discount as b,
               l_extendedprice * (1 - l_discount) as y from lineitem)),
s as (
  select *, (sbb * say - sab * sby) / (saa * sbb - sab * sab) as wa,
         (saa * sby - sab * say) / (saa * sbb - sab * sab) as wb from m)
select round(wa, 4) as slope_extendedprice, round(wb, 4) as slope_discount,
       round(my - wa * ma - wb * mb, 4) as intercept,
       round((wa * say + wb * sby) / syy, 4) as r2
from s
""")
def ols_two_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M5 with two inputs against the normal equations."""
    return _least_squares(spark, sf_dir, ["l_extendedprice", "l_discount"], 4)


@query("""
select count(*) as "rows", round(sqrt(sum((y - p) * (y - p)) / count(*)), 6) as rmse,
       round(1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)), 6) as r2,
       round(sqrt(sum((y - p) * (y - p)) / count(*)) / (max(y) - min(y)), 6) as nrmse
from (select l_extendedprice * (1 - l_discount) as y, l_extendedprice * 0.95 as p
      from lineitem)
""")
def eval_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All three measures of an analytic prediction in one pass."""
    scored = load(spark, sf_dir, "lineitem").select(
        revenue().alias(LABEL), (F.col("l_extendedprice") * 0.95).alias("prediction")
    )
    return rounded_measures(scored, 6)


@query(f"""
with d as (
  select l_extendedprice as a, l_discount as b, l_extendedprice * (1 - l_discount) as y,
         {_bucket_sql('holdout')} < 8 as fitting
  from lineitem),
m as (
  select var_pop(a) as saa, var_pop(b) as sbb, covar_pop(a, b) as sab, covar_pop(y, a) as say,
         covar_pop(y, b) as sby, avg(a) as ma, avg(b) as mb, avg(y) as my
  from d where fitting),
w as (
  select *, (sbb * say - sab * sby) / (saa * sbb - sab * sab) as wa,
         (saa * sby - sab * say) / (saa * sbb - sab * sab) as wb from m),
s as (
  select y, my + wa * (a - ma) + wb * (b - mb) as p from d, w where not fitting)
select count(*) as "rows", round(sqrt(sum((y - p) * (y - p)) / count(*)), 4) as rmse,
       round(1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)), 6) as r2,
       round(sqrt(sum((y - p) * (y - p)) / count(*)) / (max(y) - min(y)), 6) as nrmse
from s
""")
def holdout_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A scaled linear chain fitted on 80 %, measured on the rest."""
    inputs = ["l_extendedprice", "l_discount"]
    params = {"model_type": "lr", "lr_regParam": 0.0, "lr_elasticNetParam": 0.0}
    train, test = split_by_hash(labelled_lines(spark, sf_dir), LINE_KEYS, 8, "holdout")
    with kept_rows(train.select(LABEL, *inputs)) as rows:  # a linear fit asks for no layout
        model = model_chain(params, inputs, LABEL).fit(rows)
    return rounded_measures(model.transform(test), 4)


def rounded_measures(scored: DataFrame, rmse_digits: int) -> DataFrame:
    return regression_metrics(scored, LABEL).select(
        "rows",
        F.round("rmse", rmse_digits).alias("rmse"),
        F.round("r2", 6).alias("r2"),
        F.round("nrmse", 6).alias("nrmse"),
    )
