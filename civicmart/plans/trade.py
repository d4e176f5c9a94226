"""Facts of the star schema in the mart's terms: a year, and a nation as the area.

An order's year and its customer's nation make the cell. Line items are summed per order
and orders per customer and year *before* any join, in that order. Each sum is map-side
first, so an order holding a third of the line items, or a customer holding a third of
the orders, is one row per task when it is shuffled, and the joins see one row per key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialise
from .registry import load

FINISHED = ("F", "f")


def order_year() -> Column:
    return F.year("o_orderdate")


def cents(price: str) -> Column:
    """Whole cents: integer sums do not depend on the order of addition."""
    return F.round(F.col(price) * 100).cast("bigint")


def order_lines(lineitem: DataFrame) -> DataFrame:
    """Per order: number of lines, quantity, returned quantity (null if none returned)."""
    returned = F.when(F.col("l_returnflag") == "R", F.col("l_quantity"))
    return (
        lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(
            F.count(F.lit(1)).alias("lines"),
            F.sum("l_quantity").alias("quantity"),
            F.sum(returned).alias("returned"),
        )
    )


def customer_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per customer and year: orders, cents, finished orders, lines and quantities.

    One scan of orders and one of line items serve every role of the mart.
    """
    return customer_year_sums(load(spark, sf_dir, "orders"), load(spark, sf_dir, "lineitem"))


def customer_year_sums(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """``customer_years`` of these orders and line items; all its columns are sums."""
    orders = orders.select(
        "o_orderkey",
        "o_custkey",
        order_year().alias("year"),
        cents("o_totalprice").alias("cents"),
        F.col("o_orderstatus").isin(*FINISHED).alias("is_finished"),
    )
    return (
        orders.join(order_lines(lineitem), "o_orderkey", "left")
        .groupBy("o_custkey", "year")
        .agg(
            F.count(F.lit(1)).alias("orders"),
            F.sum("cents").alias("cents"),
            F.count_if("is_finished").alias("finished"),
            F.sum("lines").alias("lines"),
            F.sum("quantity").alias("quantity"),
            F.sum("returned").alias("returned"),
        )
    )


def customer_year_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``customer_years`` with the customer's area."""
    return with_area(customer_years(spark, sf_dir), spark, sf_dir)


def with_area(facts: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = load(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("area")
    )
    return facts.join(customers, "o_custkey")


def cells(facts: DataFrame) -> DataFrame:
    """Per year and area. A customer-year is one row of ``facts``, so counting rows counts
    distinct customers without a distinct aggregate."""
    return facts.groupBy("year", "area").agg(
        F.count(F.lit(1)).alias("population"),
        F.sum("orders").alias("orders"),
        F.sum("cents").alias("cents"),
        F.sum("finished").alias("finished"),
        F.sum("lines").alias("lines"),
        F.sum("quantity").alias("quantity"),
        F.sum("returned").alias("returned"),
    )


def target_index(cell_rows: DataFrame) -> Column:
    """Mean order value of the cell, with the mean over all cells at 100."""
    total = cell_rows.agg(
        F.try_divide(F.sum("cents"), F.sum("orders")).alias("mean_cents")
    ).scalar()
    return F.try_divide(F.col("cents") / F.col("orders"), total) * 100


def mart_inputs(
    spark: SparkSession, sf_dir: str
) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Income, density, immigrants and unemployment roles, from one pass over the facts.

    The facts are written once and the roles read that table; otherwise each role and the overall
    mean would repeat the scans behind it. Income and density have a row per cell (year and area),
    the other two one per customer and year, for the mart to sum up.
    """
    return roles(customer_year_facts(spark, sf_dir))


def roles(facts: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """``mart_inputs`` of customer-year facts."""
    facts = materialise(facts, "facts")
    cell_rows = materialise(cells(facts), "cells")
    income = cell_rows.select(
        "year", "area", "population", target_index(cell_rows).alias("target_index")
    )
    density = cell_rows.filter("lines > 0").select("year", "area", F.col("quantity").alias("density"))
    immigrants = facts.filter("lines > 0").select("year", "area", F.col("returned").alias("value"))
    unemployment = facts.filter("finished > 0").select(
        "year", "area", F.lit(FINISHED[0]).alias("status"), F.col("finished").alias("count")
    )
    return income, density, immigrants, unemployment
