"""The star-schema tables seen as the four feeds.

Joins that attach a ward or site to a row come first and the counts after them, combined before
their shuffle: a row is moved once, and adaptive execution may split a customer or order that has
a large share of the rows. No side is forced to broadcast.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.settings import constant_rule, quantile_rule

UNIT_TYPE = "R"  # the return flag that plays the counted unit type
WARDS = [f"N{i}" for i in range(25)]

EVENT_RULES = (
    quantile_rule("click", 0.25, lambda v: v < 20.0),
    quantile_rule("error", 0.25, lambda v: v < 30.0),
    constant_rule("purchase", 50.0, lambda v: v < 10.0),
    quantile_rule("signup", 0.25, lambda v: v > 90.0, count_side="above"),
    constant_rule("view", 40.0, lambda v: v < 15.0),
)
LINE_RULES = (
    quantile_rule("AF", 0.25, lambda v: v < 9.0),
    constant_rule("AO", 12.0, lambda v: v < 12.0),
    quantile_rule("NF", 0.25, lambda v: v < 9.0),
    quantile_rule("NO", 0.25, lambda v: v > 40.0, count_side="above"),
    constant_rule("RF", 25.0, lambda v: v < 25.0),
    quantile_rule("RO", 0.25, lambda v: v < 9.0),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def labs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as lab results, with below-detection markers and bad texts."""
    e = table(spark, sf_dir, "events")
    text = (
        F.when(F.col("event_id") % 50 == 0, "<0.1")
        .when(F.col("event_id") % 97 == 0, "ERR")
        .otherwise(F.col("value").cast("string"))
    )
    return e.select(
        F.col("ts").alias("result_time"), F.col("event_type").alias("base_name"),
        text.alias("ord_value"),
    )


def lab_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as cleaned lab values."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_shipdate").cast("date").alias("date"),
        F.concat("l_returnflag", "l_linestatus").alias("base_name"),
        F.col("l_quantity").alias("lab_value"),
    )


def census(
    spark: SparkSession, sf_dir: str, pick: Callable[[DataFrame], DataFrame] = lambda orders: orders
) -> DataFrame:
    """Orders as patients, the customer's nation as ward; ``pick`` narrows the orders scanned."""
    orders = pick(table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate"))
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return orders.join(customer, orders.o_custkey == customer.c_custkey).select(
        F.col("o_orderdate").cast("date").alias("location_time"),
        F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias("ward"),
    )


def transfusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as issued units."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("type"), F.col("l_shipdate").alias("issue_time"), "l_orderkey"
    )


def site_transfusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Issued units with the customer's nation as ``site``."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    sites = orders.join(customer, orders.o_custkey == customer.c_custkey)
    lines = transfusion(spark, sf_dir)
    return lines.join(sites, lines.l_orderkey == sites.o_orderkey).select(
        F.col("c_nationkey").alias("site"), "type", "issue_time"
    )


def _regional(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with the customer's nation as ward and its region as ``site``."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    return (
        orders.join(customer, orders.o_custkey == customer.c_custkey)
        .join(nation, customer.c_nationkey == nation.n_nationkey)
        .select(
            "o_orderkey", "o_orderdate", F.col("n_regionkey").alias("site"),
            F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias("ward"),
        )
    )


def regional_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines of each site, as issued units and as cleaned lab values at once."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", F.col("l_returnflag").alias("type"), F.col("l_shipdate").alias("issue_time"),
        F.col("l_shipdate").cast("date").alias("date"),
        F.concat("l_returnflag", "l_linestatus").alias("base_name"),
        F.col("l_quantity").alias("lab_value"),
    )
    sites = _regional(spark, sf_dir).select("o_orderkey", "site")
    return lines.join(sites, lines.l_orderkey == sites.o_orderkey).drop("l_orderkey", "o_orderkey")


def regional_census(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of each site as patients."""
    return _regional(spark, sf_dir).select(
        "site", F.col("o_orderdate").cast("date").alias("location_time"), "ward"
    )


def inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as shelf stock: shelf life from -1 to 3.5 days."""
    days = (F.col("l_quantity") % 5) - 1 + F.when(F.col("l_partkey") % 2 == 1, 0.5).otherwise(0.0)
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_shipdate").cast("date").alias("date"),
        F.col("l_returnflag").alias("type"),
        days.alias("days_to_expire"),
    )
