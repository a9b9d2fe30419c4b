"""The star-schema test tables, and the event views derived from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def customer_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``o_custkey``'s region name: ``user_id``, ``region``."""
    nations = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    return (
        table(spark, sf_dir, "customer")
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(F.col("c_custkey").alias("user_id"), F.col("r_name").alias("region"))
    )


def order_lines(
    spark: SparkSession, sf_dir: str, with_order: bool = False, with_product: bool = False
) -> DataFrame:
    """Order events out of the order lines.

    The joins are asked for by need: an inner join that a query does not use
    cannot be pruned by the planner, and at scale each one is a shuffle.
    """
    lines = table(spark, sf_dir, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("event_id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("supplier_id"),
        F.col("l_linenumber").alias("line"),
        F.col("l_quantity").cast("int").alias("quantity"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price"),
        F.col("l_extendedprice").alias("total_amount"),
        F.col("l_discount").alias("discount_pct"),
        F.col("l_returnflag").alias("return_flag"),
        F.col("l_shipdate").alias("event_time"),
    )
    if with_product:
        parts = table(spark, sf_dir, "part").select(
            F.col("p_partkey").alias("product_id"), F.col("p_brand").alias("category")
        )
        lines = lines.join(parts, "product_id")
    if with_order:
        orders = (
            table(spark, sf_dir, "orders")
            .select(
                F.col("o_orderkey").alias("order_id"),
                F.col("o_custkey").alias("user_id"),
                F.col("o_orderstatus").alias("status"),
            )
            .join(customer_regions(spark, sf_dir), "user_id")
        )
        lines = lines.join(orders, "order_id")
    return lines


#: Line changes by ship month: the month is the version a change came with.
LINE_KEY = ("order_id", "line")
LINE_ORDER = ("event_time", "product_id", "supplier_id")


def month_number(ts: str) -> Column:
    """Months since January 1995, the first month of the tables."""
    return ((F.year(ts) - 1995) * 12 + F.month(ts) - 1).cast("long")


def line_changes(spark: SparkSession, sf_dir: str, **joins: bool) -> DataFrame:
    """Order lines as changes of a keyed table; an order line comes several times."""
    lines = order_lines(spark, sf_dir, **joins)
    return lines.withColumn("batch_id", month_number("event_time")).withColumn("_op", F.lit("U"))


def late_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table with lateness: errors carry a time of up to two hours ago.

    ``event_id`` is the arrival order.
    """
    back = F.make_dt_interval(
        secs=F.when(F.col("event_type") == "error", 1800 + (F.col("event_id") * 37 % 90) * 60)
        .otherwise(0)
        .cast("decimal(18,6)")
    )
    return table(spark, sf_dir, "events").select(
        "event_id",
        (F.col("ts") - back).alias("event_time"),
        "user_id",
        F.col("event_type").alias("region"),
        F.col("value").alias("total_amount"),
    )
