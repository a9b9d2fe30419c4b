"""Event-time window aggregates for batch and stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablestream.functions.money import exact_sum
from tablestream.schemas import WINDOW_SIZE


def distinct_orders(
    events: DataFrame,
    ts: str = "event_timestamp",
    product: str = "product_id",
    order: str = "order_id",
    size: str = WINDOW_SIZE,
) -> DataFrame:
    """Exact distinct orders per window and product.

    Two stages instead of ``count(distinct)``: a stream refuses the latter, and
    the first grouping spreads a hot product over its orders and collapses
    repeats before the shuffle. NULL orders do not count; a NULL product is a
    group of its own.
    """
    pairs = events.groupBy(F.window(ts, size).alias("_w"), product, order).agg(
        F.count(F.lit(1)).alias("_rows")
    )
    return (
        pairs.groupBy("_w", product)
        .agg(F.count(order).alias("orders"))
        .select(F.col("_w.start").alias("event_time"), product, "orders")
    )


def window_sales(
    events: DataFrame,
    ts: str = "event_timestamp",
    key: str = "region",
    amount: str = "total_amount",
    size: str = WINDOW_SIZE,
) -> DataFrame:
    """Exact sales per window and key, as decimal partials that add up."""
    return (
        events.groupBy(F.window(ts, size).alias("_w"), key)
        .agg(exact_sum(amount).alias("total_sales"))
        .select(
            F.col("_w.start").alias("window_start"),
            F.col("_w.end").alias("window_end"),
            key,
            "total_sales",
        )
    )


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("total_events"))


def with_watermark(stream: DataFrame, ts: str = "event_timestamp", delay: str = "5 seconds") -> DataFrame:
    return stream.withWatermark(ts, delay)
