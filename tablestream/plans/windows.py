"""Window aggregates, lateness and enrichment over the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablestream.functions.times import at_rest, tumble
from tablestream.operators import late, lookup
from tablestream.operators.keyed import last_per_key
from tablestream.operators.windows import distinct_orders, window_sales
from tablestream.plans.registry import query
from tablestream.sources.tables import (
    LINE_ORDER,
    customer_regions,
    late_events,
    order_lines,
    table,
)

MONTHLY = "30 days"
HOURLY = "1 hour"
HOURLY_GRACE = "65 minutes"

LINES_SQL = """
lines AS (
  SELECT l_orderkey || '-' || l_linenumber AS event_id, l_orderkey AS order_id,
         l_partkey AS product_id, l_suppkey AS supplier_id, l_linenumber AS line,
         CAST(l_quantity AS INTEGER) AS quantity, l_extendedprice AS total_amount,
         l_discount AS discount_pct, l_returnflag AS return_flag, l_shipdate AS event_time
  FROM lineitem
),
order_regions AS (
  SELECT o_orderkey AS order_id, o_custkey AS user_id, o_orderstatus AS status, r_name AS region
  FROM orders JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
)
"""

LATE_SQL = """
shifted AS (
  SELECT event_id, user_id, event_type AS region, value AS total_amount, ts AS sent_at,
         ts - to_seconds(CASE WHEN event_type = 'error'
                              THEN 1800 + (event_id * 37 % 90) * 60 ELSE 0 END) AS event_time
  FROM events
),
arrivals AS (
  SELECT *, date_trunc('hour', event_time) AS window_start,
         date_trunc('hour', event_time) + INTERVAL 1 HOUR AS window_end,
         max(event_time) OVER (ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
           AS high_water
  FROM shifted
),
marked AS (
  SELECT *, coalesce(window_end + INTERVAL 65 MINUTE <= high_water, false) AS is_late FROM arrivals
)
"""


@query(
    "A1 T3 F10",
    """
    SELECT time_bucket(INTERVAL 30 DAY, l_shipdate, TIMESTAMP '1970-01-01') AS event_time,
           p_brand AS category, count(DISTINCT l_orderkey) AS orders
    FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2
    """,
)
def products_sold(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = order_lines(spark, sf_dir, with_product=True)
    return distinct_orders(lines, "event_time", "category", size=MONTHLY)


@query(
    "A1 T3",
    """
    SELECT date_trunc('hour', ts) AS event_time, event_type, count(DISTINCT user_id) AS orders
    FROM events GROUP BY 1, 2
    """,
)
def users_by_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct_orders(
        table(spark, sf_dir, "events"), "ts", "event_type", order="user_id", size=HOURLY
    )


@query(
    "A2 T3 T7 U1 U3",
    f"""
    WITH {LINES_SQL}
    SELECT time_bucket(INTERVAL 30 DAY, event_time, TIMESTAMP '1970-01-01') AS window_start,
           time_bucket(INTERVAL 30 DAY, event_time, TIMESTAMP '1970-01-01') + INTERVAL 30 DAY
             AS window_end,
           region, CAST(sum(CAST(total_amount AS DECIMAL(18,2))) AS DOUBLE) AS total_sales
    FROM lines JOIN order_regions USING (order_id) GROUP BY 1, 2, 3
    """,
)
def regional_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = order_lines(spark, sf_dir, with_order=True)
    sales = window_sales(lines, "event_time", size=MONTHLY)
    return sales.withColumn("total_sales", F.col("total_sales").cast("double"))


@query(
    "A2 T2 T3 T4 T7 T9 U1 U4",
    f"""
    WITH {LATE_SQL}
    SELECT window_start, window_end, region,
           CAST(sum(CAST(total_amount AS DECIMAL(18,2))) AS DOUBLE) AS total_sales
    FROM marked WHERE NOT is_late GROUP BY 1, 2, 3
    """,
)
def windowed_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = late.mark_late(
        late_events(spark, sf_dir), "event_time", "event_id", HOURLY, HOURLY_GRACE
    )
    return late.on_time_sales(marked).withColumn("total_sales", F.col("total_sales").cast("double"))


@query(
    "T5 K2",
    f"WITH {LATE_SQL} SELECT region, total_amount, event_time FROM marked WHERE is_late",
)
def late_events_dlq(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = late.mark_late(
        late_events(spark, sf_dir), "event_time", "event_id", HOURLY, HOURLY_GRACE
    )
    return late.dead_letters(marked, "event_time")


REGION_DIM_SQL = """
dim AS (
  SELECT r_name AS region, r_name || ' DC' AS data_center,
         CAST(r_regionkey AS DOUBLE) / 20 AS tax_rate, upper(substr(r_name, 1, 4)) AS compliance_type
  FROM region WHERE r_name <> 'ASIA'
)
"""


def region_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attributes per region, with one region unknown."""
    return (
        table(spark, sf_dir, "region")
        .where(F.col("r_name") != "ASIA")
        .select(
            F.col("r_name").alias("region"),
            F.concat("r_name", F.lit(" DC")).alias("data_center"),
            (F.col("r_regionkey").cast("double") / 20).alias("tax_rate"),
            F.upper(F.substring("r_name", 1, 4)).alias("compliance_type"),
        )
    )


@query(
    "J1",
    f"""
    WITH {LINES_SQL}, {REGION_DIM_SQL}
    SELECT event_time, order_id, o.region, data_center, tax_rate, compliance_type, total_amount
    FROM lines JOIN order_regions o USING (order_id) LEFT JOIN dim ON o.region = dim.region
    """,
)
def enriched_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = order_lines(spark, sf_dir, with_order=True)
    return lookup.regional_orders(lines, region_dimension(spark, sf_dir), "event_time").select(
        "event_time", "order_id", "region", "data_center", "tax_rate", "compliance_type", "total_amount"
    )


@query(
    "J1 K1",
    f"""
    WITH {LINES_SQL}, {REGION_DIM_SQL},
    last_line AS (
      SELECT * FROM (
        SELECT *, row_number() OVER (PARTITION BY order_id
          ORDER BY event_time DESC, product_id DESC, supplier_id DESC, line DESC) AS rn FROM lines)
      WHERE rn = 1
    )
    SELECT event_time, order_id, o.region, data_center, tax_rate, compliance_type, total_amount
    FROM last_line JOIN order_regions o USING (order_id) LEFT JOIN dim ON o.region = dim.region
    """,
)
def regional_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The last line per order is found before the joins: they then move one row
    # per order, and every attribute depends on the order alone.
    last = last_per_key(order_lines(spark, sf_dir), ["order_id"], [*LINE_ORDER, "line"])
    orders = (
        table(spark, sf_dir, "orders")
        .select(F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("user_id"))
        .join(customer_regions(spark, sf_dir), "user_id")
    )
    rows = last.join(orders, "order_id")
    return lookup.regional_orders(rows, region_dimension(spark, sf_dir), "event_time").select(
        "event_time", "order_id", "region", "data_center", "tax_rate", "compliance_type", "total_amount"
    )


@query(
    "F10 T3",
    """
    SELECT event_id, date_trunc('hour', ts) AS window_start,
           date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end FROM events
    """,
)
def window_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tumble(table(spark, sf_dir, "events"), "ts", HOURLY).select(
        "event_id", at_rest("window_start").alias("window_start"), at_rest("window_end").alias("window_end")
    )
