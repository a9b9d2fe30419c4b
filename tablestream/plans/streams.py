"""The continuous jobs, run to their end over the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablestream.functions import times
from tablestream.functions.codec import encode
from tablestream.operators import quality
from tablestream.operators.changelog import EventTable, open_table
from tablestream.operators.windows import distinct_orders, window_sales, with_watermark
from tablestream.plans.registry import query
from tablestream.plans.windows import HOURLY, LATE_SQL, REGION_DIM_SQL, region_dimension
from tablestream.schemas import (
    BIGINT,
    DOUBLE,
    LATE_EVENTS_DLQ,
    ORDER_EVENTS,
    OUT_OF_ORDER,
    REGIONAL_ORDERS,
    TEXT,
    TIME,
    WINDOWED_SALES,
    TableSpec,
    columns,
)
from tablestream.session import fresh_path
from tablestream.sources.tables import customer_regions, late_events, table
from tablestream.sources.topics import text_messages, write_messages
from tablestream.streaming import jobs
from tablestream.streaming.run import keyed_writer, start


def events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a stream, with its time as an instant."""
    schema = table(spark, sf_dir, "events").schema
    return (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", "events.parquet")
        .parquet(sf_dir)
        .withColumn("event_timestamp", F.col("ts").cast("timestamp"))
    )


def _run(stream: DataFrame, write, name: str, root: str, mode: str = "append") -> None:
    """Work off a stateful query with one state partition per core."""
    cores = stream.sparkSession.sparkContext.defaultParallelism
    _finish(
        start(stream, write, name, f"{root}/progress", mode, interval=None, state_partitions=cores)
    )


def _finish(query) -> None:
    query.awaitTermination()
    if query.exception():
        raise query.exception()


SOLD_BY_TYPE = TableSpec(
    "users_by_hour",
    columns(event_time=TIME, event_type=TEXT, orders=BIGINT),
    ("event_time", "event_type"),
)


@query(
    "A1 T1 T3 T6 T8 K4",
    """
    SELECT date_trunc('hour', ts) AS event_time, event_type, count(DISTINCT user_id) AS orders
    FROM events
    WHERE date_trunc('hour', ts) + INTERVAL 1 HOUR
          <= (SELECT max(date_trunc('millisecond', ts)) - INTERVAL 5 SECOND FROM events)
    GROUP BY 1, 2
    """,
)
def products_sold_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Append mode: the windows that the watermark has closed."""
    root = fresh_path(spark, "products-sold")
    events = with_watermark(events_stream(spark, sf_dir), delay=OUT_OF_ORDER)
    sold = distinct_orders(events, "event_timestamp", "event_type", "user_id", HOURLY)
    write = keyed_writer(spark, root, SOLD_BY_TYPE, "users_by_hour")
    _run(sold, write, "users_by_hour", root)
    return open_table(spark, root, SOLD_BY_TYPE).read()


SALES_STATE = TableSpec(
    "sales_state", WINDOWED_SALES.schema, ("window_start", "region")
)


@query(
    "A2 T3 T9 K1",
    """
    SELECT date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end,
           event_type AS region, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total_sales
    FROM events GROUP BY 1, 2, 3
    """,
)
def sales_update_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Update mode into a keyed table: every change of a window replaces its row."""
    root = fresh_path(spark, "sales-state")
    events = with_watermark(events_stream(spark, sf_dir), delay=OUT_OF_ORDER)
    sales = window_sales(
        events.withColumnRenamed("event_type", "region"), "event_timestamp", amount="value", size=HOURLY
    )
    write = keyed_writer(spark, root, SALES_STATE, "sales_state")
    _run(sales, write, "sales_state", root, mode="update")
    state = open_table(spark, root, SALES_STATE).read()
    return state.withColumn("total_sales", F.col("total_sales").cast("double"))


def _sales_tables(spark: SparkSession, sf_dir: str, parts: int = 4) -> tuple[EventTable, EventTable]:
    """Four arrivals of messages, each run to its end by a restarted job.

    Lateness is judged per row, so the number of arrivals makes no difference.
    """
    root = fresh_path(spark, "windowed-sales")
    inbox = f"{root}/inbox"
    sent = late_events(spark, sf_dir).select(
        "region",
        "total_amount",
        times.event_time_text("event_time").alias("event_time"),
        F.col("event_id").alias("offset"),
    )
    last = sent.agg(F.max("offset")).first()[0] or 0
    for part in range(parts):
        arrival = F.floor(F.col("offset") * parts / (last + 1)) == part
        write_messages(encode(sent.where(arrival), "region"), inbox)
        _finish(
            jobs.windowed_sales(
                text_messages(spark, inbox),
                root,
                f"{root}/progress",
                interval=None,
                size=HOURLY,
                grace="65 minutes",
            )
        )
    return open_table(spark, root, WINDOWED_SALES), open_table(spark, root, LATE_EVENTS_DLQ)


PER_ROW_SQL = f"""
{LATE_SQL},
judged AS (
  SELECT *, date_trunc('millisecond', event_time) AS sent_time FROM marked
)
"""


@query(
    "S1 K2 K3 K4 T2 T4 T9",
    f"""
    WITH {PER_ROW_SQL}
    SELECT window_start, window_end, region,
           CAST(sum(CAST(total_amount AS DECIMAL(18,2))) AS DOUBLE) AS total_sales
    FROM judged WHERE NOT is_late GROUP BY 1, 2, 3
    """,
)
def windowed_sales_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    sales, _ = _sales_tables(spark, sf_dir)
    return sales.read().withColumn("total_sales", F.col("total_sales").cast("double"))


@query(
    "T5 K2 K3",
    f"WITH {PER_ROW_SQL} SELECT region, total_amount, sent_time AS event_time FROM judged WHERE is_late",
)
def late_events_dlq_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All messages as one backlog."""
    _, dlq = _sales_tables(spark, sf_dir, parts=1)
    return dlq.read()


def _user_messages(
    spark: SparkSession, sf_dir: str, inbox: str, numbered: bool = True
) -> None:
    """Events as messages whose key comes again: one key per user and kind.

    Without numbers, the messages of a key stand in one file in their order.
    """
    events = table(spark, sf_dir, "events").join(customer_regions(spark, sf_dir), "user_id", "left")
    rows = events.select(
        F.concat_ws("-", "user_id", "event_type").alias("event_id"),
        F.col("user_id").cast("string").alias("order_id"),
        F.col("event_type").alias("category"),
        F.get_json_object("props", "$.k").alias("quantity"),
        F.col("value").alias("total_amount"),
        "region",
        times.event_time_text("ts").alias("event_time"),
        F.col("event_id").alias("offset"),
    )
    if not numbered:
        rows = rows.repartition("event_id").sortWithinPartitions("offset").drop("offset")
    write_messages(encode(rows, "order_id"), inbox)


LAST_OF_KEY_SQL = """
    SELECT event_id, order_id, category, quantity, total_amount, event_time FROM (
      SELECT user_id || '-' || event_type AS event_id, CAST(user_id AS VARCHAR) AS order_id,
             event_type AS category, CAST(json_extract(props, '$.k') AS INTEGER) AS quantity,
             value AS total_amount, date_trunc('millisecond', ts) AS event_time,
             row_number() OVER (PARTITION BY user_id, event_type ORDER BY events.event_id DESC) AS rn
      FROM events) WHERE rn = 1
"""


def _ingested(spark: SparkSession, sf_dir: str, numbered: bool) -> DataFrame:
    root = fresh_path(spark, "ingest")
    _user_messages(spark, sf_dir, f"{root}/inbox", numbered)
    _finish(
        jobs.ingest(text_messages(spark, f"{root}/inbox"), root, f"{root}/progress", interval=None)
    )
    return (
        open_table(spark, root, ORDER_EVENTS)
        .read()
        .select("event_id", "order_id", "category", "quantity", "total_amount", "event_time")
    )


@query("S1 S2 K1 K3 K4 K5 P5 S5", LAST_OF_KEY_SQL)
def ingest_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ingested(spark, sf_dir, numbered=True)


@query("S1 K1", LAST_OF_KEY_SQL)
def ingest_by_place(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages without a number: their place in the files is their order."""
    return _ingested(spark, sf_dir, numbered=False)


@query(
    "J1 K1 S1 S3",
    f"""
    WITH {REGION_DIM_SQL}
    SELECT event_time, order_id, r_name AS region, data_center, tax_rate, compliance_type,
           total_amount
    FROM (
      SELECT date_trunc('millisecond', ts) AS event_time, CAST(user_id AS VARCHAR) AS order_id,
             user_id, value AS total_amount,
             row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn
      FROM events)
    LEFT JOIN customer ON user_id = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey
    LEFT JOIN region ON n_regionkey = r_regionkey LEFT JOIN dim ON r_name = dim.region
    WHERE rn = 1
    """,
)
def regional_orders_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = fresh_path(spark, "regional")
    _user_messages(spark, sf_dir, f"{root}/inbox")
    _finish(
        jobs.regional_orders(
            text_messages(spark, f"{root}/inbox"),
            region_dimension(spark, sf_dir),
            root,
            f"{root}/progress",
            interval=None,
        )
    )
    return open_table(spark, root, REGIONAL_ORDERS).read()


DEDUPED = TableSpec(
    "first_events", columns(event_id=BIGINT, event_type=TEXT, value=DOUBLE), ("event_id",)
)


@query("R3 T1", "SELECT event_id, event_type, value FROM events")
def dedup_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event sent twice; one of each stays."""
    root = fresh_path(spark, "dedup")
    events = events_stream(spark, sf_dir).select("event_id", "event_type", "value", "event_timestamp")
    twice = events.unionByName(events)
    once = quality.deduplicate_stream(twice, ["event_id"], "event_timestamp", "5 seconds")
    write = keyed_writer(spark, root, DEDUPED, "first_events")
    _run(once, write, "first_events", root)
    return open_table(spark, root, DEDUPED).changes().select("event_id", "event_type", "value")
