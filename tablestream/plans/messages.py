"""Decoding, encoding, time functions and plain reads over the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablestream.functions import money, times
from tablestream.functions.codec import accepted, decode, decode_events, encode, rejected
from tablestream.plans.registry import query
from tablestream.plans.windows import LINES_SQL, REGION_DIM_SQL, region_dimension
from tablestream.schemas import ORDER_EVENT, REGION_DIM, pick
from tablestream.session import fresh_path
from tablestream.sources.dimensions import read_csv_dimension
from tablestream.sources.tables import order_lines, table

# -- decode and encode -------------------------------------------------------


@query(
    "S2 F11",
    "SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events",
)
def decode_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = T.StructType([T.StructField("k", T.IntegerType())])
    rows = decode(table(spark, sf_dir, "events").select("event_id", "props"), fields, "props")
    return accepted(rows).select("event_id", "k")


def damaged_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event as message text; some kinds of events are damaged.

    Errors lose their closing brace, sign-ups carry words for a quantity, and
    clicks carry a time that is none.
    """
    kind = F.col("event_type")
    text = F.to_json(
        F.struct(
            F.col("event_id").cast("string").alias("event_id"),
            F.col("user_id").cast("string").alias("user_id"),
            kind.alias("category"),
            F.when(kind == "signup", F.lit("some"))
            .otherwise(F.get_json_object("props", "$.k"))
            .alias("quantity"),
            F.col("value").alias("total_amount"),
            F.when(kind == "click", F.lit("soon"))
            .otherwise(times.event_time_text("ts"))
            .alias("event_time"),
        )
    )
    whole = F.when(kind == "error", F.expr("substring(value, 1, length(value) - 1)")).otherwise(
        F.col("value")
    )
    return (
        table(spark, sf_dir, "events")
        .withColumn("value", text)
        .select(F.col("event_id").alias("_seq"), whole.alias("value"))
    )


@query(
    "S1 S2 F1 F9 F11 P3",
    """
    SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS user_id,
           event_type AS category,
           CASE WHEN event_type <> 'signup' THEN CAST(json_extract(props, '$.k') AS INTEGER) END
             AS quantity,
           value AS total_amount, date_trunc('millisecond', ts) AS event_timestamp
    FROM events WHERE event_type NOT IN ('error', 'click')
    """,
)
def decode_lenient(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = accepted(decode_events(damaged_messages(spark, sf_dir)))
    return rows.select(
        "event_id",
        "user_id",
        "category",
        "quantity",
        "total_amount",
        times.at_rest("event_timestamp").alias("event_timestamp"),
    )


@query(
    "S2",
    """
    SELECT event_id AS _seq,
           CASE event_type WHEN 'error' THEN 'broken_text' ELSE 'no_event_time' END AS reject_reason
    FROM events WHERE event_type IN ('error', 'click')
    """,
)
def decode_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rejected(decode_events(damaged_messages(spark, sf_dir))).select("_seq", "reject_reason")


@query(
    "S3",
    """
    SELECT CAST(event_id AS VARCHAR) AS event_id, value AS total_amount
    FROM events WHERE event_type <> 'error'
    """,
)
def narrow_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = pick(ORDER_EVENT, "event_id", "total_amount")
    return accepted(decode(damaged_messages(spark, sf_dir), fields)).select("event_id", "total_amount")


@query(
    "K7 F11",
    """
    SELECT CAST(l_orderkey AS VARCHAR) AS key,
           '{"order_id":' || l_orderkey || ',"line":' || l_linenumber || ',"event_time":"'
           || strftime(l_shipdate, '%Y-%m-%d %H:%M:%S.%g') || '"}' AS value
    FROM lineitem
    """,
)
def order_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = order_lines(spark, sf_dir).withColumn("event_time", times.event_time_text("event_time"))
    return encode(lines, "order_id", ["order_id", "line", "event_time"])


@query(
    "K7 S2 F11",
    f"""
    WITH {LINES_SQL}
    SELECT event_id, CAST(order_id AS VARCHAR) AS order_id, quantity, total_amount, event_time
    FROM lines
    """,
)
def message_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = order_lines(spark, sf_dir).withColumn("event_time", times.event_time_text("event_time"))
    sent = encode(
        lines, "order_id", ["event_id", "order_id", "quantity", "total_amount", "event_time"]
    )
    return accepted(decode_events(sent)).select(
        "event_id",
        "order_id",
        "quantity",
        "total_amount",
        times.at_rest("event_timestamp").alias("event_time"),
    )


@query("S4", f"WITH {REGION_DIM_SQL} SELECT * FROM dim")
def csv_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "regions_csv")
    region_dimension(spark, sf_dir).write.csv(path)
    return read_csv_dimension(spark, path, REGION_DIM)


# -- times -------------------------------------------------------------------


@query(
    "F1 F2 F3 F4 F8 P3 T1",
    """
    SELECT event_id,
           strftime(ts, '%Y-%m-%d %H:%M:%S.%g') AS event_time,
           date_trunc('millisecond', ts) AS event_timestamp,
           date_trunc('millisecond', ts) AS cast_timestamp,
           ts AS micros,
           date_trunc('millisecond', ts) AS millis,
           ts - INTERVAL 5 SECOND AS watermark
    FROM events
    """,
)
def timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = table(spark, sf_dir, "events").withColumn("event_time", times.event_time_text("ts"))
    return text.select(
        "event_id",
        "event_time",
        times.at_rest(times.parse_event_time("event_time")).alias("event_timestamp"),
        times.at_rest(times.parse_time_lenient("event_time")).alias("cast_timestamp"),
        times.at_rest("ts").alias("micros"),
        times.at_rest(times.truncate_millis("ts")).alias("millis"),
        times.earlier("ts", "5 seconds").alias("watermark"),
    )


@query(
    "F5 F6 U4",
    """
    SELECT event_id, epoch_us(ts) // 1000 AS millis, date_trunc('millisecond', ts) AS from_millis
    FROM events
    """,
)
def epoch_millis(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").withColumn("millis", times.to_millis("ts"))
    return rows.select(
        "event_id", "millis", times.at_rest(times.from_millis("millis")).alias("from_millis")
    )


@query(
    "F1 F9",
    """
    SELECT p_partkey, TRY_CAST(split_part(p_brand, '#', 2) AS INTEGER) AS brand_number,
           TRY_CAST(p_name AS DOUBLE) AS name_number, CAST(p_size AS VARCHAR) AS size_text,
           CAST(NULL AS TIMESTAMP) AS name_time
    FROM part
    """,
)
def lenient_casts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        F.split_part("p_brand", F.lit("#"), F.lit(2)).try_cast("int").alias("brand_number"),
        F.col("p_name").try_cast("double").alias("name_number"),
        F.col("p_size").cast("string").alias("size_text"),
        times.at_rest(times.parse_event_time("p_name")).alias("name_time"),
    )


@query(
    "F12",
    """
    SELECT l_orderkey AS order_id, l_linenumber AS line, l_partkey AS product_id,
           l_suppkey AS supplier_id,
           CAST(round(CAST(p_retailprice AS DECIMAL(18,2))
                      * (1 - CAST(l_discount AS DECIMAL(5,4))), 2) AS DOUBLE) AS unit_price,
           CAST(CAST(round(CAST(p_retailprice AS DECIMAL(18,2))
                      * (1 - CAST(l_discount AS DECIMAL(5,4))), 2) AS DECIMAL(18,2))
                * CAST(l_quantity AS INTEGER) AS DOUBLE) AS total_amount
    FROM lineitem JOIN part ON l_partkey = p_partkey
    """,
)
def line_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"), F.col("p_retailprice").alias("base")
    )
    priced = (
        order_lines(spark, sf_dir)
        .join(parts, "product_id")
        .withColumn("unit_price", money.unit_price("base", "discount_pct"))
    )
    return priced.select(
        "order_id",
        "line",
        "product_id",
        "supplier_id",
        F.col("unit_price").cast("double").alias("unit_price"),
        money.line_total("unit_price", "quantity").cast("double").alias("total_amount"),
    )


# -- plain reads -------------------------------------------------------------


@query(
    "P1",
    """
    SELECT l_orderkey AS order_id, l_partkey AS product_id, CAST(l_quantity AS INTEGER) AS quantity,
           l_shipdate AS event_time FROM lineitem
    """,
)
def projected_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_lines(spark, sf_dir).select("order_id", "product_id", "quantity", "event_time")


@query("P2 L1", "SELECT * FROM events ORDER BY event_id LIMIT 10")
def preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("*").orderBy("event_id").limit(10)


@query(
    "P4 U2 F4",
    """
    SELECT event_type AS region, value AS total_amount,
           strftime(ts, '%Y-%m-%d %H:%M:%S.%g') AS event_time FROM events
    """,
)
def sales_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("event_type").cast("string").alias("region"),
        F.col("value").cast("double").alias("total_amount"),
        times.event_time_text("ts").alias("event_time"),
    )


@query(
    "P5 F7",
    "SELECT event_id, ts AS event_time, true AS ingested_later FROM events",
)
def ingestion_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    stamped = table(spark, sf_dir, "events").withColumn(
        "ingestion_time", times.at_rest(F.current_timestamp())
    )
    return stamped.select(
        "event_id",
        F.col("ts").alias("event_time"),
        (F.col("ingestion_time") > F.col("ts")).alias("ingested_later"),
    )


@query(
    "P6",
    """
    SELECT event_id, user_id, event_type, value FROM events
    WHERE event_type IN ('purchase', 'signup')
    """,
)
def category_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "events")
        .where(F.col("event_type").isin("purchase", "signup"))
        .select("event_id", "user_id", "event_type", "value")
    )


ADHOC = """
SELECT event_type, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total
FROM events GROUP BY event_type ORDER BY event_type
"""


@query("P7 L2", ADHOC)
def adhoc_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    table(spark, sf_dir, "events").createOrReplaceTempView("events")
    return spark.sql(ADHOC)
