"""Queries over stored layouts: hash buckets, days, and messages in the order of keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from tablestream.operators.buckets import BucketedTable
from tablestream.operators.sequence import with_previous
from tablestream.plans.registry import query
from tablestream.plans.versions import CHANGES_SQL, VERSION, _latest_sql
from tablestream.schemas import BIGINT, DOUBLE, TEXT, TIME, columns
from tablestream.session import fresh_path
from tablestream.sources.days import on_days, read_days, write_by_day
from tablestream.sources.tables import LINE_KEY, LINE_ORDER, line_changes, table
from tablestream.sources.topics import text_messages_batch, write_messages

LINES = columns(
    order_id=BIGINT, line=IntegerType(), product_id=BIGINT, supplier_id=BIGINT, total_amount=DOUBLE, event_time=TIME
)
#: Versions are months; a batch of the layout holds the months up to one of these.
BATCHES = [20, VERSION, 60, 1000]
BUCKETS = 16


def _bucketed(spark: SparkSession, sf_dir: str, compact_at: int | None = None) -> BucketedTable:
    """Order lines, stored in four batches by ship month."""
    changes = line_changes(spark, sf_dir).select(*LINES.names, "batch_id")
    held = BucketedTable(spark, fresh_path(spark, "bucketed"), LINES, LINE_KEY, BUCKETS)
    after = -(10**6)
    for upto in BATCHES:
        batch = changes.where((F.col("batch_id") > after) & (F.col("batch_id") <= upto))
        held.upsert(batch, upto, ["batch_id", *LINE_ORDER])
        if upto == compact_at:
            held.compact(upto)
        after = upto
    return held


@query("K1 S5", f"WITH {CHANGES_SQL} {_latest_sql('changes')}")
def bucketed_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state, read without moving a stored row."""
    return _bucketed(spark, sf_dir).read()


@query("K1 S7", f"WITH {CHANGES_SQL} {_latest_sql('changes', f'batch_id <= {VERSION}')}")
def bucketed_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An earlier version, read after later ones were compacted."""
    return _bucketed(spark, sf_dir, compact_at=60).read(VERSION)


@query("K1 M1", f"WITH {CHANGES_SQL} {_latest_sql('changes')}")
def bucketed_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state over a compacted base and the batch after it."""
    return _bucketed(spark, sf_dir, compact_at=60).read()


ORDERS = columns(order_id=BIGINT, user_id=BIGINT, status=TEXT, total_price=DOUBLE)


@query(
    "K1",
    f"""
    WITH {CHANGES_SQL},
    state AS ({_latest_sql('changes')})
    SELECT o_orderstatus AS status, count(*) AS lines,
           CAST(sum(CAST(total_amount AS DECIMAL(18,2))) AS DOUBLE) AS total_sales
    FROM state JOIN orders ON o_orderkey = order_id GROUP BY 1
    """,
)
def bucketed_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines and orders with the same buckets meet where they lie."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").alias("total_price"),
    )
    held = BucketedTable(spark, fresh_path(spark, "orders"), ORDERS, ["order_id"], BUCKETS)
    held.upsert(orders, 0, ["total_price"])
    joined = _bucketed(spark, sf_dir).read().join(held.read(), "order_id")
    return joined.groupBy("status").agg(
        F.count(F.lit(1)).alias("lines"),
        F.sum(F.col("total_amount").cast("decimal(18,2)")).cast("double").alias("total_sales"),
    )


@query(
    "K6",
    """
    WITH busy AS (
      SELECT CAST(ts AS DATE) AS event_day FROM events WHERE event_type = 'purchase'
      GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 3)
    SELECT event_id, user_id, event_type, CAST(ts AS DATE) AS event_day
    FROM events WHERE CAST(ts AS DATE) IN (SELECT event_day FROM busy)
    """,
)
def busy_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of the three days with most purchases: a list of days that only the data
    tell, so the stored days are pruned while the query runs."""
    path = fresh_path(spark, "by-day")
    write_by_day(table(spark, sf_dir, "events"), "ts", path)
    stored = read_days(spark, path)
    purchases = stored.where("event_type = 'purchase'").groupBy("event_day").agg(F.count("*").alias("n"))
    busy = purchases.orderBy(F.desc("n"), "event_day").limit(3)
    return on_days(stored, busy).select("event_id", "user_id", "event_type", "event_day")


@query(
    "K7",
    """
    SELECT CAST(user_id AS VARCHAR) AS key, count(*) AS messages, min(event_id) AS first_id,
           max(event_id) AS last_id, CAST(0 AS BIGINT) AS out_of_sequence
    FROM events GROUP BY 1
    """,
)
def messages_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages written in the order of their keys; their places in the files tell it."""
    inbox = f"{fresh_path(spark, 'in-order')}/inbox"
    messages = table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("key"),
        F.to_json(F.struct(F.col("user_id").alias("key"), F.col("event_id").alias("id"))).alias("value"),
        "event_id",
    )
    write_messages(messages, inbox, key="key", order=["event_id"])
    read = text_messages_batch(spark, inbox).select(F.from_json("value", "key string, id bigint").alias("m"), "_seq")
    steps = with_previous(read.select("m.key", "m.id", "_seq"), ["key"], ["_seq"], {"before": "id"})
    return steps.groupBy("key").agg(
        F.count(F.lit(1)).alias("messages"),
        F.min_by("id", "_seq").alias("first_id"),
        F.max_by("id", "_seq").alias("last_id"),
        F.count_if(F.col("id") < F.col("before")).alias("out_of_sequence"),
    )
