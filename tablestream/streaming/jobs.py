"""The four continuous jobs. Each takes a stream of messages of ``sources.topics``."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tablestream.functions.codec import (
    accepted,
    decode,
    decode_events,
    mark,
    rejected,
    require,
)
from tablestream.functions.money import is_countable
from tablestream.functions.times import at_rest, parse_event_time, zoneless
from tablestream.operators import late, lookup, windows
from tablestream.operators.changelog import MAIN, open_table
from tablestream.schemas import (
    COMMIT_INTERVAL,
    GRACE,
    LATE_EVENTS_DLQ,
    ORDER_EVENT,
    ORDER_EVENTS,
    OUT_OF_ORDER,
    PRODUCTS_SOLD,
    REGIONAL_ORDERS,
    WINDOW_SIZE,
    WINDOWED_SALES,
    pick,
    rejects_of,
)
from tablestream.sources.topics import arrivals
from tablestream.streaming.run import keyed_writer, save_rejects, start

NO_REGION = "no_region"
BAD_AMOUNT = "bad_amount"
LONG_AGO = datetime(1, 1, 1)
SOLD_FIELDS = pick(ORDER_EVENT, "order_id", "product_id", "event_time")


def ingest(
    messages: DataFrame,
    root: str,
    checkpoint: str,
    branch: str = MAIN,
    interval: str | None = COMMIT_INTERVAL,
    name: str = "ingest",
) -> StreamingQuery:
    """Messages to ``order_events``, the last arrival per ``event_id``, and the
    rest to the job's reject table. An event without a readable time is kept:
    the key decides, and only window jobs need the time."""
    spark = messages.sparkSession
    events = open_table(spark, root, ORDER_EVENTS)
    rejects = open_table(spark, root, rejects_of(name))

    def write(batch: DataFrame, batch_id: int, writer: str) -> None:
        rows = (
            require(decode(arrivals(batch)), "event_id")
            .withColumn("event_time", at_rest(parse_event_time("event_time")))
            .withColumn("ingestion_time", at_rest(F.current_timestamp()))
            .persist()
        )
        try:
            save_rejects(rejects, rejected(rows), writer, batch_id, branch)
            events.append(accepted(rows), branch, writer=writer, writer_batch=batch_id)
        finally:
            rows.unpersist()

    return start(messages, write, name, checkpoint, interval=interval)


def products_sold(
    messages: DataFrame,
    root: str,
    checkpoint: str,
    branch: str = MAIN,
    interval: str | None = COMMIT_INTERVAL,
    name: str = "products_sold",
    size: str = WINDOW_SIZE,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Distinct orders per window and product, once per closed window.

    The unreadable messages are kept by ``undecoded``, a query of its own, because
    the state of this one begins before its first sink.
    """
    fields = SOLD_FIELDS
    events = accepted(decode_events(messages.select("value"), fields)).select(
        "order_id", "product_id", "event_timestamp"
    )
    sold = windows.distinct_orders(windows.with_watermark(events, delay=OUT_OF_ORDER), size=size)
    write = keyed_writer(messages.sparkSession, root, PRODUCTS_SOLD, name, branch)
    return start(
        sold, write, name, checkpoint, interval=interval, state_partitions=state_partitions
    )


def undecoded(
    messages: DataFrame,
    root: str,
    checkpoint: str,
    branch: str = MAIN,
    interval: str | None = COMMIT_INTERVAL,
    name: str = "products_sold",
) -> StreamingQuery:
    """The messages that ``products_sold`` cannot read, to its reject table."""
    rejects = open_table(messages.sparkSession, root, rejects_of(name))
    bad = rejected(decode_events(messages.select("value"), SOLD_FIELDS)).select(
        "value", "reject_reason"
    )

    def write(batch: DataFrame, batch_id: int, writer: str) -> None:
        save_rejects(rejects, batch, writer, batch_id, branch)

    return start(bad, write, f"{name}_undecoded", checkpoint, interval=interval)


def regional_orders(
    messages: DataFrame,
    regions: DataFrame,
    root: str,
    checkpoint: str,
    branch: str = MAIN,
    interval: str | None = COMMIT_INTERVAL,
    name: str = "regional_orders",
) -> StreamingQuery:
    """Orders with their region's attributes, the last arrival per order."""
    spark = messages.sparkSession
    orders = open_table(spark, root, REGIONAL_ORDERS)
    rejects = open_table(spark, root, rejects_of(name))
    fields = pick(ORDER_EVENT, "order_id", "region", "total_amount", "event_time")

    def write(batch: DataFrame, batch_id: int, writer: str) -> None:
        # A row without a readable time keeps its place: the order is the key here.
        rows = (
            require(decode(arrivals(batch), fields), "order_id")
            .withColumn("event_timestamp", parse_event_time("event_time"))
            .persist()
        )
        try:
            save_rejects(rejects, rejected(rows), writer, batch_id, branch)
            enriched = lookup.regional_orders(
                accepted(rows).drop("event_time"), regions, heavy_rows=lookup.HEAVY_ROWS
            )
            orders.append(enriched, branch, writer=writer, writer_batch=batch_id)
        finally:
            rows.unpersist()

    return start(messages, write, name, checkpoint, interval=interval)


def windowed_sales(
    messages: DataFrame,
    root: str,
    checkpoint: str,
    branch: str = MAIN,
    interval: str | None = COMMIT_INTERVAL,
    name: str = "windowed_sales",
    size: str = WINDOW_SIZE,
    grace: str = GRACE,
) -> StreamingQuery:
    """Sales per region and window with allowed lateness, and the dead letters.

    A row is judged by the greater of two marks: that of earlier batches, which is
    stored with their commits, and that of the arrivals before it in its own batch.
    So neither a restart nor the size of a batch decides what is late. Both tables are
    written from one micro-batch; the sums are committed last and carry the mark.
    """
    spark = messages.sparkSession
    sales = open_table(spark, root, WINDOWED_SALES)
    dlq = open_table(spark, root, LATE_EVENTS_DLQ)
    rejects = open_table(spark, root, rejects_of(name))
    fields = pick(ORDER_EVENT, "region", "total_amount", "event_time")

    def write(batch: DataFrame, batch_id: int, writer: str) -> None:
        if sales.committed(writer, batch_id, branch):
            return
        rows = require(decode_events(arrivals(batch), fields), "region", reason=NO_REGION)
        uncountable = F.col("total_amount").isNotNull() & ~is_countable("total_amount")
        rows = mark(rows, uncountable, BAD_AMOUNT).persist()
        closings = None
        try:
            save_rejects(rejects, rejected(rows), writer, batch_id, branch)
            before = sales.high_water_before(writer, batch_id, branch) or LONG_AGO
            good = accepted(rows).withColumn("event_timestamp", at_rest("event_timestamp"))
            # Cached, so that the planner knows the size of this small side.
            closings = late.closing_arrivals(
                good, "event_timestamp", "_seq", size, grace
            ).persist()
            closings.count()
            marked = late.mark_late(
                good, size=size, grace=grace, closings=closings, mark=zoneless(before)
            )
            dlq.append(late.dead_letters(marked), branch, writer=writer, writer_batch=batch_id)
            reached = good.agg(F.max("event_timestamp")).first()[0]
            sales.append(
                late.on_time_sales(marked),
                branch,
                writer=writer,
                writer_batch=batch_id,
                high_water=max(before, reached or before),
            )
        finally:
            rows.unpersist()
            if closings is not None:
                closings.unpersist()

    return start(messages, write, name, checkpoint, interval=interval)

