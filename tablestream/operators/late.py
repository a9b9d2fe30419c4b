"""Allowed lateness and the dead-letter split.

A row is late when an earlier arrival already reached ``window_end + grace``,
where grace is the out-of-order bound plus the allowed lateness. ``arrival`` is
any rising number: a position for per-row lateness, or a batch number when rows
of one batch must not be late against each other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablestream.functions.money import exact_sum
from tablestream.functions.times import (
    earlier,
    floor_micros,
    micros,
    span_micros,
    tumble,
)
from tablestream.schemas import GRACE, WINDOW_SIZE
from tablestream.session import settle


def closing_arrivals(
    events: DataFrame, ts: str, arrival: str, size: str = WINDOW_SIZE, grace: str = GRACE
) -> DataFrame:
    """``_end``, ``closed_at``: the first arrival that closed the window ending
    at ``_end`` microseconds.

    A row closes every window that ends at or before ``ts - grace``, so only the
    last such end matters: the closing arrival of a window is the smallest
    arrival over all ends from its own on. Rows shrink to one per pair of
    (window, end they reach) before any shuffle; what is left grows with the
    time span and not with the number of rows.
    """
    end, reach = F.col("_end"), F.col("_reach")
    when = micros(ts)
    reached = (
        events.where(F.col(ts).isNotNull())
        .select(
            (floor_micros(when, size) + span_micros(size)).alias("_end"),
            floor_micros(when - span_micros(grace), size).alias("_reach"),
            arrival,
        )
        .groupBy("_end", "_reach")
        .agg(F.min(arrival).alias("_first"))
    )
    no_arrival = F.lit(None).cast(events.schema[arrival].dataType)
    ends = (
        reached.select(
            F.inline(
                F.array(
                    F.struct(end.alias("_end"), no_arrival.alias("_first")),
                    F.struct(reach.alias("_end"), F.col("_first").alias("_first")),
                )
            )
        )
        .groupBy("_end")
        .agg(F.min("_first").alias("_first"))
        .withColumn("_day", F.date_from_unix_date((end / span_micros("1 day")).cast("int")))
    )
    # Suffix minimum in two levels: within a day in parallel, then over days.
    from_here_on = Window.partitionBy("_day").orderBy(F.desc("_end"))
    later_days = Window.orderBy(F.desc("_day")).rowsBetween(Window.unboundedPreceding, -1)
    days = (
        ends.groupBy("_day")
        .agg(F.min("_first").alias("_first"))
        .select("_day", F.min("_first").over(later_days).alias("_later"))
    )
    return (
        ends.withColumn("_same_day", F.min("_first").over(from_here_on))
        .join(days, "_day")
        .select("_end", F.least("_same_day", "_later").alias("closed_at"))
        .where(F.col("closed_at").isNotNull())
    )


def mark_late(
    events: DataFrame,
    ts: str = "event_timestamp",
    arrival: str = "_seq",
    size: str = WINDOW_SIZE,
    grace: str = GRACE,
    closings: DataFrame | None = None,
    mark: Column | None = None,
) -> DataFrame:
    """Add ``window_start``, ``window_end`` and ``is_late``; rows without a time are
    left out (``undated`` has them).

    The small closing table is written first, so that the planner knows its
    size: it is broadcast if it is small and the rows are not moved at all. A
    caller that keeps it itself passes it as ``closings``. ``mark`` is the
    high-water mark of arrivals before all of ``events``.
    """
    if closings is None:
        closings = settle(closing_arrivals(events, ts, arrival, size, grace), "closings")
    end = floor_micros(micros(ts), size) + span_micros(size)
    joined = (
        events.where(F.col(ts).isNotNull())
        .withColumn("_end", end)
        .join(closings, "_end", "left")
        .withColumn("is_late", F.coalesce(F.col(arrival) > F.col("closed_at"), F.lit(False)))
        .drop("_end", "closed_at")
    )
    windowed = tumble(joined, ts, size)
    if mark is None:
        return windowed
    before = F.coalesce(F.col("window_end") <= earlier(mark, grace), F.lit(False))
    return windowed.withColumn("is_late", F.col("is_late") | before)


def undated(events: DataFrame, ts: str = "event_timestamp") -> DataFrame:
    """The rows that ``mark_late`` and the windows leave out."""
    return events.where(F.col(ts).isNull())


def on_time_sales(marked: DataFrame, key: str = "region", amount: str = "total_amount") -> DataFrame:
    """Partial sums of the accepted rows; they re-fire a window by adding up."""
    return (
        marked.where(~F.col("is_late"))
        .groupBy("window_start", "window_end", key)
        .agg(exact_sum(amount).alias("total_sales"))
    )


def dead_letters(
    marked: DataFrame, ts: str = "event_timestamp", key: str = "region", amount: str = "total_amount"
) -> DataFrame:
    return marked.where("is_late").select(key, amount, F.col(ts).alias("event_time"))


def high_water(
    events: DataFrame,
    ts: str = "event_timestamp",
    arrival: str = "_seq",
    chunk_bits: int = 16,
    block_bits: int = 16,
) -> DataFrame:
    """Add ``high_water``: the greatest event time among strictly earlier arrivals.

    A running maximum over one global order, in pieces: arrivals fall into
    chunks of ``2**chunk_bits`` numbers, chunks into blocks of ``2**block_bits``
    chunks. Each chunk starts from one carried row with the maximum of all
    earlier chunks, so no task sees more than a chunk, and the only
    unpartitioned window runs over blocks: one per 4e9 arrivals.
    """
    number = F.col(arrival).cast("long")
    chunked = events.withColumn("_chunk", F.shiftright(number, chunk_bits))
    chunks = (
        chunked.groupBy("_chunk")
        .agg(F.max(ts).alias("_max"))
        .withColumn("_block", F.shiftright("_chunk", block_bits))
    )
    before = (Window.unboundedPreceding, -1)
    over_blocks = Window.orderBy("_block").rowsBetween(*before)
    blocks = (
        chunks.groupBy("_block")
        .agg(F.max("_max").alias("_max"))
        .select("_block", F.max("_max").over(over_blocks).alias("_blocks"))
    )
    within = Window.partitionBy("_block").orderBy("_chunk").rowsBetween(*before)
    first_number = F.shiftleft(F.col("_chunk"), chunk_bits)
    carried = (
        chunks.withColumn("_chunks", F.max("_max").over(within))
        # Every block is there; an outer join lets both sides share one scan.
        .join(blocks, "_block", "left")
        .select(
            "_chunk",
            (first_number - 1).cast(events.schema[arrival].dataType).alias(arrival),
            F.greatest("_chunks", "_blocks").alias(ts),
            F.lit(True).alias("_carried"),
        )
        .where(F.col(ts).isNotNull())
    )
    earlier_rows = (
        Window.partitionBy("_chunk")
        .orderBy(arrival)
        .rangeBetween(Window.unboundedPreceding, -1)
    )
    return (
        chunked.withColumn("_carried", F.lit(False))
        .unionByName(carried, allowMissingColumns=True)
        .withColumn("high_water", F.max(ts).over(earlier_rows))
        .where(~F.col("_carried"))
        .drop("_chunk", "_carried")
    )
