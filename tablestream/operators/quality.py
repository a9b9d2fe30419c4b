"""Quality and behaviour checks over event tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablestream.functions.money import discounted, money
from tablestream.functions.times import micros, span_micros
from tablestream.operators.keyed import first_per_key, last_per_key
from tablestream.operators.lookup import lookup
from tablestream.operators.sequence import HOT_ROWS, with_previous
from tablestream.schemas import (
    BURST_EVENTS,
    BURST_WINDOW,
    HIGH_VALUE,
    STATUS_TRANSITIONS,
    TERMINAL_STATUSES,
    WINDOW_SIZE,
)

# -- lateness ---------------------------------------------------------------


def with_delay(events: DataFrame, ts: str, reached: str) -> DataFrame:
    """Add ``delay_sec``: how far the event lies behind ``reached``.

    ``reached`` is the high-water mark, or the ingestion time of streams that
    carry one. NULL for the first arrival, which lies behind nothing.
    """
    behind = F.unix_micros(F.col(reached).cast("timestamp")) - F.unix_micros(
        F.col(ts).cast("timestamp")
    )
    return events.withColumn("delay_sec", behind / F.lit(1_000_000))


def lateness_profile(delayed: DataFrame) -> DataFrame:
    """Totals and delay statistics; a row is late when its delay is positive."""
    late = F.when(F.col("delay_sec") > 0, F.col("delay_sec"))
    return delayed.agg(
        F.count(F.lit(1)).alias("total_events"),
        F.count(late).alias("late_events"),
        F.sum(F.round(late * 1_000_000).cast("decimal(38,0)")).alias("_micros"),
        F.min(late).alias("min_delay_sec"),
        F.max(late).alias("max_delay_sec"),
    ).select(
        "total_events",
        "late_events",
        F.when(F.col("total_events") > 0, 100 * F.col("late_events") / F.col("total_events"))
        .otherwise(0.0)
        .alias("late_pct"),
        F.when(
            F.col("late_events") > 0,
            F.col("_micros").cast("double") / F.col("late_events") / 1_000_000,
        )
        .otherwise(0.0)
        .alias("avg_delay_sec"),
        F.coalesce("min_delay_sec", F.lit(0.0)).alias("min_delay_sec"),
        F.coalesce("max_delay_sec", F.lit(0.0)).alias("max_delay_sec"),
    )


def delay_bucket(delay: Column, step: int = 30) -> Column:
    """Four buckets of ``step`` seconds and an open one; lower bounds included."""
    bounds = [step * i for i in range(1, 5)]
    bucket, low = None, 0
    for high in bounds:
        label = F.lit(f"{low}-{high}s")
        bucket = F.when(delay < high, label) if bucket is None else bucket.when(delay < high, label)
        low = high
    return bucket.otherwise(F.lit(f"{bounds[-1]}s+"))


def delay_histogram(delayed: DataFrame, step: int = 30) -> DataFrame:
    return (
        delayed.where("delay_sec > 0")
        .groupBy(delay_bucket(F.col("delay_sec"), step).alias("bucket"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def late_by(delayed: DataFrame, key: str = "region") -> DataFrame:
    return delayed.where("delay_sec > 0").groupBy(key).agg(F.count(F.lit(1)).alias("late_events"))


# -- duplicates -------------------------------------------------------------


def deduplicate(events: DataFrame, key: Sequence[str], arrival: Sequence[str]) -> DataFrame:
    """Keep the first arrival per key."""
    return first_per_key(events, key, arrival)


def deduplicate_stream(events: DataFrame, key: Sequence[str], ts: str, delay: str) -> DataFrame:
    """Keep one arrival per key; the state of a key ends ``delay`` after its time."""
    return events.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(key))


def repeated_keys(events: DataFrame, key: Sequence[str]) -> DataFrame:
    return events.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


# -- order lifecycle --------------------------------------------------------


def transition_table(spark: SparkSession, transitions: dict[str, list[str]]) -> DataFrame:
    pairs = [(a, b) for a, nexts in transitions.items() for b in nexts]
    return spark.createDataFrame(pairs, "from_status string, to_status string")


def status_violations(
    events: DataFrame,
    key: str,
    status: str,
    order: Sequence[str],
    transitions: dict[str, list[str]] = STATUS_TRANSITIONS,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Events whose step from the previous status of their key is not allowed."""
    allowed = transition_table(events.sparkSession, transitions)
    steps = with_previous(
        events, [key], order, {"previous_status": status}, hot_rows
    ).where(F.col("previous_status").isNotNull())
    known = (F.col("previous_status") == F.col("from_status")) & (
        F.col(status) == F.col("to_status")
    )
    return steps.join(F.broadcast(allowed), known, "left_anti")


def out_of_order(
    events: DataFrame,
    key: str,
    ts: str,
    arrival: Sequence[str],
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Events that arrived after one of the same key with a later event time."""
    seen = with_previous(events, [key], arrival, {"previous_time": ts}, hot_rows)
    return seen.where(F.col(ts) < F.col("previous_time"))


def current_status(
    events: DataFrame,
    key: str,
    status: str,
    order: Sequence[str],
    terminal: Sequence[str] = TERMINAL_STATUSES,
) -> DataFrame:
    return last_per_key(events.select(key, status, *order), [key], order).select(
        key, status, (~F.col(status).isin(*terminal)).alias("is_open")
    )


# -- amounts ----------------------------------------------------------------


def high_value(events: DataFrame, amount: str = "total_amount", least: float = HIGH_VALUE) -> DataFrame:
    return events.where(F.col(amount) >= least)


def price_mismatches(
    events: DataFrame,
    products: DataFrame,
    product: str = "product_id",
    base: str = "base_price",
    unit: str = "unit_price",
    quantity: str = "quantity",
    discount: str = "discount_pct",
    total: str = "total_amount",
) -> DataFrame:
    """Events whose prices do not follow from the product's base price.

    The unit price must lie within half a cent of the discounted base, which
    accepts either rounding of an exact half; the total must be unit times
    quantity to the cent. An unknown product or a missing value is a mismatch.
    """
    priced = lookup(events, products.select(product, base), product)
    off = F.abs(money(unit) - discounted(base, discount))
    right = (off <= F.lit("0.005").cast("decimal(4,3)")) & (
        money(total) == money(unit) * F.col(quantity).cast("decimal(10,0)")
    )
    return priced.where(~F.coalesce(right, F.lit(False)))


# -- traffic ----------------------------------------------------------------


def bursts(
    events: DataFrame,
    ts: str = "event_timestamp",
    key: str = "category",
    size: str = BURST_WINDOW,
    least: int = BURST_EVENTS,
) -> DataFrame:
    """Windows in which a key has at least ``least`` events."""
    return (
        events.groupBy(F.window(ts, size).alias("_w"), key)
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") >= least)
        .select(F.col("_w.start").alias("window_start"), key, "n")
    )


def sliding_bursts(
    events: DataFrame,
    ts: str = "event_timestamp",
    key: str = "category",
    span: str = BURST_WINDOW,
    least: int = BURST_EVENTS,
    spans_per_slice: int = 64,
) -> DataFrame:
    """Instants that end a ``span`` with at least ``least`` events of a key, both ends
    included, with the number ``n`` and the time of the first of them, ``since``.

    Unlike ``bursts``, no boundary of a window can cut a burst. Events of one instant
    are first one row. Time is cut into slices for every key alike, so that a hot key
    is many tasks; the last ``span`` of a slice is carried into the next one, where it
    counts and is not reported.

    An instant comes twice in its slice: when it enters the span, and one microsecond
    after it has left it. Running sums over both give ``n``, and the instant after the
    last that left is ``since``, so the work does not grow with the events in a span.
    """
    wide = span_micros(span)
    slice_ = wide * spans_per_slice
    instants = (
        events.where(F.col(ts).isNotNull())
        .groupBy(key, ts)
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_at", micros(ts))
    )
    instants = instants.withColumn("_slice", F.expr(f"(_at - pmod(_at, {slice_})) div {slice_}"))
    tail = F.col("_at") >= (F.col("_slice") + 1) * slice_ - wide
    here = F.struct(F.col("_slice"), F.lit(False).alias("_carried"))
    there = F.struct((F.col("_slice") + 1).alias("_slice"), F.lit(True).alias("_carried"))
    copies = F.inline(F.when(tail, F.array(here, there)).otherwise(F.array(here)))
    in_slice = Window.partitionBy(key, "_slice").orderBy("_at")
    # What enters at an instant counts at it; what has left before is gone by then.
    along = Window.partitionBy(key, "_slice").orderBy("_when", "_enters").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    enters = F.struct(
        F.col("_at").alias("_when"), F.lit(True).alias("_enters"), F.col("_n").alias("_change"),
        F.lit(None).cast(events.schema[ts].dataType).alias("_first"),
    )
    leaves = F.struct(
        (F.col("_at") + wide + 1).alias("_when"), F.lit(False).alias("_enters"), (-F.col("_n")).alias("_change"),
        F.col("_next").alias("_first"),
    )
    return (
        instants.select(key, ts, "_at", "_n", copies)
        .withColumn("_next", F.lead(ts).over(in_slice))
        .select(key, ts, "_slice", "_carried", F.inline(F.array(enters, leaves)))
        .withColumns(
            {
                "n": F.sum("_change").over(along),
                "since": F.coalesce(F.max("_first").over(along), F.min(ts).over(along)),
            }
        )
        .where(F.col("_enters") & ~F.col("_carried") & (F.col("n") >= least))
        .select(key, F.col(ts).alias("until"), "since", "n")
    )


def session_bursts(
    events: DataFrame,
    ts: str = "event_timestamp",
    key: str = "category",
    gap: str = BURST_WINDOW,
    least: int = BURST_EVENTS,
) -> DataFrame:
    """Sessions of a key, split by silence longer than ``gap``, with enough events.

    Rows first shrink to one per key and ``gap``-wide bucket: neighbours inside
    a bucket are closer than the gap, so they are always of one session. Only
    the buckets, whose number follows the time span, are put in order.
    """
    buckets = (
        events.groupBy(F.window(ts, gap).alias("_w"), key)
        .agg(F.count(F.lit(1)).alias("_n"), F.min(ts).alias("_lo"), F.max(ts).alias("_hi"))
        .withColumn("_at", F.col("_w.start"))
    )
    along = Window.partitionBy(key).orderBy("_at")
    silence = F.col("_lo") > F.lag("_hi").over(along) + F.expr(f"INTERVAL {gap}")
    marked = buckets.withColumn("_new", F.coalesce(silence, F.lit(True)).cast("long"))
    return (
        marked.withColumn("_session", F.sum("_new").over(along))
        .groupBy(key, "_session")
        .agg(
            F.min("_lo").alias("session_start"),
            F.max("_hi").alias("last_event"),
            F.sum("_n").alias("n"),
        )
        .where(F.col("n") >= least)
        .drop("_session")
    )


def session_bursts_stream(
    events: DataFrame, ts: str, key: str, gap: str, least: int, delay: str
) -> DataFrame:
    """``session_bursts`` on a stream: a session is told once the watermark closes it.

    Spark ends a session ``gap`` after its last event, that instant excluded; a silence
    of exactly ``gap`` is still one session, as in the batch form.
    """
    return (
        events.withWatermark(ts, delay)
        .groupBy(F.session_window(ts, f"{gap} 1 microsecond").alias("_s"), key)
        .agg(F.count(F.lit(1)).alias("n"), F.max(ts).alias("last_event"))
        .where(F.col("n") >= least)
        .select(key, F.col("_s.start").alias("session_start"), "last_event", "n")
    )


def region_share(
    events: DataFrame, ts: str = "event_timestamp", key: str = "region", size: str = WINDOW_SIZE
) -> DataFrame:
    """Each key's share of its window's events."""
    counts = events.groupBy(F.window(ts, size).alias("_w"), key).agg(F.count(F.lit(1)).alias("n"))
    whole = Window.partitionBy("_w")
    return counts.select(
        F.col("_w.start").alias("window_start"),
        key,
        "n",
        (F.col("n") / F.sum("n").over(whole)).alias("share"),
    )
