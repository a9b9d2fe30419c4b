"""Event-time marks of a source that is read by partition.

Each partition of a topic has a high-water mark of its own, the greatest event time
it has brought so far. The common mark is the least of them: a slow partition holds it
back, so its rows are not late because others ran ahead. Before every partition has
brought a row there is no common mark.

``arrival`` is one rising number over all partitions, ``partition`` a row's partition;
a topic has a fixed, small number of them, which the caller names or the data tell.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablestream.functions.times import floor_micros, micros, span_micros
from tablestream.schemas import GRACE, WINDOW_SIZE

#: A topic with more partitions needs marks kept by its reader.
MOST_PARTITIONS = 1024


def arrival_number(offset: Column | str, partition: Column | str, partitions: int) -> Column:
    """Offsets of all partitions as one dense order, by offset and then partition."""
    offset = F.col(offset) if isinstance(offset, str) else offset
    partition = F.col(partition) if isinstance(partition, str) else partition
    return offset.cast("bigint") * F.lit(partitions) + partition.cast("bigint")


def partitions_of(events: DataFrame, partition: str) -> list[int]:
    """The partitions that occur; fails where there are too many to be a topic's."""
    found = events.select(partition).where(F.col(partition).isNotNull()).distinct()
    found = [r[0] for r in found.orderBy(partition).limit(MOST_PARTITIONS + 1).collect()]
    if len(found) > MOST_PARTITIONS:
        raise ValueError(f"more than {MOST_PARTITIONS} partitions in {partition}")
    return found


def common_high_water(
    events: DataFrame,
    ts: str,
    arrival: str,
    partition: str,
    partitions: Sequence[int] | None = None,
    chunk_bits: int = 16,
    block_bits: int = 16,
) -> DataFrame:
    """Add ``high_water``: the common mark of all strictly earlier arrivals.

    Arrivals fall into chunks of ``2**chunk_bits`` numbers. Each chunk starts from the
    marks of all partitions at its beginning, one row per chunk that holds them as
    columns, so that no task sees more than a chunk; with dense numbers the count of
    chunks follows the rows. Chunks are put in order in two levels, and the only
    window without a key has one row per 4e9 arrivals.
    """
    known = partitions_of(events, partition) if partitions is None else list(partitions)
    if not known:
        return events.withColumn("high_water", F.lit(None).cast(events.schema[ts].dataType))
    marks = [f"_m{i}" for i in range(len(known))]
    own = [F.when(F.col(partition) == F.lit(p), F.col(ts)) for p in known]
    chunked = events.withColumn("_chunk", F.shiftright(F.col(arrival).cast("long"), chunk_bits))
    chunks = (
        chunked.groupBy("_chunk")
        .agg(*[F.max(c).alias(m) for m, c in zip(marks, own)])
        .withColumn("_block", F.shiftright("_chunk", block_bits))
    )
    before = (Window.unboundedPreceding, -1)
    over_blocks = Window.orderBy("_block").rowsBetween(*before)
    blocks = (
        chunks.groupBy("_block")
        .agg(*[F.max(m).alias(m) for m in marks])
        .select("_block", *[F.max(m).over(over_blocks).alias(f"{m}_blocks") for m in marks])
    )
    within = Window.partitionBy("_block").orderBy("_chunk").rowsBetween(*before)
    carried = (
        chunks.select("_chunk", "_block", *[F.max(m).over(within).alias(m) for m in marks])
        .join(blocks, "_block")
        .select("_chunk", *[_later(F.col(m), F.col(f"{m}_blocks")).alias(f"{m}_carried") for m in marks])
    )
    earlier = Window.partitionBy("_chunk").orderBy(arrival).rangeBetween(Window.unboundedPreceding, -1)
    rows = chunked.join(carried, "_chunk").withColumns({m: F.max(c).over(earlier) for m, c in zip(marks, own)})
    now = [_later(F.col(m), F.col(f"{m}_carried")) for m in marks]
    return rows.withColumn("high_water", _least(now)).select(*events.columns, "high_water")


def _later(a: Column, b: Column) -> Column:
    return F.greatest(a, b)


def _least(marks: list[Column]) -> Column:
    """The least mark; NULL while one is missing."""
    every = marks[0].isNotNull()
    for m in marks[1:]:
        every = every & m.isNotNull()
    return F.when(every, marks[0] if len(marks) == 1 else F.least(*marks))


def common_closings(
    events: DataFrame,
    ts: str,
    arrival: str,
    partition: str,
    size: str = WINDOW_SIZE,
    grace: str = GRACE,
    partitions: Sequence[int] | None = None,
) -> DataFrame:
    """``_end``, ``closed_at``: the first arrival by which every partition had passed
    the window that ends at ``_end`` microseconds; the ``closings`` of ``mark_late``.

    The common mark reaches a time when the last partition does. So each partition
    closes windows on its own, as one order does, and the latest closing counts; a
    window that some partition has not passed is open. Rows shrink to one per
    partition, window and furthest window they close before any shuffle.
    """
    known = partitions_of(events, partition) if partitions is None else list(partitions)
    end, reach, first = F.col("_end"), F.col("_reach"), F.col("_first")
    when = micros(ts)
    kind = events.schema[arrival].dataType
    if not known:
        return events.select(F.lit(0).cast("bigint").alias("_end"), F.col(arrival).alias("closed_at")).limit(0)
    reached = (
        events.where(F.col(ts).isNotNull() & F.col(partition).isin(*known))
        .select(
            F.col(partition).alias("_partition"),
            (floor_micros(when, size) + span_micros(size)).alias("_end"),
            floor_micros(when - span_micros(grace), size).alias("_reach"),
            F.col(arrival).alias("_arrival"),
        )
        .groupBy("_partition", "_end", "_reach")
        .agg(F.min("_arrival").alias("_first"))
    )
    # Every window is asked of every partition; what each reaches is its own.
    asked = reached.select(end).distinct().select(
        F.explode(F.array(*[F.lit(p).cast(events.schema[partition].dataType) for p in known])).alias("_partition"), end, F.lit(None).cast(kind).alias("_first")
    )
    own = reached.groupBy("_partition", reach.alias("_end")).agg(F.min(first).alias("_first"))
    steps = (
        asked.unionByName(own)
        .groupBy("_partition", "_end")
        .agg(F.min("_first").alias("_first"))
        .withColumn("_day", F.date_from_unix_date((end / span_micros("1 day")).cast("int")))
    )
    # The first arrival at or beyond each window: within a day, then over later days.
    from_here_on = Window.partitionBy("_partition", "_day").orderBy(F.desc("_end"))
    later_days = Window.partitionBy("_partition").orderBy(F.desc("_day")).rowsBetween(Window.unboundedPreceding, -1)
    days = (
        steps.groupBy("_partition", "_day")
        .agg(F.min("_first").alias("_day_first"))
        .select("_partition", "_day", F.min("_day_first").over(later_days).alias("_later"))
    )
    closed = steps.withColumn("_same_day", F.min("_first").over(from_here_on)).join(days, ["_partition", "_day"])
    return (
        closed.select("_end", F.least("_same_day", "_later").alias("_closed"))
        .groupBy("_end")
        .agg(F.max("_closed").alias("closed_at"), F.count("_closed").alias("_passed"))
        .where(F.col("_passed") == len(known))
        .select("_end", "closed_at")
    )
