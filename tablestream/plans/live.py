"""Checks on a stream: four arrivals of events, each worked off by a restarted query."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablestream.operators import lifecycle, quality
from tablestream.operators.changelog import open_table
from tablestream.operators.seen import SeenKeys
from tablestream.plans.checks import EVENT_STEPS
from tablestream.plans.registry import query
from tablestream.plans.streams import _finish, _run
from tablestream.plans.windows import LATE_SQL
from tablestream.schemas import BIGINT, DOUBLE, TEXT, TIME, TableSpec, columns
from tablestream.session import fresh_path
from tablestream.sources.tables import late_events, table
from tablestream.streaming.run import keyed_writer, start

PARTS = 4
#: A key that is silent for longer starts anew.
TTL = "12 hours"


def arrive(
    spark: SparkSession, events: DataFrame, spec: TableSpec, plan: Callable[[DataFrame], DataFrame], parts: int = PARTS
) -> DataFrame:
    """Send ``events`` in ``parts`` by ``event_id``; the query over them stops after each
    and goes on from its checkpoint. Returns what it has written."""
    root = fresh_path(spark, spec.name)
    inbox, last = f"{root}/inbox", events.agg(F.max("event_id")).first()[0] or 0
    for part in range(parts):
        sent = events.where(F.floor(F.col("event_id") * parts / (last + 1)) == part)
        sent.write.mode("append").parquet(inbox)
        stream = spark.readStream.schema(events.schema).parquet(inbox)
        write = keyed_writer(spark, root, spec, spec.name)
        _run(plan(stream), write, spec.name, root)
    return open_table(spark, root, spec).changes().select(*spec.names)


BAD_STEPS = TableSpec(
    "bad_steps",
    columns(event_id=BIGINT, user_id=BIGINT, previous_status=TEXT, event_type=TEXT),
    ("event_id",),
)


@query(
    "R4",
    """
    WITH allowed(from_status, to_status) AS (VALUES
      ('signup','view'), ('signup','click'), ('view','click'), ('view','view'),
      ('click','purchase'), ('click','view'), ('purchase','view'),
      ('error','view'), ('error','click'), ('error','error')),
    steps AS (
      SELECT event_id, user_id, event_type, ts,
             lag(event_type) OVER w AS previous_status, lag(ts) OVER w AS previous_time
      FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id))
    SELECT event_id, user_id, previous_status, event_type FROM steps
    WHERE previous_status IS NOT NULL AND ts <= previous_time + INTERVAL 12 HOUR AND NOT EXISTS (
      SELECT 1 FROM allowed WHERE from_status = previous_status AND to_status = event_type)
    """,
)
def status_violations_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    def plan(events: DataFrame) -> DataFrame:
        checked = lifecycle.with_last(events, "user_id", "event_type", "ts", "event_id", TTL)
        return lifecycle.violations(checked, "event_type", EVENT_STEPS).select(*BAD_STEPS.names)

    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts")
    return arrive(spark, events, BAD_STEPS, plan)


OVERTAKEN = TableSpec(
    "overtaken",
    columns(event_id=BIGINT, user_id=BIGINT, event_time=TIME, greatest_time=TIME),
    ("event_id",),
)


@query(
    "R5",
    f"""
    WITH {LATE_SQL},
    steps AS (
      SELECT event_id, user_id, event_time, max(event_time) OVER (PARTITION BY user_id
        ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS greatest_time
      FROM shifted)
    SELECT event_id, user_id, event_time, greatest_time FROM steps WHERE event_time < greatest_time
    """,
)
def out_of_order_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    def plan(events: DataFrame) -> DataFrame:
        checked = lifecycle.with_last(events, "user_id", "region", "event_time", "event_id", TTL)
        return lifecycle.behind(checked, "event_time").select(*OVERTAKEN.names)

    events = late_events(spark, sf_dir).select("event_id", "user_id", "region", "event_time")
    return arrive(spark, events, OVERTAKEN, plan)


BURST_SESSIONS = TableSpec(
    "burst_sessions",
    columns(category=TEXT, session_start=TIME, last_event=TIME, n=BIGINT),
    ("category", "session_start"),
)


@query(
    "R8 T1",
    """
    WITH gaps AS (
      SELECT event_type AS category, ts,
             CASE WHEN ts <= lag(ts) OVER w + INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS opens
      FROM events WINDOW w AS (PARTITION BY event_type ORDER BY ts)),
    numbered AS (
      SELECT *, sum(opens) OVER (PARTITION BY category ORDER BY ts) AS session FROM gaps),
    sessions AS (
      SELECT category, min(ts) AS session_start, max(ts) AS last_event, count(*) AS n
      FROM numbered GROUP BY category, session)
    SELECT * FROM sessions
    WHERE n >= 4 AND last_event + INTERVAL 30 MINUTE
                     < (SELECT date_trunc('millisecond', max(ts)) - INTERVAL 5 SECOND FROM events)
    """,
)
def session_bursts_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions in the state store, each told once the watermark has closed it."""

    def plan(events: DataFrame) -> DataFrame:
        timed = events.withColumn("event_timestamp", F.col("ts").cast("timestamp"))
        found = quality.session_bursts_stream(
            timed, "event_timestamp", "category", "30 minutes", least=4, delay="5 seconds"
        )
        return found.select(*BURST_SESSIONS.names)

    events = table(spark, sf_dir, "events").select("event_id", "ts", F.col("event_type").alias("category"))
    return arrive(spark, events, BURST_SESSIONS, plan)


FIRST_EVENTS = TableSpec(
    "first_events_ever",
    columns(event_id=BIGINT, event_type=TEXT, value=DOUBLE),
    ("event_id",),
)


@query("R3 K4", "SELECT event_id, event_type, value FROM events")
def dedup_any_time_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each arrival repeats the one before, a week of event time earlier, and itself."""
    root = fresh_path(spark, "first-events")
    inbox = f"{root}/inbox"
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    key = columns(event_id=BIGINT)
    seen = SeenKeys(spark, f"{root}/seen", key, bits=1 << 22, buckets=8)
    store = keyed_writer(spark, root, FIRST_EVENTS, FIRST_EVENTS.name)

    def write(batch: DataFrame, batch_id: int, writer: str) -> None:
        store(seen.accept(batch, batch_id, ["sent"]).drop("sent"), batch_id, writer)

    last = events.agg(F.max("event_id")).first()[0] or 0
    part = F.floor(F.col("event_id") * PARTS / (last + 1))
    shape = events.withColumn("sent", F.lit(0)).schema
    for turn in range(PARTS):
        sent = events.where(part.isin(turn, turn - 1))
        twice = sent.withColumn("sent", F.lit(2 * turn)).unionByName(sent.withColumn("sent", F.lit(2 * turn + 1)))
        twice.write.mode("append").parquet(inbox)
        stream = spark.readStream.schema(shape).parquet(inbox)
        _finish(start(stream, write, FIRST_EVENTS.name, f"{root}/progress", interval=None))
    return open_table(spark, root, FIRST_EVENTS).changes().select(*FIRST_EVENTS.names)
