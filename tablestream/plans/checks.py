"""Quality checks over the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablestream.operators import partitions, quality
from tablestream.operators.late import high_water, mark_late
from tablestream.plans.registry import query
from tablestream.plans.windows import HOURLY, HOURLY_GRACE, LATE_SQL, LINES_SQL, MONTHLY
from tablestream.session import settle
from tablestream.sources.tables import LINE_KEY, LINE_ORDER, late_events, order_lines, table

DELAY_SQL = f"""
{LATE_SQL},
delayed AS (
  SELECT *, (epoch_us(high_water) - epoch_us(event_time)) / 1000000 AS delay_sec FROM arrivals
)
"""


def _delayed(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = high_water(late_events(spark, sf_dir), "event_time", "event_id")
    return quality.with_delay(rows, "event_time", "high_water")


@query(
    "R1",
    f"""
    WITH {DELAY_SQL}
    SELECT count(*) AS total_events,
           count(*) FILTER (delay_sec > 0) AS late_events,
           100 * (count(*) FILTER (delay_sec > 0)) / count(*) AS late_pct,
           CAST(sum(epoch_us(high_water) - epoch_us(event_time)) FILTER (delay_sec > 0) AS DOUBLE)
             / (count(*) FILTER (delay_sec > 0)) / 1000000 AS avg_delay_sec,
           min(delay_sec) FILTER (delay_sec > 0) AS min_delay_sec,
           max(delay_sec) FILTER (delay_sec > 0) AS max_delay_sec
    FROM delayed
    """,
)
def lateness_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.lateness_profile(_delayed(spark, sf_dir))


@query(
    "R2",
    f"""
    WITH {DELAY_SQL}
    SELECT CASE WHEN delay_sec < 1800 THEN '0-1800s' WHEN delay_sec < 3600 THEN '1800-3600s'
                WHEN delay_sec < 5400 THEN '3600-5400s' WHEN delay_sec < 7200 THEN '5400-7200s'
                ELSE '7200s+' END AS bucket, count(*) AS n
    FROM delayed WHERE delay_sec > 0 GROUP BY 1
    """,
)
def delay_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.delay_histogram(_delayed(spark, sf_dir), step=1800)


@query(
    "R2",
    f"""
    WITH {DELAY_SQL}
    SELECT region, count(*) AS late_events FROM delayed WHERE delay_sec > 0 GROUP BY 1
    """,
)
def late_by_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.late_by(_delayed(spark, sf_dir))


#: Events as the messages of a topic with four partitions, dealt by user; offsets of the
#: partitions interleave and begin at different numbers.
PARTITIONS = 4
PARTITIONED_SQL = f"""
{LATE_SQL},
messages AS (
  SELECT *, user_id % {PARTITIONS} AS part,
         (event_id + user_id % {PARTITIONS} * 37) * {PARTITIONS} + user_id % {PARTITIONS} AS arrival
  FROM shifted
),
own AS (
  SELECT *, {", ".join(
      f"max(event_time) FILTER (part = {p}) OVER (ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS m{p}"
      for p in range(PARTITIONS))}
  FROM messages
),
common AS (
  SELECT *, CASE WHEN {" AND ".join(f"m{p} IS NOT NULL" for p in range(PARTITIONS))}
            THEN least({", ".join(f"m{p}" for p in range(PARTITIONS))}) END AS mark
  FROM own
),
behind AS (SELECT *, (epoch_us(mark) - epoch_us(event_time)) / 1000000 AS delay_sec FROM common)
"""


def _messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = F.col("user_id") % PARTITIONS
    offset = F.col("event_id") + part * 37
    return late_events(spark, sf_dir).withColumns(
        {"part": part, "arrival": partitions.arrival_number(offset, part, PARTITIONS)}
    )


def _behind(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = partitions.common_high_water(_messages(spark, sf_dir), "event_time", "arrival", "part")
    return quality.with_delay(marked, "event_time", "high_water")


@query(
    "R1 S1",
    f"""
    WITH {PARTITIONED_SQL}
    SELECT count(*) AS total_events,
           count(*) FILTER (delay_sec > 0) AS late_events,
           100 * (count(*) FILTER (delay_sec > 0)) / count(*) AS late_pct,
           CAST(sum(epoch_us(mark) - epoch_us(event_time)) FILTER (delay_sec > 0) AS DOUBLE)
             / (count(*) FILTER (delay_sec > 0)) / 1000000 AS avg_delay_sec,
           min(delay_sec) FILTER (delay_sec > 0) AS min_delay_sec,
           max(delay_sec) FILTER (delay_sec > 0) AS max_delay_sec
    FROM behind
    """,
)
def partitioned_lateness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delays behind the least of the partitions' marks."""
    return quality.lateness_profile(_behind(spark, sf_dir))


@query(
    "R2",
    f"""
    WITH {PARTITIONED_SQL}
    SELECT CASE WHEN delay_sec < 1800 THEN '0-1800s' WHEN delay_sec < 3600 THEN '1800-3600s'
                WHEN delay_sec < 5400 THEN '3600-5400s' WHEN delay_sec < 7200 THEN '5400-7200s'
                ELSE '7200s+' END AS bucket, count(*) AS n
    FROM behind WHERE delay_sec > 0 GROUP BY 1
    """,
)
def partitioned_delays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.delay_histogram(_behind(spark, sf_dir), step=1800)


@query(
    "T2 T4 T5",
    f"""
    WITH {PARTITIONED_SQL}
    SELECT event_id, region, total_amount, event_time,
           coalesce(date_trunc('hour', event_time) + INTERVAL 1 HOUR + INTERVAL 65 MINUTE <= mark, false) AS is_late
    FROM behind
    """,
)
def partitioned_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which rows come after every partition had passed their window and the grace."""
    rows = _messages(spark, sf_dir)
    closings = settle(
        partitions.common_closings(rows, "event_time", "arrival", "part", HOURLY, HOURLY_GRACE), "closings"
    )
    marked = mark_late(rows, "event_time", "arrival", HOURLY, HOURLY_GRACE, closings=closings)
    return marked.select("event_id", "region", "total_amount", "event_time", "is_late")


@query(
    "R3",
    f"""
    WITH {LINES_SQL}
    SELECT event_id, order_id, line, product_id, supplier_id, total_amount, event_time FROM (
      SELECT *, row_number() OVER (PARTITION BY order_id, line
        ORDER BY event_time, product_id, supplier_id) AS rn FROM lines)
    WHERE rn = 1
    """,
)
def dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = order_lines(spark, sf_dir).select(
        "event_id", "order_id", "line", "product_id", "supplier_id", "total_amount", "event_time"
    )
    return quality.deduplicate(lines, LINE_KEY, LINE_ORDER)


@query(
    "R3",
    """
    SELECT l_orderkey AS order_id, l_linenumber AS line, count(*) AS n
    FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1
    """,
)
def duplicate_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.repeated_keys(order_lines(spark, sf_dir), LINE_KEY)


#: Steps a user may take between kinds of events.
EVENT_STEPS = {
    "signup": ["view", "click"],
    "view": ["click", "view"],
    "click": ["purchase", "view"],
    "purchase": ["view"],
    "error": ["view", "click", "error"],
}


@query(
    "R4",
    """
    WITH allowed(from_status, to_status) AS (VALUES
      ('signup','view'), ('signup','click'), ('view','click'), ('view','view'),
      ('click','purchase'), ('click','view'), ('purchase','view'),
      ('error','view'), ('error','click'), ('error','error')),
    steps AS (
      SELECT event_id, user_id, event_type, ts,
             lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS previous_status
      FROM events)
    SELECT event_id, user_id, previous_status, event_type FROM steps
    WHERE previous_status IS NOT NULL AND NOT EXISTS (
      SELECT 1 FROM allowed WHERE from_status = previous_status AND to_status = event_type)
    """,
)
def status_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts")
    return quality.status_violations(
        events,
        "user_id",
        "event_type",
        ["ts", "event_id"],
        transitions=EVENT_STEPS,
    ).select("event_id", "user_id", "previous_status", "event_type")


@query(
    "R5",
    f"""
    WITH {LATE_SQL},
    steps AS (SELECT *, lag(event_time) OVER (PARTITION BY user_id ORDER BY event_id) AS previous_time
              FROM shifted)
    SELECT event_id, user_id, event_time, previous_time FROM steps WHERE event_time < previous_time
    """,
)
def out_of_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = late_events(spark, sf_dir).select("event_id", "user_id", "event_time")
    return quality.out_of_order(
        events,
        "user_id",
        "event_time",
        ["event_id"],
    )


@query(
    "R6",
    """
    SELECT user_id, event_type, event_type NOT IN ('purchase', 'error') AS is_open FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
      FROM events) WHERE rn = 1
    """,
)
def current_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.current_status(
        table(spark, sf_dir, "events"),
        "user_id",
        "event_type",
        ["ts", "event_id"],
        terminal=["purchase", "error"],
    )


@query(
    "R7 P6",
    """
    SELECT l_orderkey AS order_id, l_linenumber AS line, l_partkey AS product_id,
           l_extendedprice AS total_amount
    FROM lineitem WHERE l_extendedprice >= 50000
    """,
)
def high_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.high_value(order_lines(spark, sf_dir), least=50_000).select(
        "order_id", "line", "product_id", "total_amount"
    )


@query(
    "R8",
    """
    SELECT date_trunc('hour', ts) AS window_start, event_type AS category, count(*) AS n
    FROM events GROUP BY 1, 2 HAVING count(*) >= 5
    """,
)
def bursts(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").withColumnRenamed("event_type", "category")
    return quality.bursts(events, "ts", size=HOURLY, least=5)


@query(
    "R8",
    """
    WITH counted AS (
      SELECT event_type AS category, ts AS until, min(ts) OVER w AS since, count(*) OVER w AS n
      FROM events
      WINDOW w AS (PARTITION BY event_type ORDER BY ts RANGE BETWEEN INTERVAL 1 HOUR PRECEDING AND CURRENT ROW))
    SELECT DISTINCT category, until, since, n FROM counted WHERE n >= 6
    """,
)
def sliding_bursts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six events of a kind within any hour, wherever it begins."""
    events = table(spark, sf_dir, "events").withColumnRenamed("event_type", "category")
    return quality.sliding_bursts(events, "ts", span=HOURLY, least=6)


@query(
    "R8",
    """
    WITH gaps AS (
      SELECT event_type AS category, ts,
             CASE WHEN ts <= lag(ts) OVER w + INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS opens
      FROM events WINDOW w AS (PARTITION BY event_type ORDER BY ts)),
    numbered AS (
      SELECT *, sum(opens) OVER (PARTITION BY category ORDER BY ts) AS session FROM gaps)
    SELECT category, min(ts) AS session_start, max(ts) AS last_event, count(*) AS n
    FROM numbered GROUP BY category, session HAVING count(*) >= 4
    """,
)
def session_bursts(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").withColumnRenamed("event_type", "category")
    return quality.session_bursts(events, "ts", gap="30 minutes", least=4)


@query(
    "R9",
    f"""
    WITH {LINES_SQL},
    counts AS (
      SELECT time_bucket(INTERVAL 30 DAY, event_time, TIMESTAMP '1970-01-01') AS window_start,
             region, count(*) AS n
      FROM lines JOIN order_regions USING (order_id) GROUP BY 1, 2)
    SELECT *, n / CAST(sum(n) OVER (PARTITION BY window_start) AS BIGINT) AS share FROM counts
    """,
)
def region_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.region_share(order_lines(spark, sf_dir, with_order=True), "event_time", size=MONTHLY)


@query(
    "R10 F12",
    """
    SELECT l_orderkey AS order_id, l_linenumber AS line, l_partkey AS product_id,
           l_suppkey AS supplier_id, l_extendedprice AS total_amount
    FROM lineitem LEFT JOIN part ON l_partkey = p_partkey
    WHERE NOT coalesce(
      abs(CAST(l_extendedprice / l_quantity AS DECIMAL(18,2))
          - CAST(p_retailprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(5,4)))) <= 0.005
      AND CAST(l_extendedprice AS DECIMAL(18,2))
          = CAST(l_extendedprice / l_quantity AS DECIMAL(18,2)) * CAST(l_quantity AS INTEGER), false)
    """,
)
def price_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    products = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"), F.col("p_retailprice").alias("base_price")
    )
    return quality.price_mismatches(order_lines(spark, sf_dir), products).select(
        "order_id", "line", "product_id", "supplier_id", "total_amount"
    )
