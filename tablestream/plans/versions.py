"""Keyed tables, versions, branches and compaction over the test tables.

Order lines are the changes: an order line comes several times, and its ship
month is the version it came with. The first group of queries applies the
changelog algebra to them directly; the second writes real tables to the shared
folder and reads them back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablestream.operators import keyed, late
from tablestream.operators.changelog import EventTable, open_table
from tablestream.operators.maintain import compact
from tablestream.operators.publish import PublishRefused, audited_publish, diff, publish
from tablestream.operators.windows import row_count, window_sales
from tablestream.plans.registry import query
from tablestream.plans.windows import HOURLY, HOURLY_GRACE, LATE_SQL, LINES_SQL, MONTHLY
from tablestream.schemas import (
    BIGINT,
    DOUBLE,
    INT,
    LATE_EVENTS_DLQ,
    TIME,
    WINDOWED_SALES,
    TableSpec,
    columns,
)
from tablestream.session import fresh_path
from tablestream.sources.days import write_by_day
from tablestream.sources.tables import (
    LINE_KEY,
    LINE_ORDER,
    late_events,
    line_changes,
    order_lines,
    table,
)

VERSION = 40
COLUMNS = ["order_id", "line", "product_id", "supplier_id", "total_amount", "event_time"]

CHANGES_SQL = f"""
{LINES_SQL},
changes AS (
  SELECT *, (year(event_time) - 1995) * 12 + month(event_time) - 1 AS batch_id FROM lines
)
"""


def _latest_sql(source: str, where: str = "true", order: str = "batch_id DESC") -> str:
    return f"""
    SELECT order_id, line, product_id, supplier_id, total_amount, event_time FROM (
      SELECT *, row_number() OVER (PARTITION BY order_id, line
        ORDER BY {order}, event_time DESC, product_id DESC, supplier_id DESC) AS rn
      FROM {source} WHERE {where}) WHERE rn = 1
    """


def _order(*first: str) -> tuple[str, ...]:
    return (*first, "batch_id", *LINE_ORDER)


# -- changelog algebra -------------------------------------------------------


@query("K1 S5", f"WITH {CHANGES_SQL} {_latest_sql('changes')}")
def bronze_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = line_changes(spark, sf_dir).select(*COLUMNS, "batch_id")
    return keyed.current_state(changes, LINE_KEY, _order())


@query("S7", f"WITH {CHANGES_SQL} {_latest_sql('changes', f'batch_id <= {VERSION}')}")
def as_of_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = line_changes(spark, sf_dir).select(*COLUMNS, "batch_id")
    return keyed.current_state(keyed.as_of(changes, VERSION), LINE_KEY, _order())


@query(
    "S6 L2",
    f"""
    WITH {CHANGES_SQL}
    SELECT batch_id, count(*) AS rows, count(DISTINCT (order_id, line)) AS keys,
           min(event_time) AS min_event_time, max(event_time) AS max_event_time
    FROM changes GROUP BY 1 ORDER BY batch_id DESC
    """,
)
def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = keyed.version_log(line_changes(spark, sf_dir), LINE_KEY, "event_time")
    return log.orderBy(F.desc("batch_id"))


@query(
    "S9",
    f"WITH {CHANGES_SQL} SELECT CAST(max(batch_id) AS BIGINT) AS latest_version FROM changes",
)
def latest_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_changes(spark, sf_dir).agg(F.max("batch_id").alias("latest_version"))


@query(
    "A3",
    "SELECT count(*) AS total_events FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)",
)
def total_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return row_count(bronze_latest(spark, sf_dir))


def _sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Returned lines were changed on a branch, all others on the main line."""
    changes = line_changes(spark, sf_dir).select(*COLUMNS, "return_flag", "batch_id", "_op")
    back = F.col("return_flag") == "R"
    return changes.where(~back), changes.where(back)


SIDES_SQL = f"""
{CHANGES_SQL},
base AS (SELECT * FROM changes WHERE return_flag <> 'R'),
dev AS (SELECT * FROM changes WHERE return_flag = 'R')
"""


@query(
    "S8",
    f"""
    WITH {SIDES_SQL},
    stacked AS (SELECT *, 0 AS layer FROM base WHERE batch_id <= {VERSION}
                UNION ALL SELECT *, 1 AS layer FROM dev)
    {_latest_sql("stacked", order="layer DESC, batch_id DESC")}
    """,
)
def branch_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    base, dev = _sides(spark, sf_dir)
    state = keyed.branch_state([keyed.as_of(base, VERSION), dev], LINE_KEY, _order())
    return state.select(*COLUMNS)


@query(
    "V2",
    f"""
    WITH {SIDES_SQL},
    ours AS ({_latest_sql("dev")}),
    theirs AS (SELECT DISTINCT order_id, line FROM base WHERE batch_id > {VERSION})
    SELECT ours.*, CASE WHEN theirs.line IS NULL THEN 'upsert' ELSE 'conflict' END AS change
    FROM ours LEFT JOIN theirs USING (order_id, line)
    """,
)
def branch_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    base, dev = _sides(spark, sf_dir)
    return keyed.branch_diff(dev, base, LINE_KEY, VERSION, _order()).select(*COLUMNS, "change")


# -- stored tables -----------------------------------------------------------

LINES_TABLE = TableSpec(
    "order_line_state",
    columns(
        order_id=BIGINT,
        line=INT,
        product_id=BIGINT,
        supplier_id=BIGINT,
        total_amount=DOUBLE,
        event_time=TIME,
    ),
    LINE_KEY,
    order=LINE_ORDER,
)


def _stored(spark: SparkSession, spec: TableSpec) -> EventTable:
    return open_table(spark, fresh_path(spark, spec.name), spec)


def _years(lines: DataFrame) -> list[DataFrame]:
    """Four batches: ship years 1995-96, 1997-98, 1999-2000 and the rest."""
    year = F.year("event_time")
    return [
        lines.where(year <= 1996),
        lines.where(year.between(1997, 1998)),
        lines.where(year.between(1999, 2000)),
        lines.where(year >= 2001),
    ]


@query("K1 K4 K5 S5 M1", f"WITH {CHANGES_SQL} {_latest_sql('changes')}")
def compacted_equals_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = _stored(spark, LINES_TABLE)
    for n, batch in enumerate(_years(order_lines(spark, sf_dir))):
        stored.append(batch, writer="lines", writer_batch=n)
    compact(stored)
    return stored.read()


@query("K4 M1", f"WITH {CHANGES_SQL} {_latest_sql('changes')}")
def compacted_while_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch is committed after the compaction has read and before it commits."""
    stored = _stored(spark, LINES_TABLE)
    *first, last = _years(order_lines(spark, sf_dir))
    for n, batch in enumerate(first):
        stored.append(batch, writer="lines", writer_batch=n)
    read = stored.latest_version()
    stored.append(last, writer="lines", writer_batch=len(first))
    compact(stored, version=read)
    return stored.read()


YEARS_SQL = f"""
{LINES_SQL},
years AS (
  SELECT CASE WHEN year(event_time) <= 1996 THEN 0 WHEN year(event_time) <= 1998 THEN 1
              WHEN year(event_time) <= 2000 THEN 2 ELSE 3 END AS n
  FROM lines
)
"""


@query(
    "S6 L2",
    f"""
    WITH {YEARS_SQL}
    SELECT g.n AS batch_id, 'append' AS operation, count(years.n) AS rows
    FROM (SELECT unnest(range(4)) AS n) AS g LEFT JOIN years USING (n) GROUP BY 1, 2
    """,
)
def stored_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = _stored(spark, LINES_TABLE)
    for n, batch in enumerate(_years(order_lines(spark, sf_dir))):
        stored.append(batch, writer="lines", writer_batch=n)
    return stored.snapshots().select("batch_id", "operation", "rows")


@query(
    "S9",
    f"""
    WITH {YEARS_SQL}
    SELECT 3 AS latest_version, count(*) AS rows FROM years WHERE n = 3
    """,
)
def stored_latest_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest version by its number, and the rows it came with."""
    stored = _stored(spark, LINES_TABLE)
    for n, batch in enumerate(_years(order_lines(spark, sf_dir))):
        stored.append(batch, writer="lines", writer_batch=n)
    newest = F.col("batch_id") == stored.latest_version()
    return stored.versions().where(newest).select(
        F.col("batch_id").cast("int").alias("latest_version"), "rows"
    )


@query("S7 M1", f"WITH {CHANGES_SQL} {_latest_sql('changes', 'year(event_time) <= 1998')}")
def version_before_compaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = _stored(spark, LINES_TABLE)
    for n, batch in enumerate(_years(order_lines(spark, sf_dir))):
        stored.append(batch, writer="lines", writer_batch=n)
    compact(stored)
    return stored.read(version=1)


@query(
    "T9 M1",
    """
    SELECT time_bucket(INTERVAL 30 DAY, l_shipdate, TIMESTAMP '1970-01-01') AS window_start,
           time_bucket(INTERVAL 30 DAY, l_shipdate, TIMESTAMP '1970-01-01') + INTERVAL 30 DAY
             AS window_end,
           l_returnflag AS region,
           CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total_sales
    FROM lineitem GROUP BY 1, 2, 3
    """,
)
def folded_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = _stored(spark, WINDOWED_SALES)
    lines = order_lines(spark, sf_dir).withColumnRenamed("return_flag", "region")
    for n, batch in enumerate(_years(lines)):
        stored.append(window_sales(batch, "event_time", size=MONTHLY), writer="sales", writer_batch=n)
    compact(stored)
    return stored.read().withColumn("total_sales", F.col("total_sales").cast("double"))


def _by_status(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Lines of pending orders go to a branch, the others to the main line."""
    pending = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"), (F.col("o_orderstatus") == "P").alias("pending")
    )
    lines = order_lines(spark, sf_dir).join(pending, "order_id")
    return lines.where(~F.col("pending")), lines.where("pending")


def _forked(spark: SparkSession, sf_dir: str) -> EventTable:
    settled, pending = _by_status(spark, sf_dir)
    early = F.year("event_time") <= 1997
    stored = _stored(spark, LINES_TABLE)
    stored.append(settled.where(early), writer="lines", writer_batch=0)
    stored.create_branch("dev")
    stored.append(pending, "dev", writer="pending", writer_batch=0)
    stored.append(settled.where(~early), writer="lines", writer_batch=1)
    return stored


STATUS_SQL = f"""
{CHANGES_SQL},
by_status AS (SELECT changes.*, o_orderstatus FROM changes JOIN orders ON order_id = o_orderkey)
"""


@query(
    "V1 S8",
    f"""WITH {STATUS_SQL}
    {_latest_sql("by_status", "o_orderstatus = 'P' OR year(event_time) <= 1997")}""",
)
def branch_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _forked(spark, sf_dir).read("dev")


@query("V3", f"WITH {STATUS_SQL} {_latest_sql('by_status')}")
def branch_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = _forked(spark, sf_dir)
    publish(stored, "dev", expected_head=stored.latest_version())
    return stored.read()


@query(
    "V3 T9",
    """
    SELECT time_bucket(INTERVAL 30 DAY, l_shipdate, TIMESTAMP '1970-01-01') AS window_start,
           time_bucket(INTERVAL 30 DAY, l_shipdate, TIMESTAMP '1970-01-01') + INTERVAL 30 DAY
             AS window_end,
           l_returnflag AS region,
           CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total_sales
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2, 3
    """,
)
def published_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partial sums written on a branch add up with those of the main line."""
    stored = _stored(spark, WINDOWED_SALES)
    settled, pending = (
        window_sales(x.withColumnRenamed("return_flag", "region"), "event_time", size=MONTHLY)
        for x in _by_status(spark, sf_dir)
    )
    stored.create()
    stored.create_branch("dev")
    stored.append(pending, "dev", writer="pending", writer_batch=0)
    stored.append(settled, writer="settled", writer_batch=0)
    publish(stored, "dev")
    return stored.read().withColumn("total_sales", F.col("total_sales").cast("double"))


@query(
    "V3 T5",
    f"WITH {LATE_SQL} SELECT region, total_amount, event_time FROM marked WHERE is_late",
)
def published_dlq(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dead letters of a branch and of the main line, after the branch is published."""
    stored = _stored(spark, LATE_EVENTS_DLQ)
    marked = late.mark_late(
        late_events(spark, sf_dir), "event_time", "event_id", HOURLY, HOURLY_GRACE
    )
    tried = F.col("event_id") % 3 == 0
    stored.create()
    stored.create_branch("dev")
    stored.append(late.dead_letters(marked.where(tried), "event_time"), "dev")
    stored.append(late.dead_letters(marked.where(~tried), "event_time"))
    publish(stored, "dev")
    return stored.read()


@query("V4", f"WITH {STATUS_SQL} {_latest_sql('by_status')}")
def audited_branch_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = _forked(spark, sf_dir)
    checks = {
        "positive amounts": lambda rows: rows.where(F.col("total_amount") <= 0),
        "known products": lambda rows: rows.where(F.col("product_id").isNull()),
    }
    audited_publish(stored, "dev", checks)
    return stored.read()


DEAR = 50_000


@query(
    "V4",
    f"""
    WITH {STATUS_SQL},
    latest AS (
      SELECT *, row_number() OVER (PARTITION BY order_id, line
        ORDER BY batch_id DESC, event_time DESC, product_id DESC, supplier_id DESC) AS rn
      FROM by_status)
    SELECT order_id, line, product_id, supplier_id, total_amount, event_time FROM latest
    WHERE rn = 1 AND NOT (o_orderstatus = 'P' AND total_amount >= {DEAR})
    """,
)
def audit_refuses_until_mended(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A check finds dear lines of pending orders on the branch: nothing is published.
    They are deleted on the branch, and the same audit lets it pass."""
    stored = _forked(spark, sf_dir)
    pending = table(spark, sf_dir, "orders").where("o_orderstatus = 'P'")
    pending = pending.select(F.col("o_orderkey").alias("order_id"))

    def dear(rows: DataFrame) -> DataFrame:
        return rows.where(F.col("total_amount") >= DEAR).join(pending, "order_id", "left_semi")

    head = stored.latest_version()
    try:
        audited_publish(stored, "dev", {"dear lines": dear})
    except PublishRefused as refused:
        if stored.latest_version() != head:
            raise RuntimeError("a refused publish changed the target") from None
        found = refused.offending["dear lines"].withColumn("_op", F.lit(keyed.DELETE))
        stored.append(found, "dev", writer="mending", writer_batch=0)
        audited_publish(stored, "dev", {"dear lines": dear})
    return stored.read()


@query(
    "V2 V3",
    f"WITH {STATUS_SQL} SELECT * , 'upsert' AS change FROM ("
    + _latest_sql("by_status", "o_orderstatus = 'P'")
    + ")",
)
def stored_branch_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return diff(_forked(spark, sf_dir), "dev").select(*COLUMNS, "change")


@query(
    "K6",
    "SELECT CAST(ts AS DATE) AS event_day, count(*) AS n FROM events GROUP BY 1",
)
def day_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "events_by_day")
    write_by_day(table(spark, sf_dir, "events"), "ts", path)
    return spark.read.parquet(path).groupBy("event_day").agg(F.count(F.lit(1)).alias("n"))
