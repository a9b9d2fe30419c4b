"""Message, dimension and table schemas."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# The event contract that producers already write.
# ---------------------------------------------------------------------------
EVENT_TIME_PATTERN = "yyyy-MM-dd HH:mm:ss.SSS"

STATUS_TRANSITIONS = {
    "placed": ["payment_pending", "cancelled"],
    "payment_pending": ["paid", "cancelled"],
    "paid": ["shipped"],
    "shipped": ["delivered", "cancelled"],
    "delivered": ["returned"],
}
TERMINAL_STATUSES = ["delivered", "cancelled", "returned"]

WINDOW_SIZE = "1 minute"
OUT_OF_ORDER = "5 seconds"
#: A row is late once the high-water mark is this far past its window's end.
GRACE = "65 seconds"
COMMIT_INTERVAL = "60 seconds"

HIGH_VALUE = 1000
BURST_EVENTS = 40
BURST_WINDOW = "60 seconds"
# ---------------------------------------------------------------------------

ORDER_EVENT = T.StructType(
    [
        T.StructField("event_id", T.StringType()),
        T.StructField("order_id", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("product_id", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("quantity", T.IntegerType()),
        T.StructField("unit_price", T.DoubleType()),
        T.StructField("total_amount", T.DoubleType()),
        T.StructField("discount_pct", T.DoubleType()),
        T.StructField("region", T.StringType()),
        T.StructField("platform", T.StringType()),
        T.StructField("event_time", T.StringType()),
    ]
)

REGION_DIM = T.StructType(
    [
        T.StructField("region", T.StringType()),
        T.StructField("data_center", T.StringType()),
        T.StructField("tax_rate", T.DoubleType()),
        T.StructField("compliance_type", T.StringType()),
    ]
)

COMMIT = T.StructType(
    [
        T.StructField("branch", T.StringType()),
        T.StructField("batch_id", T.LongType()),
        T.StructField("commit_ts", T.TimestampNTZType()),
        T.StructField("operation", T.StringType()),
        T.StructField("rows", T.LongType()),
        T.StructField("fork_batch", T.LongType()),
        T.StructField("source_branch", T.StringType()),
        T.StructField("writer", T.StringType()),
        T.StructField("writer_batch", T.LongType()),
        T.StructField("high_water", T.TimestampNTZType()),
        T.StructField("covers", T.LongType()),
        T.StructField("folder", T.StringType()),
    ]
)


def pick(schema: T.StructType, *names: str) -> T.StructType:
    """A narrower schema: only the fields a job reads."""
    return T.StructType([schema[name] for name in names])


KEYED, APPEND, SUMS = "keyed", "append", "sums"


@dataclass(frozen=True)
class TableSpec:
    """What a table holds and how its changes add up.

    ``keyed``: the last change per key wins. ``append``: every row stays.
    ``sums``: rows of one key are partial sums of the ``measures``.
    ``order`` ranks the changes of one key within a batch.
    """

    name: str
    schema: T.StructType
    key: tuple[str, ...] = ()
    kind: str = KEYED
    measures: tuple[str, ...] = ()
    order: tuple[str, ...] = ("_seq",)

    @property
    def names(self) -> list[str]:
        return self.schema.fieldNames()


def columns(**types: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, t) for name, t in types.items()])


TEXT, INT, BIGINT, DOUBLE = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()
TIME = T.TimestampNTZType()
MONEY_SUM = T.DecimalType(28, 2)

ORDER_EVENTS = TableSpec(
    "order_events",
    T.StructType(
        [f for f in ORDER_EVENT if f.name != "event_time"]
        + [T.StructField("event_time", TIME), T.StructField("ingestion_time", TIME)]
    ),
    ("event_id",),
)
PRODUCTS_SOLD = TableSpec(
    "products_sold",
    columns(event_time=TIME, product_id=TEXT, orders=BIGINT),
    ("event_time", "product_id"),
)
REGIONAL_ORDERS = TableSpec(
    "regional_orders",
    columns(
        event_time=TIME,
        order_id=TEXT,
        region=TEXT,
        data_center=TEXT,
        tax_rate=DOUBLE,
        compliance_type=TEXT,
        total_amount=DOUBLE,
    ),
    ("order_id",),
)
WINDOWED_SALES = TableSpec(
    "windowed_sales",
    columns(window_start=TIME, window_end=TIME, region=TEXT, total_sales=MONEY_SUM),
    ("window_start", "window_end", "region"),
    kind=SUMS,
    measures=("total_sales",),
)
LATE_EVENTS_DLQ = TableSpec(
    "late_events_dlq",
    columns(region=TEXT, total_amount=DOUBLE, event_time=TIME),
    kind=APPEND,
)


def rejects_of(job: str) -> TableSpec:
    """The rows a job could not use. One table per job keeps one writer per table."""
    return TableSpec(
        f"{job}_rejects", columns(value=TEXT, reason=TEXT, ingestion_time=TIME), kind=APPEND
    )


TABLES = {
    t.name: t
    for t in (
        ORDER_EVENTS,
        PRODUCTS_SOLD,
        REGIONAL_ORDERS,
        WINDOWED_SALES,
        LATE_EVENTS_DLQ,
    )
}
