"""Message text to typed columns and back."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablestream.functions.times import parse_event_time
from tablestream.schemas import ORDER_EVENT

BROKEN = "_broken"
BROKEN_TEXT = "broken_text"
NO_EVENT_TIME = "no_event_time"
NO_KEY = "no_key"


def decode(messages: DataFrame, fields: T.StructType = ORDER_EVENT, value: str = "value") -> DataFrame:
    """Add the typed ``fields`` and ``reject_reason``; keep the other columns.

    Text that is no JSON object gets the reason ``broken_text``. A field that
    does not fit its type is NULL and the row stays: fields are read as text
    first and then cast one by one, because a typed read would flag the whole
    message for one bad field.
    """
    wire = T.StructType(
        [T.StructField(f.name, T.StringType()) for f in fields]
        + [T.StructField(BROKEN, T.StringType())]
    )
    parsed = F.from_json(
        F.col(value).cast("string"),
        wire,
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BROKEN},
    )
    nothing = F.struct(
        *[F.lit(None).cast("string").alias(f.name) for f in fields], F.lit("").alias(BROKEN)
    )
    kept = [c for c in messages.columns if c not in fields.fieldNames()]
    # A generator instead of a projection: a filter on its output cannot be
    # pushed below it, which would parse every message twice.
    rows = messages.select(*kept, F.inline_outer(F.array(F.coalesce(parsed, nothing))))
    typed = [
        F.col(f.name)
        if isinstance(f.dataType, T.StringType)
        else F.col(f.name).try_cast(f.dataType).alias(f.name)
        for f in fields
    ]
    return rows.select(
        *kept,
        *typed,
        F.when(F.col(BROKEN).isNotNull(), F.lit(BROKEN_TEXT)).alias("reject_reason"),
    )


def decode_events(
    messages: DataFrame, fields: T.StructType = ORDER_EVENT, value: str = "value"
) -> DataFrame:
    """``decode`` plus ``event_timestamp``, and a reason when it is missing."""
    rows = decode(messages, fields, value).withColumn(
        "event_timestamp", parse_event_time("event_time")
    )
    return require(rows, "event_timestamp", reason=NO_EVENT_TIME)


def accepted(decoded: DataFrame) -> DataFrame:
    return decoded.where(F.col("reject_reason").isNull()).drop("reject_reason")


def rejected(decoded: DataFrame) -> DataFrame:
    return decoded.where(F.col("reject_reason").isNotNull())


def require(decoded: DataFrame, *columns: str, reason: str = NO_KEY) -> DataFrame:
    """Mark rows that lack one of ``columns``."""
    return mark(decoded, reduce(or_, [F.col(c).isNull() for c in columns]), reason)


def mark(decoded: DataFrame, unusable: Column, reason: str) -> DataFrame:
    """Give unusable rows a reason, unless they have one."""
    return decoded.withColumn(
        "reject_reason", F.coalesce(F.col("reject_reason"), F.when(unusable, F.lit(reason)))
    )


def encode(df: DataFrame, key: str = "order_id", columns: list[str] | None = None) -> DataFrame:
    """One keyed JSON message per row, for a Kafka or text sink."""
    return df.select(
        F.col(key).cast("string").alias("key"), message_text(columns or df.columns).alias("value")
    )


def message_text(columns: list[str]) -> Column:
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
