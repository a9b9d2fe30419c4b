"""Time expressions. All are native and stay inside generated code."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablestream.schemas import EVENT_TIME_PATTERN


def parse_event_time(text: Column | str, pattern: str = EVENT_TIME_PATTERN) -> Column:
    """Text to instant; NULL, not an error, when the text does not fit."""
    return F.try_to_timestamp(_col(text), F.lit(pattern))


def parse_time_lenient(text: Column | str) -> Column:
    """Any text Spark accepts as a time; NULL otherwise."""
    return _col(text).try_cast("timestamp")


def event_time_text(ts: Column | str, pattern: str = EVENT_TIME_PATTERN) -> Column:
    return F.date_format(_col(ts), pattern)


def truncate_millis(ts: Column | str) -> Column:
    return F.date_trunc("MILLISECOND", _col(ts))


def from_millis(millis: Column | str) -> Column:
    return F.timestamp_millis(_col(millis))


def to_millis(ts: Column | str) -> Column:
    return F.unix_millis(_col(ts).cast("timestamp"))


def at_rest(ts: Column | str) -> Column:
    """Instants are stored without a zone; the session zone is UTC."""
    return _col(ts).cast("timestamp_ntz")


def zoneless(moment: datetime) -> Column:
    """A stored time as a literal; a plain literal would shift by the host's zone."""
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def earlier(ts: Column | str, span: str) -> Column:
    return _col(ts) - F.expr(f"INTERVAL {span}")


def later(ts: Column | str, span: str) -> Column:
    return _col(ts) + F.expr(f"INTERVAL {span}")


#: Microseconds per unit of a span such as "5 seconds".
UNITS = {
    "microsecond": 1,
    "millisecond": 1_000,
    "second": 1_000_000,
    "minute": 60_000_000,
    "hour": 3_600_000_000,
    "day": 86_400_000_000,
    "week": 604_800_000_000,
}


def span_micros(span: str) -> int:
    """A span of fixed length, in microseconds: "1 minute", "1 hour 5 minutes"."""
    words = span.split()
    if len(words) % 2 or not words:
        raise ValueError(f"not a span of time: {span!r}")
    return sum(int(n) * UNITS[unit.removesuffix("s")] for n, unit in zip(words[::2], words[1::2]))


def micros(ts: Column | str) -> Column:
    """Microseconds since 1970; a time without zone is read in the session zone."""
    return F.unix_micros(_col(ts).cast("timestamp"))


def floor_micros(ts_micros: Column, size: str) -> Column:
    """Start of the epoch-aligned window of ``size``, also before 1970."""
    return ts_micros - F.pmod(ts_micros, F.lit(span_micros(size)))


def tumble(df: DataFrame, ts: str, size: str) -> DataFrame:
    """Add ``window_start`` and ``window_end`` of the epoch-aligned window.

    The same bounds as Spark's ``window`` by whole-number arithmetic, which is
    cheaper when a plan needs them more than once. For batches; a streaming
    aggregate needs ``window`` itself. Rows without a time belong to no window
    and are left out, as there; split them off first.
    """
    kind = df.schema[ts].dataType
    start = floor_micros(micros(ts), size)
    return df.where(F.col(ts).isNotNull()).withColumns(
        {
            "window_start": F.timestamp_micros(start).cast(kind),
            "window_end": F.timestamp_micros(start + F.lit(span_micros(size))).cast(kind),
        }
    )


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c
