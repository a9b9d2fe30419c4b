"""Order lifecycles on a stream: what each key did last, kept in the state store.

A key's state is its last status and its greatest event time, by order of arrival. It
counts for ``ttl`` of event time after that greatest time, so results do not depend on
when a batch runs. The store itself drops a key that no batch has brought for ``ttl`` by
the clock: the watermark is set on the time of the batch and not on the events, so no
late event is ever dropped. Only the columns the checks need enter the state operator.

Keys are held in shards, dealt by a hash: a call of the state function handles all the
rows of a shard with arrays, so that its cost is that of rows and not of calls. A key's
own deadline stands in the shard, which is called again when the first of them is due.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablestream.functions.times import micros, span_micros
from tablestream.schemas import STATUS_TRANSITIONS

_STATE = "keys array<string>, statuses array<string>, greatest array<bigint>, due array<bigint>"
#: Groups of keys; the state of one is read and written as a whole.
SHARDS = 1024
#: By how much the clock of a restarted query may lie behind without loss.
CLOCK_SKEW = "1 hour"
#: Before every event: the time of a row that has none.
NEVER = -(2**63)


def with_last(
    events: DataFrame, key: str, status: str, ts: str, arrival: str, ttl: str, shards: int = SHARDS
) -> DataFrame:
    """``key, arrival, status, ts, previous_status, greatest_time`` of a stream's rows.

    ``previous_status`` is that of the key's row before, ``greatest_time`` the greatest
    time of all its rows before; both NULL for the first row, and for a row more than
    ``ttl`` beyond that greatest time. Rows without a time have a status but move no
    time. Rows of one key are taken by ``arrival`` within a micro-batch, whose size the
    source bounds, and batch after batch; rows without a key are left out. ``shards``
    must not change while a query goes on from its checkpoint.
    """
    reach = span_micros(ttl)
    key_type, ts_type = events.schema[key].dataType, events.schema[ts].dataType
    name = F.hex(key) if key_type.typeName() == "binary" else F.col(key).cast("string")
    rows = events.where(F.col(key).isNotNull()).select(
        F.pmod(F.xxhash64(name), F.lit(shards)).alias("shard"),
        F.col(key).alias("key"),
        name.alias("name"),
        F.col(arrival).cast("bigint").alias("arrival"),
        F.col(status).cast("string").alias("status"),
        F.coalesce(micros(ts), F.lit(NEVER)).alias("at"),
        F.current_timestamp().alias("clock"),
    )
    rows = rows.withWatermark("clock", CLOCK_SKEW)

    def step(_shard: tuple, frames: Iterator, state) -> Iterator:
        import numpy as np
        import pandas as pd

        held, statuses, greatest, due = (list(x) for x in state.get) if state.exists else ([], [], [], [])
        watermark = state.getCurrentWatermarkMs()
        if not state.hasTimedOut:
            batch = pd.concat(list(frames)).sort_values(["arrival", "at"], kind="stable")
            codes, names = pd.factorize(batch["name"])
            names, n = names.tolist(), len(names)
            slot = {k: i for i, k in enumerate(held)}
            seen = np.array([k in slot for k in names])
            for k in names:
                if k not in slot:
                    slot[k] = len(held)
                    held.append(k)
                    statuses.append(None)
                    greatest.append(NEVER)
                    due.append(0)
            at_slot = [slot[k] for k in names]
            # In front of a key's rows, in their order, stands what is held of it.
            code = np.concatenate([np.arange(n), codes])
            order = np.argsort(code, kind="stable")
            code = code[order]
            at = np.concatenate([np.array([greatest[i] for i in at_slot], np.int64), batch["at"].to_numpy(np.int64)])[order]
            said = np.empty(len(order), dtype=object)
            said[:] = [*(statuses[i] for i in at_slot), *(None if s is None or s != s else s for s in batch["status"])]
            said = said[order]
            # Greatest so far within a key: codes ascend, so a key's first beats the one before.
            times, rank = np.unique(at, return_inverse=True)
            reached = times[np.maximum.accumulate(code * len(times) + rank) % len(times)]
            here = np.flatnonzero(order >= n)
            before, now_at = reached[here - 1], at[here]
            # A gap is only measured between two times; differences cannot overflow.
            stale = (before != NEVER) & (now_at != NEVER)
            stale[stale] = now_at[stale] - before[stale] > reach
            gone = stale | ((order[here - 1] < n) & ~seen[code[here]])
            previous = said[here - 1]
            previous[gone] = None
            clock = int(batch["clock"].max().timestamp() * 1000)
            until = max(clock, watermark) + max(1, reach // 1000)
            for i, end in zip(at_slot, np.flatnonzero(np.append(code[1:] != code[:-1], True)).tolist()):
                statuses[i], greatest[i], due[i] = said[end], int(reached[end]), until
            rows = batch.iloc[order[here] - n]
            yield pd.DataFrame(
                {
                    "key": rows["key"].to_numpy(),
                    "arrival": rows["arrival"].to_numpy(),
                    "status": said[here],
                    "at": now_at,
                    "previous_status": previous,
                    "greatest": np.where(gone, NEVER, before),
                }
            )
        live = [i for i, d in enumerate(due) if d >= watermark]
        if not live:
            state.remove()
            return
        if len(live) < len(due):
            held, statuses, greatest, due = ([x[i] for i in live] for x in (held, statuses, greatest, due))
        state.update((held, statuses, greatest, due))
        state.setTimeoutTimestamp(max(min(due), watermark + 1))

    found = rows.groupBy("shard").applyInPandasWithState(
        step,
        f"key {key_type.simpleString()}, arrival bigint, status string, at bigint,"
        " previous_status string, greatest bigint",
        _STATE,
        "append",
        "EventTimeTimeout",
    )
    time = lambda c: F.when(F.col(c) != NEVER, F.timestamp_micros(F.col(c))).cast(ts_type)
    return found.select(
        F.col("key").alias(key),
        F.col("arrival").alias(arrival),
        F.col("status").alias(status),
        time("at").alias(ts),
        "previous_status",
        time("greatest").alias("greatest_time"),
    )


def is_allowed(previous: Column, status: Column, transitions: dict[str, list[str]] = STATUS_TRANSITIONS) -> Column:
    """Whether a step is in the table, as an expression: a stream needs no join for it."""
    allowed = F.lit(False)
    for a, nexts in transitions.items():
        allowed = allowed | ((previous == a) & status.isin(*nexts))
    return F.coalesce(allowed, F.lit(False))


def violations(
    checked: DataFrame, status: str, transitions: dict[str, list[str]] = STATUS_TRANSITIONS
) -> DataFrame:
    """Rows of ``with_last`` whose step is not allowed."""
    bad = ~is_allowed(F.col("previous_status"), F.col(status), transitions)
    return checked.where(F.col("previous_status").isNotNull() & bad)


def behind(checked: DataFrame, ts: str) -> DataFrame:
    """Rows of ``with_last`` that came after a later one of their key."""
    return checked.where(F.col(ts) < F.col("greatest_time"))
