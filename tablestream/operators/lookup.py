"""Joins of a fact side to a dimension."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablestream.session import settle

BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 << 20
#: Rows of one key that one task of a join should hold, and the most keys above it.
HEAVY_ROWS, MOST_HEAVY = 1_000_000, 10_000


def is_small(df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> bool:
    """Whether ``df`` is proven to fit a broadcast, by rows and then by bytes."""
    if df.count() > rows:
        return False
    width = df.agg(F.sum(F.octet_length(F.to_json(F.struct(*df.columns))))).first()[0]
    return (width or 0) <= size


def heavy_keys(facts: DataFrame, key: Sequence[str], rows: int = HEAVY_ROWS) -> DataFrame:
    """``key, _salts``: keys above ``rows`` and over how many tasks to spread each.

    There are at most ``MOST_HEAVY`` of them, because a key counts as heavy only with
    that share of all rows: a list of proven size.
    """
    counts = facts.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.sum("_n")).first()[0] or 0
    bound = max(rows, -(-total // MOST_HEAVY))
    spread = F.ceil(F.col("_n") / bound).cast("int")
    return counts.where(F.col("_n") > bound).select(*key, spread.alias("_salts"))


def lookup(
    facts: DataFrame, dim: DataFrame, key: Sequence[str] | str, heavy_rows: int | None = None
) -> DataFrame:
    """Left join that keeps every fact row.

    A NULL or unknown key gives NULL attributes; a repeated dimension key
    multiplies rows. A dimension that is proven small is broadcast, so the facts
    are not moved and skew does not matter. A larger one is joined by shuffle:
    in batch, adaptive execution splits hot keys; a stream has no such step, so there
    ``heavy_rows`` counts the keys of ``facts`` (a micro-batch, kept by the caller): a
    key above it is dealt out over salts, and only its rows of the dimension are copied.
    """
    key = [key] if isinstance(key, str) else list(key)
    if is_small(dim):
        return facts.join(F.broadcast(dim), key, "left")
    if heavy_rows is None:
        return facts.join(dim, key, "left")
    heavy = settle(heavy_keys(facts, key, heavy_rows), "heavy")
    if heavy.isEmpty():
        return facts.join(dim, key, "left")
    heavy = F.broadcast(heavy)
    others = [c for c in facts.columns if c not in key]
    # Equal rows would share a salt; their place in the batch tells them apart.
    spread = F.pmod(F.xxhash64(*others, F.monotonically_increasing_id()), F.coalesce("_salts", F.lit(1)))
    dealt = facts.join(heavy, key, "left").withColumn("_salt", spread.cast("int")).drop("_salts")
    copies = dim.join(heavy, key, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))
    )
    joined = dealt.join(copies.drop("_salts"), [*key, "_salt"], "left")
    return joined.drop("_salt")


def regional_orders(
    events: DataFrame, regions: DataFrame, ts: str = "event_timestamp", heavy_rows: int | None = None
) -> DataFrame:
    """Orders with the attributes of their region; ``heavy_rows`` as in ``lookup``."""
    facts = events.select(
        F.col(ts).alias("event_time"),
        "order_id",
        "region",
        "total_amount",
        *[c for c in ("_seq", "batch_id") if c in events.columns],
    )
    return lookup(facts, regions, "region", heavy_rows)
