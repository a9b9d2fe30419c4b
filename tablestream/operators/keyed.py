"""Changelog algebra: the state of a keyed table out of its changes.

A change row carries the table's columns, ``batch_id``, ``_seq`` (arrival order
in its batch) and ``_op`` (``U`` or ``D``). Nothing here touches storage.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

UPSERT, DELETE = "U", "D"
LAYER = "_layer"


def last_per_key(df: DataFrame, key: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The last row of every key by ``order``.

    ``row_number() = 1`` lets Spark keep one row per key in each map task
    before the shuffle, so a hot key costs one row per task and not its rows.
    """
    newest_first = Window.partitionBy(*key).orderBy(*[_col(c).desc() for c in order])
    return df.withColumn("_rank", F.row_number().over(newest_first)).where("_rank = 1").drop("_rank")


def first_per_key(df: DataFrame, key: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """De-duplicate: the first row of every key by ``order``."""
    oldest_first = Window.partitionBy(*key).orderBy(*[_col(c).asc() for c in order])
    return df.withColumn("_rank", F.row_number().over(oldest_first)).where("_rank = 1").drop("_rank")


def current_state(
    changes: DataFrame,
    key: Sequence[str],
    order: Sequence[str] = ("batch_id", "_seq"),
    keep_version: bool = False,
) -> DataFrame:
    """Latest row per key, without the deleted keys."""
    state = last_per_key(changes, key, order)
    if "_op" in changes.columns:
        state = state.where(F.col("_op") != DELETE)
    if keep_version:
        return state
    return state.drop("batch_id", "_seq", "_op", LAYER)


def as_of(changes: DataFrame, version: int | Column) -> DataFrame:
    return changes.where(F.col("batch_id") <= version)


def stack(layers: Sequence[DataFrame]) -> DataFrame:
    """Changes of a branch over those of its base, lowest layer first.

    A row of a higher layer outranks every lower one whatever its batch id.
    """
    stacked = None
    for level, layer in enumerate(layers):
        layer = layer.withColumn(LAYER, F.lit(level))
        stacked = layer if stacked is None else stacked.unionByName(layer)
    return stacked


def branch_state(layers: Sequence[DataFrame], key: Sequence[str], order=("batch_id", "_seq"), **kw) -> DataFrame:
    return current_state(stack(layers), key, (LAYER, *order), **kw)


def changed_keys(changes: DataFrame, key: Sequence[str], after: int | Column | None = None) -> DataFrame:
    if after is not None:
        changes = changes.where(F.col("batch_id") > after)
    return changes.select(*key).distinct()


def branch_diff(
    branch_changes: DataFrame,
    base_changes: DataFrame,
    key: Sequence[str],
    fork: int | Column,
    order: Sequence[str] = ("batch_id", "_seq"),
) -> DataFrame:
    """One row per key changed on the branch, with its last change.

    ``change`` is ``conflict`` when the base changed the key after the fork,
    ``delete`` or ``upsert`` otherwise.
    """
    ours = last_per_key(branch_changes, key, order)
    theirs = changed_keys(base_changes, key, fork).withColumn("_theirs", F.lit(True))
    verdict = (
        F.when(F.col("_theirs"), F.lit("conflict"))
        .when(F.col("_op") == DELETE, F.lit("delete"))
        .otherwise(F.lit("upsert"))
    )
    return ours.join(theirs, list(key), "left").withColumn("change", verdict).drop("_theirs")


def sum_partials(changes: DataFrame, key: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """State of a partial-sum table."""
    return changes.groupBy(*key).agg(*[F.sum(m).alias(m) for m in measures])


def version_log(changes: DataFrame, key: Sequence[str], ts: str) -> DataFrame:
    """Per version: rows, keys, and the span of event time."""
    # Two groupings keep the count of keys exact without a hot version.
    per_key = changes.groupBy("batch_id", *key).agg(
        F.count(F.lit(1)).alias("_n"), F.min(ts).alias("_lo"), F.max(ts).alias("_hi")
    )
    return per_key.groupBy("batch_id").agg(
        F.sum("_n").alias("rows"),
        F.count(F.lit(1)).alias("keys"),
        F.min("_lo").alias("min_event_time"),
        F.max("_hi").alias("max_event_time"),
    )


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c
