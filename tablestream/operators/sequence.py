"""The previous row of the same key, safe for hot keys."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablestream.session import settle

HOT_ROWS = 1_000_000


def hot_keys(df: DataFrame, key: Sequence[str], rows: int = HOT_ROWS) -> DataFrame:
    """The keys above ``rows``: at most one for so many rows."""
    counts = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
    return counts.where(F.col("_n") > rows).drop("_n")


def with_previous(
    df: DataFrame,
    key: Sequence[str],
    order: Sequence[str],
    previous: dict[str, str],
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Add ``previous[c]``: the value of column ``c`` one row earlier in its key.

    ``order`` must be total within a key. Ordinary keys are one window partition each.
    Rows of hot keys are sorted as a whole: Spark samples their order and cuts it into
    ranges of like size, so a key is cut by rank however dense an hour or an instant of
    it is. Each range of a key starts from one carried row: the last one of the range
    before. Which keys count as hot changes the plan's balance and never the result.
    """
    key, order = list(key), list(order)
    along = Window.partitionBy(*key).orderBy(*order)
    # Written once: both sides below read it, and an empty list needs neither.
    hot = settle(hot_keys(df, key, hot_rows), "hot-keys")
    if hot.isEmpty():
        return df.withColumns({name: F.lag(c).over(along) for name, c in previous.items()})

    helpers = [f"_hot_{k}" for k in key]
    tag = hot.toDF(*helpers)
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_hot_{k}")) for k in key])
    values = list(dict.fromkeys([*order, *previous.values()]))
    ranged = df.join(tag, same, "left_semi").repartitionByRange(*key, *order)
    # Written with the number of its range, which must not change between its readers.
    ranged = settle(ranged.withColumn("_range", F.spark_partition_id()), "ranges")

    over_ranges = Window.partitionBy(*key).orderBy("_range")
    tails = (
        ranged.groupBy(*key, "_range")
        .agg(F.max(F.struct(*values)).alias("_tail"))
        .withColumn("_range", F.lead("_range").over(over_ranges))
        .where(F.col("_range").isNotNull())
        .select(*key, "_range", "_tail.*", F.lit(True).alias("_carried"))
    )
    in_range = Window.partitionBy(*key, "_range").orderBy(*order)
    cut = (
        ranged.withColumn("_carried", F.lit(False))
        .unionByName(tails, allowMissingColumns=True)
        .withColumns({name: F.lag(c).over(in_range) for name, c in previous.items()})
        .where(~F.col("_carried"))
        .drop("_range", "_carried")
    )
    rest = df.join(tag, same, "left_anti")
    whole = rest.withColumns({name: F.lag(c).over(along) for name, c in previous.items()})
    return whole.unionByName(cut)
