"""Parquet partitioned by event day."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablestream.session import settle

DAY = "event_day"


def write_by_day(df: DataFrame, ts: str, path: str, mode: str = "append") -> None:
    """One folder per day. Rebalancing gathers a day into few files, and adaptive
    execution splits a day that is too large for one task."""
    (
        df.withColumn(DAY, F.to_date(ts))
        .hint("rebalance", DAY)
        .write.mode(mode)
        .partitionBy(DAY)
        .parquet(path)
    )


def replace_days(df: DataFrame, ts: str, path: str) -> None:
    """Write the days that ``df`` holds anew; other days stay as they are."""
    (
        df.withColumn(DAY, F.to_date(ts))
        .hint("rebalance", DAY)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(DAY)
        .parquet(path)
    )


def read_days(spark: SparkSession, path: str, first: str | None = None, last: str | None = None) -> DataFrame:
    """The stored rows with their day as a date; ``first`` to ``last`` opens these days only."""
    rows = spark.read.option("basePath", path).parquet(path)
    rows = rows.withColumn(DAY, F.col(DAY).cast("date"))
    if first is not None:
        rows = rows.where(F.col(DAY) >= F.lit(first).cast("date"))
    if last is not None:
        rows = rows.where(F.col(DAY) <= F.lit(last).cast("date"))
    return rows


def on_days(rows: DataFrame, days: DataFrame) -> DataFrame:
    """Rows of the days in ``days`` (``event_day``), however often a day is listed.

    The list is written first, so that the planner knows its size: it is broadcast
    when it is small, and the scan of ``rows`` waits for it to skip all other days.
    """
    few = settle(days.select(F.col(DAY).cast("date").alias(DAY)).distinct(), "days")
    # Spark prunes by a joined list only if a filter promises that it is selective.
    return rows.join(few.where(F.col(DAY) >= F.lit("0001-01-01").cast("date")), DAY, "left_semi")
