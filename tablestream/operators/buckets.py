"""Keyed tables laid out by their key: hash buckets in plain Parquet.

    <path>/batch_id=<n>/base=<0 or 1>/part-..._<bucket>.c000.parquet

A batch is one partition, cut into buckets by a hash of the key. Spark reads such files
as already dealt out by the key, so the latest row per key, a join of two tables with
the same buckets and a compaction move no stored row, and a read of one key opens one
bucket. Files carry their bucket in their names; the table's declaration is repeated by
each session and no catalog service is needed.

A batch is reduced to the last change of each key before it is written. A key that
comes in a third of all changes is one row per batch, and buckets stay even.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablestream.operators.keyed import DELETE, UPSERT, last_per_key

BUCKETS = 64


def declare(
    spark: SparkSession, name: str, path: str, stored: Sequence[str], partitions: dict[str, str], more: str = ""
) -> None:
    """Tell the session of a partitioned Parquet table in ``path``, and what it holds."""
    typed = [*stored, *[f"{c} {kind}" for c, kind in partitions.items()]]
    # Writing nothing makes the folder, where there is none, in any store.
    nothing = spark.createDataFrame([], ", ".join(typed))
    nothing.write.mode("append").partitionBy(*partitions).parquet(path)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({', '.join(typed)}) USING parquet"
        f" PARTITIONED BY ({', '.join(partitions)}) {more} LOCATION '{path}'"
    )
    spark.catalog.recoverPartitions(name)


def replace_partitions(rows: DataFrame, name: str) -> None:
    """Write ``rows`` over the partitions they belong to; all others stay."""
    conf, setting = rows.sparkSession.conf, "spark.sql.sources.partitionOverwriteMode"
    before = conf.get(setting)
    # A writer's option does not reach a declared table.
    conf.set(setting, "dynamic")
    try:
        rows.write.mode("overwrite").insertInto(name)
    finally:
        conf.set(setting, before)


class BucketedTable:
    """The last change per key wins, by batch. ``key[0]`` decides the bucket."""

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: T.StructType,
        key: Sequence[str],
        buckets: int = BUCKETS,
    ) -> None:
        self.spark, self.path, self.key, self.buckets = spark, path.rstrip("/"), list(key), buckets
        self.columns = schema.fieldNames()
        self.name = "bucketed_" + hashlib.sha256(self.path.encode()).hexdigest()[:16]
        stored = [*[f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields], "_op STRING"]
        declare(
            spark,
            self.name,
            self.path,
            stored,
            {"batch_id": "BIGINT", "base": "INT"},
            f"CLUSTERED BY (`{self.key[0]}`) SORTED BY (`{self.key[0]}`) INTO {buckets} BUCKETS",
        )

    # -- writing -----------------------------------------------------------

    def upsert(self, rows: DataFrame, batch_id: int, order: Sequence[str] = ()) -> None:
        """Store a batch of changes; the same number again replaces it.

        ``order`` ranks the changes of one key. ``_op`` is ``U`` or ``D``, ``U`` if absent.
        Rows without a key belong to no bucket and are refused.
        """
        if "_op" not in rows.columns:
            rows = rows.withColumn("_op", F.lit(UPSERT))
        for k in self.key:
            whole = F.when(F.col(k).isNull(), F.raise_error(F.lit(f"a change without {k}")))
            rows = rows.withColumn(k, F.coalesce(whole.cast(rows.schema[k].dataType), F.col(k)))
        last = last_per_key(rows, self.key, order or self.key)
        # One file per bucket: the same hash deals the rows to the tasks.
        self._write(last.repartition(self.buckets, self.key[0]), batch_id, 0)

    def compact(self, version: int) -> None:
        """Write the state of ``version`` as one batch, bucket by bucket, without a shuffle.

        Later reads start from it; older ones find what they found before. Deleted
        keys stay as rows that say so.
        """
        self._write(self._latest(version), version, 1)

    def _write(self, rows: DataFrame, batch_id: int, base: int) -> None:
        stored = rows.select(*self.columns, "_op", F.lit(batch_id).alias("batch_id"), F.lit(base).alias("base"))
        replace_partitions(stored, self.name)

    # -- reading -----------------------------------------------------------

    def base(self, version: int | None = None) -> int | None:
        """The newest compacted batch up to ``version``, from the list of partitions."""
        batch = F.regexp_extract("partition", r"batch_id=(-?\d+)/base=1", 1).try_cast("bigint")
        seen = self.spark.sql(f"SHOW PARTITIONS {self.name}").select(batch.alias("b"))
        return seen.where(F.lit(True) if version is None else F.col("b") <= version).agg(F.max("b")).first()[0]

    def changes(self, version: int | None = None) -> DataFrame:
        """Stored changes since the newest base, which counts as one."""
        rows = self.spark.table(self.name)
        if version is not None:
            rows = rows.where(F.col("batch_id") <= version)
        if (base := self.base(version)) is None:
            return rows.where("base = 0")
        return rows.where((F.col("batch_id") > base) & (F.col("base") == 0) | (F.col("batch_id") == base) & (F.col("base") == 1))

    def _latest(self, version: int | None) -> DataFrame:
        return last_per_key(self.changes(version), self.key, ["batch_id"])

    def read(self, version: int | None = None) -> DataFrame:
        """The rows as of ``version``, still dealt out by the key."""
        return self._latest(version).where(F.col("_op") != DELETE).select(*self.columns)
