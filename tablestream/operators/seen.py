"""De-duplication over any span of time: a Bloom filter before an exact join.

A watermark forgets a key after its delay, so a repeat that comes hours later passes.
Here every key ever accepted is stored, dealt into hash buckets by itself. A batch first
asks a Bloom filter of the stored keys: whoever misses a bit is new. Only the rest is
compared with the stored keys, in their buckets, and that exact join decides.

The filter is a table of bitmaps, one row for 32,768 bits, so that no task and no
broadcast holds it as a whole; a batch joins the rows its keys need.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablestream.operators.buckets import BUCKETS, BucketedTable, declare, replace_partitions
from tablestream.operators.keyed import first_per_key
from tablestream.session import settle

HASHES = 3
#: Bits of the filter, fixed for its life: ten for each key that is to come.
BITS = 1 << 33
#: Bits in one row.
ROW_BITS = 32_768


def bit_numbers(key: Sequence[str], bits: int = BITS, hashes: int = HASHES) -> Column:
    """The bits of a key, as an array of numbers from 0."""
    spots = [F.pmod(F.xxhash64(F.lit(seed), *key), F.lit(bits)) for seed in range(hashes)]
    return F.array_distinct(F.array(*spots))


def is_set(bitmap: Column | str, bit: Column) -> Column:
    """Whether a bit of a row is set: byte by byte, the lowest bit first."""
    byte = F.conv(F.hex(F.substring(bitmap, (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10)
    return F.getbit(byte.cast("int"), F.pmod(bit, F.lit(8)).cast("int")) == 1


class SeenKeys:
    """Keys accepted so far, under ``path``."""

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        key: T.StructType,
        bits: int = BITS,
        buckets: int = BUCKETS,
    ) -> None:
        self.spark, self.key, self.bits = spark, key.fieldNames(), bits
        self.stored = BucketedTable(spark, f"{path}/keys", key, self.key, buckets)
        self.filter = f"{self.stored.name}_filter"
        declare(spark, self.filter, f"{path}/filter", ["bucket BIGINT", "bits BINARY"], {"batch_id": "BIGINT"})

    def bitmaps(self, before: int) -> DataFrame:
        """The filter of all batches before ``before``."""
        rows = self.spark.table(self.filter).where(F.col("batch_id") < before)
        return rows.groupBy("bucket").agg(F.bitmap_or_agg("bits").alias("bits"))

    def perhaps_seen(self, keys: DataFrame, before: int) -> DataFrame:
        """Keys with all their bits set: every stored key, and a few others."""
        asked = keys.select(*self.key, F.explode(bit_numbers(self.key, self.bits)).alias("_bit"))
        asked = asked.select(
            *self.key,
            F.floor(F.col("_bit") / ROW_BITS).alias("bucket"),
            F.pmod("_bit", F.lit(ROW_BITS)).alias("_bit"),
        )
        hits = asked.join(self.bitmaps(before), "bucket", "left").select(
            *self.key, F.coalesce(is_set("bits", F.col("_bit")), F.lit(False)).alias("_hit")
        )
        return hits.groupBy(*self.key).agg(F.bool_and("_hit").alias("_all")).where("_all").drop("_all")

    def accept(self, batch: DataFrame, batch_id: int, arrival: Sequence[str]) -> DataFrame:
        """The first row of each key that no earlier batch had; the keys are stored.

        The same batch again gives the same rows. ``arrival`` ranks the rows of a key.
        Rows with a NULL in their key are left out.
        """
        whole = batch.dropna(subset=list(self.key))
        first = settle(first_per_key(whole, self.key, arrival), "first")
        asked = first.select(*self.key)
        perhaps = settle(self.perhaps_seen(asked, batch_id), "perhaps")
        stored = self.stored.changes(batch_id - 1).select(*self.key)
        # The stored side lies by its key: only the few that are asked for move.
        seen = stored.join(perhaps.repartition(self.stored.buckets, self.key[0]), self.key, "left_semi")
        fresh = settle(first.join(seen.distinct(), self.key, "left_anti"), "fresh")
        self._store(fresh.select(*self.key), batch_id)
        return fresh

    def _store(self, keys: DataFrame, batch_id: int) -> None:
        self.stored.upsert(keys, batch_id)
        spots = keys.select(F.explode(bit_numbers(self.key, self.bits)).alias("_bit")).select(
            F.floor(F.col("_bit") / ROW_BITS).alias("bucket"), F.pmod("_bit", F.lit(ROW_BITS)).alias("_bit")
        )
        rows = spots.groupBy("bucket").agg(F.bitmap_construct_agg("_bit").alias("bits"))
        rows = rows.select("bucket", "bits", F.lit(batch_id).cast("bigint").alias("batch_id"))
        replace_partitions(rows, self.filter)
