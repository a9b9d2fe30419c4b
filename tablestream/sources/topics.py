"""Message streams: a Kafka topic, or a folder of JSON lines in its place."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Where a line was read; orders lines that carry no offset.
PLACE = ("_file_time", "_file", "_block")
TEXT_LINE = T.StructType([T.StructField("value", T.StringType())])


def kafka_options(
    brokers: str,
    topic: str,
    start: str = "latest",
    group_id: str | None = None,
    max_offsets: int | None = None,
) -> dict[str, str]:
    """``start`` is ``latest``, ``earliest`` or a JSON map of offsets.

    It only counts on the first run; later runs resume from the checkpoint.
    ``max_offsets`` bounds a micro-batch, so that a backlog is worked off in parts.
    """
    options = {
        "kafka.bootstrap.servers": brokers,
        "subscribe": topic,
        "startingOffsets": start.removesuffix("-offset"),
    }
    if group_id:
        options["kafka.group.id"] = group_id
    if max_offsets:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    return options


def kafka_messages(spark: SparkSession, brokers: str, topic: str, **kw) -> DataFrame:
    """Columns ``value`` and ``_seq``. Needs Spark's Kafka package.

    ``_seq`` orders by offset and then partition: rows of one key share a
    partition, where offsets rise; equal offsets of two partitions are decided
    by the partition number.
    """
    raw = spark.readStream.format("kafka").options(**kafka_options(brokers, topic, **kw)).load()
    return raw.select(F.col("value").cast("string").alias("value"), kafka_seq())


def kafka_seq():
    """One rising number per message; leaves room for 65,536 partitions."""
    return (F.col("offset") * F.lit(65536) + F.col("partition")).alias("_seq")


def text_messages(
    spark: SparkSession, folder: str, max_files: int | None = None, glob: str | None = None
) -> DataFrame:
    """Messages from a folder of JSON lines; ``arrivals`` puts a batch of them in order."""
    reader = spark.readStream.schema(TEXT_LINE)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return _lines(reader.text(folder))


def text_messages_batch(spark: SparkSession, folder: str) -> DataFrame:
    return arrivals(_lines(spark.read.schema(TEXT_LINE).text(folder)))


def _lines(lines: DataFrame) -> DataFrame:
    offset = F.get_json_object("value", "$.offset").try_cast("long")
    place = [
        F.col("_metadata.file_modification_time").alias("_file_time"),
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
    ]
    return lines.select("value", offset.alias("_seq"), *place)


def arrivals(batch: DataFrame) -> DataFrame:
    """Number the messages of a batch in the order of their arrival, as ``_seq``.

    Kafka messages have their number. Lines of files count by the time and name of
    their file and their place in it; lines with an ``offset`` field of their own, as
    a topic's copy has, go by that. A folder has such a field in all lines or none.
    """
    if not set(PLACE) <= set(batch.columns):
        return batch
    lines = batch.withColumn("_line", F.monotonically_increasing_id())
    splits = lines.groupBy(*PLACE).agg(F.min("_line").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy(*PLACE).rowsBetween(Window.unboundedPreceding, -1)
    starts = splits.select(
        *PLACE, (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift")
    )
    kept = [c for c in batch.columns if c not in (*PLACE, "_seq")]
    # One row per file split of this batch: the list the driver has planned it by.
    return lines.join(F.broadcast(starts), list(PLACE)).select(
        *kept, F.coalesce("_seq", F.col("_line") + F.col("_shift")).alias("_seq")
    )


def in_key_order(
    messages: DataFrame, key: str, order: Sequence[str], partitions: int | None = None
) -> DataFrame:
    """Deal messages out by their key and sort each part: a key's messages leave one
    task one after the other, as a topic's partition must take them."""
    dealt = messages.repartition(partitions, key) if partitions else messages.repartition(key)
    return dealt.sortWithinPartitions(key, *order)


def write_messages(
    messages: DataFrame,
    folder: str,
    key: str | None = None,
    order: Sequence[str] = (),
    files: int | None = None,
) -> None:
    """Offline stand-in for the topic: the message text, one per line.

    With ``key`` the messages of a key stand in one file by ``order``.
    """
    if key:
        messages = in_key_order(messages, key, order, files)
    messages.select("value").write.mode("append").text(folder)


def publish_to_kafka(messages: DataFrame, brokers: str, topic: str, order: Sequence[str] = ()) -> None:
    """Batch write of ``key``/``value`` rows, those of a key by ``order`` if it is given.

    Needs Spark's Kafka package. A retried task sends its messages again, so a reader
    takes the last of a key and not the count.
    """
    rows = in_key_order(messages, "key", order) if order else messages
    (
        rows.select("key", "value")
        .write.format("kafka")
        .option("kafka.bootstrap.servers", brokers)
        .option("topic", topic)
        .save()
    )
