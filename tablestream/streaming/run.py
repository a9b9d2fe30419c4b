"""Starting a query with a checkpoint, and the batch writers of keyed tables."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import Future
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tablestream.functions.codec import NO_KEY
from tablestream.operators.changelog import MAIN, EventTable, open_table
from tablestream.schemas import COMMIT_INTERVAL, TableSpec, rejects_of


def start(
    stream: DataFrame,
    write: Callable[[DataFrame, int, str], object],
    name: str,
    checkpoint: str,
    mode: str = "append",
    interval: str | None = COMMIT_INTERVAL,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Run ``write(batch, batch_id, writer)`` per micro-batch.

    ``interval`` None works off what is there and stops. ``writer`` names the query
    by the id that its checkpoint keeps: a restarted query has the same one, a query
    with a new checkpoint another, though both count their batches from 0. Writer
    and batch number together make each batch count exactly once.
    ``state_partitions`` spreads keyed state over that many tasks; the first run
    fixes it for the life of the checkpoint, so choose it for the load to come.
    """
    spark = stream.sparkSession
    identity: Future[str] = Future()

    def run(batch: DataFrame, batch_id: int) -> None:
        write(batch, batch_id, f"{name}:{identity.result()}")

    writer = (
        stream.writeStream.queryName(name)
        .outputMode(mode)
        .option("checkpointLocation", f"{checkpoint.rstrip('/')}/{name}")
        .foreachBatch(run)
    )
    if interval is None:
        writer = writer.trigger(availableNow=True)
    else:
        writer = writer.trigger(processingTime=interval)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        # A query takes over the session's settings when it starts.
        spark.conf.set("spark.sql.shuffle.partitions", str(state_partitions or before))
        query = writer.start()
        identity.set_result(str(query.id))
        return query
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def save_rejects(
    table: EventTable, rows: DataFrame, writer: str, batch_id: int, branch: str = MAIN
) -> None:
    """Keep the rows a job could not use, on the job's own branch; a batch without
    any commits nothing."""
    if rows.isEmpty():
        return
    if branch != MAIN and table.versions(branch).isEmpty():
        table.create()
        table.create_branch(branch)
    stamped = rows.withColumnRenamed("reject_reason", "reason").withColumn(
        "ingestion_time", F.current_timestamp().cast("timestamp_ntz")
    )
    table.append(stamped, branch, writer=writer, writer_batch=batch_id)


def keyed_writer(
    spark: SparkSession, root: str, spec: TableSpec, job: str, branch: str = MAIN
) -> Callable[[DataFrame, int, str], None]:
    """Commit every micro-batch to the keyed table ``spec``.

    A keyed table holds no NULL key; such rows go to the job's reject table.
    """
    table = open_table(spark, root, spec)
    rejects = open_table(spark, root, rejects_of(job))

    def write(batch: DataFrame, batch_id: int, writer: str) -> None:
        rows = batch.persist()
        try:
            keyed = rows.dropna(subset=list(spec.key))
            without = rows.where(reduce(or_, [F.col(k).isNull() for k in spec.key])).select(
                F.to_json(F.struct(*batch.columns)).alias("value"),
                F.lit(NO_KEY).alias("reject_reason"),
            )
            save_rejects(rejects, without, writer, batch_id, branch)
            table.append(keyed, branch, writer=writer, writer_batch=batch_id)
        finally:
            rows.unpersist()

    return write
