"""Small-file compaction."""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from math import ceil

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablestream.operators.changelog import MAIN, REPLACE, EventTable
from tablestream.schemas import APPEND

TARGET_BYTES = 256 << 20
#: Stored bytes whose keys one task merges: sorted rows take some twenty times that.
MERGE_BYTES = 32 << 20


@dataclass(frozen=True)
class Compaction:
    old_files: int
    new_files: int
    old_bytes: int
    new_bytes: int
    batch_id: int


def file_stats(stored: DataFrame) -> tuple[int, int]:
    """Files and bytes behind a scan, counted by Spark; reads no data columns."""
    files = stored.select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size")
    ).distinct()
    n, size = files.agg(F.count(F.lit(1)), F.sum("size")).first()
    return n, size or 0


def compact(
    table: EventTable,
    branch: str = MAIN,
    target_bytes: int = TARGET_BYTES,
    version: int | None = None,
) -> Compaction:
    """Rewrite a branch's live rows (at ``version``) as one new base version.

    Keyed tables shrink to the latest row per key, partial-sum tables to one row
    per key; append-only tables keep every row. Versions before the new base stay
    readable: their folders are left alone. Batches committed while it runs come
    after the version it has read, and readers add them to the new base.

    A task merges the keys of at most about ``MERGE_BYTES``, however large the files
    are to be; the merged rows are then written aside and strung together to files,
    which needs no sort.
    """
    head = table.latest_version(branch) if version is None else version
    stats = [file_stats(table.layer_changes(x)) for x in table.layers(branch, head)]
    old_files = sum(n for n, _ in stats)
    old_bytes = sum(b for _, b in stats)
    files = max(1, ceil(old_bytes / target_bytes))

    # The one shuffle that merges the keys gets its own partition count, in a session of
    # its own.
    merges = max(files, ceil(old_bytes / MERGE_BYTES))
    session = table.spark.newSession()
    session.conf.set("spark.sql.session.timeZone", "UTC")
    session.conf.set("spark.sql.shuffle.partitions", str(merges))
    session.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(min(target_bytes, MERGE_BYTES)))
    own = EventTable(session, table.path.rsplit("/", 1)[0], table.spec)
    live = own.state_of(own.changes(branch, head), with_seq=True)
    aside = f"_merged-{uuid.uuid4().hex}"
    try:
        if table.spec.kind == APPEND:
            live = live.repartition(files)
        elif merges > files:
            live.write.parquet(f"{table.path}/{aside}")
            live = session.read.schema(live.schema).parquet(f"{table.path}/{aside}").coalesce(files)
        batch_id = own.append(live, branch, operation=REPLACE, covers=head)
    finally:
        path, system = table._file_system(aside)
        system.delete(path, True)

    new_files, new_bytes = file_stats(table.stored(branch, batch_id))
    return Compaction(old_files, new_files, old_bytes, new_bytes, batch_id)
