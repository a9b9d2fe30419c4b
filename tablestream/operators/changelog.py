"""Keyed, append-only and partial-sum tables kept as Parquet changes.

    <root>/<table>/changes/branch=<b>/batch_id=<n>/rows-<attempt>/   the rows, first
    <root>/<table>/commits/<b>/<fold>/<n>.parquet                    one row, last

Readers open only the folders that commits since the newest base name, so a
half-written batch is never seen and old history is not even listed. Commits are
folded: the first commit of every hundred repeats the earlier rows, so a reader
lists and opens one fold however long the history is.

A writer names its own batch (``writer``, ``writer_batch``); a replay of a
committed one is a no-op. Rows are written aside, in a folder of their own, which the
commit names. The commit is a whole file that takes its place only if nothing is
there: a writer that is late, however late, finds its number taken and goes on to the
next one. So several writers of one branch commit one after the other and lose
nothing, and no clock decides. A rewrite stores the version it was made of
(``covers``), and readers add every batch after that version, whenever it was
committed.
"""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass
from datetime import datetime

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablestream.functions.times import zoneless
from tablestream.operators import keyed
from tablestream.schemas import COMMIT, KEYED, SUMS, TableSpec

MAIN = "main"
ADD, REPLACE, FORK = "append", "replace", "fork"
#: Commits per fold.
FOLD = 100


class NoSuchVersion(LookupError):
    """The table, branch or version asked for was never committed."""


class HeadMoved(RuntimeError):
    """Another batch was committed first."""


@dataclass(frozen=True)
class Layer:
    """The part of one branch a read sees: batches after ``after`` up to ``upto``,
    over the rewritten rows of batch ``base``, if there is one."""

    branch: str
    after: int
    upto: int
    base: int | None = None


class EventTable:
    def __init__(self, spark: SparkSession, root: str, spec: TableSpec):
        self.spark = spark
        self.spec = spec
        self.path = f"{root.rstrip('/')}/{spec.name}"

    # -- commits -----------------------------------------------------------

    def versions(self, branch: str = MAIN) -> DataFrame:
        """One row per commit of ``branch``; empty before the first."""
        return self._read_commits([branch])

    def _read_commits(self, branches: list[str]) -> DataFrame:
        newest = [
            f"{self.path}/commits/{b}/{fold}"
            for b in branches
            if (fold := self._newest_fold(b)) is not None
        ]
        if not newest:
            return self.spark.createDataFrame([], COMMIT)
        reader = self.spark.read.schema(COMMIT).option("recursiveFileLookup", "true")
        return reader.parquet(*newest)

    def _newest_fold(self, branch: str) -> int | None:
        """The newest fold with a finished commit. A commit is one file, so a
        writer that died leaves none, and the fold before still has it all."""
        for fold in sorted(map(int, self._children(f"commits/{branch}")), reverse=True):
            if any(x.endswith(".parquet") for x in self._children(f"commits/{branch}/{fold}", files=True)):
                return fold
        return None

    def _children(self, folder: str, files: bool = False) -> list[str]:
        path, system = self._file_system(folder)
        if not system.exists(path):
            return []
        return [s.getPath().getName() for s in system.listStatus(path) if s.isFile() == files]

    def _file_system(self, folder: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{folder}")
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def latest_version(self, branch: str = MAIN) -> int:
        """The newest committed batch of ``branch``; fails if there is none."""
        head = self.versions(branch).agg(F.max("batch_id")).first()[0]
        if head is None:
            raise NoSuchVersion(f"{self.spec.name} has no committed batch on {branch}")
        return head

    def snapshots(self, branch: str = MAIN) -> DataFrame:
        """Version list, newest first."""
        return (
            self.versions(branch)
            .select("batch_id", "commit_ts", "operation", "rows")
            .orderBy(F.desc("commit_ts"), F.desc("batch_id"))
        )

    def committed(self, writer: str, writer_batch: int, branch: str = MAIN) -> bool:
        mine = (F.col("writer") == writer) & (F.col("writer_batch") == writer_batch)
        return not self.versions(branch).where(mine).isEmpty()

    def high_water_before(self, writer: str, writer_batch: int, branch: str = MAIN) -> datetime | None:
        """The mark stored by the writer's earlier batches."""
        mine = (F.col("writer") == writer) & (F.col("writer_batch") < writer_batch)
        return self.versions(branch).where(mine).agg(F.max("high_water")).first()[0]

    # -- writing -----------------------------------------------------------

    def create(self) -> bool:
        """Commit an empty first version, unless the table has one."""
        if not self.versions().isEmpty():
            return False
        self.append(self.spark.createDataFrame([], self.spec.schema))
        return True

    def append(
        self,
        rows: DataFrame,
        branch: str = MAIN,
        writer: str | None = None,
        writer_batch: int | None = None,
        operation: str = ADD,
        high_water: datetime | None = None,
        covers: int | None = None,
        expected_head: int | None = None,
    ) -> int:
        """Commit ``rows`` as one batch and return its id.

        Rows may carry ``_seq`` and ``_op``; they default to 0 and ``U``. With
        ``expected_head`` nothing is committed if another batch came in between.
        """
        batch_id, done = self._next(branch, writer, writer_batch)
        if done is not None:
            return done
        attempt = f"rows-{uuid.uuid4().hex}"
        written = Observation()
        counted = self.as_changes(rows).observe(written, F.count(F.lit(1)).alias("rows"))
        counted.write.parquet(self._folder(branch, batch_id, attempt))
        return self._commit(
            branch,
            operation,
            batch_id,
            expected_head,
            folder=attempt,
            rows=written.get["rows"],
            writer=writer,
            writer_batch=writer_batch,
            high_water=high_water,
            covers=covers,
        )

    def as_changes(self, rows: DataFrame) -> DataFrame:
        have = set(rows.columns)
        return rows.select(
            *[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.spec.schema],
            (F.col("_seq") if "_seq" in have else F.lit(0)).cast("long").alias("_seq"),
            (F.col("_op") if "_op" in have else F.lit(keyed.UPSERT)).alias("_op"),
        )

    @property
    def change_schema(self) -> T.StructType:
        return T.StructType(
            [
                *self.spec.schema.fields,
                T.StructField("_seq", T.LongType()),
                T.StructField("_op", T.StringType()),
            ]
        )

    def _next(
        self, branch: str, writer: str | None = None, writer_batch: int | None = None
    ) -> tuple[int, int | None]:
        """The next batch id, and the id the writer's batch has already got."""
        mine = (F.col("writer") == F.lit(writer)) & (F.col("writer_batch") == F.lit(writer_batch))
        head, done = (
            self.versions(branch)
            .agg(F.max("batch_id"), F.max(F.when(mine, F.col("batch_id"))))
            .first()
        )
        if head is None and branch != MAIN:
            raise NoSuchVersion(f"create branch {branch} of {self.spec.name} before writing to it")
        return (0 if head is None else head + 1), done

    def _folder(self, branch: str, batch_id: int, attempt: str) -> str:
        return f"{self.path}/changes/branch={branch}/batch_id={batch_id}/{attempt}"

    def stored(self, branch: str, batch_id: int) -> DataFrame:
        """The rows of one committed batch, as they were written."""
        row = self.versions(branch).where(F.col("batch_id") == batch_id).select("folder").first()
        return self.spark.read.schema(self.change_schema).parquet(self._folder(branch, batch_id, row.folder))

    def _commit(
        self, branch: str, operation: str, batch_id: int, expected_head: int | None = None, **values
    ) -> int:
        """Commit under ``batch_id``, or under the next free id if others were faster."""
        while True:
            if expected_head is not None and batch_id != expected_head + 1:
                raise HeadMoved(f"{branch} moved from {expected_head} to {batch_id - 1}")
            if self._write_commit(branch, batch_id, operation, values):
                return batch_id
            taken = batch_id
            batch_id, done = self._next(branch, values.get("writer"), values.get("writer_batch"))
            if done is not None:
                return done
            if attempt := values.get("folder"):
                # Only this writer knows the folder, and no reader yet.
                self._move(self._folder(branch, taken, attempt), self._folder(branch, batch_id, attempt))

    def _write_commit(self, branch: str, batch_id: int, operation: str, values: dict) -> bool:
        """Whether the commit got its number: false if the number is taken."""
        given = {"branch": branch, "batch_id": batch_id, "operation": operation, **values}
        mark = given.get("high_water")
        computed = {
            "commit_ts": F.current_timestamp(),
            "high_water": F.lit(None) if mark is None else zoneless(mark),
        }
        row = self.spark.range(0, 1, 1, 1).select(
            *[
                computed.get(f.name, F.lit(given.get(f.name))).cast(f.dataType).alias(f.name)
                for f in COMMIT
            ]
        )
        fold = max(batch_id, 0) // FOLD
        if fold and self._newest_fold(branch) != fold:
            row = self._read_commits([branch]).unionByName(row).coalesce(1)
        aside = f"commits/{branch}/{fold}/_new-{uuid.uuid4().hex}"
        row.write.parquet(f"{self.path}/{aside}")
        (part,) = [x for x in self._children(aside, files=True) if x.endswith(".parquet")]
        made = self._place(f"{aside}/{part}", f"commits/{branch}/{fold}/{batch_id}.parquet")
        path, files = self._file_system(aside)
        files.delete(path, True)
        return made

    def _place(self, source: str, target: str) -> bool:
        """Give a whole file its name, unless the name is taken: one atomic step of the
        store (a link on a local disk, a rename that refuses elsewhere)."""
        jvm = self.spark._jvm
        old, files = self._file_system(source)
        new, _ = self._file_system(target)
        try:
            if files.getScheme() == "file":
                local = [jvm.java.io.File(p.toUri().getPath()).toPath() for p in (new, old)]
                jvm.java.nio.file.Files.createLink(*local)
            else:
                modes = self.spark.sparkContext._gateway.new_array(
                    getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0
                )
                conf = self.spark._jsc.hadoopConfiguration()
                jvm.org.apache.hadoop.fs.FileContext.getFileContext(old.toUri(), conf).rename(old, new, modes)
        except Py4JJavaError as error:
            if "FileAlreadyExists" not in str(error.java_exception):
                raise
            return False
        return True

    def _move(self, source: str, target: str) -> None:
        old, files = self._file_system(source.removeprefix(f"{self.path}/"))
        new, _ = self._file_system(target.removeprefix(f"{self.path}/"))
        files.mkdirs(new.getParent())
        if not files.rename(old, new):
            raise OSError(f"cannot move {source} to {target}")

    # -- branches ---------------------------------------------------

    def create_branch(self, branch: str, source: str = MAIN, at: int | None = None) -> int:
        """Fork ``branch`` from a version of ``source``; copies no data."""
        _check_name(branch)
        if not self.versions(branch).isEmpty():
            raise ValueError(f"branch {branch} already exists")
        at = self.latest_version(source) if at is None else at
        fork = {"rows": 0, "fork_batch": at, "source_branch": source, "covers": -1}
        self._commit(branch, FORK, -1, expected_head=-2, **fork)
        return at

    def refork(self, branch: str, source: str, at: int, covers: int) -> None:
        """Let ``branch`` start again from ``source`` at ``at``, which holds the
        branch's batches up to ``covers``; later ones stay on top."""
        fork = {"rows": 0, "fork_batch": at, "source_branch": source, "covers": covers}
        self._commit(branch, FORK, self._next(branch)[0], **fork)

    def branches(self) -> list[str]:
        return sorted(self._children("commits"))

    def layers(self, ref: str = MAIN, version: int | None = None) -> list[Layer]:
        """What a read of a branch (at ``version``) is made of, lowest first."""
        found: list[Layer] = []
        while True:
            at = self._position(ref, version)
            if at["head"] is None:
                raise NoSuchVersion(f"{self.spec.name} has no committed batch on {ref}")
            if version is not None and not at["present"]:
                raise NoSuchVersion(f"{self.spec.name} has no batch {version} on {ref}")
            upto = at["head"] if version is None else version
            base, fork = at["base"], at["fork"]
            # A rewrite that was read before the newest fork does not hold it.
            if base is not None and (fork is None or base["covers"] >= fork["batch_id"]):
                found.append(Layer(ref, base["covers"], upto, base["batch_id"]))
                break
            found.append(Layer(ref, -1 if fork is None else fork["covers"], upto))
            if fork is None:
                break
            ref, version = fork["source_branch"], fork["fork_batch"]
        return found[::-1]

    def _position(self, ref: str, version: int | None) -> Row:
        """Where a read of ``ref`` starts and ends, in one pass over its commits."""
        batch, operation = F.col("batch_id"), F.col("operation")
        fork = F.struct("batch_id", "fork_batch", "source_branch", "covers")
        seen = F.lit(True) if version is None else batch <= version
        return (
            self._read_commits([ref])
            .agg(
                F.max(batch).alias("head"),
                F.max(F.when((operation == FORK) & seen, fork)).alias("fork"),
                F.max(
                    F.when((operation == REPLACE) & seen, F.struct("covers", "batch_id"))
                ).alias("base"),
                F.coalesce(F.max(batch == F.lit(version)), F.lit(False)).alias("present"),
            )
            .first()
        )

    def layer_changes(self, layer: Layer) -> DataFrame:
        """Committed changes of one layer, with their ``batch_id``.

        Rows of the rewritten base rank as the version it was made of, below every
        batch that was committed meanwhile.
        """
        added = (
            (F.col("operation") == ADD)
            & (F.col("batch_id") > layer.after)
            & (F.col("batch_id") <= layer.upto)
        )
        live = [
            self._folder(layer.branch, *r)
            for r in self.versions(layer.branch)
            .where(added | (F.col("batch_id") == F.lit(layer.base)))
            .select("batch_id", "folder")
            .orderBy("batch_id")
            .collect()  # batch numbers since the last compaction, not data
        ]
        schema = T.StructType([*self.change_schema.fields, T.StructField("batch_id", T.LongType())])
        if not live:
            return self.spark.createDataFrame([], schema)
        rows = (
            self.spark.read.schema(schema)
            .option("basePath", f"{self.path}/changes/branch={layer.branch}")
            .parquet(*live)
        )
        if layer.base is None:
            return rows
        is_base = F.col("batch_id") == layer.base
        return rows.withColumn(
            "batch_id", F.when(is_base, F.lit(layer.after).cast("long")).otherwise(F.col("batch_id"))
        )

    def changes(self, branch: str = MAIN, version: int | None = None) -> DataFrame:
        return keyed.stack([self.layer_changes(x) for x in self.layers(branch, version)])

    def read(self, branch: str = MAIN, version: int | None = None) -> DataFrame:
        """The table's rows on ``branch``, now or at ``version``."""
        return self.state_of(self.changes(branch, version))

    def state_of(self, changes: DataFrame, with_seq: bool = False) -> DataFrame:
        spec = self.spec
        if spec.kind == KEYED:
            state = keyed.current_state(
                changes, spec.key, (keyed.LAYER, "batch_id", *spec.order), keep_version=True
            )
            return state.select(*spec.names, *(["_seq"] if with_seq else []))
        if spec.kind == SUMS:
            return keyed.sum_partials(changes, spec.key, spec.measures).select(*spec.names)
        return changes.select(*spec.names, *(["_seq"] if with_seq else []))

    def register(self, branch: str = MAIN, version: int | None = None, view: str | None = None) -> str:
        """Make the table visible to ``spark.sql``."""
        name = view or self.spec.name
        self.read(branch, version).createOrReplaceTempView(name)
        return name


def _check_name(ref: str) -> None:
    """Branches become folder names and, in views, follow two underscores."""
    if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9._-]*", ref):
        raise ValueError(f"not a name for a branch: {ref!r}")
    if ref == MAIN:
        raise ValueError(f"{MAIN} is reserved")


def open_table(spark: SparkSession, root: str, spec: TableSpec) -> EventTable:
    return EventTable(spark, root, spec)
