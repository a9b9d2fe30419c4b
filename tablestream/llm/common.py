"""What the operators share: session pins, Arrow stages, text access."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tablestream.session import fresh_path, pin_utc
from tablestream.sources.tables import table

__all__ = [
    "Batches", "Scratch", "annotate", "arrow", "collect_garbage", "documents", "only", "ready", "release", "settle", "table", "text_of"
]

Batches = Iterable[pa.RecordBatch]

#: An Arrow batch. Texts run to hundreds of kilobytes, so rows alone are no bound.
BATCH_ROWS, BATCH_BYTES = 5000, "4m"


def ready(spark: SparkSession) -> SparkSession:
    """UTC and small Arrow batches; local workers find this package.

    On a cluster the package is shipped with ``--py-files``.
    """
    if spark.sparkContext.master.startswith("local"):
        spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).parents[2]))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return pin_utc(spark)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(ready(spark), sf_dir, "documents")


_CACHES: list = []


def only(cache=None) -> None:
    """Empty the word caches that other operators have left in this worker.

    Workers live on between stages; the caches of all operators would add up. What
    they held goes back to the system, which a C heap does not do by itself.
    """
    if others := [c for c in _CACHES if c is not cache]:
        for other in others:
            other.clear()
        _CACHES[:] = [c for c in _CACHES if c is cache]
        gc.collect()
        pa.default_memory_pool().release_unused()
        if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
            trim(0)
    if cache is not None and not any(c is cache for c in _CACHES):
        _CACHES.append(cache)


#: Intermediate tables since the last ``release``.
_WRITTEN: list[tuple[str, StructType]] = []


def settle(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage and survives
    lost executors."""
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    _WRITTEN.append((path, df.schema))
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession, forget: bool = False) -> None:
    """Free the intermediate tables since the last call, or only forget them.

    For a caller whose earlier results are written: what has not been written yet can
    no longer be computed.
    """
    for path, schema in [] if forget else _WRITTEN:
        spark.createDataFrame([], schema).coalesce(1).write.mode("overwrite").parquet(path)
    _WRITTEN.clear()


def collect_garbage(spark: SparkSession) -> None:
    """Let the executors collect garbage, so that their heaps give memory back.

    A heap keeps the size of the stage before, while the Python workers of the next one
    need the memory. One short task per core.
    """
    cores = spark.sparkContext.defaultParallelism
    once = spark.range(0, cores, 1, cores).select(F.expr("java_method('java.lang.System', 'gc')"))
    once.write.format("noop").mode("overwrite").save()


class Scratch:
    """Tables in the shared folder that a later step of the same work replaces."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.paths: dict[int, str] = {}

    def settle(self, df: DataFrame, label: str) -> DataFrame:
        held = settle(df, label)
        self.paths[id(held)] = _WRITTEN[-1][0]
        return held

    def drop(self, *held: DataFrame) -> None:
        """Free the space of tables that nothing reads any more."""
        for df in held:
            none = self.spark.createDataFrame([], df.schema)
            path = self.paths.pop(id(df))
            none.write.mode("overwrite").parquet(path)
            _WRITTEN[:] = [w for w in _WRITTEN if w[0] != path]


def text_of(df: DataFrame, column: str = "text"):
    """The text column, null as the empty text."""
    return F.coalesce(df[column].cast("string"), F.lit(""))


def arrow(
    df: DataFrame, step: Callable[[Batches], Iterator[pa.RecordBatch]], schema: str
) -> DataFrame:
    return df.mapInArrow(step, schema)


def annotate(
    df: DataFrame,
    text: str,
    found: Callable[[list[str | None]], list[list]],
    schema: str,
) -> DataFrame:
    """``df`` as a struct ``row`` beside what ``found`` says of each text.

    ``row`` keeps every column of ``df`` whatever its name, so an added column
    never clashes with one of the input. ``found`` takes the texts of a batch and
    returns one list of values per column of ``schema``.
    """
    packed = df.select(F.struct(*[df[c] for c in df.columns]).alias("row"), df[text].alias("text"))
    names = [part.split(":")[0].strip() for part in _fields(schema)]

    def step(batches: Batches) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        types = [to_arrow_type(f.dataType) for f in added.fields]
        for batch in batches:
            values = found(batch.column(1).to_pylist())
            arrays = [pa.array(v, t) for v, t in zip(values, types, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], ["row", *names])

    row_type = packed.schema["row"].dataType
    from pyspark.sql.types import StructField, _parse_datatype_string

    added = _parse_datatype_string(schema)
    return packed.mapInArrow(step, StructType([StructField("row", row_type), *added.fields]))


def _fields(schema: str) -> list[str]:
    """Top-level fields of ``name: type, ...``; commas inside brackets stay."""
    out, depth, at = [], 0, 0
    for i, c in enumerate(schema):
        depth += (c in "<(") - (c in ">)")
        if c == "," and depth == 0:
            out.append(schema[at:i])
            at = i + 1
    return [*out, schema[at:]]
