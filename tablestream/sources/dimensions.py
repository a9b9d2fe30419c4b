"""Static dimension files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablestream.schemas import REGION_DIM


def read_csv_dimension(
    spark: SparkSession, path: str, schema: T.StructType = REGION_DIM, delimiter: str = ","
) -> DataFrame:
    """A CSV without header. A line of the wrong width is left out; a field
    that does not fit its type is NULL and its line stays."""
    as_text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema])
    lines = (
        spark.read.schema(as_text)
        .option("header", "false")
        .option("sep", delimiter)
        .option("mode", "DROPMALFORMED")
        # Judge the whole line, whichever columns a query asks for.
        .option("columnPruning", "false")
        .csv(path)
    )
    return lines.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema])
