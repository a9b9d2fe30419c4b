import re

import pytest
from pyspark.sql import functions as F

from tablestream.operators.buckets import BucketedTable
from tablestream.schemas import BIGINT, TEXT, columns
from tests.conftest import rows_of

SHAPE = columns(k=BIGINT, part=BIGINT, v=TEXT)


def plan(df):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


@pytest.fixture
def table(spark, root):
    return BucketedTable(spark, f"{root}/t", SHAPE, ["k", "part"], buckets=8)


def changes(spark, *rows):
    return spark.createDataFrame(rows, "k bigint, part bigint, v string, _op string, at int")


def test_last_change_wins_within_and_across_batches(spark, table):
    table.upsert(changes(spark, (1, 1, "a", "U", 1), (1, 1, "b", "U", 2), (2, 1, "c", "U", 1)), 0, ["at"])
    table.upsert(changes(spark, (2, 1, None, "D", 1), (3, 1, "d", "U", 1)), 1, ["at"])
    table.upsert(changes(spark, (2, 1, "e", "U", 1), (1, 2, "f", "U", 1)), 2, ["at"])
    assert rows_of(table.read(0)) == [(1, 1, "b"), (2, 1, "c")]
    assert rows_of(table.read(1)) == [(1, 1, "b"), (3, 1, "d")]
    assert rows_of(table.read()) == [(1, 1, "b"), (1, 2, "f"), (2, 1, "e"), (3, 1, "d")]


def test_a_batch_written_again_replaces_itself(spark, table):
    for _ in range(2):
        table.upsert(changes(spark, (1, 1, "a", "U", 1)), 0)
    assert table.changes().count() == 1
    table.upsert(changes(spark, (1, 1, "x", "U", 1)), 0)
    assert rows_of(table.read()) == [(1, 1, "x")]


def test_compaction_keeps_every_version_and_deletes(spark, table, root):
    table.upsert(changes(spark, (1, 1, "a", "U", 1), (2, 1, "b", "U", 1)), 0)
    table.upsert(changes(spark, (1, 1, None, "D", 1)), 1)
    before = {v: rows_of(table.read(v)) for v in (0, 1)}
    table.compact(1)
    table.upsert(changes(spark, (4, 1, "z", "U", 1)), 2)
    assert {v: rows_of(table.read(v)) for v in (0, 1)} == before
    assert rows_of(table.read()) == [(2, 1, "b"), (4, 1, "z")]
    assert table.base() == 1 and table.base(0) is None
    # Another session declares the table anew over the same files.
    spark.sql(f"DROP TABLE {table.name}")
    again = BucketedTable(spark, f"{root}/t", SHAPE, ["k", "part"], buckets=8)
    assert rows_of(again.read()) == [(2, 1, "b"), (4, 1, "z")]


def test_latest_per_key_and_compaction_move_nothing(spark, table):
    for n in range(3):
        rows = spark.range(2000).select(F.col("id").alias("k"), F.lit(n).cast("bigint").alias("part"), F.lit("v").alias("v"))
        table.upsert(rows, n)
    assert "Exchange" not in plan(table.read())
    assert "Exchange" not in plan(table._latest(1))
    one = plan(table.read().where("k = 77"))
    assert "Exchange" not in one
    assert re.search(r"SelectedBucketsCount: 1 out of 8", one)
    assert table.read().where("k = 77").count() == 3


def test_tables_with_the_same_buckets_join_in_place(spark, table, root):
    other = BucketedTable(spark, f"{root}/o", SHAPE, ["k"], buckets=8)
    rows = spark.range(3000).select(F.col("id").alias("k"), F.lit(1).cast("bigint").alias("part"), F.lit("v").alias("v"))
    table.upsert(rows, 0)
    other.upsert(rows.where("k % 3 = 0"), 0)
    joined = table.read().hint("merge").join(other.read().withColumnRenamed("v", "w"), "k")
    assert "Exchange" not in plan(joined)
    assert joined.count() == 1000


def test_a_hot_key_is_one_row_per_batch(spark, table):
    hot = spark.range(5000).select(
        F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id")).cast("bigint").alias("k"),
        F.lit(1).cast("bigint").alias("part"),
        F.col("id").cast("string").alias("v"),
        F.col("id").alias("at"),
    )
    table.upsert(hot, 0, ["at"])
    assert table.changes().where("k = 7").count() == 1
    assert table.read().where("k = 7").first().v == "4998"


def test_a_change_without_a_key_is_refused(spark, table):
    with pytest.raises(Exception, match="a change without k"):
        table.upsert(changes(spark, (None, 1, "a", "U", 1)), 0)


def test_empty_batches_and_tables(spark, table):
    assert table.read().count() == 0
    table.upsert(spark.createDataFrame([], "k bigint, part bigint, v string"), 0)
    assert table.read().count() == 0 and table.base() is None
