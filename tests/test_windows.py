import random

import pytest
from pyspark.sql import functions as F

from tablestream.functions.times import tumble, zoneless
from tablestream.operators import late, windows
from tests.conftest import at, rows_of


def test_distinct_orders(spark):
    rows = [
        (at(1), "P1", "o1"),
        (at(2), "P1", "o1"),
        (at(3), "P1", "o2"),
        (at(4), "P2", "o1"),
        (at(61), "P1", "o1"),
        (at(62), "P1", None),
        (at(63), None, "o9"),
    ]
    events = spark.createDataFrame(
        rows, "event_timestamp timestamp, product_id string, order_id string"
    )
    assert rows_of(windows.distinct_orders(events)) == sorted(
        [(at(0), "P1", 2), (at(0), "P2", 1), (at(60), "P1", 1), (at(60), None, 1)], key=repr
    )


def test_a_window_with_only_null_orders_counts_zero(spark):
    events = spark.createDataFrame(
        [(at(5), "P1", None)], "event_timestamp timestamp, product_id string, order_id string"
    )
    assert rows_of(windows.distinct_orders(events)) == [(at(0), "P1", 0)]


def test_sums_are_exact(spark):
    events = spark.createDataFrame(
        [(at(i % 60), "us", 0.1) for i in range(1000)] + [(at(1), "us", None)],
        "event_timestamp timestamp, region string, total_amount double",
    )
    out = windows.window_sales(events).collect()
    assert [str(r.total_sales) for r in out] == ["100.00"]


def test_sums_fail_rather_than_lie(spark):
    for amount in (float("nan"), 1e14):
        events = spark.createDataFrame(
            [(at(1), "us", amount)], "event_timestamp timestamp, region string, total_amount double"
        )
        with pytest.raises(Exception, match="counted in cents"):
            windows.window_sales(events).collect()


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
@pytest.mark.parametrize("size", ["1 minute", "1 hour", "7 days", "90 seconds"])
def test_windows_by_arithmetic_equal_the_built_in(spark, kind, size):
    df = spark.sql(
        f"""SELECT CAST(t AS {kind}) AS ts FROM VALUES ('1969-12-31 23:59:59.999999'), ('1970-01-01'),
        ('2024-02-29 12:34:56.789'), ('1905-06-07 01:02:03'), (NULL) AS v(t)"""
    )
    mine = tumble(df, "ts", size).select("ts", "window_start", "window_end")
    theirs = df.withColumn("w", F.window("ts", size)).select("ts", "w.start", "w.end")
    assert rows_of(mine) == rows_of(theirs) and mine.count() == 4
    assert [t for _, t in mine.dtypes] == [t for _, t in theirs.dtypes]


ARRIVALS = [(0, 10, 1), (1, 100, 2), (2, 20, 4), (3, 126, 8), (4, 30, 16), (5, 400, 32)]
SCHEMA = "_seq long, event_timestamp timestamp_ntz, region string, total_amount double"


def sales(spark, rows):
    return spark.createDataFrame([(s, at(t), "us-east", float(a)) for s, t, a in rows], SCHEMA)


def test_allowed_lateness(spark):
    marked = late.mark_late(sales(spark, ARRIVALS))
    totals = late.on_time_sales(marked).select("window_start", F.col("total_sales").cast("int"))
    assert rows_of(totals) == [(at(0), 5), (at(60), 2), (at(120), 8), (at(360), 32)]
    assert rows_of(late.dead_letters(marked)) == [("us-east", 16.0, at(30))]


@pytest.mark.parametrize(
    "mark, t, is_late",
    [(124.999, 59.999, False), (125.0, 59.999, True), (125.0, 60.0, False)],
)
def test_lateness_boundary(spark, mark, t, is_late):
    rows = sales(spark, [(0, mark, 1), (1, t, 1)])
    assert [r.is_late for r in late.mark_late(rows).orderBy("_seq").collect()] == [False, is_late]
    known = late.mark_late(rows.where("_seq = 1"), mark=zoneless(at(mark)))
    assert [r.is_late for r in known.collect()] == [is_late]


def test_rows_of_one_arrival_are_not_late_against_each_other(spark):
    rows = sales(spark, [(0, 500, 1), (0, 1, 2), (1, 1, 4)])
    late_amounts = late.mark_late(rows).where("is_late").select("total_amount")
    assert rows_of(late_amounts) == [(4.0,)]


def brute_force(rows):
    """(seq, high water before, late) by walking the arrivals."""
    out, mark = [], None
    for seq, t, _ in sorted(rows):
        end = t // 60 * 60 + 60
        out.append((seq, mark, mark is not None and end + 65 <= mark))
        mark = t if mark is None else max(mark, t)
    return out


@pytest.mark.parametrize("seed", range(3))
def test_lateness_equals_brute_force_and_conserves_amounts(spark, seed):
    rng = random.Random(seed)
    # Jumps over days, long quiet spells and negative steps.
    rows, clock = [], 200_000
    for seq in range(400):
        clock += rng.choice([1, 5, 40, 3_000, 90_000 if rng.random() < 0.05 else 2])
        rows.append((seq * 3, clock - rng.choice([0, 0, 0, 30, 70, 130, 5_000, 100_000]), seq + 1))
    truth = brute_force(rows)
    rng.shuffle(rows)
    marked = late.mark_late(sales(spark, rows).repartition(3)).cache()
    assert rows_of(marked, "_seq", "is_late") == sorted(((s, x) for s, _, x in truth), key=repr)
    assert any(x for _, _, x in truth)
    kept = late.on_time_sales(marked).agg(F.sum("total_sales")).first()[0]
    dead = late.dead_letters(marked).agg(F.sum("total_amount")).first()[0]
    assert float(kept) + dead == sum(a for _, _, a in rows)

    running = late.high_water(sales(spark, rows), chunk_bits=3, block_bits=2)
    assert rows_of(running, "_seq", "high_water") == sorted(
        ((s, None if m is None else at(m)) for s, m, _ in truth), key=repr
    )


def test_lateness_does_not_move_the_rows(spark):
    """The closing table is small, so the rows are joined where they are."""
    marked = late.mark_late(sales(spark, ARRIVALS))
    plan = marked._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
