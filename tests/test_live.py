"""Checks with state across micro-batches and restarts."""

import random

import pytest
from pyspark.sql import functions as F

from tablestream.operators import lifecycle
from tablestream.operators.seen import SeenKeys, bit_numbers, is_set
from tablestream.plans.live import arrive
from tablestream.schemas import BIGINT, TEXT, TIME, TableSpec, columns
from tests.conftest import at, rows_of

EVENTS = "event_id bigint, order_id string, status string, t timestamp_ntz"
CHECKED = TableSpec(
    "checked",
    columns(event_id=BIGINT, order_id=TEXT, status=TEXT, t=TIME, previous_status=TEXT, greatest_time=TIME),
    ("event_id",),
)


def worked_off(spark, rows, ttl="1 hour", parts=4):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], EVENTS)
    plan = lambda s: lifecycle.with_last(s, "order_id", "status", "t", "event_id", ttl)
    return arrive(spark, df, CHECKED, plan, parts)


def brute(rows, ttl):
    state, out = {}, []
    for i, (key, status, t) in enumerate(rows):
        if key is None:
            continue
        last, greatest = state.get(key, (None, None))
        stale = t is not None and greatest is not None and (t - greatest).total_seconds() > ttl
        shown = (None, None) if stale else (last, greatest)
        out.append((i, key, status, t, *shown))
        state[key] = (status, t if greatest is None or (t is not None and t > greatest) else greatest)
    return sorted(out, key=repr)


@pytest.mark.parametrize("parts", [1, 4])
def test_state_goes_on_over_batches_and_restarts(spark, parts):
    rng = random.Random(5)
    rows = []
    for i in range(160):
        t = rng.choice([None, at(i * 60 + rng.randint(-600, 600)), at(i * 60)])
        rows.append((rng.choice(["o1", "o2", "o3", None]), rng.choice(["placed", "paid", "shipped", None]), t))
    assert rows_of(worked_off(spark, rows, "10 minutes", parts)) == brute(rows, 600)


def test_a_key_silent_for_longer_than_its_time_starts_anew(spark):
    rows = [("o1", "placed", at(0)), ("o1", "paid", at(3600)), ("o1", "shipped", at(7201)), ("o1", "paid", at(7300))]
    got = {r.event_id: (r.previous_status, r.greatest_time) for r in worked_off(spark, rows).collect()}
    assert got == {0: (None, None), 1: ("placed", at(0)), 2: (None, None), 3: ("shipped", at(7201))}


def test_steps_and_times_of_the_checks(spark):
    rows = [
        ("o1", "placed", at(10)), ("o2", "placed", at(11)), ("o1", "shipped", at(20)),
        ("o2", "payment_pending", at(5)), ("o1", "delivered", at(30)), ("o2", None, at(40)),
    ]
    checked = worked_off(spark, rows)
    assert rows_of(lifecycle.violations(checked, "status"), "event_id", "previous_status") == [(2, "placed"), (5, "payment_pending")]
    assert rows_of(lifecycle.behind(checked, "t"), "event_id", "greatest_time") == [(3, at(11))]


@pytest.mark.parametrize("shards", [1, 3])
def test_keys_of_a_shard_stay_apart(spark, shards):
    rng = random.Random(6)
    rows = []
    for i in range(200):
        t = rng.choice([None, at(i * 60 + rng.randint(-600, 600))])
        rows.append((rng.choice(["o1", "o2", "o3", "o4", None]), rng.choice(["placed", "paid", None]), t))
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], EVENTS)
    plan = lambda s: lifecycle.with_last(s, "order_id", "status", "t", "event_id", "10 minutes", shards)
    assert rows_of(arrive(spark, df, CHECKED, plan)) == brute(rows, 600)


# -- de-duplication over any span -------------------------------------------------


KEY = columns(a=BIGINT, b=TEXT)


def sent(spark, *rows):
    return spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "a bigint, b string, v string, at int")


@pytest.mark.parametrize("bits", [1 << 20, 64])
def test_repeats_are_found_however_late(spark, root, bits):
    """With 64 bits nearly every key passes the filter, and the exact join decides."""
    seen = SeenKeys(spark, root, KEY, bits=bits, buckets=4)
    first = sent(spark, (1, "x", "p"), (1, "x", "q"), (1, "y", "r"), (None, "x", "s"))
    assert rows_of(seen.accept(first, 0, ["at"]), "a", "b", "v") == [(1, "x", "p"), (1, "y", "r")]
    many = sent(spark, *[(i, "x", "z") for i in range(200)])
    assert seen.accept(many, 1, ["at"]).count() == 199
    late = sent(spark, (1, "x", "w"), (7, "x", "w"), (7, "new", "w"), (500, "x", "w"))
    assert rows_of(seen.accept(late, 2, ["at"]), "a", "b") == [(500, "x"), (7, "new")]
    # The same batch once more, as after a failure: the same answer.
    assert rows_of(seen.accept(late, 2, ["at"]), "a", "b") == [(500, "x"), (7, "new")]
    assert seen.accept(late, 3, ["at"]).isEmpty()
    assert seen.accept(late.limit(0), 4, ["at"]).isEmpty()


def test_the_filter_passes_stored_keys_and_few_others(spark, root):
    seen = SeenKeys(spark, root, columns(a=BIGINT), bits=1 << 16, buckets=4)
    seen.accept(spark.range(2000).select(F.col("id").alias("a"), F.lit(0).alias("at")), 0, ["at"])
    asked = spark.range(6000).select(F.col("id").alias("a"))
    passed = seen.perhaps_seen(asked, 1)
    assert passed.where("a < 2000").count() == 2000
    assert passed.where("a >= 2000").count() < 200
    assert seen.perhaps_seen(asked, 0).isEmpty()


def test_bits_are_read_as_they_are_written(spark):
    bits = spark.range(0, 300, 7).select((F.col("id") % 32768).alias("bit"))
    bitmap = bits.agg(F.bitmap_construct_agg("bit").alias("bits"))
    read = spark.range(320).crossJoin(bitmap).where(is_set("bits", F.col("id")))
    assert rows_of(read, "id") == rows_of(bits, "bit")
    spots = spark.range(50).select(bit_numbers(["id"], 100).alias("s")).collect()
    assert all(0 <= b < 100 for r in spots for b in r.s)
