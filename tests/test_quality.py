import random

import pytest
from pyspark.sql import functions as F

from tablestream.operators import late, lookup, partitions, quality
from tablestream.operators.sequence import hot_keys, with_previous
from tests.conftest import at, rows_of

EVENTS = "_seq long, order_id string, status string, event_timestamp timestamp_ntz"


def lifecycle(spark, *steps):
    return spark.createDataFrame([(i, o, s, at(i)) for i, (o, s) in enumerate(steps)], EVENTS)


def violations(df, **kw):
    out = quality.status_violations(
        df,
        "order_id",
        "status",
        ["event_timestamp", "_seq"],
        **kw,
    )
    return rows_of(out, "order_id", "previous_status", "status")


def test_status_transitions(spark):
    df = lifecycle(
        spark,
        ("skips", "placed"),
        ("fine", "placed"),
        ("fine", "payment_pending"),
        ("fine", "paid"),
        ("skips", "paid"),
        ("back", "delivered"),
        ("back", "returned"),
        ("back", "placed"),
    )
    assert violations(df) == [("back", "returned", "placed"), ("skips", "placed", "paid")]


@pytest.mark.parametrize("hot_rows", [0, 5, 1000])
def test_previous_row_is_the_same_for_hot_keys(spark, hot_rows):
    rng = random.Random(7)
    rows, seen, want, clock = [], {}, [], 0
    for i in range(300):
        clock += rng.choice([0, 1, 500, 9000])
        key = rng.choice(["hot", "hot", "hot", "a", "b", None])
        rows.append((i, key, f"s{i}", at(clock)))
        want.append((i, seen.get(key)))
        seen[key] = f"s{i}"
    df = spark.createDataFrame(rows, EVENTS).repartition(5)
    out = with_previous(
        df,
        ["order_id"],
        ["event_timestamp", "_seq"],
        {"before": "status"},
        hot_rows=hot_rows,
    )
    assert set(out.columns) == {*df.columns, "before"}
    assert rows_of(out, "_seq", "before") == sorted(want, key=repr)


def test_hot_keys_hold_more_than_their_rows(spark):
    df = spark.createDataFrame([(k,) for k in "aaaabbbcc"], "k string")
    assert rows_of(hot_keys(df, ["k"], rows=2)) == [("a",), ("b",)]


def test_a_dense_hour_of_a_hot_key_is_cut_by_rank(spark):
    """Half of all rows are one key within one hour, most of them on one instant."""
    hot = spark.range(20_000).select(
        F.col("id").alias("_seq"), F.lit("hot").alias("order_id"), F.col("id").cast("string").alias("status"),
        F.when(F.col("id") < 15_000, F.lit(0)).otherwise(F.col("id") % 3600).alias("s"),
    )
    cold = spark.range(20_000).select(
        (F.col("id") + 20_000).alias("_seq"), (F.col("id") % 4000).cast("string").alias("order_id"),
        F.col("id").cast("string").alias("status"), F.col("id").alias("s"),
    )
    rows = hot.unionByName(cold).withColumn("event_timestamp", F.timestamp_seconds("s").cast("timestamp_ntz")).drop("s")
    order = ["event_timestamp", "_seq"]
    conf, before = spark.conf, spark.conf.get("spark.sql.shuffle.partitions")
    conf.set("spark.sql.shuffle.partitions", "16")
    conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = with_previous(rows, ["order_id"], order, {"before": "status"}, hot_rows=1000)
        tasks = out.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
        assert tasks < 0.35 * 40_000
        plain = with_previous(rows, ["order_id"], order, {"before": "status"}, hot_rows=10**9)
        assert out.select("_seq", "before").exceptAll(plain.select("_seq", "before")).isEmpty()
        assert out.count() == 40_000
    finally:
        conf.set("spark.sql.shuffle.partitions", before)
        conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_out_of_order_and_current_status(spark):
    df = spark.createDataFrame(
        [
            (0, "o1", "placed", at(10)),
            (1, "o1", "paid", at(30)),
            (2, "o1", "payment_pending", at(20)),
            (3, "o2", "delivered", at(5)),
        ],
        EVENTS,
    )
    inverted = quality.out_of_order(
        df, "order_id", "event_timestamp", ["_seq"], hot_rows=0
    )
    assert rows_of(inverted, "_seq", "event_timestamp", "previous_time") == [(2, at(20), at(30))]
    status = quality.current_status(df, "order_id", "status", ["event_timestamp", "_seq"])
    assert rows_of(status) == [("o1", "paid", True), ("o2", "delivered", False)]


def test_delay_buckets(spark):
    delays = [0.0, 29.9, 30.0, 60.0, 90.0, 119.9, 120.0]
    df = spark.createDataFrame([(d,) for d in delays], "d double")
    counts = df.groupBy(quality.delay_bucket(F.col("d")).alias("b")).count()
    assert rows_of(counts) == [
        ("0-30s", 2),
        ("120s+", 1),
        ("30-60s", 1),
        ("60-90s", 1),
        ("90-120s", 2),
    ]


def test_lateness_profile(spark):
    df = spark.createDataFrame(
        [(at(100), at(40), "us"), (at(100), at(100), "us"), (at(100), at(70), "eu"), (None, at(1), "eu")],
        "ingestion_time timestamp_ntz, event_time timestamp_ntz, region string",
    )
    delayed = quality.with_delay(df, "event_time", "ingestion_time")
    assert rows_of(quality.lateness_profile(delayed)) == [(4, 2, 50.0, 45.0, 30.0, 60.0)]
    assert rows_of(quality.delay_histogram(delayed)) == [("30-60s", 1), ("60-90s", 1)]
    assert rows_of(quality.late_by(delayed)) == [("eu", 1), ("us", 1)]
    nothing = quality.lateness_profile(delayed.where("region = 'none'"))
    assert rows_of(nothing.select("total_events", "late_events", "avg_delay_sec")) == [(0, 0, 0.0)]


def test_duplicates(spark):
    df = spark.createDataFrame([(0, "e", "A"), (1, "e", "B"), (2, "f", "C")], "_seq int, id string, o string")
    assert rows_of(quality.deduplicate(df, ["id"], ["_seq"]), "o") == [("A",), ("C",)]
    assert rows_of(quality.repeated_keys(df, ["id"])) == [("e", 2)]


def test_price_mismatches(spark):
    products = spark.createDataFrame([("P1", 149.99), ("P2", 20.0)], "product_id string, base_price double")
    events = spark.createDataFrame(
        [
            ("ok", "P1", 134.99, 2, 0.1, 269.98),
            ("half cent down", "P1", 74.99, 1, 0.5, 74.99),
            ("half cent up", "P1", 75.0, 1, 0.5, 75.0),
            ("unit", "P1", 135.0, 1, 0.1, 135.0),
            ("total", "P2", 20.0, 3, 0.0, 59.99),
            ("unknown", "P9", 1.0, 1, 0.0, 1.0),
            ("null", "P2", None, 1, 0.0, 20.0),
        ],
        "event_id string, product_id string, unit_price double, quantity int, "
        "discount_pct double, total_amount double",
    )
    bad = quality.price_mismatches(events, products)
    assert rows_of(bad, "event_id") == [("null",), ("total",), ("unit",), ("unknown",)]


def test_bursts_and_shares(spark):
    df = spark.createDataFrame(
        [(at(i), "books", "us") for i in range(40)] + [(at(70), "food", "eu"), (at(71), "food", "us")],
        "event_timestamp timestamp_ntz, category string, region string",
    )
    assert rows_of(quality.bursts(df)) == [(at(0), "books", 40)]
    assert rows_of(quality.high_value(df.withColumn("total_amount", F.lit(1000.0)))) != []
    shares = quality.region_share(df)
    assert rows_of(shares) == [(at(0), "us", 40, 1.0), (at(60), "eu", 1, 0.5), (at(60), "us", 1, 0.5)]


@pytest.mark.parametrize("seed", range(2))
def test_session_bursts_equal_brute_force(spark, seed):
    rng = random.Random(seed)
    clock, times = 0, []
    for _ in range(200):
        clock += rng.choice([0, 1, 30, 59, 60, 61, 200])
        times.append(clock)
    sessions = []
    for t in times:
        if sessions and t - sessions[-1][1] <= 60:
            sessions[-1][1] = t
            sessions[-1][2] += 1
        else:
            sessions.append([t, t, 1])
    df = spark.createDataFrame([(at(t), "c") for t in times], "event_timestamp timestamp_ntz, category string")
    out = quality.session_bursts(df.repartition(4), least=3)
    assert rows_of(out, "session_start", "last_event", "n") == sorted(
        ((at(a), at(b), n) for a, b, n in sessions if n >= 3), key=repr
    )


# -- lookups ----------------------------------------------------------------------

FACTS = [("e1", "us-east"), ("e2", "mars"), ("e3", None), ("e4", "us-east")]


@pytest.mark.parametrize("small, heavy", [(True, None), (False, None), (False, 1), (False, 100)])
def test_lookup_keeps_every_fact(spark, monkeypatch, small, heavy):
    monkeypatch.setattr(lookup, "is_small", lambda df: small)
    facts = spark.createDataFrame(FACTS, "event_id string, region string")
    dim = spark.createDataFrame([("us-east", "Virginia DC"), ("ap-south", "Mumbai DC")], "region string, data_center string")
    out = lookup.lookup(facts, dim, "region", heavy_rows=heavy)
    assert rows_of(out, "event_id", "data_center") == [
        ("e1", "Virginia DC"),
        ("e2", None),
        ("e3", None),
        ("e4", "Virginia DC"),
    ]


def test_heavy_keys_are_dealt_out_and_only_their_dimension_rows_copied(spark, monkeypatch):
    """Half of a micro-batch in one region; the dimension is above the broadcast bound."""
    monkeypatch.setattr(lookup, "is_small", lambda df: False)
    facts = spark.range(20_000).select(
        F.col("id").alias("event_id"),
        F.when(F.col("id") % 2 == 0, F.lit("hot")).otherwise(F.concat(F.lit("r"), F.col("id") % 3000)).alias("region"),
    )
    dim = spark.range(3000).select(F.concat(F.lit("r"), F.col("id")).alias("region"), F.col("id").alias("v"))
    dim = dim.unionByName(spark.createDataFrame([("hot", -1)], "region string, v bigint"))
    heavy = lookup.heavy_keys(facts, ["region"], 1000)
    assert rows_of(heavy) == [("hot", 10)]
    names = ["spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions", "spark.sql.autoBroadcastJoinThreshold"]
    before = {n: spark.conf.get(n) for n in names}
    for name, value in zip(names, ["false", "16", "-1"]):
        spark.conf.set(name, value)
    try:
        out = lookup.lookup(facts, dim, "region", heavy_rows=1000)
        tasks = out.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
        assert tasks < 0.3 * 20_000
        assert out.where("region = 'hot' AND v = -1").count() == 10_000
        assert out.count() == 20_000 and out.where("v IS NULL").isEmpty()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_repeated_dimension_key_multiplies_rows(spark):
    facts = spark.createDataFrame(FACTS, "event_id string, region string")
    dim = spark.createDataFrame([("us-east", 1), ("us-east", 2)], "region string, v int")
    assert lookup.lookup(facts, dim, "region").count() == 6


def test_small_is_proven_by_rows_and_bytes(spark):
    df = spark.range(100).withColumn("t", F.lit("x" * 50))
    assert lookup.is_small(df)
    assert not lookup.is_small(df, rows=99)
    assert not lookup.is_small(df, size=1000)


# -- any span of time -----------------------------------------------------------------


def sliding(spark, seconds, key="books", **kw):
    df = spark.createDataFrame([(key, at(s)) for s in seconds], "category string, event_timestamp timestamp_ntz")
    out = quality.sliding_bursts(df, span="60 seconds", **kw)
    return [(r.until, r.since, r.n) for r in out.orderBy("until").collect()]


def test_a_burst_across_a_boundary_is_found(spark):
    """Five events around a full minute: no minute holds more than three of them."""
    seconds = [100, 110, 119, 125, 150, 400]
    df = spark.createDataFrame([("books", at(s)) for s in seconds], "category string, event_timestamp timestamp_ntz")
    assert quality.bursts(df, size="60 seconds", least=4).isEmpty()
    want = [(at(125), at(100), 4), (at(150), at(100), 5)]
    for spans in (1, 2, 64):
        assert sliding(spark, seconds, least=4, spans_per_slice=spans) == want


def test_both_ends_of_a_span_count_and_instants_gather(spark):
    assert sliding(spark, [0, 60], least=2) == [(at(60), at(0), 2)]
    assert sliding(spark, [0, 60.000001], least=2) == []
    assert sliding(spark, [5, 5, 5], least=3) == [(at(5), at(5), 3)]


@pytest.mark.parametrize("spans", [1, 3])
def test_sliding_counts_equal_brute_force(spark, spans):
    rng = random.Random(11)
    rows = [(rng.choice(["hot", "hot", "hot", "a", None]), at(rng.choice([-90, 0, 59, 60, 61]) + rng.randint(0, 900))) for _ in range(500)]
    df = spark.createDataFrame([*rows, ("a", None)], "category string, event_timestamp timestamp_ntz")
    got = quality.sliding_bursts(df, span="60 seconds", least=12, spans_per_slice=spans)
    want = set()
    for key, t in rows:
        inside = [u for k, u in rows if k == key and 0 <= (t - u).total_seconds() <= 60]
        if len(inside) >= 12:
            want.add((key, t, min(inside), len(inside)))
    assert rows_of(got, "category", "until", "since", "n") == sorted(want, key=repr)


def test_no_span_is_summed_anew_for_each_event(spark):
    """Frames begin at the slice's start; one of the span's width costs its events each time."""
    df = spark.createDataFrame([("books", at(0))], "category string, event_timestamp timestamp_ntz")
    plan = quality.sliding_bursts(df, span="60 seconds")._jdf.queryExecution().optimizedPlan().toString()
    frames = [line for line in plan.splitlines() if "specifiedwindowframe" in line]
    assert frames and not any("RangeFrame, -" in line for line in frames)


# -- partitions of a source -----------------------------------------------------------


def brute_marks(rows, parts):
    """(arrival, part, seconds) in order of arrival to the mark before each."""
    best, out = {}, {}
    for arrival, part, t in sorted(rows):
        out[arrival] = min(best.values()) if len(best) == parts else None
        if t is not None:
            best[part] = max(best.get(part, t), t)
    return out


@pytest.mark.parametrize("bits", [2, 16])
def test_common_mark_is_the_least_of_the_partitions(spark, bits):
    rng = random.Random(bits)
    rows = []
    for offset in range(120):
        for part in range(3):
            if rng.random() < 0.8 and not (part == 2 and offset < 9):
                rows.append((offset * 3 + part, part, rng.choice([None, offset * 10 + rng.randint(-80, 80)])))
    df = spark.createDataFrame([(a, p, None if t is None else at(t)) for a, p, t in rows], "arrival bigint, part int, t timestamp_ntz")
    got = partitions.common_high_water(df, "t", "arrival", "part", chunk_bits=bits, block_bits=bits)
    want = {a: None if m is None else at(m) for a, m in brute_marks(rows, 3).items()}
    assert {r.arrival: r.high_water for r in got.collect()} == want


def test_windows_close_when_the_last_partition_passes(spark):
    rng = random.Random(3)
    rows = [(i, rng.randrange(3), i * 7 + rng.randint(-200, 50)) for i in range(400)]
    df = spark.createDataFrame([(a, p, at(t)) for a, p, t in rows], "arrival bigint, part int, t timestamp_ntz")
    closings = partitions.common_closings(df, "t", "arrival", "part", "1 minute", "65 seconds")
    marked = late.mark_late(df, "t", "arrival", "1 minute", "65 seconds", closings=closings)
    marks = brute_marks(rows, 3)
    want = [
        (a, marks[a] is not None and (t // 60 + 1) * 60 + 65 <= marks[a]) for a, _, t in rows
    ]
    assert rows_of(marked, "arrival", "is_late") == sorted(want, key=repr)
    assert any(late for _, late in want)


def test_a_silent_partition_holds_every_window_open(spark):
    df = spark.createDataFrame([(i, 0, at(i * 100)) for i in range(20)], "arrival bigint, part int, t timestamp_ntz")
    assert partitions.common_closings(df, "t", "arrival", "part", partitions=[0, 1]).isEmpty()
    assert not partitions.common_closings(df, "t", "arrival", "part").isEmpty()
    marked = partitions.common_high_water(df, "t", "arrival", "part", partitions=[0, 1])
    assert marked.where("high_water IS NOT NULL").isEmpty()
    none = df.limit(0)
    assert partitions.common_high_water(none, "t", "arrival", "part").isEmpty()
    assert partitions.common_closings(none, "t", "arrival", "part").isEmpty()


def test_chunks_follow_the_rows(spark):
    """65,536 arrivals a chunk, however many partitions share them."""
    dense = spark.range(200_000).select(
        partitions.arrival_number(F.floor(F.col("id") / 4), F.col("id") % 4, 4).alias("arrival")
    )
    assert dense.select(F.shiftright("arrival", 16)).distinct().count() == 4
