import json

import pytest
from pyspark.sql import functions as F

from tablestream.functions import codec, money, times
from tablestream.sources.dimensions import read_csv_dimension
from tablestream.sources.topics import kafka_options, text_messages_batch, write_messages
from tests.conftest import at, rows_of, text_at


def event(**changes):
    base = {
        "event_id": "e1",
        "order_id": "ORD-1",
        "user_id": "USR-00001",
        "product_id": "PROD-001",
        "category": "books",
        "status": "placed",
        "quantity": 2,
        "unit_price": 1.5,
        "total_amount": 3.0,
        "discount_pct": 0.0,
        "region": "us-east",
        "platform": "web",
        "event_time": text_at(1),
    }
    return json.dumps({**base, **changes})


def test_lenient_decode(spark):
    lines = [
        event(event_id="good"),
        "{bad json",
        event(event_id="words", quantity="notint"),
        event(event_id="junk", event_time="junk"),
        event(event_id="text", quantity="7"),
        "",
        "[1,2]",
        "null",
        None,
    ]
    messages = spark.createDataFrame([(i, v) for i, v in enumerate(lines)], "_seq long, value string")
    decoded = codec.decode_events(messages)
    assert rows_of(codec.accepted(decoded), "event_id", "quantity", "event_timestamp") == [
        ("good", 2, at(1)),
        ("text", 7, at(1)),
        ("words", None, at(1)),
    ]
    assert rows_of(codec.rejected(decoded), "_seq", "reject_reason") == [
        (1, "broken_text"),
        (3, "no_event_time"),
        (5, "broken_text"),
        (6, "broken_text"),
        (7, "broken_text"),
        (8, "broken_text"),
    ]


def test_narrow_fields_and_missing_fields(spark):
    from tablestream.schemas import ORDER_EVENT, pick

    messages = spark.createDataFrame([(event(),), ('{"event_id": "only"}',)], "value string")
    fields = pick(ORDER_EVENT, "event_id", "total_amount")
    assert rows_of(codec.accepted(codec.decode(messages, fields)), "event_id", "total_amount") == [
        ("e1", 3.0),
        ("only", None),
    ]


def test_messages_are_parsed_once(spark):
    messages = spark.createDataFrame([(event(),)], "value string")
    plan = codec.accepted(codec.decode_events(messages))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_encode_and_decode_give_the_same_rows(spark):
    rows = spark.createDataFrame(
        [("e1", "o1", 1.25, None), ("e2", None, None, "x")],
        "event_id string, order_id string, total_amount double, region string",
    )
    sent = codec.encode(rows)
    assert [r.key for r in sent.orderBy("value").collect()] == ["o1", None]
    back = codec.accepted(codec.decode(sent))
    assert rows_of(back, "event_id", "order_id", "total_amount", "region") == rows_of(rows)


def test_text_folder_stands_in_for_the_topic(spark, tmp_path):
    folder = str(tmp_path / "inbox")
    sent = spark.createDataFrame([("k", '{"event_id":"a","offset":7}')], "key string, value string")
    write_messages(sent, folder)
    assert rows_of(text_messages_batch(spark, folder)) == [('{"event_id":"a","offset":7}', 7)]


def test_kafka_start_modes():
    assert kafka_options("b:1", "order_events")["startingOffsets"] == "latest"
    options = kafka_options("b:1", "order_events", start="earliest-offset", group_id="g")
    assert options["startingOffsets"] == "earliest"
    assert options["kafka.group.id"] == "g"


def test_csv_dimension_is_lenient(spark, tmp_path):
    path = tmp_path / "regions.csv"
    path.write_text(
        "us-east,Virginia DC,0.05,HIPAA\n"
        "us-west,Oregon DC,high,CCPA\n"
        "too,few\n"
        "one,too,0.1,many,fields\n"
        "ap-south,Mumbai DC,0.18,PDPB\n"
    )
    dim = read_csv_dimension(spark, str(path))
    expected = [
        ("ap-south", "Mumbai DC", 0.18, "PDPB"),
        ("us-east", "Virginia DC", 0.05, "HIPAA"),
        ("us-west", "Oregon DC", None, "CCPA"),
    ]
    assert rows_of(dim) == expected
    assert dim.count() == 3
    assert rows_of(dim, "region") == [(r[0],) for r in expected]


def test_times(spark):
    df = spark.createDataFrame([("2024-01-01 00:00:01.234",), ("soon",), (None,)], "t string")
    out = df.select(
        times.parse_event_time("t").alias("p"),
        times.parse_time_lenient("t").alias("c"),
        times.to_millis(times.parse_event_time("t")).alias("ms"),
    )
    first, bad, null = [tuple(r) for r in out.collect()]
    assert first == (at(1.234), at(1.234), 1704067201234)
    assert bad == null == (None, None, None)


@pytest.mark.parametrize("base, discount, unit", [(149.99, 0.1, 134.99), (20.0, 0.25, 15.0)])
def test_price_arithmetic(spark, base, discount, unit):
    df = spark.createDataFrame([(base, discount, 3)], "base double, disc double, qty int")
    priced = df.withColumn("unit", money.unit_price("base", "disc")).select(
        F.col("unit").cast("double"), money.line_total("unit", "qty").cast("double")
    )
    assert tuple(priced.first()) == (unit, round(unit * 3, 2))


def test_messages_of_a_key_leave_in_their_order(spark, tmp_path):
    folder = str(tmp_path / "out")
    rows = spark.range(3000).select(
        F.when(F.col("id") % 2 == 0, F.lit("hot")).otherwise((F.col("id") % 50).cast("string")).alias("key"),
        F.col("id").cast("string").alias("value"),
        F.col("id").alias("at"),
    )
    write_messages(rows.repartition(7), folder, key="key", order=["at"], files=5)
    files = [[int(x) for x in f.read_text().split()] for f in sorted((tmp_path / "out").glob("part-*"))]
    assert sum(map(len, files)) == 3000
    held = {}
    for number, lines in enumerate(files):
        for n in lines:
            key = "hot" if n % 2 == 0 else str(n % 50)
            assert held.setdefault(key, (number, []))[0] == number
            held[key][1].append(n)
    assert all(ids == sorted(ids) for _, ids in held.values()) and len(held) == 26


def test_stored_days_are_pruned_by_a_joined_list(spark, tmp_path):
    from tablestream.sources.days import on_days, read_days, replace_days, write_by_day

    path = str(tmp_path / "days")
    rows = spark.range(2000).select(
        F.col("id"), F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 3600).alias("ts")
    )
    write_by_day(rows, "ts", path)
    stored = read_days(spark, path)
    days = stored.where("id IN (50, 51, 1000, 1000)").select("event_day")
    found = on_days(stored, days)
    want = {r.event_day for r in days.collect()}
    assert {r.event_day for r in found.select("event_day").distinct().collect()} == want and len(want) == 2
    assert found.count() == 48
    text = found._jdf.queryExecution().toString()
    assert "dynamicpruning" in text
    files = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in text and files
    # A literal span of days, and days written anew.
    first = str(min(want))
    assert read_days(spark, path, first, first).count() == 24
    replace_days(rows.where("id = 50"), "ts", path)
    assert read_days(spark, path, first, first).count() == 1
    assert read_days(spark, path).count() == 2000 - 23
