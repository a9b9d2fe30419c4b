import json

import pytest
from pyspark.sql import functions as F

from tablestream.operators import quality
from tablestream.operators.changelog import open_table
from tablestream.schemas import (
    LATE_EVENTS_DLQ,
    ORDER_EVENTS,
    PRODUCTS_SOLD,
    REGIONAL_ORDERS,
    WINDOWED_SALES,
    rejects_of,
)
from tablestream.sources.topics import text_messages
from tablestream.streaming import jobs
from tests.conftest import at, rows_of, text_at
from tests.test_windows import ARRIVALS


class Inbox:
    """A folder of message files and a job that works it off."""

    def __init__(self, spark, tmp_path):
        self.spark, self.folder = spark, tmp_path / "inbox"
        self.root, self.progress = str(tmp_path / "tables"), str(tmp_path / "progress")
        self.folder.mkdir()
        self.sent = 0

    def send(self, *events):
        lines = []
        for e in events:
            if isinstance(e, dict):
                e = json.dumps({"offset": self.sent, **e})
            lines.append(e)
            self.sent += 1
        (self.folder / f"{self.sent:06d}.json").write_text("\n".join(lines) + "\n")

    def run(self, job, *args, progress="", **kw):
        stream = text_messages(self.spark, str(self.folder))
        query = job(stream, *args, self.root, self.progress + progress, interval=None, **kw)
        query.awaitTermination()
        assert query.exception() is None

    def table(self, spec):
        return open_table(self.spark, self.root, spec)


@pytest.fixture
def inbox(spark, tmp_path):
    return Inbox(spark, tmp_path)


def sale(t, amount, region="us-east"):
    return {"region": region, "total_amount": amount, "event_time": text_at(t)}


def test_ingest_keeps_the_last_arrival_and_the_rejects(inbox):
    inbox.send(
        {"event_id": "e1", "order_id": "A", "quantity": "7", "event_time": text_at(1)},
        "{broken",
        {"order_id": "no key"},
        {"event_id": "e2", "order_id": "C", "event_time": "junk"},
    )
    inbox.run(jobs.ingest)
    inbox.send({"event_id": "e1", "order_id": "B", "quantity": 1, "event_time": text_at(0)})
    inbox.run(jobs.ingest)
    inbox.run(jobs.ingest)  # nothing new
    events = inbox.table(ORDER_EVENTS)
    assert rows_of(events.read(), "event_id", "order_id", "quantity", "event_time") == [
        ("e1", "B", 1, at(0)),
        ("e2", "C", None, None),
    ]
    assert rows_of(events.read(version=0), "event_id", "order_id") == [("e1", "A"), ("e2", "C")]
    assert events.read().where("ingestion_time IS NULL").isEmpty()
    rejects = inbox.table(rejects_of("ingest")).read()
    assert sorted(r.reason for r in rejects.collect()) == ["broken_text", "no_key"]


def test_allowed_lateness_over_restarts(inbox):
    for _, t, amount in ARRIVALS:
        inbox.send(sale(t, amount))
        inbox.run(jobs.windowed_sales)
    totals = inbox.table(WINDOWED_SALES).read()
    assert rows_of(totals, "window_start", F.col("total_sales").cast("int")) == [
        (at(0), 5),
        (at(60), 2),
        (at(120), 8),
        (at(360), 32),
    ]
    assert rows_of(inbox.table(LATE_EVENTS_DLQ).read()) == [("us-east", 16.0, at(30))]
    marks = inbox.table(WINDOWED_SALES).versions().orderBy("batch_id").select("high_water")
    assert [r[0] for r in marks.collect()] == [at(t) for t in (10, 100, 100, 126, 126, 400)]


@pytest.mark.parametrize("files", [1, 6])
def test_allowed_lateness_of_a_backlog(inbox, files):
    """The size of a batch does not decide which rows are late."""
    rows = [sale(t, amount) for _, t, amount in ARRIVALS]
    if files == 1:
        inbox.send(*rows)
    else:
        for row in rows:
            inbox.send(row)
    inbox.run(jobs.windowed_sales)
    totals = inbox.table(WINDOWED_SALES).read()
    assert rows_of(totals, "window_start", F.col("total_sales").cast("int"))[0] == (at(0), 5)
    assert rows_of(inbox.table(LATE_EVENTS_DLQ).read()) == [("us-east", 16.0, at(30))]


def test_lines_without_an_offset_count_by_their_place(inbox):
    for states in (["placed", "paid", "shipped"], ["delivered"]):
        lines = [json.dumps({"event_id": "e1", "order_id": "A", "status": s}) for s in states]
        inbox.send(*lines)
        inbox.run(jobs.ingest)
        assert rows_of(inbox.table(ORDER_EVENTS).read(), "status") == [(states[-1],)]


def test_files_of_one_batch_count_by_their_time(inbox):
    import os

    for n, state in ((9, "placed"), (5, "paid"), (7, "shipped")):
        path = inbox.folder / f"{n}.json"
        path.write_text(json.dumps({"event_id": "e1", "status": state}) + "\n")
        os.utime(path, (1_000_000 - n, 1_000_000 - n))
    inbox.run(jobs.ingest)
    assert rows_of(inbox.table(ORDER_EVENTS).read(), "status") == [("paid",)]


def test_a_second_checkpoint_loses_nothing(inbox):
    inbox.send({"event_id": "e1", "order_id": "A"}, "{broken")
    inbox.run(jobs.ingest)
    for old in inbox.folder.iterdir():
        old.write_text(json.dumps({"event_id": "e2", "order_id": "B"}) + "\n{worse\n")
    inbox.run(jobs.ingest, progress="-2")
    inbox.run(jobs.ingest, progress="-2")
    assert rows_of(inbox.table(ORDER_EVENTS).read(), "event_id") == [("e1",), ("e2",)]
    assert rows_of(inbox.table(rejects_of("ingest")).read(), "value") == [("{broken",), ("{worse",)]


def test_rejects_follow_the_branch(inbox):
    inbox.send({"event_id": "e1", "order_id": "A"}, "{main")
    inbox.run(jobs.ingest)
    inbox.table(ORDER_EVENTS).create_branch("dev")
    inbox.send("{dev")
    inbox.run(jobs.ingest, branch="dev")
    rejects = inbox.table(rejects_of("ingest"))
    assert rows_of(rejects.read(), "value") == [("{main",)]
    assert rows_of(rejects.read("dev"), "value") == [("{dev",), ("{main",)]


def test_products_sold_keeps_what_it_cannot_read(inbox):
    inbox.send("{broken", {"product_id": "P1", "order_id": "o1"})
    inbox.run(jobs.undecoded)
    reasons = inbox.table(rejects_of("products_sold")).read()
    assert rows_of(reasons, "reason") == [("broken_text",), ("no_event_time",)]


def test_windowed_sales_rejects_rows_without_region_or_time(inbox):
    inbox.send(
        sale(1, 1.0),
        sale(2, 2.0, region=None),
        {"region": "x", "total_amount": 4.0},
        sale(3, "NaN"),
        sale(4, None),
    )
    inbox.run(jobs.windowed_sales)
    assert [str(r.total_sales) for r in inbox.table(WINDOWED_SALES).read().collect()] == ["1.00"]
    rejects = inbox.table(rejects_of("windowed_sales")).read()
    assert sorted(r.reason for r in rejects.collect()) == [
        "bad_amount",
        "no_event_time",
        "no_region",
    ]


def test_crash_between_the_two_sinks(spark, inbox, monkeypatch):
    """The dead letters are written, the sums are not: the replay adds nothing twice."""
    inbox.send(sale(300, 1))
    inbox.run(jobs.windowed_sales)
    inbox.send(sale(10, 16), sale(301, 2))
    real = jobs.late.on_time_sales

    def crash(*args, **kw):
        raise RuntimeError("executor lost")

    monkeypatch.setattr(jobs.late, "on_time_sales", crash)
    with pytest.raises(Exception, match="executor lost"):
        inbox.run(jobs.windowed_sales)
    monkeypatch.setattr(jobs.late, "on_time_sales", real)
    assert inbox.table(LATE_EVENTS_DLQ).read().count() == 1
    inbox.run(jobs.windowed_sales)
    assert inbox.table(LATE_EVENTS_DLQ).read().count() == 1
    assert [str(r.total_sales) for r in inbox.table(WINDOWED_SALES).read().collect()] == ["3.00"]


def test_products_sold_emits_closed_windows_once(inbox):
    def order(t, product, order_id):
        return {"product_id": product, "order_id": order_id, "event_time": text_at(t)}

    inbox.send(order(1, "P1", "o1"), order(2, "P1", "o1"), order(3, "P1", "o2"), order(4, "P2", "o1"))
    inbox.run(jobs.products_sold)
    assert inbox.table(PRODUCTS_SOLD).versions().isEmpty() or inbox.table(PRODUCTS_SOLD).read().isEmpty()
    inbox.send(order(61, "P1", "o1"), order(62, "P1", None), order(300, "P9", "o3"))
    inbox.run(jobs.products_sold)
    assert rows_of(inbox.table(PRODUCTS_SOLD).read()) == [
        (at(0), "P1", 2),
        (at(0), "P2", 1),
        (at(60), "P1", 1),
    ]


def test_regional_orders(spark, inbox):
    regions = spark.createDataFrame(
        [("us-east", "Virginia DC", 0.05, "HIPAA")],
        "region string, data_center string, tax_rate double, compliance_type string",
    )

    def order(order_id, region, t):
        return {"order_id": order_id, "region": region, "total_amount": 1.0, "event_time": text_at(t)}

    inbox.send(order("o1", "us-east", 9), order("o2", "mars", 1), order("o3", None, 1))
    inbox.run(jobs.regional_orders, regions)
    inbox.send(order("o1", "us-east", 2), order(None, "us-east", 3))
    inbox.run(jobs.regional_orders, regions)
    out = inbox.table(REGIONAL_ORDERS).read()
    assert rows_of(out, "order_id", "event_time", "data_center", "tax_rate") == [
        ("o1", at(2), "Virginia DC", 0.05),
        ("o2", at(1), None, None),
        ("o3", at(1), None, None),
    ]
    assert inbox.table(rejects_of("regional_orders")).read().count() == 1


def test_branch_of_a_stream(inbox):
    inbox.send({"event_id": "e1", "order_id": "A"})
    inbox.run(jobs.ingest)
    inbox.table(ORDER_EVENTS).create_branch("dev")
    inbox.send({"event_id": "e1", "order_id": "B"})
    inbox.run(jobs.ingest, branch="dev", name="ingest")
    assert rows_of(inbox.table(ORDER_EVENTS).read(), "order_id") == [("A",)]
    assert rows_of(inbox.table(ORDER_EVENTS).read("dev"), "order_id") == [("B",)]


def test_session_stream_equals_batch(spark, inbox):
    lines = [sale(t, 1.0) for t in (0, 10, 20, 200, 210, 5000)]
    inbox.send(*lines)
    from tablestream.functions.codec import accepted, decode_events

    events = accepted(decode_events(text_messages(spark, str(inbox.folder))))
    bursts = quality.session_bursts_stream(events, "event_timestamp", "region", "60 seconds", 2, "5 seconds")
    query = (
        bursts.writeStream.format("memory").queryName("bursts").outputMode("append")
        .option("checkpointLocation", inbox.progress).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    found = rows_of(spark.table("bursts"), "region", "session_start", "last_event", "n")
    assert found == [("us-east", at(0), at(20), 3), ("us-east", at(200), at(210), 2)]
