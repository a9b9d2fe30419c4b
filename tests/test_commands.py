import json

import pytest

from tablestream.__main__ import parser, run
from tests.conftest import rows_of, text_at


@pytest.fixture
def cli(spark, tmp_path):
    def call(*argv):
        return run(spark, parser().parse_args(["--root", str(tmp_path / "tables"), *argv]))

    return call


def test_a_day_with_the_command_line(spark, cli, tmp_path, capsys):
    inbox, progress = tmp_path / "inbox", str(tmp_path / "progress")
    inbox.mkdir()
    (tmp_path / "regions.csv").write_text("us-east,Virginia DC,0.05,HIPAA\n")
    job = ["--checkpoint", progress, "--inbox", str(inbox), "--once"]

    cli("setup")
    assert "order_events: created" in capsys.readouterr().out
    cli("setup")
    assert "order_events: exists" in capsys.readouterr().out

    def send(n, **changes):
        event = {"event_id": f"e{n}", "order_id": f"o{n}", "region": "us-east", "product_id": "P1"}
        event |= {"total_amount": 2.5, "offset": n, "event_time": text_at(n)} | changes
        (inbox / f"{n}.json").write_text(json.dumps(event) + "\n")

    send(1)
    send(2, event_id="e1")
    cli("ingest", *job)
    cli("regional-orders", *job, "--regions", str(tmp_path / "regions.csv"))
    cli("windowed-sales", *job)

    assert rows_of(cli("query"), "event_id", "order_id") == [("e1", "o2")]
    assert "total rows: 1" in capsys.readouterr().out
    assert [r.batch_id for r in cli("query", "--snapshots").collect()] == [1, 0]
    assert cli("query", "--snapshot", "0").isEmpty()
    assert rows_of(cli("sql", "SELECT sum(total_sales) FROM windowed_sales"))[0][0] == 5
    assert rows_of(cli("query", "regional_orders"), "order_id", "data_center") == [
        ("o1", "Virginia DC"),
        ("o2", "Virginia DC"),
    ]

    cli("branches", "--create", "dev")
    send(3)
    cli("ingest", *job, "--branch", "dev")
    assert rows_of(cli("query", "--branch", "dev"), "event_id") == [("e1",), ("e3",)]
    both = "SELECT (SELECT count(*) FROM order_events), (SELECT count(*) FROM order_events__dev)"
    assert rows_of(cli("sql", both)) == [(1, 2)]
    cli("branches", "--merge", "dev")
    cli("compact", "order_events")
    assert "new_files=1" in capsys.readouterr().out
    assert rows_of(cli("query"), "event_id") == [("e1",), ("e3",)]
    assert rows_of(cli("branches"), "name") == [("dev",), ("main",)]

    cli("emit", "--outbox", str(tmp_path / "outbox"))
    sent = [json.loads(r.value) for r in spark.read.text(str(tmp_path / "outbox")).collect()]
    assert sorted((m["event_id"], m["event_time"]) for m in sent) == [
        ("e1", text_at(2)),
        ("e3", text_at(3)),
    ]
    with pytest.raises(ValueError):
        cli("branches", "--create", "main")
