import pathlib
import shutil

import pytest
from pyspark.sql import functions as F

from tablestream.operators import keyed, maintain
from tablestream.operators.changelog import EventTable, NoSuchVersion, open_table
from tablestream.operators.maintain import compact
from tablestream.operators.publish import PublishRefused, audited_publish, diff, publish
from tablestream.schemas import (
    APPEND,
    BIGINT,
    SUMS,
    TEXT,
    TableSpec,
    columns,
)
from tests.conftest import rows_of

SPEC = TableSpec("t", columns(event_id=TEXT, value=BIGINT), ("event_id",))
C6 = [
    [(0, "a", 1), (1, "a", 2), (2, "b", 3)],
    [(0, "a", 4)],
    [(0, "b", 5)],
]


def batch(spark, rows):
    return spark.createDataFrame(rows, "_seq long, event_id string, value long")


@pytest.fixture(scope="module")
def template(spark, tmp_path_factory):
    """The table of C6, written once; every test works on a copy."""
    folder = tmp_path_factory.mktemp("template")
    t = open_table(spark, str(folder), SPEC)
    for n, rows in enumerate(C6):
        t.append(batch(spark, rows), writer="w", writer_batch=n)
    return folder


@pytest.fixture
def table(spark, template, root):
    shutil.copytree(template, root, dirs_exist_ok=True)
    return open_table(spark, root, SPEC)


def test_last_change_per_key_wins(table):
    assert rows_of(table.read()) == [("a", 4), ("b", 5)]


def test_time_travel(table):
    assert rows_of(table.read(version=0)) == [("a", 2), ("b", 3)]
    assert rows_of(table.read(version=1)) == [("a", 4), ("b", 3)]
    with pytest.raises(NoSuchVersion):
        table.read(version=9)


def test_replayed_batch_changes_nothing(spark, table):
    assert table.append(batch(spark, [(0, "a", 99)]), writer="w", writer_batch=1) == 1
    assert rows_of(table.read()) == [("a", 4), ("b", 5)]
    assert table.latest_version() == 2


def test_uncommitted_leftovers_are_not_seen_and_overwritten(spark, table):
    table.as_changes(batch(spark, [(0, "z", 1)])).write.parquet(table._folder("main", 3, "rows-dead"))
    assert rows_of(table.read()) == [("a", 4), ("b", 5)]
    table.append(batch(spark, [(0, "c", 6)]), writer="w", writer_batch=3)
    assert rows_of(table.read()) == [("a", 4), ("b", 5), ("c", 6)]


def test_snapshots_newest_first(table):
    log = table.snapshots().collect()
    assert [(r.batch_id, r.operation, r.rows) for r in log] == [
        (2, "append", 1),
        (1, "append", 1),
        (0, "append", 3),
    ]


def test_empty_table_has_no_version(spark, root):
    with pytest.raises(NoSuchVersion):
        open_table(spark, root, SPEC).latest_version()
    with pytest.raises(NoSuchVersion):
        open_table(spark, root, SPEC).append(batch(spark, C6[0]), "dev")


def test_deletes_hide_a_key(spark, table):
    table.append(batch(spark, [(0, "a", None)]).withColumn("_op", F.lit("D")))
    assert rows_of(table.read()) == [("b", 5)]
    assert rows_of(table.read(version=2)) == [("a", 4), ("b", 5)]


def test_commit_log_folds(spark, root, monkeypatch):
    from tablestream.operators import changelog

    monkeypatch.setattr(changelog, "FOLD", 3)
    t = open_table(spark, root, SPEC)
    for n in range(8):
        t.append(batch(spark, [(0, "a", n), (1, f"k{n}", n)]), writer="w", writer_batch=n)
    assert sorted(t._children("commits/main")) == ["0", "1", "2"]
    assert [r.batch_id for r in t.snapshots().collect()] == [7, 6, 5, 4, 3, 2, 1, 0]
    assert t.append(batch(spark, [(0, "a", 99)]), writer="w", writer_batch=2) == 2
    assert ("a", 7) in rows_of(t.read()) and ("a", 1) in rows_of(t.read(version=1))


def test_a_fold_that_was_never_finished_is_not_read(spark, root, monkeypatch):
    from tablestream.operators import changelog

    monkeypatch.setattr(changelog, "FOLD", 2)
    t = open_table(spark, root, SPEC)
    for n in range(2):
        t.append(batch(spark, [(0, "a", n)]))
    (pathlib.Path(root) / "t/commits/main/1/_new-dead/_temporary/0").mkdir(parents=True)
    assert rows_of(t.read()) == [("a", 1)]
    assert t.append(batch(spark, [(0, "b", 2)])) == 2
    assert rows_of(t.read()) == [("a", 1), ("b", 2)]
    assert [r.batch_id for r in t.snapshots().collect()] == [2, 1, 0]


def test_names_of_refs(table):
    for name in ("", "a/b", "..", "x y"):
        with pytest.raises(ValueError):
            table.create_branch(name)


# -- branches -----------------------------------------------------------------


@pytest.fixture
def forked(spark, table):
    table.create_branch("dev", at=1)
    table.append(batch(spark, [(0, "a", 9)]), "dev", writer="d", writer_batch=0)
    return table


def test_branch_read(forked):
    assert rows_of(forked.read("dev")) == [("a", 9), ("b", 3)]
    assert rows_of(forked.read()) == [("a", 4), ("b", 5)]
    with pytest.raises(ValueError):
        forked.create_branch("dev")


def test_branch_of_a_branch(spark, forked):
    forked.create_branch("try", source="dev")
    forked.append(batch(spark, [(0, "b", 7)]), "try")
    forked.append(batch(spark, [(0, "a", 8)]), "dev")
    assert rows_of(forked.read("try")) == [("a", 9), ("b", 7)]


def test_publish_without_conflict(forked):
    assert rows_of(diff(forked, "dev"), "event_id", "value", "change") == [("a", 9, "upsert")]
    assert publish(forked, "dev", expected_head=2) == 3
    assert rows_of(forked.read()) == [("a", 9), ("b", 5)]
    # The branch goes on from the published head.
    assert rows_of(forked.read("dev")) == [("a", 9), ("b", 5)]
    assert diff(forked, "dev").isEmpty()


def test_branch_can_be_published_again(spark, forked):
    publish(forked, "dev")
    forked.append(batch(spark, [(0, "a", 10)]), "dev")
    publish(forked, "dev")
    assert rows_of(forked.read()) == [("a", 10), ("b", 5)]


def test_conflict_publishes_nothing(spark, forked):
    forked.append(batch(spark, [(0, "b", 11)]), "dev")
    with pytest.raises(PublishRefused, match="changed on both"):
        publish(forked, "dev")
    assert rows_of(forked.read()) == [("a", 4), ("b", 5)]
    assert forked.latest_version() == 2


def test_moved_target_refuses(forked):
    with pytest.raises(PublishRefused, match="moved"):
        publish(forked, "dev", expected_head=1)


def test_compaction_of_the_target_is_no_conflict(forked):
    compact(forked)
    publish(forked, "dev")
    assert rows_of(forked.read()) == [("a", 9), ("b", 5)]


def test_compaction_of_the_branch_publishes_only_its_changes(forked):
    compact(forked, "dev")
    assert rows_of(diff(forked, "dev"), "event_id", "value", "change") == [("a", 9, "upsert")]
    publish(forked, "dev")
    assert rows_of(forked.read()) == [("a", 9), ("b", 5)]
    assert rows_of(forked.read("dev")) == [("a", 9), ("b", 5)]


def test_delete_is_published(spark, forked):
    forked.append(batch(spark, [(0, "a", None)]).withColumn("_op", F.lit("D")), "dev")
    assert rows_of(diff(forked, "dev"), "event_id", "change") == [("a", "delete")]
    publish(forked, "dev")
    assert rows_of(forked.read()) == [("b", 5)]


def test_audit_stops_a_publish(forked):
    checks = {"small": lambda df: df.where("value > 8"), "keyed": lambda df: df.where("event_id IS NULL")}
    with pytest.raises(PublishRefused, match="small"):
        audited_publish(forked, "dev", checks)
    assert forked.latest_version() == 2
    audited_publish(forked, "dev", {"keyed": checks["keyed"]})
    assert rows_of(forked.read()) == [("a", 9), ("b", 5)]


def test_a_refused_audit_hands_over_what_it_found(spark, forked, monkeypatch):
    checks = {
        "small": lambda df: df.where("value > 8"),
        "keyed": lambda df: df.where("event_id IS NULL"),
        "odd names": lambda df: df.where("value > 8").select("value", "value", F.lit(None)),
    }
    with pytest.raises(PublishRefused) as refused:
        audited_publish(forked, "dev", checks)
    assert {*refused.value.offending} == {"small", "odd names"}
    found = refused.value.offending["small"]
    # The rows are kept: the branch's state is not computed for them again.
    assert "Window" not in found._jdf.queryExecution().toString()
    assert rows_of(found) == [("a", 9)]
    forked.append(found.withColumn("_op", F.lit("D")), "dev")
    audited_publish(forked, "dev", checks)
    assert rows_of(forked.read()) == [("b", 5)]


def test_a_publish_that_broke_off_is_completed(spark, forked, monkeypatch):
    def crash(*args):
        raise RuntimeError("driver lost")

    monkeypatch.setattr(type(forked), "refork", crash)
    with pytest.raises(RuntimeError, match="driver lost"):
        publish(forked, "dev")
    monkeypatch.undo()
    forked.append(batch(spark, [(0, "c", 1)]), "dev")
    publish(forked, "dev")
    assert rows_of(forked.read()) == [("a", 9), ("b", 5), ("c", 1)]
    assert diff(forked, "dev").isEmpty()


def test_rows_after_the_audited_version_stay_on_the_branch(spark, forked):
    audited = forked.latest_version("dev")
    forked.append(batch(spark, [(0, "c", -1)]), "dev")
    publish(forked, "dev", version=audited)
    assert rows_of(forked.read()) == [("a", 9), ("b", 5)]
    assert rows_of(forked.read("dev")) == [("a", 9), ("b", 5), ("c", -1)]
    assert rows_of(diff(forked, "dev"), "event_id") == [("c",)]
    publish(forked, "dev")
    assert ("c", -1) in rows_of(forked.read())


def test_appended_rows_are_published_once(spark, root):
    t = open_table(spark, root, TableSpec("l", columns(event_id=TEXT, value=BIGINT), kind=APPEND))
    t.create()
    t.create_branch("dev")
    t.append(batch(spark, [(0, "a", 1)]), "dev")
    t.append(batch(spark, [(0, "a", 2)]))
    publish(t, "dev")
    publish(t, "dev")
    assert rows_of(t.read()) == rows_of(t.read("dev")) == [("a", 1), ("a", 2)]


# -- compaction -----------------------------------------------------------------


def test_compaction_keeps_the_result_and_the_history(spark, table):
    report = compact(table)
    assert report.old_files >= 3 and report.new_files == 1
    assert report.batch_id == 3
    assert rows_of(table.read()) == [("a", 4), ("b", 5)]
    assert rows_of(table.read(version=0)) == [("a", 2), ("b", 3)]
    assert table.layer_changes(table.layers()[-1]).count() == 2
    table.append(batch(spark, [(0, "a", 6)]), writer="w", writer_batch=3)
    assert rows_of(table.read()) == [("a", 6), ("b", 5)]


def test_compacting_a_branch_leaves_its_base(forked):
    compact(forked, "dev")
    assert rows_of(forked.read("dev")) == [("a", 9), ("b", 3)]
    assert rows_of(forked.read()) == [("a", 4), ("b", 5)]
    assert len(forked.layers("dev")) == 1


def test_partial_sums_fold(spark, root):
    spec = TableSpec("s", columns(event_id=TEXT, value=BIGINT), ("event_id",), SUMS, ("value",))
    t = open_table(spark, root, spec)
    for rows in C6:
        t.append(batch(spark, rows))
    assert rows_of(t.read()) == [("a", 7), ("b", 8)]
    compact(t)
    assert rows_of(t.read()) == [("a", 7), ("b", 8)]
    assert t.layer_changes(t.layers()[-1]).count() == 2
    t.append(batch(spark, [(0, "a", 1)]))
    assert rows_of(t.read()) == [("a", 8), ("b", 8)]


def test_append_only_keeps_every_row(spark, root):
    t = open_table(spark, root, TableSpec("l", columns(event_id=TEXT, value=BIGINT), kind=APPEND))
    for rows in C6:
        t.append(batch(spark, rows))
    before = rows_of(t.read())
    assert len(before) == 5
    assert compact(t).new_files == 1
    assert rows_of(t.read()) == before


def test_keys_are_merged_by_more_tasks_than_there_are_files(spark, table, monkeypatch):
    """A file's worth of keys is too much for the memory of one task."""
    monkeypatch.setattr(maintain, "MERGE_BYTES", 500, raising=False)
    asked = []
    read = EventTable.state_of

    def seen(self, changes, **kw):
        asked.append(int(self.spark.conf.get("spark.sql.shuffle.partitions")))
        return read(self, changes, **kw)

    monkeypatch.setattr(EventTable, "state_of", seen)
    report = compact(table)
    assert asked[0] >= report.old_bytes / 500 > 1
    assert report.new_files == 1
    assert rows_of(table.read()) == [("a", 4), ("b", 5)]
    assert not [x for x in table._children("") if x.startswith("_merged")]


def test_a_commit_during_a_compaction_is_kept(spark, table):
    read = table.latest_version()
    table.append(batch(spark, [(0, "a", 7), (0, "c", 8)]))
    compact(table, version=read)
    assert rows_of(table.read()) == [("a", 7), ("b", 5), ("c", 8)]
    compact(table, version=read)  # two at a time
    assert rows_of(table.read()) == [("a", 7), ("b", 5), ("c", 8)]
    compact(table)
    assert rows_of(table.read()) == [("a", 7), ("b", 5), ("c", 8)]
    assert table.layers()[-1].after == 5


def test_a_compaction_that_overlaps_a_publish_keeps_the_new_fork(spark, forked):
    read = forked.latest_version("dev")
    publish(forked, "dev")
    compact(forked, "dev", version=read)
    assert rows_of(forked.read("dev")) == [("a", 9), ("b", 5)]


def test_two_writers_lose_nothing(spark, root):
    from concurrent.futures import ThreadPoolExecutor

    t = open_table(spark, root, TableSpec("l", columns(event_id=TEXT, value=BIGINT), kind=APPEND))
    t.create()

    def write(who):
        for n in range(3):
            t.append(batch(spark, [(0, who, n)]), writer=who, writer_batch=n)

    with ThreadPoolExecutor(2) as both:
        list(both.map(write, ["p", "q"]))
    assert rows_of(t.read()) == [(w, n) for w in "pq" for n in range(3)]
    assert [r.batch_id for r in t.snapshots().orderBy("batch_id").collect()] == list(range(7))


def test_a_writer_that_stalls_before_its_commit_loses_nothing(spark, table, monkeypatch):
    """However long: another commits the number meanwhile, and both batches stay."""
    place, other = table._place, open_table(spark, table.path.rsplit("/", 1)[0], SPEC)

    def stalled(source, target):
        monkeypatch.setattr(table, "_place", place)
        assert other.append(batch(spark, [(0, "d", 7)]), writer="b", writer_batch=1) == 3
        return place(source, target)

    monkeypatch.setattr(table, "_place", stalled)
    assert table.append(batch(spark, [(0, "c", 6)]), writer="a", writer_batch=1) == 4
    assert rows_of(table.read()) == [("a", 4), ("b", 5), ("c", 6), ("d", 7)]
    assert [r.batch_id for r in table.snapshots().collect()] == [4, 3, 2, 1, 0]
    assert rows_of(table.read(version=3)) == [("a", 4), ("b", 5), ("d", 7)]


def test_a_stalled_publisher_is_told_that_the_head_moved(spark, table, monkeypatch):
    from tablestream.operators.changelog import HeadMoved

    place = table._place

    def stalled(source, target):
        monkeypatch.setattr(table, "_place", place)
        table.append(batch(spark, [(0, "d", 7)]))
        return place(source, target)

    monkeypatch.setattr(table, "_place", stalled)
    with pytest.raises(HeadMoved):
        table.append(batch(spark, [(0, "c", 6)]), expected_head=2)
    assert rows_of(table.read()) == [("a", 4), ("b", 5), ("d", 7)]


def test_a_name_is_given_once_on_any_store(spark, table):
    """The rename of stores without links refuses as well."""
    jvm = spark._jvm
    for name, text in (("one", "1"), ("two", "2")):
        path, files = table._file_system(f"files/{name}")
        files.create(path, False).close()
    modes = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    one, two = (table._file_system(f"files/{n}")[0] for n in ("one", "two"))
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(one.toUri(), spark._jsc.hadoopConfiguration())
    with pytest.raises(Exception, match="FileAlreadyExists"):
        context.rename(one, two, modes)
    assert not table._place("files/one", "files/two")


# -- algebra ----------------------------------------------------------------------


def test_hot_key_is_reduced_before_the_shuffle(spark):
    changes = spark.range(1000).select(
        F.when(F.col("id") >= 0, "hot").alias("event_id"), F.col("id").alias("batch_id"), F.lit(0).alias("_seq")
    )
    state = keyed.current_state(changes, ["event_id"], keep_version=True)
    plan = state._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert [r.batch_id for r in state.collect()] == [999]


def test_first_and_last_differ_on_duplicates(spark):
    rows = spark.createDataFrame(
        [(0, "e1", "first"), (1, "e1", "second")], "_seq int, event_id string, order_id string"
    )
    assert rows_of(keyed.first_per_key(rows, ["event_id"], ["_seq"]), "order_id") == [("first",)]
    assert rows_of(keyed.last_per_key(rows, ["event_id"], ["_seq"]), "order_id") == [("second",)]


def test_tables_are_visible_to_sql(spark, table):
    table.register()
    assert spark.sql("SELECT sum(value) AS s FROM t").first().s == 9


def test_kafka_options_bound_a_batch():
    from tablestream.sources.topics import kafka_options

    assert kafka_options("b", "t", max_offsets=500)["maxOffsetsPerTrigger"] == "500"
    assert "maxOffsetsPerTrigger" not in kafka_options("b", "t")


def test_main_is_no_name_for_a_ref():
    from tablestream.operators.changelog import _check_name

    with pytest.raises(ValueError):
        _check_name("main")
