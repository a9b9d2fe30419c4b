"""The pipeline's stages, and the registered queries on the small tables."""

from __future__ import annotations

import hashlib

import pytest

import __spark_entry__
import corpus_pipeline
from tablestream.llm import common, queries, shingles
from tablestream.llm.common import documents
from tests.conftest import rows_of
from tests.oracle import connect, difference

SF_DIR = "/root/testdata/sf0.001"


def test_all_queries_are_registered():
    found = __spark_entry__.queries()
    assert set(queries.QUERIES) | {"pipeline"} <= set(found)
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, name):
    assert difference(queries.QUERIES[name](spark, SF_DIR), connect(SF_DIR), queries.SQL[name]) is None


def test_digests(spark):
    row = queries.op6_personal_data(spark, SF_DIR).where("spans = ''").first()
    assert row["base_sha256"] == hashlib.sha256(b"").hexdigest()
    rows = queries.op10_secret_network(spark, SF_DIR).collect()
    for r in rows:
        kinds = [s.split(":")[0] for s in r["spans"].split(",") if s]
        assert kinds.count("hex") == r["n_hex"] and kinds.count("assign") == r["n_assign"]


def test_a_stage_begins_with_collected_heaps(spark):
    beans = spark._jvm.java.lang.management.ManagementFactory.getGarbageCollectorMXBeans()
    count = lambda: sum(b.getCollectionCount() for b in beans)
    before = count()
    corpus_pipeline.begin(spark, first=True)
    assert count() >= before + spark.sparkContext.defaultParallelism // 2


def test_stages_take_effect(spark):
    docs = documents(spark, SF_DIR)
    counts = [docs.count()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF_DIR)
        docs = corpus_pipeline.settle(docs, "stage")
        assert docs.columns == corpus_pipeline.COLUMNS
        counts.append(docs.count())
    assert counts[0] == counts[1] > counts[2] >= counts[3] == counts[4]
    assert not docs.where(r"text RLIKE '[a-z0-9]@[a-z0-9-]+\\.[a-z]'").count()
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR)
    assert last.select("doc_id").distinct().count() == counts[4]
    assert corpus_pipeline.run(spark, SF_DIR).count() == last.count()


def test_a_column_may_have_the_name_of_a_helper(spark):
    texts = ["one two three four five six seven", "one two three four five six seven", "other words altogether here now yes"]
    docs = spark.createDataFrame([(i, t, i) for i, t in enumerate(texts)], "doc_id bigint, text string, _uid int")
    kept = shingles.representatives(docs)
    assert kept.columns == docs.columns
    assert rows_of(kept, "doc_id", "_uid") == [(0, 0), (2, 2)]


def test_release_frees_only_what_was_written_since(spark):
    common.release(spark, forget=True)
    held = common.settle(spark.range(100), "held")
    (path, _), = common._WRITTEN
    common.release(spark, forget=True)
    common.release(spark)
    assert held.count() == 100
    common._WRITTEN.append((path, held.schema))
    common.release(spark)
    assert spark.read.schema(held.schema).parquet(path).isEmpty() and not common._WRITTEN


def test_emptied_caches_are_forgotten():
    class Cache:
        emptied = 0

        def clear(self):
            self.emptied += 1

    one, other = Cache(), Cache()
    common.only(one)
    common.only(other)
    common.only()
    assert (one.emptied, other.emptied) == (1, 1) and not common._CACHES
