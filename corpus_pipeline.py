"""A training corpus in five stages, each an operator of ``tablestream.llm``.

Every stage reads what the one before has kept, written as Parquet, and its
decisions take effect: rows are dropped or texts changed. All but the last return
the columns of ``documents``.

A stage begins by freeing the intermediate tables of the one before, whose result is
written by then. Nulls, empty and very long texts, ties, repeated rows, empty tables
and further columns are handled as the operators say; further columns of ``docs`` are
left out, and a null text is dropped by ``language``, which finds no letter in it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablestream.llm import decontaminate, langid, packing, pii, shingles
from tablestream.llm.common import collect_garbage, documents, ready, release, table
from tablestream.llm.tokens import vocabulary_path
from tablestream.session import settle

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def begin(spark: SparkSession, first: bool = False) -> SparkSession:
    """Free what the stage before has left, on disk and in the executors' heaps; the
    first stage leaves others' tables alone."""
    release(spark, forget=first)
    collect_garbage(spark)
    return ready(spark)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without a recognisable language go."""
    begin(spark, first=True)
    model = langid.fit(docs, vocabulary_path("piece_bpe_32k.model"))
    found = langid.identify(docs, model)
    return found.where(F.col("lang_pred") != langid.UNKNOWN).select("row.*").select(COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    begin(spark)
    return shingles.representatives(docs).select(COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of the benchmark go."""
    found = decontaminate.scan(docs, table(begin(spark), sf_dir, "benchmark"))
    return found.where("n_hit = 0").select("row.*").select(COLUMNS)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind."""
    begin(spark)
    found = pii.scan(docs).select("row.*", "clean")
    return found.select(
        "doc_id",
        F.col("clean").alias("text"),
        "lang",
        "source",
        F.length("clean").cast("bigint").alias("n_chars"),
    )


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of at most 2048: one row per piece."""
    begin(spark)
    packed = packing.pack(docs, vocabulary_path("word_bpe_49k.json"), end_id=0, capacity=2048)
    return packed.select(
        "sequence_id", "offset", "length", "doc_id", "piece", "start", "ids"
    )


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("sequences", sequences),
]

#: No SQL: a language model, a similarity join and a tokenizer are no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
