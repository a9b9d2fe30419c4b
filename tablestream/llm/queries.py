"""The queries of this package, ``opN_<name>``, each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablestream.llm import (
    cells,
    chat,
    decontaminate,
    langid,
    packing,
    pii,
    prefix_trie,
    rans,
    secret_scan,
    shingles,
    suffixes,
    variants,
    warc,
)
from tablestream.llm.common import documents, ready, table
from tablestream.llm.tokens import vocabulary_path


def op1_archive_converter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive(table(ready(spark), sf_dir, "pages"))


def op3_rans_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return rans.round_trip(docs, vocabulary_path("byte_bpe_50k.json"), end_id=2)


def op4_sum_of_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    packed = packing.pack(docs, vocabulary_path("word_bpe_49k.json"), end_id=0, capacity=2048)
    digest = F.crc32("ids").alias("ids_crc32")
    return packed.select(
        "doc_id", "piece", "start", "length", digest, "sequence_id", "offset"
    )


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    model = langid.fit(docs.where(~out), vocabulary_path("piece_bpe_32k.model"))
    found = langid.identify(docs.select("doc_id", "text"), model)
    return found.select("row.doc_id", "lang_pred", "score").withColumn("held_out", out)


def op5_perspective_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.rotate(table(ready(spark), sf_dir, "conversations"))


def _digest(spans: str, kinds: tuple[str, ...] | None = None):
    """``kind:start:end`` of the spans in their order, joined by commas."""
    listed = F.col(spans)
    if kinds:
        listed = F.filter(listed, lambda s: s["kind"].isin(*kinds))
    return F.array_join(
        F.transform(listed, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


def _count(kind: str):
    return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")


def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.scan(documents(spark, sf_dir).select("doc_id", "text"))
    return found.select(
        "row.doc_id",
        *[_count(kind) for kind in pii.BASE],
        F.sha2(_digest("spans", pii.BASE), 256).alias("base_sha256"),
        _digest("spans").alias("spans"),
    )


def op7_embedding_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cells.near_duplicates(table(ready(spark), sf_dir, "embeddings"), threshold=0.93)


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    found = decontaminate.scan(docs, table(spark, sf_dir, "benchmark"))
    ids = F.array_sort(F.transform("items", lambda i: i.cast("string")))
    return found.select(
        "row.doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return shingles.near_duplicates(docs).select("doc_id", "n_shingles", "component_id")


def op10_secret_network(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(documents(spark, sf_dir).select("doc_id", "text"))
    return found.select(
        "row.doc_id",
        *[_count(kind) for kind in secret_scan.BASE],
        F.sha2(_digest("spans", secret_scan.BASE), 256).alias("base_sha256"),
        _digest("spans").alias("spans"),
    )


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.groups(variants.words(documents(spark, sf_dir), every=97))


def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    found = suffixes.without_repeats(docs, length=400)
    lengths = F.transform("spans", lambda s: s["hi"] - s["lo"])
    return found.select(
        "row.doc_id",
        "n_bytes",
        F.aggregate(lengths, F.lit(0).cast("bigint"), lambda a, b: a + b).alias("n_removed"),
        F.size("spans").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.rebuilt_trie(table(ready(spark), sf_dir, "conversations"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_archive_converter,
        op2_language_id,
        op3_rans_files,
        op4_sum_of_squares_packing,
        op5_perspective_rotation,
        op6_personal_data,
        op7_embedding_cells,
        op8_decontamination,
        op9_jaccard_join,
        op10_secret_network,
        op11_spelling_variants,
        op12_suffix_dedup,
        op13_prefix_trie,
    )
}
SQL: dict[str, str] = {
    "op5_perspective_rotation": chat.ROTATE_SQL,
    "op11_spelling_variants": variants.GROUPS_SQL,
    "op13_prefix_trie": prefix_trie.TRIE_SQL,
}
