"""Token ids in files, coded with a static range asymmetric numeral system.

One frequency table, counted over all documents and scaled to ``2 ** SCALE``, is
stored beside the files and shared by all blocks. A file holds documents in
ascending id order as blocks of whole documents. A block is cut into segments of
at most ``SEGMENT`` ids, each coded by itself over up to ``LANES`` interleaved
states. The block's head lists, per segment, where its words begin, the states to
start from and a CRC-32 of its ids: a checkpoint from which any segment can be
decoded without the others.

Files, all numbers little-endian: ``table`` is Parquet (id, weight); ``blocks`` are
files of blocks, each followed by a newline byte::

    b"RNS1", part u32, block u32, documents u32, segments u32, length u64, crc u32
    documents x (id i64, is_null u8, n_ids u64)
    segments x (n_ids u32, lanes u32, n_words u32, crc of the ids u32)
    per segment: lanes x state u64, n_words x u32

``length`` and ``crc`` are of all that follows in the block.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablestream.llm.common import Batches, arrow, settle, text_of
from tablestream.llm.tokens import encoder
from tablestream.session import fresh_path

SCALE = 18
SEGMENT = 1 << 18
LANES = 2048
#: Ids after which a block ends with the document at hand.
BLOCK = 1 << 18
#: Bytes of ids a file should hold.
FILE_IDS = 1 << 23
LOW = 1 << 31
MAGIC = b"RNS1"
HEAD = struct.Struct("<4sIIIIQI")
DOC = np.dtype([("id", "<i8"), ("null", "u1"), ("n", "<u8")])
SEG = np.dtype([("n", "<u4"), ("lanes", "<u4"), ("words", "<u4"), ("crc", "<u4")])


class Table:
    """Weights of the ids that occur; they add up to ``2 ** SCALE``."""

    def __init__(self, ids: np.ndarray, weights: np.ndarray) -> None:
        self.ids = ids.astype("<u4")
        self.weight = weights.astype(np.uint64)
        self.start = np.cumsum(self.weight, dtype=np.uint64) - self.weight
        self.slot = np.repeat(np.arange(len(ids)), weights.astype(np.int64))
        self.rank = np.zeros(int(ids.max()) + 1 if len(ids) else 1, np.int64)
        self.rank[ids] = np.arange(len(ids))


def scaled(ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Counts as weights of at least 1 that add up to ``2 ** SCALE``."""
    total = 1 << SCALE
    if not len(ids):
        return np.zeros(0, np.int64)
    if len(ids) > total:
        raise ValueError(f"{len(ids)} different ids do not fit {total} weights")
    share = counts.astype(np.float64) / counts.sum() * (total - len(ids))
    weight = np.floor(share).astype(np.int64) + 1
    # What rounding left over goes to the largest remainders.
    rest = total - int(weight.sum())
    order = np.lexsort((ids, np.floor(share) - share))
    weight[order[:rest]] += 1
    return weight


def encode_segment(ids: np.ndarray, table: Table) -> tuple[int, bytes, bytes]:
    """Lanes, states and words of a segment; id ``i`` is coded by lane ``i % lanes``."""
    n = len(ids)
    lanes = min(LANES, max(1, n // 64))
    rank = table.rank[ids]
    weight, start = table.weight[rank], table.start[rank]
    state = np.full(lanes, LOW, np.uint64)
    out = []
    shift, low32 = np.uint64(SCALE), np.uint64(32)
    top = np.uint64((LOW >> SCALE) << 32)
    for a in range((n - 1) // lanes * lanes, -1, -lanes):
        w, c = weight[a : a + lanes], start[a : a + lanes]
        x = state[: len(w)]
        full = x >= top * w
        if full.any():
            out.append(x[full].astype("<u4"))
            x[full] >>= low32
        div = x // w
        x[:] = (div << shift) + (x - div * w) + c
    words = np.concatenate(out[::-1]) if out else np.zeros(0, "<u4")
    return lanes, state.astype("<u8").tobytes(), words.tobytes()


def decode_segment(n: int, state: np.ndarray, words: np.ndarray, table: Table) -> np.ndarray:
    lanes = len(state)
    state = state.astype(np.uint64)
    words = words.astype(np.uint64)
    ranks = np.zeros(n, np.int64)
    shift, mask, low32 = np.uint64(SCALE), np.uint64((1 << SCALE) - 1), np.uint64(32)
    low, at = np.uint64(LOW), 0
    for a in range(0, n, lanes):
        x = state[: min(lanes, n - a)]
        slot = x & mask
        rank = table.slot[slot]
        x[:] = table.weight[rank] * (x >> shift) + slot - table.start[rank]
        ranks[a : a + lanes] = rank
        short = x < low
        k = int(short.sum())
        if k:
            x[short] = (x[short] << low32) | words[at : at + k]
            at += k
    if at != len(words) or (state != low).any():
        raise ValueError("a segment does not end where it should")
    return table.ids[ranks]


def encode_block(part: int, number: int, docs: list[tuple[int | None, bytes]], table: Table):
    heads = np.array([(i or 0, i is None, len(b) // 4) for i, b in docs], DOC)
    ids = np.frombuffer(b"".join(b for _, b in docs), "<u4")
    segments, bodies = [], []
    for a in range(0, len(ids), SEGMENT):
        piece = ids[a : a + SEGMENT]
        lanes, states, words = encode_segment(piece, table)
        segments.append((len(piece), lanes, len(words) // 4, zlib.crc32(piece.tobytes())))
        bodies += [states, words]
    body = b"".join([heads.tobytes(), np.array(segments, SEG).tobytes(), *bodies])
    head = (MAGIC, part, number, len(docs), len(segments), len(body), zlib.crc32(body))
    return HEAD.pack(*head) + body


def blocks_of(content: bytes) -> Iterator[memoryview]:
    """The blocks of a file, by their declared lengths."""
    view, at = memoryview(content), 0
    while at < len(view):
        magic, *_, length, _ = HEAD.unpack_from(view, at)
        end = at + HEAD.size + length
        if magic != MAGIC or view[end : end + 1] != b"\n":
            raise ValueError("not a block of token ids")
        yield view[at:end]
        at = end + 1


def decode_block(block: bytes | memoryview, table: Table) -> tuple[int, int, np.ndarray, np.ndarray]:
    """Part, number, document heads and ids of a block, with all checksums tested."""
    _, part, number, n_docs, n_segments, _, crc = HEAD.unpack_from(block)
    body = memoryview(block)[HEAD.size :]
    if zlib.crc32(body) != crc:
        raise ValueError(f"block {number} of part {part} is damaged")
    heads = np.frombuffer(body, DOC, n_docs)
    segments = np.frombuffer(body, SEG, n_segments, heads.nbytes)
    at, out = heads.nbytes + segments.nbytes, []
    for n, lanes, n_words, seg_crc in segments.tolist():
        state = np.frombuffer(body, "<u8", lanes, at)
        words = np.frombuffer(body, "<u4", n_words, at + state.nbytes)
        at += state.nbytes + words.nbytes
        ids = decode_segment(n, state, words, table)
        if zlib.crc32(ids.tobytes()) != seg_crc:
            raise ValueError(f"a segment of block {number} of part {part} is damaged")
        out.append(ids)
    return part, number, heads, np.concatenate(out) if out else np.zeros(0, "<u4")


@lru_cache(maxsize=1)
def _zstd():
    """Compress and decompress, with contexts that a worker makes once."""
    import zstandard

    return zstandard.ZstdCompressor(level=3).compress, zstandard.ZstdDecompressor().decompress


def _deflated(ids: bytes) -> bytes:
    a = np.frombuffer(ids, "<u4")
    narrow = a.astype("<u2") if not len(a) or a.max() < 1 << 16 else a
    return bytes([narrow.itemsize]) + _zstd()[0](narrow.tobytes())


def _inflated(kept: bytes) -> bytes:
    raw = _zstd()[1](kept[1:])
    return raw if kept[0] == 4 else np.frombuffer(raw, "<u2").astype("<u4").tobytes()


def token_rows(docs: DataFrame, path: str, end_id: int, id_col: str, text_col: str) -> DataFrame:
    """``doc_id``, ``n`` and the ids of each text with ``end_id`` behind, compressed."""
    end = int(end_id).to_bytes(4, "little")

    def step(batches: Batches) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        for batch in batches:
            ids = [x + end for x in encode(batch.column(1))]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(x) // 4 for x in ids], pa.int64()),
                    pa.array([_deflated(x) for x in ids], pa.binary()),
                ],
                ["doc_id", "n", "kept"],
            )

    rows = docs.select(docs[id_col].cast("bigint").alias("id"), text_of(docs, text_col).alias("t"))
    return arrow(rows, step, "doc_id bigint, n bigint, kept binary")


def id_counts(rows: DataFrame) -> DataFrame:
    """How often each id occurs; added up in the tasks before the shuffle."""

    def step(batches: Batches) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            raw = b"".join(_inflated(x) for x in batch.column(0).to_pylist())
            found = np.bincount(np.frombuffer(raw, "<u4"), minlength=len(total))
            found[: len(total)] += total
            total = found
        ids = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(total[ids])], ["id", "n"])

    return (
        arrow(rows.select("kept"), step, "id bigint, n bigint")
        .groupBy("id")
        .agg(F.sum("n").alias("n"))
    )


def write(
    docs: DataFrame,
    target: str,
    path: str,
    end_id: int,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> None:
    """Write the ids of all texts to ``target``.

    Null texts are empty, null ids come first, repeated rows are written each, other
    columns are not carried. An empty table gives an empty folder.
    """
    spark = docs.sparkSession
    rows = settle(token_rows(docs, path, end_id, id_col, text_col), "token-ids")
    # As many rows as there are different ids: the vocabulary bounds it.
    counts = sorted(tuple(r) for r in id_counts(rows).collect())
    ids = np.array([c[0] for c in counts], np.int64)
    weights = scaled(ids, np.array([c[1] for c in counts], np.int64))
    spark.createDataFrame(
        list(zip(ids.tolist(), weights.tolist(), strict=True)), "id bigint, weight bigint"
    ).coalesce(1).write.parquet(f"{target}/table")
    files = max(1, -(-sum(c[1] for c in counts) // FILE_IDS))

    def step(batches: Batches) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        table = Table(ids, weights)
        part, number, held, size = TaskContext.get().partitionId(), 0, [], 0

        def flush() -> pa.RecordBatch:
            block = encode_block(part, number, held, table)
            return pa.RecordBatch.from_arrays([pa.array([block], pa.binary())], ["value"])

        for batch in batches:
            for doc, kept in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                held.append((doc, _inflated(kept)))
                size += len(held[-1][1]) // 4
                if size >= BLOCK:
                    yield flush()
                    number, held, size = number + 1, [], 0
        if held:
            yield flush()

    dealt = rows.select("doc_id", "kept").repartitionByRange(files, F.col("doc_id").asc())
    ordered = dealt.sortWithinPartitions("doc_id", "kept")
    # The text writer puts the bytes of a value as they are, then a newline byte.
    arrow(ordered, step, "value binary").select(F.col("value").cast("string")).write.text(
        f"{target}/blocks"
    )


def read(spark: SparkSession, target: str) -> DataFrame:
    """``part, block, doc_id, n, at, ids``: the documents in the files.

    ``at`` is the number of ids before the document in its block; ``ids`` are
    little-endian unsigned 32-bit. Blocks are decoded independently.
    """
    kept = sorted(tuple(r) for r in spark.read.parquet(f"{target}/table").collect())
    ids = np.array([k[0] for k in kept], np.int64)
    weights = np.array([k[1] for k in kept], np.int64)

    def decode(batches: Batches) -> Iterator[pa.RecordBatch]:
        table = Table(ids, weights)
        for batch in batches:
            blocks = (b for content in batch.column(0).to_pylist() for b in blocks_of(content))
            for block in blocks:
                part, number, heads, got = decode_block(block, table)
                n = heads["n"].astype(np.int64)
                at = np.cumsum(n) - n
                raw = got.tobytes()
                docs = pa.array(heads["id"], mask=heads["null"].astype(bool))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(n), part, np.int64)),
                        pa.array(np.full(len(n), number, np.int64)),
                        docs,
                        pa.array(n),
                        pa.array(at),
                        pa.array(
                            [
                                raw[4 * a : 4 * b]
                                for a, b in zip(at.tolist(), (at + n).tolist(), strict=True)
                            ],
                            pa.binary(),
                        ),
                    ],
                    ["part", "block", "doc_id", "n", "at", "ids"],
                )

    files = spark.read.format("binaryFile").load(f"{target}/blocks").select("content")
    return arrow(
        files,
        decode,
        "part bigint, block bigint, doc_id bigint, n bigint, at bigint, ids binary",
    )


def digests(spark: SparkSession, target: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of what the files hold.

    ``start`` counts the ids of all documents before: those of earlier blocks come
    from a table with one row per block, put in order once.
    """
    from pyspark.sql import Window as W

    rows = settle(
        read(spark, target).select(
            "part", "block", "doc_id", "at", "n", F.crc32("ids").alias("ids_crc32")
        ),
        "decoded",
    )
    sums = rows.groupBy("part", "block").agg(F.sum("n").alias("n"))
    inside = W.partitionBy("part").orderBy("block")
    parts = sums.groupBy("part").agg(F.sum("n").alias("n"))
    # One row per file: the only window over everything.
    before = F.sum("n").over(W.orderBy("part")) - F.col("n")
    base = parts.select("part", before.alias("base"))
    block_at = (F.sum("n").over(inside) - F.col("n")).alias("block_at")
    starts = sums.select("part", "block", block_at).join(base, "part")
    return rows.join(starts, ["part", "block"]).select(
        "doc_id",
        (F.col("base") + F.col("block_at") + F.col("at")).alias("start"),
        F.col("n").alias("n_tokens"),
        "ids_crc32",
    )


def round_trip(docs: DataFrame, path: str, end_id: int) -> DataFrame:
    target = fresh_path(docs.sparkSession, "token-files")
    write(docs, target, path, end_id)
    return digests(docs.sparkSession, target)
