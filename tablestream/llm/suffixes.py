"""Passages of at least ``length`` bytes that occur twice, by sorting their suffixes.

Every string of ``length`` bytes in a text is a window. Its anchor is the first of its
64-byte strings with the smallest hash, so equal windows have equal anchors at equal
places. The windows of one anchor follow one another: they are a segment of text, of
which only a digest travels. A window can occur twice only if its anchor does, and
does if its whole segment does; all other segments with a common anchor meet, each
distinct one once, and their suffixes are sorted.

A block of such segments is sorted by a difference cover, one suffix bucket at a time:
of every ``PERIOD`` places a few are samples, so that for any two suffixes some step of
less than the period takes both to samples. Ranks of the samples' strings are computed
first. Suffixes of a bucket are sorted by their first 32 bytes; ties compare the ranks
of the samples that their common step leads to, and the bytes left behind them. Memory
is the block's text with its ranks and one bucket.

An anchor with more than ``KINDS`` distinct segments (a common passage in as many
surroundings) does not meet in one task. Its segments are cut into shorter ones, of at
most ``STEPS`` windows, that meet by the bytes all their windows share as well; what
is common still is cut again, in the end to single windows.

Cases: null text is empty; ids may be null or repeat, and repeated rows are texts of
their own, so a text that occurs twice loses all its windows; texts of any length are
cut in pieces; texts shorter than ``length`` lose nothing; a window may overlap its
repetition; no rows make no rows. Added columns never clash with those of the input.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, _parse_datatype_string

from tablestream.llm.common import Batches, Scratch

GRAM = 64
#: Bytes of text hashed at once; longer texts are cut in pieces that overlap.
PIECE = 1 << 20
#: Distinct segments of an anchor that one task sorts.
KINDS = 2000
#: Windows of a segment when crowded ones are cut, time after time.
STEPS = (64, 8, 1)
#: Bytes of segments and number of suffixes sorted at once.
BLOCK, BUCKET = 1 << 20, 1 << 16
#: Bytes that suffixes are compared by before ranks are asked.
HEAD = 32

#: A perfect difference set, every difference modulo 31 occurs once.
PERIOD, COVER = 31, [1, 5, 11, 24, 25, 27]


def _steps() -> np.ndarray:
    """For two places modulo the period, the step that takes both to samples."""
    out = np.full((PERIOD, PERIOD), -1)
    for a in range(PERIOD):
        for b in range(PERIOD):
            out[a, b] = next(s for s in range(PERIOD) if {(a + s) % PERIOD, (b + s) % PERIOD} <= set(COVER))
    return out


_STEP = _steps()
_BYTES = np.random.default_rng(20).integers(1, 2**63, (2, 256)).astype(np.uint64)
_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
_PLACE = np.uint64((1 << 24) - 1)


# ------------------------------------------------------------ windows and anchors


def window_hash(data: np.ndarray, size: int, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of the ``size`` bytes from each place on, by doubling."""
    if len(data) < size:
        return np.zeros(0, np.uint64)
    part, power, held, total = _BYTES[seed][data], _BASES[seed], 0, None
    step = 1
    while step <= size:
        by = np.uint64(power)
        if size & step:
            left = len(data) - held - step + 1
            total = part if total is None else total[:left] * by + part[held : held + left]
            held += step
        if 2 * step <= size:
            part = part[:-step] * by + part[step:]
        power = power * power % 2**64
        step *= 2
    x = total[: len(data) - size + 1]
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(29))


def _smallest(keys: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each ``width`` keys in a row."""
    step = 1
    while 2 * step <= width:
        keys = np.minimum(keys[:-step], keys[step:])
        step *= 2
    rest = width - step
    return np.minimum(keys[: len(keys) - rest], keys[rest:]) if rest else keys


def segments(data: np.ndarray, inside: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """First and last window, anchor and its place for each segment of ``data``.

    ``inside``: which windows lie in one text.
    """
    grams = window_hash(data, GRAM)
    places = np.arange(len(grams), dtype=np.uint64)
    anchor = _smallest((grams & ~_PLACE) | places, length - GRAM + 1) & _PLACE
    change = np.concatenate([[True], (anchor[1:] != anchor[:-1]) | ~inside[:-1]])
    first = np.flatnonzero(inside & change)
    change = np.concatenate([(anchor[1:] != anchor[:-1]) | ~inside[1:], [True]])
    last = np.flatnonzero(inside & change)
    place = anchor[first].astype(np.int64)
    return first, last, grams[place], place


def _pieces(texts: list[bytes], length: int) -> Iterator[list[tuple[int, int, bytes]]]:
    """(text, start, bytes) by about ``PIECE`` bytes; texts without windows are left out."""
    held, size = [], 0
    for k, text in enumerate(texts):
        for start in range(0, len(text) - length + 1, PIECE):
            part = text[start : start + PIECE + length - 1]
            held.append((k, start, part))
            size += len(part)
            if size >= PIECE:
                yield held
                held, size = [], 0
    if held:
        yield held


_SEGMENT = "anchor bigint, seg binary, size int, lead int, doc binary, id string, starts array<int>"


def _cut(length: int):
    """Documents (doc, id, text) to their segments, once per text with all places."""

    def step(batches: Batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs, ids = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            texts = [t.encode() for t in batch.column(2).to_pylist()]
            for pieces in _pieces(texts, length):
                data = np.frombuffer(b"".join(p[2] for p in pieces), np.uint8)
                ends = np.cumsum([len(p[2]) for p in pieces])
                inside = np.ones(len(data) - length + 1, dtype=bool)
                for end in ends[:-1]:
                    inside[max(0, end - length + 1) : end] = False
                first, last, anchors, leads = segments(data, inside, length)
                whole = data.tobytes()
                owner = np.searchsorted(ends, first, side="right")
                found: dict[tuple, list[int]] = {}
                listed = zip(*[x.tolist() for x in (first, last, anchors.view(np.int64), leads - first, owner)])
                for a, b, anchor, lead, k in listed:
                    digest = hashlib.md5(whole[a : b + length], usedforsecurity=False).digest()
                    text, start, part = pieces[k]
                    place = a - (int(ends[k]) - len(part)) + start
                    found.setdefault((text, anchor, digest, b - a + 1, lead), []).append(place)
                at = [k[0] for k in found]
                counts = np.cumsum([0, *[len(v) for v in found.values()]])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([k[1] for k in found], pa.int64()),
                        pa.array([k[2] for k in found], pa.binary()),
                        pa.array([k[3] for k in found], pa.int32()),
                        pa.array([k[4] for k in found], pa.int32()),
                        pa.array([docs[k] for k in at], pa.binary()),
                        pa.array([ids[k] for k in at], pa.string()),
                        pa.ListArray.from_arrays(
                            pa.array(counts, pa.int32()), pa.array([p for v in found.values() for p in v], pa.int32())
                        ),
                    ],
                    ["anchor", "seg", "size", "lead", "doc", "id", "starts"],
                )

    return step


# ------------------------------------------------------------ sorting a block


def _words(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as one number, big end first."""
    word = data.astype(np.uint64)
    for step in (1, 2, 4):
        word = (word[:-step] << np.uint64(8 * step)) | word[step:]
    return word


def sample_ranks(data: np.ndarray, depth: int) -> np.ndarray:
    """Ranks of the ``depth`` bytes from each sample on; -1 elsewhere.

    Equal strings are found by digest, so that each distinct one is sorted once.
    """
    a, b = window_hash(data, depth, 0), window_hash(data, depth, 1)
    at = np.flatnonzero(np.isin(np.arange(len(a)) % PERIOD, COVER))
    order = at[np.lexsort((b[at], a[at]))]
    fresh = (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1])
    name = np.concatenate([[0], np.cumsum(fresh)]) if len(order) else np.zeros(0, np.int64)
    whole = data.tobytes()
    strings = [whole[p : p + depth] for p in order[np.flatnonzero(np.concatenate([[True], fresh]))].tolist()] if len(order) else []
    rank_of = np.empty(len(strings), dtype=np.int64)
    rank_of[sorted(range(len(strings)), key=strings.__getitem__)] = np.arange(len(strings))
    ranks = np.full(len(data), -1)
    ranks[order] = rank_of[name]
    return ranks


class Block:
    """Text whose suffixes are sorted to a depth of ``length`` bytes."""

    def __init__(self, data: bytes, length: int) -> None:
        self.data, self.length = np.frombuffer(data, np.uint8), length
        self.word = _words(self.data)
        self.rank = sample_ranks(self.data, length - PERIOD + 1)

    def _order(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """-1, 0 or 1 for pairs of suffixes with equal heads."""
        step = _STEP[a % PERIOD, b % PERIOD]
        out = np.sign(self.rank[a + step] - self.rank[b + step])
        # The rank's string ends up to a period before the window does.
        for back in range(HEAD, 0, -8):
            x, y = self.word[a + self.length - back], self.word[b + self.length - back]
            out = np.where(out == 0, (x > y).astype(np.int64) - (x < y), out)
        return out

    def bucket(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffixes in order, and which of them equal another one."""
        heads = [self.word[at + k] for k in range(0, HEAD, 8)]
        at = at[np.lexsort(heads[::-1])]
        fresh = np.zeros(max(len(at) - 1, 0), dtype=bool)
        for k in range(0, HEAD, 8):
            w = self.word[at + k]
            fresh |= w[1:] != w[:-1]
        group = np.concatenate([[0], np.cumsum(fresh)])
        twice = np.zeros(len(at), dtype=bool)
        slots = np.arange(len(at))  # places whose suffix may still move within its group
        while len(slots):
            _, first, counts = np.unique(group, return_index=True, return_counts=True)
            several = np.repeat(counts > 1, counts)
            slots, group = slots[several], group[several]
            if not len(slots):
                break
            first, counts = np.unique(group, return_index=True, return_counts=True)[1:]
            here = at[slots]
            side = self._order(here, np.repeat(here[first + counts // 2], counts))
            moved = np.lexsort((side, group))
            at[slots], side = here[moved], side[moved]
            number = np.repeat(np.arange(len(counts)), counts)
            equal = np.bincount(number[side == 0], minlength=len(counts))
            twice[slots] = (side == 0) & np.repeat(equal > 1, counts)
            group = 3 * number + side
            slots, group = slots[side != 0], group[side != 0]
        return at, twice

    def repeated(self, at: np.ndarray) -> np.ndarray:
        """Which of the windows that start at ``at`` equal another one of them."""
        lead = (self.word[at] >> np.uint64(48)).astype(np.int64)
        before = np.cumsum(np.bincount(lead, minlength=1 << 16)) - 1
        number = before[lead] // BUCKET
        out = np.zeros(len(self.data), dtype=bool)
        for k in np.unique(number):
            placed, twice = self.bucket(at[number == k])
            out[placed[twice]] = True
        return out[at]


def ranges(flags: np.ndarray) -> list[dict]:
    """Runs of true flags as ``lo`` and ``hi``, which is excluded."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return [{"lo": a, "hi": b} for a, b in zip(edge[::2].tolist(), edge[1::2].tolist())]


_RANGES = "array<struct<lo:int,hi:int>>"
_FOUND = f"seg binary, found {_RANGES}"


def _found_batch(rows: list[tuple]) -> pa.RecordBatch:
    kind = pa.list_(pa.struct([("lo", pa.int32()), ("hi", pa.int32())]))
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], kind)], ["seg", "found"]
    )


def _sorted_blocks(length: int):
    """Bodies of segments, sorted by anchor, to their windows that occur elsewhere."""

    def settled(bodies: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
        sizes = np.array([len(b) for _, b in bodies])
        starts = np.cumsum(sizes) - sizes
        # A tail, so that every sample has a string; it starts no window.
        block = Block(b"".join(b for _, b in bodies) + bytes(PERIOD), length)
        counts = sizes - length + 1
        at = np.repeat(starts, counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        parts = np.split(block.repeated(at), np.cumsum(counts)[:-1])
        return _found_batch([(seg, ranges(p)) for (seg, _), p in zip(bodies, parts) if p.any()])

    def step(batches: Batches) -> Iterator[pa.RecordBatch]:
        bodies, size, at, last = [], 0, None, None
        for batch in batches:
            for anchor, seg, body in zip(*[batch.column(c).to_pylist() for c in ("anchor", "seg", "body")]):
                if anchor != at and size >= BLOCK:
                    yield settled(bodies)
                    bodies, size = [], 0
                at = anchor
                if seg != last:  # repeated rows bring a segment again
                    bodies.append((seg, body))
                    size += len(body)
                last = seg
        if bodies:
            yield settled(bodies)

    return step


# ------------------------------------------------------------ the tables


_BODY = "anchor bigint, seg binary, size int, lead int, body binary"
_BODY_SHAPE = pa.schema(
    [("anchor", pa.int64()), ("seg", pa.binary()), ("size", pa.int32()), ("lead", pa.int32()), ("body", pa.binary())]
)


def _bodies(length: int):
    """Packed texts with the segments asked of them to the segments' bytes."""

    def step(batches: Batches) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            out, size = [], 0
            for text, asked in zip(batch.column("text"), batch.column("asked")):
                text = unpack(text.as_py())
                for a in asked.as_py():
                    body = text[a["start"] : a["start"] + a["size"] + length - 1]
                    out.append((a["anchor"], a["seg"], a["size"], a["lead"], body))
                    size += len(body)
                    if size >= PIECE:
                        yield _batch(out, _BODY_SHAPE)
                        out, size = [], 0
            yield _batch(out, _BODY_SHAPE)

    return step


def _batch(rows: list[tuple], shape: pa.Schema) -> pa.RecordBatch:
    columns = [*zip(*rows)] or [[]] * len(shape)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, shape)], schema=shape)


_PART = f"whole binary, shift int, {_BODY}"
_PART_SHAPE = pa.schema([("whole", pa.binary()), ("shift", pa.int32()), *_BODY_SHAPE])


def _shorter(length: int, windows: int):
    """Segments to parts whose windows lie alike to the anchor, ``windows`` at most.

    All windows of a part share some bytes. They have a place before the anchor, so
    equal windows are in parts with the same name made of place and shared bytes.
    """

    def parts(anchor: int, seg: bytes, size: int, lead: int, body: bytes) -> Iterator[tuple]:
        for near in range((lead - size + 1) // windows * windows, lead + 1, windows):
            far = near + windows - 1
            a, b = max(0, lead - far), min(size - 1, lead - near)
            name = hashlib.md5(f"{anchor} {near} ".encode(), usedforsecurity=False)
            name.update(body[lead - near : lead - far + length])
            part = body[a : b + length]
            digest = hashlib.md5(part, usedforsecurity=False).digest()
            yield seg, a, int.from_bytes(name.digest()[:8], "big", signed=True), digest, b - a + 1, lead - a, part

    def step(batches: Batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in zip(*[c.to_pylist() for c in batch.columns]):
                out += parts(*row)
                if len(out) >= 2000:
                    yield _batch(out, _PART_SHAPE)
                    out = []
            yield _batch(out, _PART_SHAPE)

    return step


def _several(kind: DataFrame, most: int) -> DataFrame:
    """Anchors with different segments, and whether they are crowded."""
    several = kind.groupBy("anchor").agg(F.count("*").alias("kinds")).where("kinds > 1")
    return several.select("anchor", (F.col("kinds") > most).alias("crowded"))


def _compared(kind: DataFrame, bodies: DataFrame, several: DataFrame, length: int, most: int, steps, scratch: Scratch):
    """``seg, found``: the repeated windows of segments.

    ``kind``: anchor, seg, size and their number n; ``bodies`` of those whose anchor
    is in ``several``, perhaps repeated.
    """
    # Segments that occur twice are repeated as a whole, whatever else is found in them.
    whole = F.array(F.struct(F.lit(0).alias("lo"), F.col("size").alias("hi"))).cast(_RANGES)
    answers = kind.where("n > 1").select("seg", whole.alias("found"))
    once = kind.where("n = 1").select("seg")
    met = bodies.join(several, "anchor")
    blocks = met.where("not crowded").repartition("anchor").sortWithinPartitions("anchor", "seg")
    found = blocks.select("anchor", "seg", "body").mapInArrow(_sorted_blocks(length), _FOUND)
    if steps and not several.where("crowded").isEmpty():
        crowd = met.where("crowded").drop("crowded").dropDuplicates(["seg"])
        found = found.unionByName(_cut_again(crowd, length, most, steps, scratch))
    return answers.unionByName(found.join(once, "seg", "left_semi"))


def _cut_again(bodies: DataFrame, length: int, most: int, steps, scratch: Scratch) -> DataFrame:
    rows = scratch.settle(bodies.select(*_BODY_SHAPE.names).mapInArrow(_shorter(length, steps[0]), _PART), "parts")
    kind = rows.groupBy("anchor", "seg", "size").agg(F.count("*").alias("n"))
    kind = scratch.settle(kind, "kinds")
    several = scratch.settle(_several(kind, most), "several")
    inner = _compared(kind, rows.select(*_BODY_SHAPE.names), several, length, most, steps[1:], scratch)
    moved = lambda r: F.struct((r["lo"] + F.col("shift")).alias("lo"), (r["hi"] + F.col("shift")).alias("hi"))
    placed = rows.select("whole", "shift", "seg").join(inner, "seg")
    placed = placed.select("whole", F.transform("found", moved).alias("found"))
    return placed.groupBy(F.col("whole").alias("seg")).agg(F.flatten(F.collect_list("found")).cast(_RANGES).alias("found"))


def _packed(docs: DataFrame, text: str) -> DataFrame:
    """``doc, id, text`` (packed) and ``row``: what the joins by text digest move."""

    def pack(batches: Batches) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            texts = [packer.compress(t.encode()) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.binary()), *batch.columns[3:]], batch.schema.names
            )

    kept = [docs[c] for c in docs.columns if c != text]
    rows = _keyed(docs, text, *kept)
    shape = StructType([StructField("text", _parse_datatype_string("binary")) if f.name == "text" else f for f in rows.schema])
    return rows.mapInArrow(pack, shape)


def _keyed(docs: DataFrame, text: str, *kept) -> DataFrame:
    words = F.coalesce(docs[text].cast("string"), F.lit(""))
    key = docs["doc_id"].cast("string").alias("id")
    rows = [F.struct(*kept).alias("row")] if kept else []
    return docs.select(F.unhex(F.md5(words.cast("binary"))).alias("doc"), key, words.alias("text"), *rows)


def repeats(docs: DataFrame, length: int = 400, text: str = "text", kinds: int = KINDS) -> DataFrame:
    """``doc, places``: by text digest, the windows that occur elsewhere.

    ``places`` are structs of ``starts`` of a segment and its repeated ``found`` windows.
    """
    scratch = Scratch(docs.sparkSession)
    rows = _keyed(docs, text).where(F.octet_length("text") >= length)
    every = scratch.settle(rows.mapInArrow(_cut(length), _SEGMENT), "segments")
    times = F.sum(F.size("starts")).alias("n")
    common = every.groupBy("anchor").agg(times).where("n > 1").select("anchor")
    kept = scratch.settle(every.join(common, "anchor", "left_semi"), "kept")
    scratch.drop(every)
    kind = kept.groupBy("anchor", "seg", "size", "lead").agg(
        times, F.min(F.struct("id", "doc", F.col("starts")[0].alias("start"))).alias("at")
    )
    kind = scratch.settle(kind, "kinds")
    several = scratch.settle(_several(kind, kinds), "several")
    asked = kind.join(several, "anchor").select(
        "at.doc", F.col("at.id").alias("asked_id"), F.struct("anchor", "seg", "size", "lead", "at.start").alias("a")
    )
    asked = asked.groupBy("doc", "asked_id").agg(F.collect_list("a").alias("asked"))
    texts = _packed(docs.select("doc_id", text).where(F.octet_length(text) >= length), text).drop("row")
    met = texts.join(asked, "doc").where(F.col("id").eqNullSafe(F.col("asked_id")))
    bodies = scratch.settle(met.select("text", "asked").mapInArrow(_bodies(length), _BODY), "bodies")
    answers = scratch.settle(_compared(kind, bodies, several, length, kinds, STEPS, scratch), "answers")
    places = kept.select("doc", "seg", "starts").groupBy("doc", "seg", "starts").agg(F.lit(1).alias("one"))
    places = places.join(answers, "seg").select("doc", F.struct("starts", "found").alias("p"))
    out = scratch.settle(places.groupBy("doc").agg(F.collect_list("p").alias("places")), "places")
    scratch.drop(kept, kind, bodies, answers)
    return out


def removed(places: list[dict] | None, length: int) -> list[tuple[int, int]]:
    """Maximal runs of bytes that repeated windows cover."""
    out: list[tuple[int, int]] = []
    spans = sorted((s + r["lo"], s + r["hi"] - 1 + length) for p in places or [] for s in p["starts"] for r in p["found"])
    for a, b in spans:
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


_OUT = "n_bytes bigint, spans array<struct<lo:bigint,hi:bigint>>, kept binary"


def without_repeats(docs: DataFrame, length: int = 400, text: str = "text", kinds: int = KINDS) -> DataFrame:
    """``row`` (the other columns), ``n_bytes``, removed ``spans`` and ``kept`` bytes.

    Bytes covered by a string of ``length`` bytes that also starts elsewhere in the
    texts go, all occurrences alike. Cutting bytes can split a character.
    """
    found = repeats(docs, length, text, kinds)
    joined = _packed(docs, text).join(found, "doc", "left").select("row", "text", "places")

    span = pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64())]))

    def step(batches: Batches) -> Iterator[pa.RecordBatch]:
        types = [pa.int64(), span, pa.binary()]
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            out = []
            for packed, places in zip(batch.column(1), batch.column(2)):
                whole = unpack(packed.as_py())
                spans = removed(places.as_py(), length)
                edges = [0, *[x for s in spans for x in s], len(whole)]
                kept = b"".join(whole[a:b] for a, b in zip(edges[::2], edges[1::2]))
                out.append((len(whole), [{"lo": a, "hi": b} for a, b in spans], kept))
            columns = [pa.array(c, t) for c, t in zip([*zip(*out)] or [[]] * 3, types)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["row", "n_bytes", "spans", "kept"])

    shape = StructType([joined.schema["row"], *_parse_datatype_string(_OUT).fields])
    return joined.mapInArrow(step, shape)
