"""Benchmark passages in documents, by one Aho-Corasick automaton.

Questions and answers are normalised to words; every run of ``WINDOW`` consecutive
words of an item is a pattern, and a shorter item is one pattern as a whole. The
automaton of all patterns scans the normalised text once; what it finds is mapped
back to places in the original.

The automaton is built from the benchmark in every worker, so its text is sent to
them. Its size is measured first: beyond ``SHARD_BYTES`` the items are dealt over
several automata, and the documents go through one after the other.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablestream.llm.common import Batches, arrow, only

WINDOW = 10
#: Bytes of benchmark text in one automaton; its nodes take a few hundred bytes for
#: each of them.
SHARD_BYTES = 1 << 20

#: Letters a-z, digits and all beyond ASCII are words; A-Z are lower-cased.
WORD_BYTES = bytes(
    c + 32
    if 0x41 <= c <= 0x5A
    else c
    if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80
    else 0x20
    for c in range(256)
)

Item = tuple[int | None, str]
RUNS = "array<struct<a: bigint, b: bigint>>"
SPANS = "array<struct<start: bigint, end: bigint>>"


def words_of(text: str) -> list[bytes]:
    return text.encode().translate(WORD_BYTES).split()


class Matcher:
    def __init__(self, items: tuple[Item, ...]) -> None:
        import ahocorasick

        patterns: dict[bytes, tuple[int, set[int | None]]] = {}
        for item, text in items:
            words = words_of(text)
            size = min(WINDOW, len(words))
            for a in range(len(words) - size + 1 if size else 0):
                window = b" " + b" ".join(words[a : a + size]) + b" "
                patterns.setdefault(window, (size, set()))[1].add(item)
        self.automaton = ahocorasick.Automaton()
        for window, (size, owners) in patterns.items():
            self.automaton.add_word(window.decode("latin-1"), (size, tuple(owners)))
        if patterns:
            self.automaton.make_automaton()
        self.empty = not patterns

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[int | None]]:
        """Runs of hit words as (first, last + 1), and the items found."""
        if self.empty or not words:
            return [], set()
        line = b" " + b" ".join(words) + b" "
        found = list(self.automaton.iter(line.decode("latin-1")))
        if not found:
            return [], set()
        # Word i ends before the blank at ends[i].
        ends = np.cumsum([len(w) + 1 for w in words])
        last = np.searchsorted(ends, [at for at, _ in found])
        items: set[int | None] = set()
        spans = []
        for k, (_, (size, owners)) in zip(last.tolist(), found, strict=True):
            spans.append((k + 1 - size, k + 1))
            items.update(owners)
        return merged(spans), items


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


@lru_cache(maxsize=2)
def matcher(items: tuple[Item, ...]) -> Matcher:
    return Matcher(items)


def original(text: str, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Runs of words as places in ``text``, in characters."""
    if not runs:
        return []
    raw = text.encode()
    places = [m.span() for m in re.finditer(rb"[^ ]+", raw.translate(WORD_BYTES))]
    spans = [(places[a][0], places[b - 1][1]) for a, b in runs]
    return [(len(raw[:a].decode()), len(raw[:b].decode())) for a, b in spans]


def shards(benchmark: DataFrame, item_col: str, text_col: str) -> list[tuple[Item, ...]]:
    """The items in groups of at most ``SHARD_BYTES``; an item is never split."""
    items = benchmark.select(
        benchmark[item_col].alias("item"),
        F.coalesce(benchmark[text_col].cast("string"), F.lit("")).alias("text"),
    )
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-size // SHARD_BYTES) or 1
    if n == 1:
        return [tuple(sorted((tuple(r) for r in items.collect()), key=repr))]
    dealt = items.withColumn("shard", F.pmod(F.xxhash64("text"), F.lit(n)))
    parts = [dealt.where(F.col("shard") == k).drop("shard").collect() for k in range(n)]
    return [tuple(sorted((tuple(r) for r in part), key=repr)) for part in parts]


def scan(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """``row`` (all columns of ``docs``), ``n_words``, ``n_hit``, ``items``, ``spans``.

    ``items`` are the ids found, ``spans`` (start, end) of the runs of hit words in
    the original text. Null texts have no words; items without words match nothing;
    a null item id is found as null; an empty benchmark finds nothing; repeated rows
    are scanned each.
    """
    groups = shards(benchmark, item_col, item_text)
    kept = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("row"),
        docs[text_col].cast("string").alias("text"),
        F.lit(None).cast(RUNS).alias("runs"),
        F.lit(None).cast("array<bigint>").alias("items"),
    )
    row = kept.schema["row"].simpleString().removeprefix("row:")
    for group in groups[:-1]:
        step = _pass(group, last=False)
        kept = arrow(kept, step, f"row {row}, text string, runs {RUNS}, items array<bigint>")
    return arrow(
        kept,
        _pass(groups[-1], last=True),
        f"row {row}, n_words bigint, n_hit bigint, items array<bigint>, spans {SPANS}",
    )


def _pass(group: tuple[Item, ...], last: bool):
    """Scan with one automaton; runs and items of earlier ones come along."""

    def step(batches: Batches) -> Iterator[pa.RecordBatch]:
        runs_type = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))
        spans_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        ids_type = pa.list_(pa.int64())
        only()
        m = matcher(group)
        for batch in batches:
            texts, before, owners = (c.to_pylist() for c in batch.columns[1:])
            n_words, runs, items, spans = [], [], [], []
            for text, old, ids in zip(texts, before, owners, strict=True):
                words = words_of(text or "")
                more, found = m.scan(words)
                all_runs = merged([*more, *((r["a"], r["b"]) for r in old or ())])
                found.update(ids or ())
                n_words.append(len(words))
                runs.append(all_runs)
                items.append(sorted(found, key=lambda i: (i is not None, i or 0)))
                if last:
                    spans.append(original(text or "", all_runs))
            if last:
                columns = [
                    batch.column(0),
                    pa.array(n_words, pa.int64()),
                    pa.array([sum(b - a for a, b in r) for r in runs], pa.int64()),
                    pa.array(items, ids_type),
                    pa.array([[{"start": a, "end": b} for a, b in s] for s in spans], spans_type),
                ]
                names = ["row", "n_words", "n_hit", "items", "spans"]
            else:
                columns = [
                    *batch.columns[:2],
                    pa.array([[{"a": a, "b": b} for a, b in r] for r in runs], runs_type),
                    pa.array(items, ids_type),
                ]
                names = ["row", "text", "runs", "items"]
            yield pa.RecordBatch.from_arrays(columns, names)

    return step
