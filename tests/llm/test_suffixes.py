"""Repeated passages against a dictionary of all strings of their length."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from tablestream.llm import suffixes
from tablestream.llm.common import ready
from tablestream.llm.queries import op12_suffix_dedup


@pytest.fixture(autouse=True)
def session(spark):
    return ready(spark)


def brute(rows, length=400):
    total = Counter()
    texts = [(k, (t or "").encode()) for k, t in rows]
    for _, text in texts:
        total.update(text[i : i + length] for i in range(len(text) - length + 1))
    out = []
    for key, text in texts:
        gone = np.zeros(len(text) + 1, dtype=bool)
        for i in range(len(text) - length + 1):
            if total[text[i : i + length]] > 1:
                gone[i : i + length] = True
        kept = bytes(b for b, g in zip(text, gone) if not g)
        spans = int((np.diff(np.concatenate([[False], gone]).astype(int)) == 1).sum())
        out.append((key, len(text), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def result(spark, rows, tmp_path, monkeypatch=None):
    schema = "doc_id bigint, text string, row string, places int"
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], schema)
    folder = str(tmp_path / f"t{random.random()}")
    df.write.parquet(f"{folder}/documents.parquet")
    return sorted((tuple(r) for r in op12_suffix_dedup(spark, folder).collect()), key=repr)


def prose(rng, words):
    return " ".join("".join(rng.choice("abcdeé日") for _ in range(rng.randint(2, 8))) for _ in range(words))


def corpus(seed):
    rng = random.Random(seed)
    passage, edge = prose(rng, 150), prose(rng, 300).encode()[:399].decode("utf-8", "ignore")
    base = prose(rng, 500)
    texts = [None, "", "short", base, base, base[:700] + "X" + base[700:], base[5:], passage + passage]
    texts += [prose(rng, rng.randint(1, 200)) + passage + prose(rng, 30) for _ in range(12)]
    texts += [prose(rng, 40) + edge + prose(rng, 40) for _ in range(12)]
    texts += ["a" * 900, "ab" * 450 + "c", "abc" * 133, "a" * 400, "q" * 399, "q" * 399 + "r", prose(rng, 100)]
    line = prose(rng, 12) + "\n"
    texts += [line * 40, prose(rng, 60) + line + prose(rng, 60) + line]
    rows = list(enumerate(texts))
    return [*rows, (3, base), (None, base[:650]), (None, passage[:500]), rows[9]]


@pytest.mark.parametrize("seed", [1, 2])
def test_rows_equal_brute_force(spark, tmp_path, seed):
    rows = corpus(seed)
    assert result(spark, rows, tmp_path) == brute(rows)


def test_crowded_anchors_are_counted_by_window(spark):
    rows = [(k, t) for k, t in corpus(3)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    for kinds in (1, 4):
        got = suffixes.without_repeats(df, kinds=kinds)
        found = sorted(
            (
                (r["row"]["doc_id"], r["n_bytes"], sum(s["hi"] - s["lo"] for s in r["spans"]), len(r["spans"]),
                 hashlib.sha256(r["kept"]).hexdigest())
                for r in got.collect()
            ),
            key=repr,
        )
        assert found == brute(rows)


def test_texts_longer_than_a_piece(spark, tmp_path, monkeypatch):
    rng = random.Random(4)
    long = "".join(rng.choice("abcdefgh ") for _ in range(2_300_000))
    rows = [(1, long), (2, "zz" + long[1_048_000:1_050_000] + "yy"), (3, long[2_200_000:2_200_450])]
    got = {r[0]: r for r in result(spark, rows, tmp_path)}
    assert got[1][2:4] == (2000 + 450, 2) and got[2][2:4] == (2000, 1) and got[3][2:4] == (450, 1)


def test_no_rows(spark, tmp_path):
    assert result(spark, [], tmp_path) == []
    assert result(spark, [(1, None)], tmp_path) == [(1, 0, 0, 0, hashlib.sha256(b"").hexdigest())]


def test_block_sorts_like_python():
    rng = random.Random(5)
    text = "".join(rng.choice("ab") for _ in range(300)).encode()
    data = (text + text + b"x" + text[:250] + text + b"aaaa" * 200)[:2000]
    block = suffixes.Block(data + bytes(suffixes.PERIOD), 400)
    at = np.arange(len(data) - 400 + 1)
    placed, twice = block.bucket(at.copy())
    windows = [data[i : i + 400] for i in placed]
    total = Counter(windows)
    assert [total[w] > 1 for w in windows] == twice.tolist()
    # Equal windows are neighbours, and heads are in order.
    assert [w[:32] for w in windows] == sorted(w[:32] for w in windows)
    seen = set()
    for a, b in zip(windows, windows[1:]):
        if a != b:
            assert b not in seen
        seen.add(a)
    assert block.repeated(at).tolist() == [total[data[i : i + 400]] > 1 for i in at]


def test_hash_of_windows():
    data = np.frombuffer(random.Random(6).randbytes(2000), np.uint8)
    for size in (1, 64, 370, 400):
        whole = suffixes.window_hash(data, size)
        assert len(whole) == len(data) - size + 1
        assert whole[77] == suffixes.window_hash(data[77 : 77 + size], size)[0]
        assert len(set(whole.tolist())) == len(whole) or size == 1
    assert (suffixes._STEP >= 0).all()
