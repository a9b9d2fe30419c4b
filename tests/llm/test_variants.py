"""Spelling variants against a comparison of all pairs."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tablestream.llm import variants
from tablestream.llm.common import ready

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(autouse=True)
def session(spark):
    return ready(spark)


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_words(rows, every=97):
    total = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            at = h % len(run)
            total[run[:at] + run[at + 1 :] if h % every == 0 else run] += 1
    return {w: n for w, n in total.items() if len(w) >= 5 and n >= 3}


def brute(counts):
    forms, out = {}, []
    nears = {w: [v for v in counts if v != w and near(w, v)] for w in counts}
    for w, n in counts.items():
        best = min(nears[w], key=lambda v: (-counts[v], v), default=None)
        forms[w] = best if best and counts[best] >= 2 * n else None
    for w, n in counts.items():
        root = w
        while forms[root]:
            root = forms[root]
        out.append((w, forms[w], root, n, len(nears[w]), counts.get(forms[w])))
    return sorted(out)


def result(spark, counts, **options):
    df = spark.createDataFrame([(w, n, "x") for w, n in counts.items()], "word string, n bigint, best string")
    return sorted(tuple(r) for r in variants.groups(df.select("word", "n"), **options).collect())


def vocabulary(seed, size=400):
    rng = random.Random(seed)
    counts = {}
    while len(counts) < size:
        word = "".join(rng.choice("eatéñz") for _ in range(rng.randint(3, 7)))
        counts[word] = rng.choice([3, 3, 5, 6, 12, 40])
    long = "x" * 60 + "y" * 60
    counts |= {long: 9, long + "z": 3, "w" + long: 20, "q" * 300: 3, "q" * 301: 7, "q" * 255 + "e" * 45: 4}
    return counts


@pytest.mark.parametrize("most", [20_000, 40, 1])
def test_forms_equal_all_pairs(spark, most):
    """Without a trunk, with one, and with every common vector cut by halves."""
    counts = vocabulary(most)
    assert result(spark, counts, most=most) == brute(counts)


def test_one_common_vector_is_cut_by_halves(spark):
    rng = random.Random(3)
    counts = {}
    while len(counts) < 300:
        letters = list("aaabbbcc")
        rng.shuffle(letters)
        word = "".join(letters)
        counts[word] = rng.randint(3, 60)
        i = rng.randrange(8)
        counts[word[:i] + rng.choice("pf") + word[i + 1 :]] = rng.randint(3, 60)
    assert result(spark, counts, most=20) == brute(counts)


def test_chains_follow_to_their_end(spark):
    word, counts, n = "aaaaaaaaaaaaaaaaaaaa", {}, 3
    for i in range(18):
        counts[word[:i] + "b" * i + word[2 * i :] if i < 10 else word[i:] + "c" * i] = n
        n *= 2
    counts = {f"{'a' * 20}{'b' * i}": 3 * 2**i for i in range(18)}
    got = result(spark, counts)
    assert got == brute(counts)
    assert {r[2] for r in got} == {"a" * 20 + "b" * 17}


def test_whole_table_of_texts(spark):
    rng = random.Random(5)
    pool = ["Étion", "étion", "Leaux", "leaux", "leau", "mentoi", "mentoy", "MENTOI", "naïve", "naive", "straße", "日本"]
    rows = [(i, " ".join(rng.choice(pool) for _ in range(40)) + "-x_y1zebra") for i in range(400)]
    rows += [(None, "mentoi " * 200), (1000, None), (1001, ""), (7, rows[7][1]), (1002, "e" * 50_000 + " " + "zebra," * 900)]
    docs = spark.createDataFrame([(*r, "f") for r in rows], "doc_id bigint, text string, word string")
    counts = {r["word"]: r["n"] for r in variants.words(docs, every=97).collect()}
    want = brute_words(rows)
    assert counts == want
    got = variants.groups(variants.words(docs, every=97))
    assert sorted(tuple(r) for r in got.collect()) == brute(want)


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert variants.groups(variants.words(docs)).collect() == []
    docs = spark.createDataFrame([(1, None), (2, "12 34")], "doc_id bigint, text string")
    assert variants.groups(variants.words(docs)).collect() == []


def test_one_edit_and_halves():
    rng = random.Random(8)
    for _ in range(3000):
        a = "".join(rng.choice("ab") for _ in range(rng.randint(1, 6)))
        b = "".join(rng.choice("ab") for _ in range(rng.randint(1, 6)))
        x, y = a.encode(), b.encode()
        assert variants.one_edit(x, y) == near(a, b)
        if near(a, b):
            kinds = {k for k, _ in variants.halves(x)} & {k for k, _ in variants.halves(y)}
            shared = set(variants.halves(x)) & set(variants.halves(y))
            assert variants.met(x, y) in {k for k, _ in shared} <= kinds


def test_counts_are_whole(spark):
    docs = spark.createDataFrame([(i, "hello world hello") for i in range(50)], "doc_id bigint, text string")
    got = {r["word"]: r["n"] for r in variants.words(docs).collect()}
    assert got == {"hello": 100, "world": 50}
    assert variants.words(docs.where(F.lit(False))).count() == 0
