"""Each operator against brute force, a round trip or held-out rows, and odd tables."""

from __future__ import annotations

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablestream.llm import (
    cells,
    chat,
    decontaminate,
    graph,
    langid,
    packing,
    pii,
    rans,
    secret_scan,
    shingles,
    warc,
)
from tablestream.llm.common import ready, settle
from tablestream.llm.tokens import Encoder, encoder, vocabulary_path
from tablestream.session import fresh_path
from tests.conftest import rows_of

BYTES, WORDS = vocabulary_path("byte_bpe_50k.json"), vocabulary_path("word_bpe_49k.json")
PIECES = vocabulary_path("piece_bpe_32k.model")
DOCS = "doc_id bigint, text string, row string, node string, spans string"


@pytest.fixture(autouse=True)
def session(spark):
    return ready(spark)


def docs(spark, texts, first=0):
    """Documents with extra columns whose names the operators use themselves."""
    rows = [(first + i, t, f"r{i}", "n", "s") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


ODD = [None, "", " ", "a", "same text", "same text", "é ß 日本 😀", "x " * 3000]


# Archives


def test_archives_round_trip(spark):
    html = ["<p>a</p>", "<p>a</p>", None, "", "\r\n\r\nWARC/1.1\r\n", "é😀", "<p>a</p>"]
    pages = spark.createDataFrame(
        [(i, None if i == 3 else f"http://h/ {i}", h, 1) for i, h in enumerate(html)],
        "page_id bigint, url string, html string, body int",
    )
    got = {r["page_id"]: r for r in warc.archive(pages.repartition(3)).collect()}
    first = {}
    for i, h in enumerate(html):
        payload = (h or "").encode()
        of = first.setdefault(payload, i)
        assert got[i]["payload_bytes"] == len(payload)
        assert got[i]["payload_digest"] == warc.sha1(payload)
        assert got[i]["record_type"] == ("response" if of == i else "revisit")
        assert got[i]["refers_to"] == (None if of == i else of)
    assert warc.archive(pages.limit(0)).count() == 0


def test_arc_versions_and_declared_lengths():
    for version in (b"1", b"2"):
        body = b"HTTP/1.1 200 OK\r\n\r\nhttp://x 1.1.1.1 20200101 text/html 5\nabc"
        fields = {"url": b"http://x", "ip": b"1.2.3.4", "date": b"2020", "type": b"text/html"}
        file = warc.arc_opening(version, "f") + b"\n"
        file += (warc.arc_record(version, fields, body) + b"\n") * 2
        import gzip

        found = list(warc.arc_records(gzip.compress(file[:50]) + gzip.compress(file[50:])))
        assert [f["url"] for _, f, _ in found] == [b"http://x"] * 2
        assert all(b == body for _, _, b in found)
    assert warc.iso_date("2020") == "2020-01-01T00:00:00Z"
    with pytest.raises(ValueError):
        list(warc.arc_records(gzip.compress(file[:-9])))


# Language


def test_languages_of_held_out_texts(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = langid.fit(table.where(~langid.held_out("doc_id")), PIECES)
    found = langid.identify(table.where(langid.held_out("doc_id")), model)
    rows = found.select("row.lang", "lang_pred", "score").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.95 * len(rows)
    assert all(0 <= r["score"] <= 1 for r in rows)
    odd = langid.identify(docs(spark, [None, "", "12 ² +", "the and of"]), model).collect()
    assert [r["lang_pred"] for r in odd] == ["und", "und", "und", "en"]
    none = langid.fit(table.limit(0), PIECES)
    assert langid.identify(docs(spark, ["the"]), none).first()["lang_pred"] == "und"


def test_forward_sums_all_segmentations():
    vocabulary = {"▁a": 0, "▁": 1, "a": 2, "ab": 3, "b": 4, "▁ab": 5}
    weight = np.array([0.2, 0.1, 0.3, 0.15, 0.05, 0.2, 1e-7])[:, None]
    groups = langid.by_step(langid.edges(["ab"], vocabulary))
    total = langid.forward(1, groups, weight)[0, 3, 0]
    # ▁|a|b, ▁a|b, ▁|ab, ▁ab
    assert total == pytest.approx(0.1 * 0.3 * 0.05 + 0.2 * 0.05 + 0.1 * 0.15 + 0.2)


# Tokens


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_cached_tokens_are_the_library_s(path):
    r = random.Random(5)
    parts = "a|B| | |,|..|.|b.|\x01|\n|\t|0|é|'s|<|endoftext|>|　|Σ|word|́|😀".split("|")
    texts = ["".join(r.choices(parts, k=r.randint(0, 16))) for _ in range(3000)]
    e = encoder(path)
    assert e(texts) == e.whole(texts)
    assert e([]) == []


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_full_cache_keeps_repeated_words(path):
    e, r = Encoder(path), random.Random(7)
    e.words.most = 300
    added, add = collections.Counter(), e.words.add
    e.words.add = lambda words: (added.update(words), add(words))
    common = ["".join(r.choices("abcdeéß", k=9)) for _ in range(100)]
    for _ in range(30):
        texts = [" ".join(["x", *common, *("".join(r.choices("fghijÀ1*", k=8)) for _ in range(100))])]
        assert e(texts) == e.whole(texts)
        assert len(e.words.slot) <= 300 + 201
    assert max(added[w] for w in common) <= 2


def test_words_of_any_case_and_before_a_stop_are_kept_once():
    e, texts = Encoder(WORDS), ["Word, word. WORD wOrd,", "word.\nWord"]
    assert e(texts) == e.whole(texts)
    assert {*e.words.slot} == {"word", "\x01,", "\x01."}


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_letters_by_the_model_are_the_library_s(path):
    e, r = Encoder(path), random.Random(8)
    parts = "aHtIÀÿßÆ ,.\n'\u0331\u0307\u212A\u0130\u01C5ſµªº×÷\u0958가ᅡ一"
    texts = ["".join(r.choices(parts, k=r.randint(0, 16))) for _ in range(3000)]
    texts += ["a <|EndOfText|> B", "A<|endoftext|>B", "<|STARTOFTEXT|>", "É" * 300, ". . .", "a ... b .,. c"]
    assert e(texts) == e.whole(texts)
    assert e.words.letters is not None


def test_token_files_round_trip(spark, monkeypatch):
    monkeypatch.setattr(rans, "FILE_IDS", 2000)
    table = docs(spark, [*ODD, None], first=-4).union(docs(spark, ["x"]).withColumn("doc_id", F.lit(None)))
    target = fresh_path(spark, "t")
    rans.write(table, target, BYTES, 2)
    got = sorted(map(tuple, rans.digests(spark, target).collect()), key=lambda t: t[1])
    texts = [(None, "x"), *((i - 4, t or "") for i, t in enumerate([*ODD, None]))]
    at = 0
    for (doc, text), row in zip(texts, got, strict=True):
        ids = encoder(BYTES).whole([text])[0] + b"\2\0\0\0"
        assert row == (doc, at, len(ids) // 4, zlib.crc32(ids))
        at += len(ids) // 4
    empty = fresh_path(spark, "t")
    rans.write(table.limit(0), empty, BYTES, 2)


def test_segments_decode_alone_and_damage_is_found():
    rng = np.random.default_rng(1)
    ids = rng.zipf(1.4, 70_000) % 50_000
    known, counts = np.unique(ids, return_counts=True)
    table = rans.Table(known, rans.scaled(known, counts))
    assert int(table.weight.sum()) == 1 << rans.SCALE
    raw = ids.astype("<u4").tobytes()
    block = rans.encode_block(3, 1, [(5, raw[:40]), (None, raw[40:])], table)
    part, number, heads, got = rans.decode_block(block, table)
    assert (part, number, heads["n"].tolist()) == (3, 1, [10, 69_990]) and (got == ids).all()
    assert len(block) < 0.7 * len(raw)
    hurt = bytearray(block)
    hurt[-5] ^= 1
    with pytest.raises(ValueError):
        rans.decode_block(bytes(hurt), table)


def test_packing(spark):
    table = docs(spark, [*ODD, "word " * 5000])
    got = packing.pack(table, WORDS, 0, 64).collect()
    for i, text in enumerate([*ODD, "word " * 5000]):
        own = sorted((r for r in got if r["doc_id"] == i), key=lambda r: r["piece"])
        ids = b"".join(bytes(r["ids"]) for r in own)
        assert ids == encoder(WORDS).whole([text or ""])[0] + bytes(4)
        assert all(r["length"] == 64 for r in own[:-1])
        assert [r["start"] for r in own] == [64 * k for k in range(len(own))]
    bins = collections.defaultdict(list)
    for r in got:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for spans in bins.values():
        spans.sort()
        assert all(a + n == b for (a, n), (b, _) in zip(spans, spans[1:]))
        assert spans[0][0] == 0 and sum(spans[-1]) <= 64
    assert len(bins) <= -(-sum(r["length"] for r in got) // 64) + 1
    assert packing.pack(table.limit(0), WORDS).count() == 0


def test_sum_of_squares_rule():
    # Gaps 4 (twice) and 5: a 4 leaves fewer squares where gap 4 is crowded.
    bins, offsets = packing.sum_of_squares([6, 6, 5, 4, 5, 4], 10)
    assert bins == [0, 1, 2, 0, 2, 1] and offsets == [0, 0, 0, 6, 5, 6]


# Chats


def test_rotation(spark):
    said = [
        (1, 0, "system", "Be.", 0),
        (1, 1, "ann", "Hi", 0),
        (1, 1, "ann", "Hi", 0),
        (1, None, None, None, 0),
        (1, 70, "bob", "Yo", 0),
        (2, 0, "system", "alone", 0),
    ]
    t = spark.createDataFrame(said, "conv_id bigint, turn bigint, role string, text string, own int")
    got = chat.rotate(t).collect()
    assert {r["conv_id"] for r in got} == {1}
    for who in ("ann", "bob", "unknown"):
        own = sorted((r for r in got if r["perspective"] == who), key=lambda r: r["start"])
        whole = "".join(r["rendered"] for r in own)
        assert [r["turn"] for r in own] == [None, 0, 1, 1, 70]
        for r in own:
            assert whole[r["start"] :].startswith(r["rendered"])
            assert (r["mask_start"] is not None) == (r["speaker"] == who)
            if r["mask_start"] is not None:
                said_text = whole[r["mask_start"] : r["mask_end"]]
                assert said_text == {"ann": "Hi", "bob": "Yo", "unknown": ""}[who] + "<|im_end|>\n"
                assert whole[r["start"] :].startswith("<|im_start|>assistant\n")
    assert chat.rotate(t.limit(0)).count() == 0


# Personal data


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def base_personal(text):
    def good(kind, found):
        digits = re.sub("[^0-9]", "", found)
        return {
            "email": True,
            "ip": all(int(p) <= 255 for p in found.split(".")) if kind == "ip" else False,
            "card": 14 <= len(digits) <= 19 and pii.luhn(digits),
            "phone": 10 <= len(digits) <= 15,
        }[kind]

    out = [
        (k, *m.span()) for k, p in PATTERNS.items() for m in re.finditer(p, text) if good(k, m[0])
    ]
    return sorted(out, key=lambda s: (s[1], pii.BASE.index(s[0])))


@pytest.mark.parametrize("letters", ["a@.-+", "1.@a", "12. -+()", "0 -", "+1 (.", "😀4-0 1@a."])
def test_anchors_find_what_the_patterns_find(letters):
    r = random.Random(2)
    for _ in range(4000):
        text = "".join(r.choices(letters, k=r.randint(0, 26)))
        assert [s for s in pii.personal(text) if s[0] in pii.BASE] == base_personal(text)


def test_added_kinds_and_redaction(spark):
    text = "iban: DE89 3704 0044 0532 0130 00, ssn 078-05-1120, http://u:p@h.com, iban DE88 3704 0044 0532 0130 00"
    kinds = [s[0] for s in pii.personal(text)]
    assert kinds == ["iban", "ssn", "login", "email"]
    assert pii.redacted("a b@c.de f", pii.personal("a b@c.de f")) == "a [EMAIL] f"
    got = pii.scan(docs(spark, ODD)).collect()
    assert [r["clean"] for r in got] == ODD and not any(r["spans"] for r in got)
    assert pii.scan(docs(spark, ["x"]).limit(0)).count() == 0


@pytest.mark.parametrize(
    "text",
    [
        "IBAN <DE89 3704 0044 0532 0130 00> BIC COBADEFFXXX",
        "IBAN: <DE89370400440532013000> A bank",
        "IBAN <DE89 3704 0044 0532 0130 00> 2024-01-01",
        "IBAN number: <DE89 3704 0044 0532 0130 00>",
        "my iBaN (international) is\n<GB82 WEST 1234 5698 7654 32> AND MORE",
        "İ IBAN / iban: <NO9386011117947>. NO",
        "Ssn <078-05-1120>",
        "SOCIAL SECURITY number (SSN) is <078-05-1120>",
        "IBAN DE88 3704 0044 0532 0130 00 BIC",
    ],
)
def test_numbers_behind_a_cue(text):
    plain = text.replace("<", "").replace(">", "")
    want = [(text.index("<"), text.index(">") - 1)] if "<" in text else []
    assert [s[1:] for s in pii.personal(plain) if s[0] in ("iban", "ssn")] == want


# Secrets


def test_secret_base_spans():
    text = "token: token: abcdefg PASSWORD = 'hunter22' AKIA" + "A1" * 9 + " " + "0f" * 13 + " ſecret=abcdefgh"
    spans = [(k, text[a:b]) for k, a, b, _, _ in secret_scan.base_spans(text)]
    assert ("assign", "PASSWORD = 'hunter22") in spans and len(spans) == 3
    r = random.Random(4)
    for _ in range(3000):
        t = "".join(r.choices(["AKIA", "A", "9", "a", "f", "0", " ", "z" * 2], k=40))
        want = [m.span() for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
        want_hex = [m.span() for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
        got = secret_scan.base_spans(t)
        assert [s[1:3] for s in got if s[0] == "access"] == want
        assert [s[1:3] for s in got if s[0] == "hex"] == want_hex


def test_secret_network_learns_and_keeps_base(spark):
    r = random.Random(6)
    some = ["word " * 9 + "password=" + "".join(r.choices("0123456789abcdef", k=20)) + " end" for _ in range(80)]
    some += ["plain text of order 4711 and more words " * 3 for _ in range(80)]
    hidden = "the key is " + "".join(r.choices("0123456789abcdef", k=23)).upper() + "Z9 here"
    got = secret_scan.scan(docs(spark, [*some, hidden, *ODD])).collect()
    assert [len(x["spans"]) for x in got[:80]] == [1] * 80
    assert not any(x["spans"] for x in got[80:160])
    assert not any(x["spans"] for x in got[161:])
    nothing = secret_scan.scan(docs(spark, ODD)).collect()
    assert len(nothing) == len(ODD) and not any(x["spans"] for x in nothing)


def test_secret_scan_reads_texts_once(spark, monkeypatch):
    read = spark.sparkContext.accumulator(0)
    inner = secret_scan.ordinary

    def ordinary(text, taken):
        read.add(1)
        return inner(text, taken)

    monkeypatch.setattr(secret_scan, "ordinary", ordinary)
    texts = [f"token={i:06x}abc{i} and a word {i}" for i in range(40)]
    got = secret_scan.scan(docs(spark, texts)).collect()
    assert len(got) == 40 and all(r["spans"] for r in got)
    assert read.value == 40
    bare = secret_scan.scan(docs(spark, texts).select("text")).select("spans").collect()
    assert sorted(r["spans"] for r in bare) == sorted(r["spans"] for r in got)


def test_secret_examples_are_drawn_once_a_share(spark, monkeypatch):
    drawn = spark.sparkContext.accumulator(0)
    inner = secret_scan.examples

    def examples(*given):
        drawn.add(1)
        return inner(*given)

    monkeypatch.setattr(secret_scan, "examples", examples)
    monkeypatch.setattr(secret_scan, "SHARE", 60)
    texts = [f"x{i} token={i:06x}abc{i} plain word{i} and {i}" for i in range(120)]
    found = secret_scan.candidates(docs(spark, texts), "text")
    found = settle(found.select("candidates", "ordinary"), "findings")
    shares = secret_scan.shares(found)
    monkeypatch.setattr(secret_scan, "shares", lambda found: shares)
    assert secret_scan.learn(found) and shares[0].count() > 1
    assert drawn.value == shares[0].count()


def test_number_is_the_first_run_with_a_digit():
    r = random.Random(3)
    for _ in range(2000):
        text = "".join(r.choices("ab1 \n\u3000\x1f٣,", k=r.randint(0, 12)))
        m = re.search(r"[^\s]*[0-9][^\s]*", text)
        assert secret_scan.number(text) == (m and m.span())


def test_secret_network_sees_tokens_with_few_digits(spark):
    r = random.Random(6)
    some = ["word " * 9 + "password=" + "".join(r.choices("0123456789abcdef", k=20)) + " end" for _ in range(80)]
    some += ["plain text of order 4711 and more words " * 3 for _ in range(80)]
    hidden = "the key is " + "".join(r.choices("0123456789abcdef", k=23)).upper() + "Z9 here"
    few = "the key is hQzRkWvTbXnMpL7cJdFgYsKw here"
    assert [x[0] for x in secret_scan.mixed_spans(few, [])] == ["learned"]
    assert secret_scan.mixed_spans("12345678901234567890123 averylongwordofonlyletters", []) == []
    name = "see docs/guides/getting/started/part2 and someWordsOfPlainTextAndMore here"
    got = secret_scan.scan(docs(spark, [*some, hidden, few, name])).collect()
    assert [[s["kind"] for s in x["spans"]] for x in got[160:]] == [["learned"], ["learned"], []]


def test_long_candidates_are_read_to_their_end(spark):
    token = "hQzRkWvTbX1MpL7cJdFgYs9w4D2"
    for lead in (0, 1, 13, 20, 39, 200):
        text = "see " + "a" * lead + token + " end"
        parts = secret_scan.windows(secret_scan.window(text, 4, len(text) - 4))
        assert all(len(w) == secret_scan.WIDTH for w in parts)
        inside = [w[secret_scan.BEFORE : -secret_scan.AFTER] for w in parts]
        whole = "a" * lead + token
        assert all(any(whole[k : k + 20].encode() in w for w in inside) for k in range(len(whole) - 19))
        assert parts[-1].endswith(b" end" + bytes(4))
    r = random.Random(6)
    some = ["word " * 9 + "password=" + "".join(r.choices("0123456789abcdef", k=20)) + " end" for _ in range(80)]
    some += ["plain text of order 4711 and more words " * 3 for _ in range(80)]
    path = "docs/guides/of/plain/text/and/more/words/for/order/"
    tests = [f"see {path}{token}5 end", f"see {path}and/more/words2 end"]
    got = secret_scan.scan(docs(spark, [*some, *tests])).collect()
    assert [len(x["spans"]) for x in got[160:]] == [1, 0]


def test_threshold_keeps_the_recall():
    rng = np.random.default_rng(2)
    # Findings that cannot be told from others: half of them score below an even chance.
    some = [bytes(rng.integers(48, 58, secret_scan.WIDTH).tolist()) for _ in range(300)]
    net = secret_scan.train(some[:100], some[100:])
    held = net.score(secret_scan._array(some[:100:5]))
    assert (held >= net.threshold).mean() >= secret_scan.RECALL


# Embeddings


def test_cells_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(cells, "PER_CELL", 40)
    monkeypatch.setattr(cells, "HOME_BLOCK", 16)
    monkeypatch.setattr(cells, "MEET_BLOCK", 32)
    rng = np.random.default_rng(3)
    base = rng.normal(size=(60, 8))
    x = np.concatenate([base, base[:50] + rng.normal(scale=0.12, size=(50, 8)), np.repeat(base[:1], 40, 0), base[1] + rng.normal(scale=0.1, size=(60, 8))])
    label = rng.integers(0, 2, len(x)).tolist()
    rows = [(i, v.tolist(), l, "c") for i, (v, l) in enumerate(zip(x, label, strict=True))]
    bad = [None, [], [0.0] * 8, [float("nan")] * 8, [None] * 8, [float("inf")] * 8]
    rows += [(1000 + i, b, 0, "c") for i, b in enumerate(bad)] + [(2000, x[0].tolist(), None, "c")]
    t = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int, home string")
    got = {r["vec_id"]: r for r in cells.near_duplicates(t).collect()}
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = (u @ u.T >= 0.93) & (np.array(label)[:, None] == np.array(label)[None])
    np.fill_diagonal(near, False)
    want = brute_components(len(x), np.argwhere(near).tolist())
    for i in range(len(x)):
        r = got[i]
        assert (r["n_links"], r["component_id"], r["kept"]) == (near[i].sum(), want[i], want[i] == i)
    for i in (*range(1000, 1006), 2000):
        assert (got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (0, i, True)
    assert cells.near_duplicates(t.limit(0)).count() == 0


def brute_components(n, pairs):
    root = list(range(n))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in pairs:
        a, b = top(a), top(b)
        root[max(a, b)] = min(a, b)
    return [top(i) for i in range(n)]


def test_components(spark):
    links = [(i, i + 1) for i in range(20)] + [(50, 40), (41, 50), (60, 60)]
    got = dict(rows_of(graph.components(spark.createDataFrame(links, "a bigint, b bigint"))))
    assert got == {**dict.fromkeys(range(21), 0), 40: 40, 41: 40, 50: 40}


# Decontamination


def brute_hits(items, text):
    def words(t):
        low = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)

    w, hit, found = words(text), set(), set()
    for item, t in items:
        x = words(t)
        n = min(10, len(x))
        for a in range(len(x) - n + 1 if n else 0):
            for b in range(len(w) - n + 1):
                if w[b : b + n] == x[a : a + n]:
                    hit.update(range(b, b + n))
                    found.add(item)
    return len(w), len(hit), sorted(found)


@pytest.mark.parametrize("shard", [1 << 20, 40])
def test_decontamination(spark, monkeypatch, shard):
    monkeypatch.setattr(decontaminate, "SHARD_BYTES", shard)
    r = random.Random(8)
    vocabulary = ["Ab", "c", "dé", "É", "9"]
    items = [(i, ", ".join(r.choices(vocabulary, k=k))) for i, k in enumerate([3, 10, 12, 15, 1, 0])]
    items += [(7, None), (8, items[1][1])]
    texts = [*ODD, *("; ".join(r.choices(vocabulary, k=60)) for _ in range(20))]
    texts += ["x " + items[3][1] + " y", items[2][1].upper()]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = decontaminate.scan(docs(spark, texts), bench).orderBy("row.doc_id").collect()
    for text, row in zip(texts, got, strict=True):
        assert (row["n_words"], row["n_hit"], row["items"]) == brute_hits(items, text)
        for s in row["spans"]:
            assert decontaminate.words_of(text[s["start"] : s["end"]])
    none = decontaminate.scan(docs(spark, texts), bench.limit(0)).collect()
    assert len(none) == len(texts) and not any(x["n_hit"] for x in none)


# Near duplicates


def brute_sets(texts):
    out = []
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        n = min(5, len(w))
        out.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if n else set())
    return out


def test_near_duplicates_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(shingles, "BLOCK", 7)
    monkeypatch.setattr(shingles, "SEEN", 3000)
    monkeypatch.setattr(shingles, "RUN", 10)
    r = random.Random(9)
    words = [f"w{i}" for i in range(300)]
    shared = r.choices(words, k=40)
    texts = [*ODD, "A b c d e", "a B c d E"]
    for _ in range(12):
        base = r.choices(words, k=r.randint(8, 90)) + shared * r.randint(0, 1)
        for _ in range(r.randint(1, 9)):
            copy = list(base)
            for _ in range(r.randint(0, 4)):
                copy[r.randrange(len(copy))] = r.choice(words)
            texts.append(" ".join(copy))
    sets = brute_sets(texts)
    pairs = [
        (i, j)
        for i, a in enumerate(sets)
        for j, b in enumerate(sets[:i])
        if a and b and 100 * len(a & b) >= 75 * len(a | b)
    ]
    want = brute_components(len(texts), pairs)
    table = docs(spark, texts).repartition(5)
    got = {x["doc_id"]: x for x in shingles.near_duplicates(table).collect()}
    assert [got[i]["n_shingles"] for i in range(len(texts))] == list(map(len, sets))
    assert [got[i]["component_id"] for i in range(len(texts))] == want
    kept = shingles.representatives(table)
    assert kept.columns == table.columns
    assert sorted(x["doc_id"] for x in kept.collect()) == sorted(set(want))
    assert shingles.near_duplicates(table.limit(0)).count() == 0


def test_runs_where_every_node_asks_are_met_in_bounded_groups(spark, monkeypatch):
    """One template in most shingles of all texts: nearly nothing links, so all ask."""
    monkeypatch.setattr(shingles, "BLOCK", 10)
    monkeypatch.setattr(shingles, "RUN", 20)
    real = shingles.proposed

    def bounded(all_of_them):
        block = real(all_of_them)

        def checked(t):
            assert t.num_rows <= 60
            return block(t)

        return checked

    monkeypatch.setattr(shingles, "proposed", bounded)
    r = random.Random(3)
    words = [f"w{i}" for i in range(5000)]
    template = r.choices(words, k=80)
    texts = [" ".join([*template, *r.choices(words, k=r.randint(18, 45))]) for _ in range(150)]
    # A few that link, and some of other sizes.
    texts += [t.rsplit(" ", r.randint(1, 9))[0] for t in texts[:12]]
    texts += [" ".join([*template[:60], *r.choices(words, k=k)]) for k in range(1, 40)]
    sets = brute_sets(texts)
    pairs = [
        (i, j)
        for i, a in enumerate(sets)
        for j, b in enumerate(sets[:i])
        if 100 * len(a & b) >= 75 * len(a | b)
    ]
    want = brute_components(len(texts), pairs)
    got = {x["doc_id"]: x["component_id"] for x in shingles.near_duplicates(docs(spark, texts)).collect()}
    assert len(set(want)) > 100 and [got[i] for i in range(len(texts))] == want


def test_similar_sizes_are_of_neighbouring_bands():
    bands = shingles.size_bands()
    for n in (*range(1, 3000), 10**6, 10**9 + 7):
        largest = n * shingles.DOWN // shingles.UP
        a, b = (int(np.searchsorted(bands, m, side="right")) for m in (n, largest))
        assert b - a <= 1


def test_divide_skip_and_parities_lose_nothing():
    rng = np.random.default_rng(4)
    sets = []
    for _ in range(60):
        base = np.unique(rng.integers(0, 1 << 60, rng.integers(1, 60)).astype(np.uint64))
        for _ in range(3):
            keep = base[rng.random(len(base)) < 0.9]
            more = rng.integers(0, 1 << 60, rng.integers(0, 5)).astype(np.uint64)
            if len(both := np.unique(np.concatenate([keep, more]))):
                sets.append(both)
    sets.sort(key=len)
    lists = shingles.Lists(sets)
    for a in sets:
        want = [
            i
            for i, b in enumerate(sets)
            if 100 * (k := len(np.intersect1d(a, b))) >= 75 * (len(a) + len(b) - k)
        ]
        assert lists.search(a) == want
        for i in want:
            b = sets[i]
            assert shingles.may_link(shingles.parity(a), len(a), shingles.parity(b), len(b))
            order = shingles.Order(np.sort(rng.choice(a, len(a) // 2)))
            assert len(np.intersect1d(order.prefix(a), order.prefix(b)))


def test_language_scores_do_not_depend_on_the_cache(monkeypatch):
    """Small caches and slices give the same languages and scores as large ones."""
    path = vocabulary_path("piece_bpe_32k.model")
    size = len(langid.pieces(path))
    weight = np.random.default_rng(1).random((size + 1, 3)) / size
    model = langid.Model(("a", "b", "c"), weight, path)
    texts = [None, "", "1 2", *(" ".join(f"word{chr(97 + i % 26)}{'xyz'[j % 3] * j}" for j in range(40)) for i in range(30))]
    want = langid.Scorer(model).predict(texts)
    for cached, at_once in ((1, 1), (50, 60), (7, 10_000)):
        monkeypatch.setattr(langid, "CACHED_WORDS", cached)
        monkeypatch.setattr(langid, "WORDS_AT_ONCE", at_once)
        got = langid.Scorer(model).predict(texts)
        assert [g[0] for g in got] == [w[0] for w in want]
        assert np.allclose([g[1] for g in got], [w[1] for w in want])


def test_secret_network_learns_from_every_finding(spark, monkeypatch):
    r = random.Random(8)
    some = ["word " * 9 + "password=" + "".join(r.choices("0123456789abcdef", k=20)) + " end" for _ in range(80)]
    some += [" ".join(r.choices(["plain", "text", "order", "words", "house"], k=30)) + f" {i} more" for i in range(80)]
    found = secret_scan.candidates(docs(spark, some), "text")
    monkeypatch.setattr(secret_scan, "SHARE", 60, raising=False)
    monkeypatch.setattr(secret_scan, "SAMPLE", 20, raising=False)
    seen = []
    shares = secret_scan.shares

    def kept(found):
        seen.append(shares(found))
        return seen[0]

    monkeypatch.setattr(secret_scan, "shares", kept)
    net = secret_scan.learn(found)
    held, n_positive, n_negative = seen[0]
    assert n_positive == 80 and held.count() > 1
    got = held.selectExpr("sum(size(positive)) AS p", "sum(size(negative)) AS n").first()
    assert (got["p"], got["n"]) == (n_positive, n_negative)
    good, plain = [[w for x in held.collect() for w in map(bytes, x[c])] for c in ("positive", "negative")]
    scores = net.score(secret_scan._array(good))
    assert (scores >= net.threshold).mean() > 0.9 and 0 < net.threshold < 1
    assert scores.mean() > net.score(secret_scan._array(plain)).mean() + 0.3
    again = secret_scan.learn(found)
    assert again.threshold == net.threshold and (again.filters == net.filters).all()
