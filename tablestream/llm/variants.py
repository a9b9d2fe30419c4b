"""Spelling variants: words one edit apart, found in a trie of frequency vectors.

A word's frequency vector counts its letters by group. One inserted, deleted or
replaced letter raises at most one count by one and lowers at most one by one, so a
search spends a budget of one surplus and one deficit on its way down a trie whose
levels are the counts of successive groups. Words in the leaves it reaches are
compared letter by letter.

The first levels of the trie, its trunk, cut it into shards: as many levels as it
takes until no shard holds more than ``SHARD_WORDS`` words. A word lives in one shard
and visits those that its budget reaches and that come after its own, so each pair
meets once. A shard's words are held; visitors pass as a stream. A vector that is
common even at full depth is cut by halves of words: with one edit, either the first
or the second half of the shorter word is kept.

Cases: null text has no words; a null id counts as the empty text where runs lose a
letter; words of any length are compared; ties of ``n`` go to the smallest word; no
words make no rows. Other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablestream.llm.common import Batches, Scratch

#: Letters by group, in the order of the trie's levels; all other
#: letters up to U+00FF are one more group.
GROUPS = ["e", "n", "a", "i", "t", "r", "o", "s", "h", "l", "u", "d", "cm", "g", "bpf", "wvkz"]
LEVELS = len(GROUPS) + 1
#: Words that a shard holds at most, while a further level can cut it.
SHARD_WORDS = 20_000
#: A node of the trie with so few words is a leaf.
LEAF_WORDS = 12
#: Pairs compared at once, distinct words counted before they are given on.
PAIRS, COUNTED = 200_000, 200_000
#: Longer words are compared one by one.
WIDTH = 48

_GROUP = np.full(256, len(GROUPS), dtype=np.int64)
for _i, _letters in enumerate(GROUPS):
    for _letter in _letters:
        _GROUP[ord(_letter)] = _i

#: Letters up to U+00FF are one byte each in Latin-1; all else is no letter there.
_RUN = re.compile(rb"[A-Za-z\xc0-\xff]+")
_LOWER = bytes(range(256)).lower()


# ------------------------------------------------------------ words


def runs(text: str | None) -> list[bytes]:
    """Maximal runs of letters, A-Z in lower case, in Latin-1."""
    return _RUN.findall(text.encode("latin-1", "replace").translate(_LOWER)) if text else []


def misspelt(run: bytes, start: int, every: int) -> bytes:
    """The run, less one letter where its hash says so. ``start``: crc32 of ``<doc_id>:``."""
    h = zlib.crc32(run.decode("latin-1").encode(), start)
    at = h % len(run)
    return run if h % every else run[:at] + run[at + 1 :]


def words(docs: DataFrame, every: int | None = None, shortest: int = 5, least: int = 3) -> DataFrame:
    """``word, n``: words of at least ``shortest`` letters that occur ``least`` times.

    ``every``: of the runs of a document, those whose hash it divides lose a letter.
    """

    def counted(batches: Batches) -> Iterator[pa.RecordBatch]:
        from collections import Counter

        total: Counter = Counter()

        def given() -> pa.RecordBatch:
            held = [w.decode("latin-1") for w in total]
            return pa.RecordBatch.from_pydict(
                {"word": pa.array(held, pa.string()), "n": pa.array(list(total.values()), pa.int64())}
            )

        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                start = zlib.crc32(f"{'' if key is None else key}:".encode())
                for run, n in Counter(runs(text)).items():
                    word = misspelt(run, start, every) if every else run
                    if len(word) >= shortest:
                        total[word] += n
                if len(total) >= COUNTED:
                    yield given()
                    total.clear()
        yield given()

    rows = docs.select(docs["doc_id"].cast("string").alias("doc_id"), docs["text"].cast("string").alias("text"))
    counts = rows.mapInArrow(counted, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.where(F.col("n") >= least)


# ------------------------------------------------------------ vectors and shards


def vectors(held: list[bytes]) -> np.ndarray:
    """Counts of each word by group, at most 255: a budget is never spent too soon."""
    sizes = np.array([len(w) for w in held], dtype=np.int64)
    letters = _GROUP[np.frombuffer(b"".join(held), np.uint8)]
    at = np.repeat(np.arange(len(held)), sizes) * LEVELS + letters
    return np.minimum(np.bincount(at, minlength=len(held) * LEVELS), 255).reshape(-1, LEVELS).astype(np.uint8)


def _latin(column) -> list[bytes]:
    return [w.encode("latin-1") for w in column.to_pylist()]


def trunk(counts: DataFrame, most: int) -> tuple[int, DataFrame]:
    """Levels of the trunk, and ``shard, words`` of the trie cut there."""

    def vector(batches: Batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = vectors(_latin(batch.column(0)))
            yield pa.RecordBatch.from_arrays([pa.array([v.tobytes() for v in found], pa.binary())], ["vec"])

    leaves = counts.select("word").mapInArrow(vector, "vec binary").groupBy("vec").agg(F.count("*").alias("m"))
    depths = F.explode(F.sequence(F.lit(1), F.lit(LEVELS))).alias("depth")
    nodes = leaves.select("vec", "m", depths).groupBy("depth", F.expr("substring(vec, 1, depth)").alias("shard"))
    nodes = nodes.agg(F.sum("m").alias("words"))
    largest = {r["depth"]: r["most"] for r in nodes.groupBy("depth").agg(F.max("words").alias("most")).collect()}
    depth = next((d for d in sorted(largest) if largest[d] <= most), LEVELS)
    return depth, nodes.where(F.col("depth") == depth).select("shard", "words")


def halves(word: bytes) -> list[tuple[str, bytes]]:
    """Kept halves, as the shorter or the longer word of a pair."""
    out = set()
    for short in (len(word), len(word) - 1):
        half = short // 2
        out |= {(f"p{half}", word[:half]), (f"s{short - half}", word[len(word) - (short - half) :])}
    return sorted(out)


def met(a: bytes, b: bytes) -> str:
    """The half by which a pair of words counts: its first, if both share it."""
    short = min(len(a), len(b))
    half = short // 2
    return f"p{half}" if a[:half] == b[:half] else f"s{short - half}"


def _moves(depth: int) -> np.ndarray:
    """Steps from a shard to later ones: one count up, and perhaps a later one down."""
    up = np.eye(depth, dtype=np.int16)
    return np.array([u for u in up] + [up[i] - up[j] for i in range(depth) for j in range(i + 1, depth)])


def _sent(counts: DataFrame, depth: int) -> DataFrame:
    """``shard, visits, word, n``: words at home and where they visit."""

    def step(batches: Batches) -> Iterator[pa.RecordBatch]:
        moves = _moves(depth)
        for whole in batches:
            for at in range(0, len(whole), 2000):
                batch = whole.slice(at, 2000)
                home = vectors(_latin(batch.column(0)))[:, :depth].astype(np.int16)
                there = np.concatenate([home[:, None], home[:, None] + moves], axis=1)
                row, move = np.nonzero(((there >= 0) & (there <= 255)).all(axis=2))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([v.tobytes() for v in there[row, move].astype(np.uint8)], pa.binary()),
                        pa.array(move > 0),
                        batch.column(0).take(pa.array(row)),
                        batch.column(1).take(pa.array(row)),
                    ],
                    ["shard", "visits", "word", "n"],
                )

    return counts.select("word", "n").mapInArrow(step, "shard binary, visits boolean, word string, n bigint")


def _halved(rows: DataFrame) -> DataFrame:
    """Rows of common vectors, once for each half."""

    def step(batches: Batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [halves(w) for w in _latin(batch.column("word"))]
            row = pa.array(np.repeat(np.arange(len(found)), [len(f) for f in found]))
            kind = pa.array([k for f in found for k, _ in f], pa.string())
            part = pa.array([p for f in found for _, p in f], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c).take(row) for c in ("shard", "visits", "word", "n")], kind, part],
                ["shard", "visits", "word", "n", "kind", "part"],
            )

    return rows.mapInArrow(step, "shard binary, visits boolean, word string, n bigint, kind string, part binary")


# ------------------------------------------------------------ search of one shard


class Words:
    """Words of a shard, or a block of its visitors."""

    def __init__(self, held: list[bytes], n: np.ndarray) -> None:
        self.held, self.n = held, n
        self.size = np.array([len(w) for w in held], dtype=np.int64)
        self.vec = vectors(held).astype(np.int16)
        short = [w if len(w) <= WIDTH else b"" for w in held]
        self.left = np.frombuffer(b"".join(w.ljust(WIDTH, b"\0") for w in short), np.uint8).reshape(-1, WIDTH)
        self.right = np.frombuffer(b"".join(w[::-1].ljust(WIDTH, b"\0") for w in short), np.uint8).reshape(-1, WIDTH)


def one_edit(a: bytes, b: bytes) -> bool:
    """Exactly one letter inserted, deleted or replaced."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    same = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[same + (len(a) == len(b)) :] == b[same + 1 :]


def _shared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Equal letters at the start of each row."""
    other = a != b
    return np.where(other.any(axis=1), other.argmax(axis=1), WIDTH)


def compared(asking: Words, there: Words, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Which of the pairs (i, j) are one edit apart."""
    shorter = np.minimum(asking.size[i], there.size[j])
    longer = np.maximum(asking.size[i], there.size[j])
    near = longer - shorter <= 1
    wide = near & (longer > WIDTH)
    at = np.flatnonzero(near & ~wide)
    kept = _shared(asking.left[i[at]], there.left[j[at]]) + _shared(asking.right[i[at]], there.right[j[at]])
    near[at] = (kept >= longer[at] - 1) & (kept < 2 * WIDTH)
    for p in np.flatnonzero(wide):
        near[p] = one_edit(asking.held[i[p]], there.held[j[p]])
    return near


def search(asking: Words, there: Words, home: bool) -> tuple[np.ndarray, np.ndarray]:
    """Pairs one edit apart; ``home``: ``asking`` is ``there``, each pair once.

    Depth first: a node is a range of the words sorted by vector, with those of the
    asking words that can still afford to be there.
    """
    order = np.lexsort(there.vec.T[::-1])
    vec = there.vec[order]
    found: list[tuple[np.ndarray, np.ndarray]] = []
    waiting: list[tuple[np.ndarray, np.ndarray]] = []
    held = 0

    def settle() -> None:
        nonlocal held
        if waiting:
            i, j = (np.concatenate(x) for x in zip(*waiting))
            good = compared(asking, there, i, j)
            found.append((i[good], j[good]))
            waiting.clear()
            held = 0

    stack = [(0, 0, len(vec), np.arange(len(asking.held)), np.zeros((2, len(asking.held)), dtype=bool))]
    while stack:
        level, lo, hi, who, spent = stack.pop()
        if level == LEVELS or hi - lo <= LEAF_WORDS:
            step = max(1, PAIRS // (hi - lo))
            for a in range(0, len(who), step):
                i, j = np.repeat(who[a : a + step], hi - lo), np.tile(order[lo:hi], len(who[a : a + step]))
                gap = asking.vec[i] - there.vec[j]
                fits = (np.maximum(gap, 0).sum(axis=1) <= 1) & (np.minimum(gap, 0).sum(axis=1) >= -1)
                if home:
                    fits &= i < j
                waiting.append((i[fits], j[fits]))
                held += int(fits.sum())
                if held >= PAIRS:
                    settle()
            continue
        counts = vec[lo:hi, level]
        cuts = [0, *(np.flatnonzero(np.diff(counts)) + 1).tolist(), hi - lo]
        mine = asking.vec[who, level]
        for a, b in zip(cuts, cuts[1:]):
            gap = mine - counts[a]
            surplus, deficit = gap == 1, gap == -1
            goes = (gap == 0) | (surplus & ~spent[0]) | (deficit & ~spent[1])
            if goes.any():
                paid = np.stack([spent[0] | surplus, spent[1] | deficit])[:, goes]
                stack.append((level + 1, lo + a, lo + b, who[goes], paid))
    settle()
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*found))


_NEAR = "word string, n_near bigint, best_n bigint, best string"


def _told(sides: list[tuple[Words, np.ndarray, Words, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    """For each word its near words among those met here: how many, and the best."""
    for mine, at, other, found in sides:
        if not len(at):
            continue
        rank = np.empty(len(other.held), dtype=np.int64)
        rank[sorted(range(len(other.held)), key=lambda k: (-other.n[k], other.held[k]))] = np.arange(len(other.held))
        by_rank = np.argsort(rank)
        n = np.bincount(at, minlength=len(mine.held))
        best = np.full(len(mine.held), len(other.held))
        np.minimum.at(best, at, rank[found])
        some = np.flatnonzero(n)
        top = by_rank[best[some]]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([mine.held[k].decode("latin-1") for k in some], pa.string()),
                pa.array(n[some].astype(np.int64)),
                pa.array(other.n[top].astype(np.int64)),
                pa.array([other.held[k].decode("latin-1") for k in top], pa.string()),
            ],
            ["word", "n_near", "best_n", "best"],
        )


def _near(batches: Batches) -> Iterator[pa.RecordBatch]:
    """Rows sorted by shard, those at home first."""
    at, home, parts = None, None, []

    def kept(i, j, asking, there):
        if not at[1]:
            return i, j
        good = np.array([met(asking.held[a], there.held[b]) == at[1] for a, b in zip(i, j)], dtype=bool)
        return i[good], j[good]

    def settled() -> Iterator[pa.RecordBatch]:
        nonlocal home
        if home is None and parts:
            home = Words([w for p in parts for w in p[0]], np.concatenate([p[1] for p in parts]))
            parts.clear()
            i, j = kept(*search(home, home, True), home, home)
            yield from _told([(home, np.concatenate([i, j]), home, np.concatenate([j, i]))])

    for batch in batches:
        keys = list(zip(*[batch.column(c).to_pylist() for c in ("shard", "kind", "part", "visits")]))
        held, n = _latin(batch.column("word")), batch.column("n").to_numpy()
        cuts = [0, *[k for k in range(1, len(keys)) if keys[k] != keys[k - 1]], len(keys)] if keys else [0]
        for a, b in zip(cuts, cuts[1:]):
            if keys[a][:3] != at:
                yield from settled()
                at, home = keys[a][:3], None
            if not keys[a][3]:
                parts.append((held[a:b], n[a:b]))
                continue
            yield from settled()
            if home is not None:
                guests = Words(held[a:b], n[a:b])
                i, j = kept(*search(guests, home, False), guests, home)
                yield from _told([(guests, i, home, j), (home, j, guests, i)])
    if at is not None:
        yield from settled()


# ------------------------------------------------------------ forms


def near_words(counts: DataFrame, scratch: Scratch, most: int = SHARD_WORDS) -> DataFrame:
    """``word, n_near, best_n, best`` of words with near words; ``counts``: word, n."""
    depth, shards = trunk(counts, most)
    rows = _sent(counts, depth)
    if depth == LEVELS:
        common = scratch.settle(shards.where(F.col("words") > most).select("shard"), "common")
        rows = scratch.settle(rows, "sent")
        plain = rows.join(common, "shard", "left_anti")
        rows = _halved(rows.join(common, "shard", "left_semi")).unionByName(plain, True)
    else:
        rows = rows.withColumns({"kind": F.lit(None).cast("string"), "part": F.lit(None).cast("binary")})
    key = ["shard", "kind", "part"]
    rows = rows.repartition(*key).sortWithinPartitions(*key, "visits")
    met_here = rows.mapInArrow(_near, _NEAR)
    best = F.min(F.struct((-F.col("best_n")).alias("less"), "best"))
    found = met_here.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b"))
    return found.select("word", "n_near", (-F.col("b.less")).alias("best_n"), "b.best")


def roots(forms: DataFrame, scratch: Scratch) -> DataFrame:
    """``word, root`` for ``word, form``: the end of the path, by doubling of its steps."""
    links = scratch.settle(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = links.join(onward, "root", "left")
        step = step.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        step = scratch.settle(step, "roots")
        done = step.where("moved").isEmpty()
        links = step.drop("moved")
        if done:
            return links


def groups(counts: DataFrame, factor: int = 2, most: int = SHARD_WORDS) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of ``counts`` (word, n).

    A word's form is its most frequent near word, if it is ``factor`` times as
    frequent; its root is where the path of forms ends.
    """
    scratch = Scratch(counts.sparkSession)
    counts = scratch.settle(counts, "words")
    table = counts.join(near_words(counts, scratch, most), "word", "left")
    is_form = F.col("best_n") >= factor * F.col("n")
    table = scratch.settle(
        table.select(
            "word",
            F.when(is_form, F.col("best")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(is_form, F.col("best_n")).alias("form_n"),
        ),
        "forms",
    )
    ends = roots(table.where("form is not null"), scratch)
    joined = table.join(ends, "word", "left")
    return joined.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


#: The same in DuckDB's SQL: pairs meet by what is left without one letter.
GROUPS_SQL = """
WITH RECURSIVE runs AS (
  SELECT doc_id, run, count(*) AS n FROM (
    SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\\x{00C0}-\\x{00FF}]+')),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents)
  GROUP BY doc_id, run
), bytes AS (
  SELECT run, n, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS b FROM runs
), hashed AS (
  SELECT run, n, xor(4294967295, list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(range(length(b) // 2), lambda i: ('0x' || substr(b, (2 * i + 1)::BIGINT, 2))::BIGINT)),
    lambda c, x: list_reduce(list_prepend(xor(c, x), range(8)),
      lambda y, i: CASE WHEN y & 1 = 1 THEN xor(y >> 1, 3988292384) ELSE y >> 1 END))) AS h
  FROM bytes
), words AS (
  SELECT word, sum(n)::BIGINT AS n FROM (
    SELECT CASE WHEN h % 97 = 0 THEN left(run, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2) ELSE run END AS word, n
    FROM hashed)
  WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3
), cut AS (
  SELECT word, n, i, left(word, i - 1) || substr(word, i + 1) AS rest
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)
), near AS (
  SELECT a.word, a.n, b.word AS other, b.n AS m FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT c.word, c.n, w.word, w.n FROM cut c JOIN words w ON w.word = c.rest
  UNION SELECT w.word, w.n, c.word, c.n FROM cut c JOIN words w ON w.word = c.rest
), best AS (
  SELECT word, count(*) AS n_near, arg_min(other, (-m, other)) AS other, max(m) AS m FROM near GROUP BY word
), forms AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near,
    CASE WHEN m >= 2 * w.n THEN other END AS form, CASE WHEN m >= 2 * w.n THEN m END AS form_n
  FROM words w LEFT JOIN best b USING (word)
), paths AS (
  SELECT word, word AS root, form AS next FROM forms
  UNION ALL SELECT p.word, f.word, f.form FROM paths p JOIN forms f ON f.word = p.next
)
SELECT f.word, f.form, p.root, f.n, f.n_near, f.form_n FROM forms f JOIN paths p ON p.word = f.word AND p.next IS NULL
"""
