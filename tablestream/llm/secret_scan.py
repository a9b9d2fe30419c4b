"""Secrets in text: patterns, and a character network over every candidate.

Candidates are what the base patterns match and every run of 20 characters or more
with a digit or with letters of both cases. A small convolutional network in numpy reads the characters of each
candidate and its surroundings, long ones in overlapping windows of which the highest
score counts. It is trained on all findings: matches of the patterns
against ordinary words, numbers, short mixed runs, and long names and paths joined from
words of the texts. Each match is also learned as a copy without its cue, every other
one with its letters drawn anew, so that a token counts by itself. A part of them is held out; on it scores are
calibrated (Platt scaling) and the threshold is set as high as a recall of
``RECALL`` allows. Base matches stay whatever their score; other candidates at or
above the threshold are added as kind ``learned``.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablestream.llm.common import Batches, annotate, arrow, settle

BASE = ("assign", "access", "hex")
KINDS = (*BASE, "learned")
#: Characters read: before the candidate, of it, and after it.
BEFORE, INSIDE, AFTER = 16, 40, 8
WIDTH = BEFORE + INSIDE + AFTER
#: From one window of a long candidate to the next.
STEP = 20
#: Distinct findings of both classes that one task trains on, about.
SHARE = 6000
#: Times that tasks go over all shares: each of the steps they average is taken by every
#: task, so fewer passes make as many steps as ``EPOCHS`` over one share.
PASSES = 6
#: Scores are counted in bins of this width of the network's raw output.
BIN = 1 / 64
RECALL = 0.98
#: Copies of a finding, at most.
MOST_COPIES = 100
EMBED, SPAN, FILTERS, EPOCHS = 8, 5, 16, 12

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
CUES = ("password", "passwd", "secret", "token", "apikey", "api_key")
#: Runs are read to their end, so asking for the length at once changes no match.
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
MIXED = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
WORD = re.compile(r"[^\s]{4,}")

Found = tuple[str, int, int, int, int]


def base_spans(text: str) -> list[Found]:
    """(kind, start, end, core start, core end): the core is the secret itself."""
    out: list[Found] = []
    low = text.lower()
    if any(cue in low for cue in CUES):
        for m in ASSIGN.finditer(text):
            if m.end(2) - m.start(2) >= 6:
                out.append(("assign", *m.span(), *m.span(2)))
    if "AKIA" in text:
        out += [("access", *m.span(), *m.span()) for m in ACCESS.finditer(text)]
    out += [("hex", *m.span(), *m.span()) for m in HEX.finditer(text)]
    order = {k: i for i, k in enumerate(KINDS)}
    return sorted(out, key=lambda s: (s[1], order[s[0]], s[2]))


def mixed_spans(text: str, taken: list[Found]) -> list[Found]:
    """Runs of 20 and more with a digit or both cases, outside base matches.

    The network decides which of them are names and paths.
    """
    out = []
    for m in MIXED.finditer(text):
        s = m.group()
        cases = s != s.lower() and s != s.upper()
        if s.isdigit() or not (cases or any(c.isdigit() for c in s)):
            continue
        if not any(a < m.end() and m.start() < b for _, a, b, _, _ in taken):
            out.append(("learned", *m.span(), *m.span()))
    return out


def window(text: str, a: int, b: int) -> bytes:
    """Character codes around and inside a candidate: 0 none, 1 beyond ASCII.

    Of a long candidate it holds all characters, for ``windows`` to cut.
    """
    before = text[max(0, a - BEFORE) : a].rjust(BEFORE, "\0")
    inside = text[a:b].ljust(INSIDE + -(-max(0, b - a - INSIDE) // STEP) * STEP, "\0")
    after = text[b : b + AFTER].ljust(AFTER, "\0")
    return bytes(c if c < 128 else 1 for c in map(ord, before + inside + after))


def windows(codes: bytes) -> list[bytes]:
    """The windows of ``WIDTH`` that cover a candidate."""
    return [codes[a : a + WIDTH] for a in range(0, len(codes) - WIDTH + 1, STEP)]


def ordinary(text: str, taken: list[Found]) -> list[bytes]:
    """Windows of one word, one number and one joined name of the text that no pattern
    matches."""
    if not text:
        return []
    out = []
    h = zlib.crc32(text.encode())
    m = WORD.search(text, h % len(text))
    for place in (m and m.span(), number(text)):
        if place and not any(a < place[1] and place[0] < b for _, a, b, _, _ in taken):
            out.append(window(text, *place))
    if m := NAME.search(text, h % len(text)) or NAME.search(text):
        if not any(a < m.end() and m.start() < b for _, a, b, _, _ in taken):
            before, name = text[max(0, m.start() - BEFORE) : m.start()], joined(m.group(), h >> 8)
            after = text[m.end() : m.end() + AFTER]
            out.append(window(before + name + after, len(before), len(before) + len(name)))
    return out


DIGIT, TO_BLANK = re.compile("[0-9]"), re.compile(r"\S*")
#: Words that make a name of 20 characters and more.
NAME = re.compile(r"\b[A-Za-z]{2,}(?:\s+[A-Za-z]{2,}){3,7}\b", re.ASCII)


def number(text: str) -> tuple[int, int] | None:
    """The first run without white space that holds a digit."""
    m = DIGIT.search(text)
    if not m:
        return None
    start = m.start()
    while start and not text[start - 1].isspace():
        start -= 1
    return start, TO_BLANK.match(text, m.end()).end()


def joined(words: str, h: int) -> str:
    """A name or path of the words, in one of the usual ways, often with a number."""
    parts = words.split()
    style, h = h % 6, h // 6
    if style == 0:
        parts = [w.capitalize() for w in parts]
    elif style == 1:
        parts = [w.upper() for w in parts]
    if h % 3:
        parts.insert(1 + h // 3 % len(parts), str(h // 3 % 10 ** (1 + h % 4)))
    return ("", "_", "/", "-", "_", "=")[style].join(parts)


@dataclass
class Network:
    embed: np.ndarray
    filters: np.ndarray
    bias: np.ndarray
    out: np.ndarray
    scale: tuple[float, float] = (1.0, 0.0)
    threshold: float = 1.0

    def _pooled(self, codes: np.ndarray):
        x = self.embed[codes]
        n, length, d = x.shape
        unfolded = np.concatenate(
            [x[:, k : length - SPAN + 1 + k] for k in range(SPAN)], axis=2
        )
        z = unfolded @ self.filters + self.bias
        at = z.argmax(axis=1)
        top = np.take_along_axis(z, at[:, None], axis=1)[:, 0]
        return unfolded, at, np.maximum(top, 0), top > 0

    def raw(self, codes: np.ndarray) -> np.ndarray:
        if not len(codes):
            return np.zeros(0)
        parts = [
            self._pooled(codes[a : a + 512])[2] @ self.out[:-1] + self.out[-1]
            for a in range(0, len(codes), 512)
        ]
        return np.concatenate(parts)

    def score(self, codes: np.ndarray) -> np.ndarray:
        return self.calibrated(self.raw(codes))

    def calibrated(self, raw: np.ndarray) -> np.ndarray:
        a, b = self.scale
        return 1 / (1 + np.exp(-np.clip(a * raw + b, -500, 500)))

    def gradients(self, codes: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
        unfolded, at, pooled, on = self._pooled(codes)
        p = 1 / (1 + np.exp(-np.clip(pooled @ self.out[:-1] + self.out[-1], -500, 500)))
        d = (p - y) / len(y)
        g_out = np.append(pooled.T @ d, d.sum())
        g = d[:, None] * self.out[:-1] * on
        best = np.take_along_axis(unfolded, at[:, :, None], axis=1)
        g_filters = np.einsum("nf,nfu->uf", g, best)
        back = (g[:, :, None] * self.filters.T).reshape(*g.shape, SPAN, EMBED)
        places = at[:, :, None] + np.arange(SPAN)
        chars = np.take_along_axis(codes, places.reshape(len(codes), -1), axis=1)
        cells = chars.reshape(-1, 1) * EMBED + np.arange(EMBED)
        g_embed = np.bincount(cells.ravel(), back.ravel(), self.embed.size).reshape(self.embed.shape)
        return [g_embed, g_filters, g.sum(axis=0), g_out]


def _array(windows: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(windows), np.uint8).reshape(-1, WIDTH).astype(np.int64)


def copies(positive: list[bytes], negative: list[bytes], rng: np.random.Generator, rounds: int) -> list[bytes]:
    """The findings amid the surroundings of others than findings; every other one with
    its letters drawn anew, of either case."""
    letters = np.array([c for c in range(128) if chr(c).isalpha()], np.uint8)
    is_letter = np.isin(np.arange(256), letters)
    out = []
    for i, w in enumerate(w for _ in range(rounds) for w in positive):
        other = negative[int(rng.integers(len(negative)))]
        core = np.frombuffer(w[BEFORE:-AFTER], np.uint8).copy()
        if (i + i // len(positive)) % 2:
            here = np.flatnonzero(is_letter[core])
            core[here] = letters[rng.integers(0, len(letters), len(here))]
        out.append(other[:BEFORE] + core.tobytes() + other[-AFTER:])
    return out


class Fit:
    """A network in training, with Adam's moments: all of it is one vector."""

    def __init__(self, rng: np.random.Generator) -> None:
        weights = [
            rng.normal(0, 0.3, (128, EMBED)),
            rng.normal(0, (2 / (SPAN * EMBED)) ** 0.5, (SPAN * EMBED, FILTERS)),
            np.zeros(FILTERS),
            np.append(rng.normal(0, 0.3, FILTERS), 0.0),
        ]
        self.shapes = [w.shape for w in weights]
        flat = np.concatenate([w.ravel() for w in weights])
        self.vector = np.concatenate([flat, np.zeros(2 * len(flat))])

    def parts(self, vector: np.ndarray) -> list[list[np.ndarray]]:
        """Weights, means and squares as views of ``vector``."""
        out = []
        for third in np.split(vector, 3):
            ends = np.cumsum([int(np.prod(x)) for x in self.shapes])
            out.append([x.reshape(shape) for x, shape in zip(np.split(third, ends[:-1]), self.shapes)])
        return out

    def network(self, vector: np.ndarray) -> Network:
        return Network(*self.parts(vector)[0])

    def epoch(self, vector: np.ndarray, step: int, x: np.ndarray, y: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The vector after one pass over the rows ``at``; ``step`` steps came before."""
        vector = vector.copy()
        weights, mean, square = self.parts(vector)
        net = Network(*weights)
        for a in range(0, len(at), 64):
            step += 1
            some = at[a : a + 64]
            for w, m, s, g in zip(weights, mean, square, net.gradients(x[some], y[some]), strict=True):
                m += 0.1 * (g - m)
                s += 0.001 * (g * g - s)
                size = 0.01 * (1 - 0.999**step) ** 0.5 / (1 - 0.9**step)
                w -= size * m / (np.sqrt(s) + 1e-8)
        return vector


def examples(
    positive: list[bytes], negative: list[bytes], rounds: int, rng: np.random.Generator
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Windows, classes, whether they are held out, and whether they are copies."""
    more = copies(positive, negative, rng, rounds) if positive and negative else []
    n = len(positive)
    x = _array(positive + more + negative)
    y = np.repeat([1.0, 0.0], [n + len(more), len(negative)])
    # A copy is held out with its finding.
    fold = np.concatenate([np.arange(n + len(more)) % max(n, 1) % 5, np.arange(len(negative)) % 5])
    test = fold == 0
    if not (y[~test].any() and (1 - y[~test]).any()):
        test[:] = False
    made = np.zeros(len(y), bool)
    made[n : n + len(more)] = True
    return x, y, test, made


def copy_rounds(positive: int, negative: int) -> int:
    """Few findings are copied more often, so that both classes weigh alike."""
    return max(1, min(MOST_COPIES, negative // positive - 1))


def threshold(below, counts: list[int]) -> float:
    """The least of the scores below which the recall allows to fall, group by group;
    ``below(group, k)`` is the score with ``k`` lower ones."""
    return min(below(g, int((1 - RECALL) * n)) for g, n in enumerate(counts) if n)


def train(positive: list[bytes], negative: list[bytes], seed: int = 1) -> Network | None:
    """Fit on four fifths, calibrate and set the threshold on the rest, in one place.

    None without findings of both classes.
    """
    if not positive or not negative:
        return None
    rng = np.random.default_rng(seed)
    x, y, test, made = examples(positive, negative, copy_rounds(len(positive), len(negative)), rng)
    fit, at = Fit(rng), np.flatnonzero(~test)
    vector = fit.vector
    for e in range(EPOCHS):
        rng.shuffle(at)
        vector = fit.epoch(vector, e * -(-len(at) // 64), x, y, at)
    net = fit.network(vector)
    if not test.any():
        test = ~test
    net.scale = platt(net.raw(x[test]), y[test])
    scores = net.score(x[test])
    good = y[test] > 0
    # The highest threshold that keeps the recall, of the findings and with their copies.
    groups = [np.sort(scores[good & ~made[test]]), np.sort(scores[good])]
    net.threshold = threshold(lambda g, k: float(groups[g][k]), [len(g) for g in groups])
    return net


def platt(raw: np.ndarray, y: np.ndarray, times: np.ndarray | None = None) -> tuple[float, float]:
    """Slope and shift of a logistic curve, with the usual smoothed targets. A row
    counts ``times``."""
    times = np.ones(len(y)) if times is None else times
    up, down = (times * y).sum(), (times * (1 - y)).sum()
    target = np.where(y == 1, (up + 1) / (up + 2), 1 / (down + 2))
    share = times / times.sum()
    spread = ((raw - (raw * share).sum()) ** 2 * share).sum() ** 0.5 or 1.0
    z, a, b = raw / spread, 1.0, 0.0
    for _ in range(300):
        p = 1 / (1 + np.exp(-np.clip(a * z + b, -500, 500)))
        a -= 2.0 * ((p - target) * z * share).sum()
        b -= 2.0 * ((p - target) * share).sum()
    return a / spread, b


FINDINGS = (
    "candidates array<struct<kind: string, start: bigint, end: bigint, window: binary>>, "
    "ordinary array<binary>"
)


def candidates(docs: DataFrame, text_col: str) -> DataFrame:
    def found(texts: list[str | None]) -> list[list]:
        rows, plain = [], []
        for t in texts:
            text = t or ""
            base = base_spans(text)
            spans = base + mixed_spans(text, base)
            rows.append(
                [
                    {"kind": k, "start": a, "end": b, "window": window(text, c, d)}
                    for k, a, b, c, d in spans
                ]
            )
            plain.append(ordinary(text, spans))
        return [rows, plain]

    return annotate(docs, text_col, found, FINDINGS)


def shares(found: DataFrame) -> tuple[DataFrame, int, int]:
    """All distinct windows of findings in shares, and their numbers by class.

    ``share, positive, negative``: a share is what one task trains on.
    """
    cut = f"transform(sequence(0, CAST(length(w) AS INT) - {WIDTH}, {STEP}), a -> substring(w, a + 1, {WIDTH}))"
    spans = found.select(F.explode("candidates").alias("c")).where("c.kind <> 'learned'")
    classes = [(1, spans.select(F.col("c.window").alias("w"))), (0, found.select(F.explode("ordinary").alias("w")))]
    rows = [w.select(F.explode(F.expr(cut)).alias("w"), F.lit(y).alias("y")) for y, w in classes]
    each = settle(rows[0].unionByName(rows[1]).distinct(), "windows")
    counts = {r["y"]: r["n"] for r in each.groupBy("y").agg(F.count("*").alias("n")).collect()}
    n = -(-sum(counts.values()) // SHARE) or 1
    by_hash = F.struct(F.xxhash64("w").alias("h"), "w")
    listed = lambda y: F.sort_array(F.collect_list(F.when(F.col("y") == y, by_hash)))["w"]
    dealt = each.groupBy(F.pmod(F.xxhash64("w"), F.lit(n)).alias("share"))
    held = dealt.agg(listed(1).alias("positive"), listed(0).alias("negative"))
    return settle(held, "shares"), counts.get(1, 0), counts.get(0, 0)


def _each(held: DataFrame, of, schema: str) -> DataFrame:
    """``of`` of its columns is a batch of rows for each share."""

    def step(batches: Batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                yield of(*row)

    return arrow(held, step, schema)


#: Weights are averaged as whole multiples of this, so that no order of tasks shows.
GRAIN = 2.0**-40


def learn(found: DataFrame) -> Network | None:
    """Train on every finding: each pass, tasks go on from the common network over their
    shares, and the network is the average of what they make of it. Calibration and
    threshold count all that is held out. A single share is trained on at once."""
    held, n_positive, n_negative = shares(found)
    if not n_positive or not n_negative:
        return None
    if n_positive + n_negative <= SHARE:
        (only_share,) = held.select("positive", "negative").collect()
        return train(*([bytes(w) for w in part] for part in only_share))
    rounds, fit = copy_rounds(n_positive, n_negative), Fit(np.random.default_rng(1))

    def made_once(share, positive, negative):
        made = examples(positive, negative, rounds, np.random.default_rng(share))
        columns = [[share], *[[a.astype(np.uint8).tobytes()] for a in made]]
        return pa.RecordBatch.from_arrays(list(map(pa.array, columns)), ["share", "x", "y", "test", "copied"])

    # Drawing the copies takes longer than a pass over them: every pass reads them.
    held = settle(_each(held, made_once, "share bigint, x binary, y binary, test binary, copied binary"), "examples")

    def read(x, y, test, copied):
        y, test, copied = (np.frombuffer(c, np.uint8) for c in (y, test, copied))
        x = np.frombuffer(x, np.uint8).reshape(-1, WIDTH).astype(np.int64)
        return x, y.astype(float), test.astype(bool), copied.astype(bool)

    vector, step = fit.vector, 0
    for epoch in range(PASSES):

        def passed(share, *columns, vector=vector, step=step, epoch=epoch):
            x, y, test, _ = read(*columns)
            at = np.random.default_rng([epoch, share]).permutation(np.flatnonzero(~test))
            n = len(at)
            new = fit.epoch(vector, step, x, y, at)
            grains = [int(v) for v in np.rint(new / GRAIN)]
            columns = [np.arange(len(new)), grains, np.full(len(new), n)]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["at", "grains", "n"])

        made = _each(held, passed, "at bigint, grains bigint, n bigint").groupBy("at").agg(
            F.sum((F.col("grains") * F.col("n").cast("decimal(19,0)")).cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n")
        )
        got = sorted((r["at"], int(r["total"]) / r["n"] * GRAIN, r["n"]) for r in made.collect())
        vector = np.array([v for _, v, _ in got])
        step += -(-got[0][2] // 64)
    net = fit.network(vector)

    def judged(share, *columns):
        x, y, test, copied = read(*columns)
        raw = net.raw(x)
        columns = [(raw, pa.float64()), (y, pa.float64()), (test, pa.bool_()), (copied, pa.bool_())]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in columns], ["raw", "y", "test", "copied"])

    every = settle(_each(held, judged, "raw double, y double, test boolean, copied boolean"), "judged")
    tested = every.where("test")
    if len(tested.select("y").distinct().collect()) < 2:
        tested = every  # too few findings to hold any out
    binned = tested.groupBy(F.floor(F.col("raw") / BIN).alias("bin"), "y", "copied").agg(F.count("*").alias("n"))
    bins = [tuple(r) for r in binned.collect()]  # as many as the raw output has steps
    net.scale = platt(*(np.array([f(r) for r in bins], float) for f in (lambda r: (r[0] + 0.5) * BIN, lambda r: r[1], lambda r: r[3])))
    upward = net.scale[0] >= 0

    def below(group: int, k: int) -> float:
        """The score with ``k`` lower ones among findings (0), or with their copies (1)."""
        for at in sorted({r[0] for r in bins}, reverse=not upward):
            n = sum(r[3] for r in bins if r[0] == at and r[1] == 1 and (group or not r[2]))
            if k < n:
                here = tested.where((F.floor(F.col("raw") / BIN) == at) & (F.col("y") == 1))
                here = here if group else here.where(~F.col("copied"))
                values = here.groupBy("raw").agg(F.count("*").alias("n"))
                for raw, times in sorted((tuple(r) for r in values.collect()), reverse=not upward):
                    if k < times:
                        return float(net.calibrated(np.array([raw]))[0])
                    k -= times
            k -= n
        raise AssertionError("fewer findings than counted")

    groups = [sum(r[3] for r in bins if r[1] == 1 and (g or not r[2])) for g in (0, 1)]
    net.threshold = threshold(below, groups)
    return net


def scan(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``row`` (columns of ``docs`` but the text) and ``spans`` (kind, start, end, score).

    Spans by start, then kind as listed. A null text has none; without findings of
    both classes nothing is learned and scores are null; repeated rows are scanned
    each.
    """
    found = candidates(docs, text_col)
    kept = [F.col("row")[c].alias(c) for c in docs.columns if c != text_col]
    # Stored with the rows but their texts, so that texts are read once; rows keep their order.
    row = [F.struct(*kept).alias("row")] if kept else []
    at = F.monotonically_increasing_id().alias("at")
    found = settle(found.select(*row, "candidates", "ordinary", at), "findings")
    network = learn(found)
    row = "row" if kept else F.struct().alias("row")
    found = found.select("at", row, "candidates").orderBy("at").select("row", "candidates")

    def scored(rows: list[list[dict] | None]) -> list[list]:
        flat = [windows(c["window"]) for row in rows for c in row or ()]
        scores = [None] * len(flat)
        if network and flat:
            first = np.cumsum([0, *map(len, flat[:-1])])
            each = network.score(_array([w for x in flat for w in x]))
            scores = np.maximum.reduceat(each, first).tolist()
        out, at = [], iter(scores)
        order = {k: i for i, k in enumerate(KINDS)}
        for row in rows:
            spans = []
            for c in row or ():
                p = next(at)
                if c["kind"] != "learned" or (p is not None and p >= network.threshold):
                    span = {k: c[k] for k in ("kind", "start", "end")}
                    spans.append(span | {"score": p})
            out.append(sorted(spans, key=lambda s: (s["start"], order[s["kind"]], s["end"])))
        return [out]

    spans = "spans array<struct<kind: string, start: bigint, end: bigint, score: double>>"
    return annotate(found, "candidates", scored, spans).select(
        "row.row", "spans"
    )
