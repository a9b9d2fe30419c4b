"""Near duplicates by word shingles: T-occurrence search over inverted lists.

A document is the set of its distinct five-word shingles, known by 64-bit hashes.
Documents with equal sets are one *node*. Two nodes link when their Jaccard
similarity reaches 75 %, and then share at least ``T`` shingles; a *query* node is
held against inverted lists of others with DivideSkip: its short lists are merged
with a heap, its ``L`` longest ones are only probed by binary search for those that
the merge left with ``T - L`` or more.

Which nodes are held against each other follows from sizes alone, without loss. With
all shingles in one order, two linked nodes share a shingle among the first
``n - ceil(0.75 n) + 1`` of each (its *prefix*). Shingles that are common in the
corpus come last in that order, so passages that many documents share do not bring
those documents together.

A *run* is the nodes with one shingle in their prefix. What a run proposes passes a
second test without loss before any text is moved: the parity of a set's shingles in
as many bits as it has, where each shingle that only one of two sets has flips a bit.

1. Every node is tried against the smallest node of its runs that passes. That ties
   large groups of copies together with one trial per node.
2. In runs with nodes of several components, the nodes outside the run's largest
   component are held against the others: twice against the one that is nearest by
   the bits, then against all that are still of another component. Larger runs are
   cut into parts of about ``BLOCK`` nodes of like size, and two parts whose sizes
   can be similar meet in a group of their own.

No step gathers a run, or all of its asking nodes, in one task. A run whose nodes are
of like size and do not link still has all its pairs compared by their bits, group by
group: with ``R`` such nodes about ``R * R / BLOCK`` rows are moved. What passes is
counted by the search itself.
"""

from __future__ import annotations

import heapq
import math
from bisect import bisect_left
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablestream.llm.common import Batches, Scratch, arrow, only, settle
from tablestream.llm.graph import components

WORDS = 5
#: Similarity as a fraction.
UP, DOWN = 75, 100
#: Common shingles that the order puts last, at most. It is an order only: results
#: are the same whatever it holds.
COMMON = 1_000_000
#: A shingle this often within ``SEEN`` shingles of a task is proposed as common.
OFTEN, SEEN = 3, 4_000_000
#: Nodes of one block.
BLOCK = 500

#: Bits of the filter that keeps texts nobody asks for from being moved, per text
#: asked for and at most. Beyond that it lets more through; the join decides.
FILTER_BITS, MOST_BITS = 16, 1 << 24
#: Postings of one shingle that stay together; more of them are salted.
RUN = 20_000

_MIX = [np.uint64(m) for m in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]
#: Odd multipliers for the words of a shingle.
_PLACE = [np.uint64((2 * k + 1) * int(_MIX[0]) % (1 << 64)) for k in range(1, WORDS + 1)]
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_KEEP = np.array([(1 << 8 * k) - 1 for k in range(8)] + [(1 << 64) - 1], np.uint64)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _MIX[1]
    h = (h ^ (h >> np.uint64(27))) * _MIX[2]
    return h ^ (h >> np.uint64(31))


def word_hashes(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Starts and hashes of the words of ``raw``, which white space ends."""
    space = _SPACE[np.frombuffer(raw, np.uint8)]
    edges = np.flatnonzero(np.diff(space, prepend=True))
    start, end = edges[0::2], edges[1::2]
    length = end - start
    padded = raw + bytes(8)
    # Eight bytes from any place on.
    eight = np.ndarray((len(raw) + 1,), "<u8", padded, strides=(1,))
    h = length.astype(np.uint64) * _MIX[0]
    at, rest, active = start, length, slice(None)
    while len(at):
        part = eight[at] & _KEEP[np.minimum(rest, 8)]
        h[active] = mixed(h[active] + part * _MIX[1] + _MIX[2])
        more = rest > 8
        active = np.arange(len(h))[active][more]
        at, rest = at[more] + 8, rest[more] - 8
    return start, h


def shingle_sets(texts: list[str | None]) -> list[np.ndarray]:
    """The distinct shingles of each text, ascending.

    Words are lower-cased in A-Z only and separated by ASCII white space; fewer than
    five words are one shingle, no word is none.
    """
    raws = [(t or "").encode() for t in texts]
    if not raws:
        return []
    start, h = word_hashes(b" ".join([*raws, b""]).lower())
    offsets = np.cumsum([0, *(len(r) + 1 for r in raws)])
    bounds = np.searchsorted(start, offsets).tolist()
    full = np.zeros(max(0, len(h) - WORDS + 1), np.uint64)
    for k in range(WORDS):
        full += h[k : k + len(full)] * _PLACE[k]
    full = mixed(full)
    out = []
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        if b - a >= WORDS:
            s = np.sort(full[a : b - WORDS + 1])
            out.append(s[np.concatenate([[True], s[1:] != s[:-1]])])
        elif b > a:
            short = sum(h[a + k : a + k + 1] * _PLACE[k] for k in range(b - a))
            out.append(mixed(short + np.uint64(b - a)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def shingle_set(text: str | None) -> np.ndarray:
    return shingle_sets([text])[0]


def parity(shingles: np.ndarray) -> bytes:
    """Bit ``h % width`` is set if an odd number of shingles fall on it."""
    width = max(128, 1 << (2 * len(shingles) - 1).bit_length()) if len(shingles) else 128
    hits = np.bincount((shingles & np.uint64(width - 1)).astype(np.int64), minlength=width)
    return np.packbits((hits & 1).astype(np.uint8), bitorder="little").tobytes()


def folded(bits: np.ndarray, words: int) -> np.ndarray:
    """Parities of a narrower width; the last axis is 64-bit words."""
    while bits.shape[-1] > words:
        half = bits.shape[-1] // 2
        bits = bits[..., :half] ^ bits[..., half:]
    return bits


def most_apart(n: int, other):
    """Shingles that only one of two similar sets can have."""
    return n + other - 2 * (-(-UP * (n + other) // (UP + DOWN)))


def may_link(a: bytes, n: int, b: bytes, other: int) -> bool:
    if DOWN * min(n, other) < UP * max(n, other):
        return False
    x, y = np.frombuffer(a, "<u8"), np.frombuffer(b, "<u8")
    words = min(len(x), len(y))
    apart = np.bitwise_count(folded(x, words) ^ folded(y, words)).sum()
    return int(apart) <= most_apart(n, other)


def node_of(shingles: np.ndarray) -> int | None:
    """A signed 64-bit name of the set; None of the empty one."""
    import xxhash

    if not len(shingles):
        return None
    return xxhash.xxh64_intdigest(shingles.tobytes(), seed=1) - (1 << 63)


def least_overlap(n: int, other: int) -> int:
    """Shared shingles that make two sets similar: 100 x >= 75 (n + other - x)."""
    return -(-UP * (n + other) // (UP + DOWN))


def shortest(n: int) -> int:
    """The smallest set that can be similar to one of ``n``."""
    return -(-UP * n // DOWN)


def prefix_size(n: int) -> int:
    return n - shortest(n) + 1


def prepared(docs: DataFrame, text_col: str, id_col: str) -> DataFrame:
    """``id``, ``node``, ``n_shingles``, ``th`` (a hash of the text), ``bits`` (the
    parities; null for a node that the task has had before) and ``often``.

    ``often`` is null but in one row of each batch of shingles counted: that lists
    those which are frequent among them.
    """
    rows = docs.select(
        docs[id_col].cast("bigint").alias("id"),
        docs[text_col].cast("string").alias("text"),
        text_hash(docs[text_col]).alias("th"),
    )
    schema = (
        "id bigint, node bigint, n_shingles bigint, th bigint, bits binary, "
        "often array<struct<h: bigint, n: bigint>>"
    )

    def step(batches: Batches) -> Iterator[pa.RecordBatch]:
        pair = pa.list_(pa.struct([("h", pa.int64()), ("n", pa.int64())]))
        held: list[np.ndarray] = []
        size, late = 0, None
        only()
        seen: set[int] = set()

        def bits_of(node: int | None, shingles: np.ndarray) -> bytes | None:
            if node is None or node in seen:
                return None
            seen.add(node)
            return parity(shingles)

        def frequent() -> list[dict]:
            h, n = np.unique(np.concatenate(held), return_counts=True)
            some = n >= OFTEN
            pairs = zip(h[some].view(np.int64).tolist(), n[some].tolist(), strict=True)
            return [{"h": a, "n": b} for a, b in pairs]

        names = ["id", "node", "n_shingles", "th", "bits", "often"]

        def out(batch: pa.RecordBatch, sets: list[np.ndarray], often: list[dict] | None):
            nodes = [node_of(s) for s in sets]
            columns = [
                batch.column(0),
                pa.array(nodes, pa.int64()),
                pa.array([len(s) for s in sets], pa.int64()),
                batch.column(2),
                pa.array(list(map(bits_of, nodes, sets)), pa.binary()),
                pa.array([None] * (len(sets) - 1) + [often] if sets else [], pair),
            ]
            return pa.RecordBatch.from_arrays(columns, names)

        for batch in batches:
            if late:
                yield out(*late, None)
            sets = shingle_sets(batch.column(1).to_pylist())
            held += sets
            size += sum(map(len, sets))
            late = (batch, sets)
            if size >= SEEN:
                yield out(*late, frequent())
                late, held, size = None, [], 0
        if late:
            yield out(*late, frequent())

    return arrow(rows, step, schema)


def text_hash(text):
    return F.xxhash64(text.cast("string"))


def common_shingles(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that are frequent somewhere in the corpus and how often they were
    counted there, the most frequent last.

    Every task counts all of its shingles and proposes the frequent ones.
    """
    proposed = rows.where("often IS NOT NULL").select(F.explode("often").alias("o"))
    counts = proposed.groupBy("o.h").agg(F.sum("o.n").alias("n"))
    top = counts.orderBy(F.desc("n"), "h").limit(COMMON).toArrow()
    return top.column("h").to_numpy()[::-1], top.column("n").to_numpy()[::-1]


class Order:
    """Rank of shingles: rare ones by hash, then the common ones, rarest first."""

    def __init__(self, common: np.ndarray) -> None:
        self.by_hash = np.argsort(common, kind="stable")
        self.common = common[self.by_hash]

    def prefix(self, shingles: np.ndarray) -> np.ndarray:
        size = prefix_size(len(shingles))
        if not len(self.common):
            return shingles[:size]
        at = np.minimum(np.searchsorted(self.common, shingles), len(self.common) - 1)
        known = self.common[at] == shingles
        rare = shingles[~known]
        if len(rare) >= size:
            return rare[:size]
        last = shingles[known][np.argsort(self.by_hash[at[known]], kind="stable")]
        return np.concatenate([rare, last[: size - len(rare)]])


def postings(docs: DataFrame, text_col: str, common: np.ndarray, counts: np.ndarray) -> DataFrame:
    """``h``, ``node``, ``salt`` for each shingle in the prefix of a text."""
    listed = common.view(np.uint64)
    parts = counts // RUN + 1
    salted = listed[parts > 1]

    def step(batches: Batches) -> Iterator[pa.RecordBatch]:
        only()
        order = Order(listed)
        by_hash = np.argsort(salted)
        hot, hot_parts = salted[by_hash], parts[parts > 1][by_hash]
        seen: set[int] = set()
        for batch in batches:
            heads, nodes = [], []
            for shingles in shingle_sets(batch.column(0).to_pylist()):
                node = node_of(shingles)
                if node is None or node in seen:
                    continue
                seen.add(node)
                head = order.prefix(shingles)
                heads.append(head)
                nodes.append(np.full(len(head), node, np.int64))
            h = np.concatenate(heads) if heads else np.zeros(0, np.uint64)
            node = np.concatenate(nodes) if nodes else np.zeros(0, np.int64)
            salt = np.zeros(len(h), np.int32)
            if len(hot):
                at = np.minimum(np.searchsorted(hot, h), len(hot) - 1)
                salt = np.where(hot[at] == h, 1 + node % hot_parts[at], 0).astype(np.int32)
            columns = [pa.array(h.view(np.int64)), pa.array(node), pa.array(salt)]
            yield pa.RecordBatch.from_arrays(columns, ["h", "node", "salt"])

    texts = docs.select(docs[text_col].cast("string").alias("text"))
    return arrow(texts, step, "h bigint, node bigint, salt int")


def runs_of(found: DataFrame) -> DataFrame:
    """``run``, ``node``, ``leader`` of all runs with two nodes or more.

    Runs of the same nodes are one run, within a task. A salted run may be shared
    with other tasks: it keeps its shingle as its name, and a leader in each part.
    """

    def step(batches: Batches) -> Iterator[pa.RecordBatch]:
        rest = [np.zeros(0, t) for t in (np.int64, np.int64, np.int32)]
        seen: set[int] = set()

        def kept(h: np.ndarray, node: np.ndarray, salt: np.ndarray) -> pa.RecordBatch:
            new = np.ones(len(h), bool)
            new[1:] = (h[1:] != h[:-1]) | (node[1:] != node[:-1]) | (salt[1:] != salt[:-1])
            h, node, salt = h[new], node[new], salt[new]
            first = np.ones(len(h), bool)
            first[1:] = (h[1:] != h[:-1]) | (salt[1:] != salt[:-1])
            at = np.flatnonzero(first)
            size = np.diff(np.append(at, len(h)))
            hot = salt[at] > 0
            with np.errstate(over="ignore"):
                mark = mixed(node.view(np.uint64) * _MIX[0])
                name = np.add.reduceat(mark, at) if len(at) else np.zeros(0, np.uint64)
                name = mixed(name + size.astype(np.uint64)).view(np.int64)
            name = np.where(hot, h[at], name)
            wanted = (size > 1) | hot
            for k in np.flatnonzero(wanted & ~hot).tolist():
                if name[k] in seen:
                    wanted[k] = False
                seen.add(int(name[k]))
            rows = np.repeat(wanted, size)
            # Nodes of a run are in order, so its first is its smallest.
            columns = [np.repeat(name, size)[rows], node[rows], np.repeat(node[at], size)[rows]]
            return pa.RecordBatch.from_arrays(list(map(pa.array, columns)), ["run", "node", "leader"])

        for batch in batches:
            got = [c.to_numpy() for c in batch.columns]
            h, node, salt = (np.concatenate(x) for x in zip(rest, got, strict=True))
            # The last run may go on in the next batch.
            cut = int(np.searchsorted(h, h[-1])) if len(h) else 0
            yield kept(h[:cut], node[:cut], salt[:cut])
            rest = [h[cut:], node[cut:], salt[cut:]]
        yield kept(*rest)

    ordered = found.repartition("h", "salt").sortWithinPartitions("h", "salt", "node")
    return arrow(ordered, step, "run bigint, node bigint, leader bigint")


class Lists:
    """Inverted lists of a block: for each shingle, its sets by number, ascending.

    Sets are numbered by size, so the sizes that can be similar are a range.
    """

    def __init__(self, sets: list[np.ndarray]) -> None:
        self.sizes = [len(s) for s in sets]
        self.lists: dict[int, list[int]] = {}
        for number, s in enumerate(sets):
            for h in s.tolist():
                self.lists.setdefault(h, []).append(number)

    def search(self, query: np.ndarray) -> list[int]:
        """Numbers of all similar sets, by DivideSkip."""
        n = len(query)
        low = bisect_left(self.sizes, shortest(n))
        high = bisect_left(self.sizes, n * DOWN // UP + 1)
        if low >= high:
            return []
        found = [x for h in query.tolist() if (x := self.lists.get(h)) is not None]
        # The weakest demand of any set in reach.
        need = least_overlap(n, self.sizes[low])
        if len(found) < need:
            return []
        found.sort(key=len)
        longest = min(need - 1, int(need / (0.0085 * math.log2(len(found[-1]) + 1) + 1)))
        short, long = found[: len(found) - longest], found[len(found) - longest :]
        out = []
        for number, group in groupby(heapq.merge(*short)):
            if not low <= number < high:
                continue
            count = sum(1 for _ in group)
            wanted = least_overlap(n, self.sizes[number])
            if count + longest < wanted:
                continue
            for k, x in enumerate(long):
                if count >= wanted or count + longest - k < wanted:
                    break
                at = bisect_left(x, number)
                count += at < len(x) and x[at] == number
            if count >= wanted:
                out.append(number)
        return out


LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def tried(t: pa.Table) -> pa.Table:
    """One leader against a block of its nodes: links (leader, node)."""
    nodes, flags = t.column("node").to_pylist(), t.column("leads").to_pylist()
    sets = shingle_sets(t.column("text").to_pylist())
    leader = next((i for i, f in enumerate(flags) if f), None)
    if leader is None:
        return pa.table({"a": [], "b": []}, LINKS)
    others = sorted((i for i, f in enumerate(flags) if not f), key=lambda i: len(sets[i]))
    hits = Lists([sets[i] for i in others]).search(sets[leader])
    linked = [nodes[others[i]] for i in hits]
    return pa.table({"a": [nodes[leader]] * len(linked), "b": linked}, LINKS)


def passing(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs (``a``, ``b``) of nodes that may link."""

    def step(batches: Batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, n, y, m = (c.to_pylist() for c in batch.columns[2:])
            keep = pa.array(list(map(may_link, x, n, y, m)), pa.bool_())
            yield batch.select(["a", "b"]).filter(keep)

    def side(name: str) -> DataFrame:
        return nodes.select(
            F.col("node").alias(name), F.col("bits").alias(f"{name}_bits"), F.col("n").alias(f"{name}_n")
        )

    both = pairs.join(side("a"), "a").join(side("b"), "b")
    return arrow(
        both.select("a", "b", "a_bits", "a_n", "b_bits", "b_n"), step, "a bigint, b bigint"
    )


PROPOSALS = pa.schema([("run", pa.int64()), ("a", pa.int64()), ("b", pa.int64())])


def proposed(all_of_them: bool):
    """Pairs of two parts of a run, or within one, that may link and are of different
    components: all, or for each node that asks the one that is least apart."""

    def block(t: pa.Table) -> pa.Table:
        node, comp, n, part, x, y = (
            t.column(c).to_numpy() for c in ("node", "comp", "n", "part", "x", "y")
        )
        asks = t.column("asks").to_numpy(zero_copy_only=False)
        bits = [np.frombuffer(b, "<u8") for b in t.column("bits").to_pylist()]
        width = np.array([len(b) for b in bits])
        # Who asks, and who is asked.
        ways = [(asks, part == x)]
        if (x != y).any():
            ways = [(asks & (part == x), part == y), (asks & (part == y), part == x)]
            ways = [w for w in ways if w[0].any()][: 1 if all_of_them else 2]
        out: set[tuple[int, int]] = set()
        for asking, asked in ways:
            there = [
                (own := np.flatnonzero(asked & (width == w)), np.stack([bits[i] for i in own]))
                for w in np.unique(width[asked])
            ]
            for q in np.flatnonzero(asking).tolist():
                near = []
                for own, matrix in there:
                    alike = DOWN * np.minimum(n[own], n[q]) >= UP * np.maximum(n[own], n[q])
                    some = (comp[own] != comp[q]) & alike
                    if not some.any():
                        continue
                    own, words = own[some], min(matrix.shape[1], len(bits[q]))
                    apart = folded(matrix[some], words) ^ folded(bits[q], words)
                    apart = np.bitwise_count(apart).sum(axis=1).astype(np.int64)
                    good = apart <= most_apart(n[q], n[own])
                    near += zip(apart[good].tolist(), node[own[good]].tolist(), strict=True)
                for _, other in near if all_of_them else [min(near)] if near else []:
                    out.add((min(int(node[q]), other), max(int(node[q]), other)))
        run = t.column("run")[0].as_py() if t.num_rows else 0
        pairs = {"a": [a for a, _ in out], "b": [b for _, b in out]}
        return pa.table({"run": [run] * len(out)} | pairs, PROPOSALS)

    return block


def size_bands() -> list[int]:
    """Where bands of set sizes begin. Similar sets are of one band or of neighbours."""
    out = [1]
    while out[-1] < 1 << 40:
        out.append(out[-1] * DOWN // UP + 1)
    return out


def blocked(placed: DataFrame, open_runs: DataFrame, nodes: DataFrame, scratch: Scratch) -> DataFrame:
    """The nodes of the open runs, once for each group that they meet in: parts ``x``
    and ``y`` of a run. ``part`` is the node's own.

    A run of up to ``BLOCK`` nodes is one part. In others the nodes that ask and those
    that do not are of different parts, by size band and hash; a part of nodes that ask
    meets itself and all parts of its own band and the next ones.
    """
    large = F.col("total") > BLOCK
    bands = F.array(*[F.lit(b).cast("bigint") for b in size_bands()])
    kind = {
        "band": F.when(large, F.size(F.filter(bands, lambda b: b <= F.col("n")))).otherwise(0),
        "asks": F.col("comp") != F.col("largest"),
    }
    big = scratch.settle(open_runs.where(large), "large")
    cells = placed.join(big, "run").join(nodes.select("node", "n"), "node").withColumns(kind)
    cells = cells.groupBy("run", "band", "asks").agg(F.count("*").alias("rows"))
    cells = cells.select(
        "run", "band", "asks", F.ceil(F.col("rows") / BLOCK).cast("bigint").alias("parts")
    )
    cells = cells.groupBy("run").agg(F.collect_list(F.struct("band", "asks", "parts")).alias("cells"))

    def first(band, asks):
        return F.shiftleft(band.cast("bigint") * 2 + asks.cast("bigint"), 40)

    def numbers(cell):
        at = first(cell["band"], cell["asks"])
        return F.sequence(at, at + cell["parts"] - 1)

    left = placed.join(open_runs, "run").join(cells, "run", "left")
    left = left.join(nodes.select("node", "n", "bits"), "node").withColumns(kind)
    band, asks = F.col("band"), F.col("asks")
    own = F.filter("cells", lambda c: (c["band"] == band) & (c["asks"] == asks))[0]["parts"]
    part = F.when(large, first(band, asks) + F.pmod(F.xxhash64("node"), own)).otherwise(F.lit(0))
    met = F.filter("cells", lambda c: (F.abs(c["band"] - band) <= 1) & (c["asks"] | asks))
    others = F.when(large, F.flatten(F.transform(met, numbers)))
    left = left.withColumn("part", part.cast("bigint"))
    left = left.withColumn("other", F.explode(F.coalesce(others, F.array(F.lit(0).cast("bigint")))))
    x, y = F.least("part", "other").alias("x"), F.greatest("part", "other").alias("y")
    return left.select("run", x, y, "part", "node", "comp", "n", "bits", "asks")


def proposals(
    runs: DataFrame, found: DataFrame, nodes: DataFrame, all_of_them: bool, scratch: Scratch
) -> DataFrame:
    """``run``, ``a``, ``b``: pairs to try in runs with nodes of several components."""
    placed = runs.join(found, "node", "left")
    placed = placed.select("run", "node", F.coalesce("root", "node").alias("comp"))
    placed = scratch.settle(placed, "placed")
    weight = placed.groupBy("run", "comp").agg(F.count("*").alias("n"))
    open_runs = (
        weight.groupBy("run")
        .agg(
            F.max_by("comp", F.struct("n", "comp")).alias("largest"),
            F.count("*").alias("comps"),
            F.sum("n").alias("total"),
        )
        .where("comps > 1")
        .drop("comps")
    )
    open_runs = scratch.settle(open_runs, "open")
    found = (
        blocked(placed, open_runs, nodes, scratch)
        .groupBy("run", "x", "y")
        .applyInArrow(proposed(all_of_them), "run bigint, a bigint, b bigint")
    )
    out = scratch.settle(found, "proposals")
    scratch.drop(placed, open_runs)
    return out


def joined(
    docs: DataFrame, nodes: DataFrame, rows: DataFrame, text_col: str, scratch: Scratch
) -> DataFrame:
    """``node``, ``root`` for the nodes that link with another."""
    common, counts = common_shingles(rows)
    runs = scratch.settle(runs_of(postings(docs, text_col, common, counts)), "runs")

    # First trials: every node against the smallest leader of its runs that passes.
    pairs = runs.where("leader <> node").select(F.col("leader").alias("a"), F.col("node").alias("b"))
    trials = passing(pairs.distinct(), nodes).groupBy("b").agg(F.min("a").alias("a"))
    found = components(verified(trials, docs, nodes, text_col, scratch))

    # Twice the nearest node of another component, then every one that is left.
    for all_of_them in (False, False, True):
        more = proposals(runs, found, nodes, all_of_them, scratch)
        links = verified(more.select("a", "b").distinct(), docs, nodes, text_col, scratch)
        tied = found.select(F.col("node").alias("a"), F.col("root").alias("b"))
        found = components(tied.unionByName(links))
        # Where nothing passes now, nothing will: components only grow.
        runs = runs.join(more.select("run").distinct(), "run", "left_semi")
    return found


def verified(
    pairs: DataFrame, docs: DataFrame, nodes: DataFrame, text_col: str, scratch: Scratch
) -> DataFrame:
    """The pairs (``a``, ``b``) that link: each ``a`` is searched for among its ``b``,
    in parts of ``BLOCK``."""
    pairs = scratch.settle(pairs.select("a", "b"), "pairs")
    sizes = pairs.groupBy("a").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("parts"))
    part = F.pmod(F.xxhash64("b"), F.col("parts")).cast("int").alias("part")
    others = pairs.join(sizes, "a").select(
        F.col("a").alias("leader"), F.col("b").alias("node"), part, F.lit(False).alias("leads")
    )
    heads = sizes.select(
        F.col("a").alias("leader"),
        F.col("a").alias("node"),
        F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
        F.lit(True).alias("leads"),
    )
    wanted = scratch.settle(others.unionByName(heads), "wanted")
    return (
        with_text(docs, nodes, text_col, wanted, scratch)
        .groupBy("leader", "part")
        .applyInArrow(tried, "a bigint, b bigint")
    )


def with_text(
    docs: DataFrame, nodes: DataFrame, text_col: str, wanted: DataFrame, scratch: Scratch
) -> DataFrame:
    """``wanted`` with one text for each node.

    Texts are found by their hash. A bit filter of bounded size, sent to all tasks,
    keeps most of what is not asked for from being moved, and copies of a text are
    dropped before they are.
    """
    asked = nodes.join(wanted.select("node").distinct(), "node", "left_semi")
    asked = scratch.settle(asked.select("node", "th"), "asked")
    bits = min(MOST_BITS, max(1 << 10, 1 << (FILTER_BITS * asked.count()).bit_length()))
    word = F.expr(f"CAST(pmod(th, {bits}L) DIV 64 AS INT)")
    mask = F.expr("shiftleft(1L, CAST(pmod(th, 64L) AS INT))")
    filled = asked.groupBy(word.alias("word")).agg(F.bit_or(mask).alias("mask"))
    # At most MOST_BITS / 64 rows of 12 bytes.
    filled = F.broadcast(scratch.settle(filled, "filter"))
    texts = docs.select(
        docs[text_col].cast("string").alias("text"), text_hash(docs[text_col]).alias("th")
    )
    some = texts.join(filled, word == F.col("word")).where(F.col("mask").bitwiseAND(mask) != 0)
    found = some.groupBy("th").agg(F.first("text").alias("text"))
    return wanted.join(asked, "node").join(found, "th").drop("th")


def near_duplicates(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id``, ``root``: a row per row of ``docs``.

    The component is the smallest id of the documents that links reach, null ids left
    aside; ``root`` names it also where all its ids are null. A null or blank text has
    no shingles, no root, and is a component by itself; repeated rows are linked.
    Other columns are not carried.
    """
    scratch = Scratch(docs.sparkSession)
    rows = scratch.settle(prepared(docs, text_col, id_col), "shingled")
    nodes = rows.where("node IS NOT NULL").groupBy("node").agg(
        F.min("id").alias("least"),
        F.min("th").alias("th"),
        F.max("n_shingles").alias("n"),
        F.first("bits", ignorenulls=True).alias("bits"),
    )
    nodes = scratch.settle(nodes, "nodes")
    found = joined(docs, nodes, rows, text_col, scratch)
    tied = nodes.join(found, "node", "left").withColumn("root", F.coalesce("root", "node"))
    tied = scratch.settle(tied.select("node", "root", "least"), "tied")
    least = tied.groupBy("root").agg(F.min("least").alias("component"))
    known = scratch.settle(tied.join(least, "root").select("node", "root", "component"), "known")
    out = rows.join(known, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("component"))
    return out.select(
        F.col("id").alias("doc_id"), "n_shingles", component.alias("component_id"), "root", "th"
    )


def representatives(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` without near duplicates: of each component one row with
    the smallest id stays; rows without shingles all stay."""
    uid = "_uid"
    while uid in docs.columns:
        uid += "_"
    held = settle(docs.withColumn(uid, F.monotonically_increasing_id()), "documents")
    found = near_duplicates(held.select(F.col(text_col).alias("t"), F.col(uid).alias("u")), "t", "u")
    # Found by row number; which row is first by id is then decided per component.
    parts = settle(found.select(F.col("doc_id").alias("u"), "root"), "parts")
    ids = held.select(F.col(uid).alias("u"), F.col(id_col).alias("i"))
    place = F.struct(F.col("i").isNull().alias("none"), "i", "u")
    best = (
        parts.where("root IS NOT NULL")
        .join(ids, "u")
        .groupBy("root")
        .agg(F.min(place).alias("best"))
        .select("best.u")
    )
    kept = settle(best.unionByName(parts.where("root IS NULL").select("u")), "kept")
    # The list of those kept grows with the documents: it is never broadcast.
    return held.join(kept.withColumnRenamed("u", uid).hint("merge"), uid, "left_semi").drop(uid)
