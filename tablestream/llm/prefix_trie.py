"""Prefix trie of conversations: a node table behind minimal perfect hashes.

A node is the sequence of the first ``depth`` turns of one or more conversations. Its
key is a 128-bit digest of that sequence: the sum, modulo a power of two, of hashes of
each turn with its place. A sum needs no predecessor, so a conversation of any length
is digested in slices.

Distinct digests are enumerated by one grouping that adds up before its shuffle, and
fails if two sequences of different depth, parent or last text share a digest. Each
node belongs to its smallest conversation. Shards are sets of slices of paths, dealt
by a hash of conversation and slice, so that no node, however common, makes a shard
large. A shard gives every digest on its paths a slot by a minimal perfect hash,
checked against the digest kept in the slot, scatters the counts of the nodes it owns
into flat arrays and adds them up through the parent slots in order of depth. What the
shards say of one node is added up by a last grouping.

Cases: null role or text is the empty text; turns are ordered by ``turn`` (null
first), then role, then text, and repeated rows are turns of their own; rows without a
``conv_id`` belong to no conversation and are left out; no conversations make no rows.
Other columns are ignored. Texts only pass the sort that orders turns.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablestream.llm.common import Batches, Scratch

#: Turns of a path that one shard takes as a whole.
SLICE = 4096
#: Rows of paths in a shard, on average.
SHARD_ROWS = 1000
#: Conversation ids in one chunk of a node's list of ends.
CHUNK = 4096

KEY = ["k1", "k2"]
NO_ENDS = hashlib.sha256(b"").hexdigest()


# ------------------------------------------------------------ turns in their order


def ordered(conversations: DataFrame, scratch: Scratch) -> DataFrame:
    """``conv_id, idx, g1, g2, chars``: turns with their place from 0 and digest.

    One sort over the whole table, so a conversation that holds a third of it is cut
    at any turn; each part's first place comes from the counts of the parts before.
    """
    c = conversations
    rows = c.where(c["conv_id"].isNotNull()).select(
        c["conv_id"].cast("bigint").alias("conv_id"),
        c["turn"].alias("turn"),
        F.coalesce(c["role"].cast("string"), F.lit("")).alias("role"),
        F.coalesce(c["text"].cast("string"), F.lit("")).alias("text"),
        F.monotonically_increasing_id().alias("row"),
    )
    order = ["conv_id", "turn", "role", "text", "row"]
    digest = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    number = lambda at: F.conv(F.substring("digest", at, 15), 16, 10).cast("bigint")
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = rows.select(
        "conv_id",
        F.monotonically_increasing_id().alias("place"),
        digest.alias("digest"),
        F.length("text").cast("bigint").alias("chars"),
    )
    return scratch.settle(
        rows.select(
            "conv_id", "place", F.shiftright("place", 33).alias("part"),
            number(1).alias("g1"), number(16).alias("g2"), "chars",
        ),
        "turns",
    )


def part_starts(turns: DataFrame) -> DataFrame:
    """``conv_id, part, shift, n``: ``place + shift`` is the turn's index; n turns in all."""
    parts = turns.groupBy("conv_id", "part").agg(F.count("*").alias("m"), F.min("place").alias("p"))
    w = Window.partitionBy("conv_id")
    before = F.coalesce(F.sum("m").over(w.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return parts.select(
        "conv_id", "part", (before - F.col("p")).alias("shift"), F.sum("m").over(w).alias("n")
    )


# ------------------------------------------------------------ paths


def rebuilt(conversations: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Each conversation with the first turns of its hundred's first conversation.

    Conversation c takes the first ``h = crc32(c) % 6`` turns of ``c - c % 100`` and
    then its own after its first h. Returns the turns, ``conv_id, d, g1, g2, chars``
    with places d from 1 and the conversation's length, and one row per conversation.
    """
    turns = ordered(conversations, scratch)
    starts = part_starts(turns)
    convs = starts.select("conv_id", "n").distinct().select(
        "conv_id",
        "n",
        (F.crc32(F.col("conv_id").cast("string")) % 6).alias("h"),
        (F.col("conv_id") - F.col("conv_id") % 100).alias("donor"),
    )
    donors = convs.where("conv_id = donor").select("donor", F.col("n").alias("n_donor"))
    taken = F.least("h", F.coalesce("n_donor", F.lit(0)))
    convs = scratch.settle(
        convs.join(donors, "donor", "left").select(
            "conv_id", "h", "donor", taken.alias("taken"),
            (taken + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length"),
        ),
        "convs",
    )
    starts = starts.drop("n").join(convs.drop("donor"), "conv_id")
    own = turns.join(starts, ["conv_id", "part"]).withColumn("idx", F.col("place") + F.col("shift"))
    kept = own.where("idx >= h").select(
        "conv_id", (F.col("taken") + F.col("idx") - F.col("h") + 1).alias("d"),
        "g1", "g2", "chars", "length",
    )
    heads = own.where("conv_id % 100 = 0 and idx < 5").select(
        F.col("conv_id").alias("donor"), "idx", "g1", "g2", "chars"
    )
    given = heads.join(convs, "donor").where("idx < h").select(
        "conv_id", (F.col("idx") + 1).alias("d"), "g1", "g2", "chars", "length"
    )
    return kept.unionByName(given), convs.select("conv_id", "length")


def _low(c: Column) -> Column:
    return c.bitwiseAND(F.lit(0xFFFFFFFF))


def _slice(d: str, size: int) -> Column:
    return F.floor((F.col(d) - 1) / size).alias("slice")


def prefixes(turns: DataFrame, scratch: Scratch, size: int = SLICE) -> DataFrame:
    """``conv_id, d, length, chars, slice`` with the digests of the prefix that ends
    with this turn (k1, k2) and of the one before (p1, p2); the root's are 0.

    A digest is four running sums of 32-bit hashes, within slices, with the sums of
    the slices before added: no conversation is summed by one task.
    """
    x1, x2 = F.xxhash64("d", "g1", "g2"), F.xxhash64("g2", "d", "g1")
    halves = {
        "a": _low(x1), "b": _low(F.shiftrightunsigned(x1, 32)),
        "e": _low(x2), "f": _low(F.shiftrightunsigned(x2, 32)),
    }
    rows = turns.select("conv_id", "d", "length", "chars", _slice("d", size), *[v.alias(k) for k, v in halves.items()])
    long = rows.where(F.col("length") > size).groupBy("conv_id", "slice")
    w = Window.partitionBy("conv_id").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    sums = long.agg(*[F.sum(k).alias(k) for k in halves])
    carry = sums.select("conv_id", "slice", *[F.sum(k).over(w).alias(f"c{k}") for k in halves])
    w = Window.partitionBy("conv_id", "slice").orderBy("d").rowsBetween(Window.unboundedPreceding, 0)
    summed = rows.select(
        "conv_id", "d", "length", "chars", "slice", *halves, *[F.sum(k).over(w).alias(f"s{k}") for k in halves]
    ).join(carry, ["conv_id", "slice"], "left")
    total = {k: F.col(f"s{k}") + F.coalesce(f"c{k}", F.lit(0)) for k in halves}
    key = lambda hi, lo: F.shiftleft(_low(hi), 32).bitwiseOR(_low(lo))
    prior = {k: v - F.col(k) for k, v in total.items()}
    return scratch.settle(
        summed.select(
            "conv_id", "d", "length", "chars", "slice",
            key(total["b"], total["a"]).alias("k1"), key(total["f"], total["e"]).alias("k2"),
            key(prior["b"], prior["a"]).alias("p1"), key(prior["f"], prior["e"]).alias("p2"),
        ),
        "paths",
    )


# ------------------------------------------------------------ minimal perfect hash


def _mix(keys: np.ndarray, seed: int) -> np.ndarray:
    x = keys["k1"].view(np.uint64) ^ (keys["k2"].view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))
    for shift, by in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(by)
    return x ^ (x >> np.uint64(31))


class SlotTable:
    """Slots 0 to n - 1 for n distinct digests, by cascading bit arrays.

    Each level keeps the digests that are alone on their bit; the others try the next
    one. A slot is the number of set bits before a digest's bit. A digest that is not
    in the table would get some slot, so each slot keeps its digest to compare with.
    """

    def __init__(self, keys: np.ndarray) -> None:
        self.levels: list[np.ndarray] = []
        rest = keys
        while len(rest):
            size = 2 * len(rest) + 1
            at = _mix(rest, len(self.levels)) % np.uint64(size)
            alone = np.bincount(at.astype(np.int64), minlength=size) == 1
            self.levels.append(alone)
            rest = rest[~alone[at.astype(np.int64)]]
        self.before = np.concatenate([[0], np.cumsum(np.concatenate([*self.levels, []]))]).astype(np.int64)
        self.kept = np.zeros(len(keys), dtype=keys.dtype)
        self.kept[self._slots(keys)] = keys
        if not (self.kept[self._slots(keys)] == keys).all():
            raise RuntimeError("two digests in one slot")

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        slot, open_, start = np.full(len(keys), -1), np.arange(len(keys)), 0
        for seed, bits in enumerate(self.levels):
            if not len(open_):
                break
            at = (_mix(keys[open_], seed) % np.uint64(len(bits))).astype(np.int64)
            hit = bits[at]
            slot[open_[hit]] = self.before[start + at[hit]]
            open_, start = open_[~hit], start + len(bits)
        return slot

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each digest, -1 for those the table does not hold."""
        slot = self._slots(keys)
        known = slot >= 0
        known[known] = self.kept[slot[known]] == keys[known]
        return np.where(known, slot, -1)


_DIGEST = np.dtype([("k1", np.int64), ("k2", np.int64)])


def _digests(table: pa.Table, a: str, b: str) -> np.ndarray:
    out = np.empty(len(table), dtype=_DIGEST)
    out["k1"], out["k2"] = table[a].to_numpy(), table[b].to_numpy()
    return out


def accumulate(table: pa.Table, size: int = SLICE) -> pa.Table:
    """One shard: paths (``own`` false) and counts of its own nodes (``own`` true)."""
    own = np.asarray(table["own"].to_numpy(zero_copy_only=False), dtype=bool)
    keys, parents = _digests(table, "k1", "k2"), _digests(table, "p1", "p2")
    first = table["d"].to_numpy() % size == 1 % size
    root = np.zeros(1, dtype=_DIGEST)
    # Paths and own nodes; the root stands above first turns.
    table_of = SlotTable(np.unique(np.concatenate([keys, root])))
    slot = table_of.slots(keys)
    depth = np.zeros(len(table_of.kept), dtype=np.int64)
    depth[slot] = table["d"].to_numpy()
    above = np.full(len(table_of.kept), -1)
    inner = ~own & (~first | (table["d"].to_numpy() == 1))
    above[slot[inner]] = table_of.slots(parents[inner])
    if (above[slot[inner]] < 0).any():
        raise RuntimeError("a prefix without the one before it")
    sums = {}
    for name in ("leaves", "saved"):
        sums[name] = np.zeros(len(table_of.kept), dtype=np.int64)
        np.add.at(sums[name], slot[own], table[name].to_numpy()[own])
    by_depth = np.argsort(depth, kind="stable")
    bounds = np.flatnonzero(np.diff(depth[by_depth])) + 1
    for level in np.split(by_depth, bounds)[::-1]:
        level = level[above[level] >= 0]
        for values in sums.values():
            np.add.at(values, above[level], values[level])
    kept = table_of.kept
    return pa.table({"k1": kept["k1"], "k2": kept["k2"], **sums})


# ------------------------------------------------------------ nodes


def _ends(paths: DataFrame, convs: DataFrame) -> DataFrame:
    """Digest of the ascending ids of the conversations that end at a node.

    Ids are sorted as one table and joined in chunks, then each node's chunks pass
    one task as a stream: the digest is sequential, its memory is not the list's.
    """
    ends = paths.where("d = length").select(*KEY, "conv_id").unionByName(
        convs.where("length = 0").select(F.lit(0).alias("k1").cast("bigint"), F.lit(0).alias("k2").cast("bigint"), "conv_id")
    )

    def chunks(batches: Batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, ids = _digests(pa.Table.from_batches([batch]), "k1", "k2"), batch.column("conv_id").to_numpy()
            edges = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.array([], int)
            cuts = sorted({*edges.tolist(), *range(0, len(key), CHUNK)})
            yield pa.RecordBatch.from_pydict(
                {
                    "k1": key["k1"][cuts],
                    "k2": key["k2"][cuts],
                    "first": ids[cuts],
                    "ids": [",".join(map(str, ids[a:b].tolist())) for a, b in zip(cuts, [*cuts[1:], len(key)])],
                },
                pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("first", pa.int64()), ("ids", pa.string())]),
            )

    def digests(batches: Batches) -> Iterator[pa.RecordBatch]:
        shape = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("ends", pa.string())])
        at, state = None, None
        for batch in batches:
            done = []
            for k1, k2, _, ids in zip(*[c.to_pylist() for c in batch.columns]):
                if (k1, k2) == at:
                    state.update(b"," + ids.encode())
                    continue
                if at:
                    done.append((*at, state.hexdigest()))
                at, state = (k1, k2), hashlib.sha256(ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip([*zip(*done)] or [[]] * 3, shape)], schema=shape)
        if at:
            yield pa.RecordBatch.from_pydict(dict(zip(shape.names, [[at[0]], [at[1]], [state.hexdigest()]])), shape)

    order = [*KEY, "conv_id"]
    pieces = ends.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        chunks, "k1 bigint, k2 bigint, first bigint, ids string"
    )
    pieces = pieces.repartition(*KEY).sortWithinPartitions(*KEY, "first")
    return pieces.mapInArrow(digests, "k1 bigint, k2 bigint, ends string")


def trie(turns: DataFrame, convs: DataFrame, scratch: Scratch, size: int = SLICE) -> DataFrame:
    """The nodes of ``turns`` (conv_id, d, g1, g2, chars, length) and ``convs``."""
    paths = prefixes(turns, scratch, size)
    same = lambda c: F.min(c) == F.max(c)
    nodes = paths.groupBy(*KEY).agg(
        F.count("*").alias("n_convs"),
        F.min("conv_id").alias("conv_id"),
        F.max("d").alias("depth"),
        F.max("p1").alias("p1"),
        F.max("p2").alias("p2"),
        F.max("chars").alias("chars"),
        (~F.max(F.col("d") < F.col("length"))).cast("bigint").alias("leaf"),
        (same("d") & same("p1") & same("p2") & same("chars")).alias("sound"),
    )
    sound = F.when(F.col("sound"), F.col("n_convs")).otherwise(
        F.raise_error(F.lit("two prefixes with one digest")).cast("bigint")
    )
    nodes = scratch.settle(nodes.withColumn("n_convs", sound).drop("sound"), "nodes")

    owned = nodes.select(
        "conv_id", F.col("depth").alias("d"), *KEY, "p1", "p2", F.lit(True).alias("own"),
        F.col("leaf").alias("leaves"),
        ((F.col("n_convs") - 1) * F.col("chars")).alias("saved"),
        _slice("depth", size),
    )
    # What later slices of a path hold counts for all of its earlier prefixes.
    w = Window.partitionBy("conv_id").orderBy("slice").rowsBetween(1, Window.unboundedFollowing)
    later = (
        owned.join(paths.where(F.col("length") > size).select("conv_id").distinct(), "conv_id", "left_semi")
        .groupBy("conv_id", "slice").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    )
    cuts = paths.where((F.col("d") % size == 0) & (F.col("length") > F.col("d")))
    cuts = cuts.select("conv_id", "d", *KEY, "p1", "p2", F.lit(True).alias("own"), "slice")
    marks = cuts.select("conv_id", "slice").unionByName(later.select("conv_id", "slice")).distinct()
    carried = marks.join(later, ["conv_id", "slice"], "left").select(
        "conv_id", "slice",
        F.coalesce(F.sum("leaves").over(w), F.lit(0)).alias("leaves"),
        F.coalesce(F.sum("saved").over(w), F.lit(0)).alias("saved"),
    )
    carried = cuts.join(carried, ["conv_id", "slice"])
    zero = F.lit(0).cast("bigint")
    rows = paths.select(
        "conv_id", "d", *KEY, "p1", "p2", F.lit(False).alias("own"),
        zero.alias("leaves"), zero.alias("saved"), "slice",
    ).unionByName(owned).unionByName(carried)
    shards = max(1, -(-paths.count() // SHARD_ROWS))
    shard = F.pmod(F.xxhash64("conv_id", "slice"), F.lit(shards)).alias("shard")
    parts = rows.select(shard, *[c for c in rows.columns if c not in ("conv_id", "slice")])
    parts = parts.groupBy("shard").applyInArrow(lambda rows: accumulate(rows, size), "k1 bigint, k2 bigint, leaves bigint, saved bigint")

    everyone = convs.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"))
    first = everyone.first()
    root = everyone.where("n_convs > 0").select(
        zero.alias("k1"), zero.alias("k2"), "n_convs", "conv_id", zero.alias("depth"),
        (F.lit(1) if nodes.isEmpty() else F.lit(0)).cast("bigint").alias("leaves"),
    )
    facts = nodes.select(*KEY, "n_convs", "conv_id", "depth", "p1", "p2").unionByName(root, True)
    children = nodes.groupBy(F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(F.count("*").alias("children"))
    every = facts.unionByName(parts, True).unionByName(children, True).unionByName(_ends(paths, convs), True)
    node = every.groupBy(*KEY).agg(
        *[F.max(c).alias(c) for c in ("conv_id", "depth", "n_convs", "p1", "p2", "ends")],
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("children", "leaves", "saved")],
    )
    # Only nodes whose parent may belong to another conversation look it up.
    above = nodes.select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("above"))
    joined = scratch.settle(node.where("depth is not null"), "trie").join(above, ["p1", "p2"], "left")
    held = F.when(F.col("depth") > 1, F.col("above")).when(F.col("depth") == 1, F.lit(first["conv_id"]))
    return joined.select(
        "conv_id",
        "depth",
        held.cast("bigint").alias("parent_conv_id"),
        "n_convs",
        F.col("children").alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"),
        F.coalesce("ends", F.lit(NO_ENDS)).alias("ends_sha256"),
    )


def rebuilt_trie(conversations: DataFrame, size: int = SLICE) -> DataFrame:
    """The trie of the rebuilt conversations; ``size``: turns of a path in one shard."""
    scratch = Scratch(conversations.sparkSession)
    turns, convs = rebuilt(conversations, scratch)
    return trie(turns, convs, scratch, size)


#: The same node table in DuckDB's SQL. Nodes are sequences of turns; what a node owns
#: is added up along the path of its smallest conversation.
TRIE_SQL = """
WITH turns AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS idx,
    coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL
), sizes AS (
  SELECT conv_id, count(*) AS n, xor(4294967295, list_reduce(
      list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
      lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)),
        lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END))) % 6 AS h
  FROM turns GROUP BY conv_id
), convs AS (
  SELECT c.conv_id, c.h, c.conv_id - c.conv_id % 100 AS donor, least(c.h, coalesce(d.n, 0)) AS taken,
    least(c.h, coalesce(d.n, 0)) + greatest(c.n - c.h, 0) AS size
  FROM sizes c LEFT JOIN sizes d ON d.conv_id = c.conv_id - c.conv_id % 100
), built AS (
  SELECT c.conv_id, c.size, t.idx + 1 AS d, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.donor AND t.idx < c.h
  UNION ALL
  SELECT c.conv_id, c.size, c.taken + t.idx - c.h + 1, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.idx >= c.h
), paths AS (
  SELECT conv_id, size, d, length(text) AS chars,
    sha256(string_agg(length(role) || ':' || role || length(text) || ':' || text, '|')
      OVER (PARTITION BY conv_id ORDER BY d ROWS UNBOUNDED PRECEDING)) AS key
  FROM built
  UNION ALL SELECT conv_id, size, 0, 0, 'root' FROM convs
), nodes AS (
  SELECT key, min(conv_id) AS conv_id, max(d) AS depth, count(*) AS n_convs, max(chars) AS chars,
    max(size) = max(d) AS leaf,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (d = size), '')) AS ends_sha256
  FROM paths GROUP BY key
), held AS (
  SELECT p.key, p.conv_id, p.d,
    sum(CASE WHEN n.leaf THEN 1 ELSE 0 END) OVER w AS leaves,
    sum(coalesce((n.n_convs - 1) * n.chars, 0)) OVER w AS saved
  FROM paths p LEFT JOIN nodes n ON n.conv_id = p.conv_id AND n.depth = p.d
  WINDOW w AS (PARTITION BY p.conv_id ORDER BY p.d ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
), totals AS (SELECT key, sum(leaves) AS leaves, sum(saved) AS saved FROM held GROUP BY key),
parents AS (
  SELECT n.key, p.key AS parent FROM nodes n JOIN paths p ON p.conv_id = n.conv_id AND p.d = n.depth - 1
)
SELECT n.conv_id, n.depth::BIGINT AS depth, above.conv_id AS parent_conv_id, n.n_convs,
  coalesce(k.n, 0) AS n_children, t.leaves::BIGINT AS n_leaves, t.saved::BIGINT AS saved_tokens, n.ends_sha256
FROM nodes n JOIN totals t USING (key)
LEFT JOIN parents p USING (key) LEFT JOIN nodes above ON above.key = p.parent
LEFT JOIN (SELECT parent, count(*) AS n FROM parents GROUP BY parent) k ON k.parent = n.key
"""
