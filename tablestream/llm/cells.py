"""Near duplicates among embeddings: spherical k-means cells, compared in blocks.

Centroids come from a bounded sample. A vector's home is the cell of its nearest
centroid. Two vectors with a cosine of at least ``threshold`` are at most
``sqrt(2 - 2 threshold)`` apart, so if they have different homes, at least one of
them is within half of that of the plane between both centroids. Each vector also
visits every cell for which that holds of it: all links are found, none is missed
at a cell's border.

Within a label and cell, home vectors meet all of the cell in blocks of bounded size
as matrix products in double precision. A block returns, per vector, how many others
it links and one vector it is connected to, never its pairs. Equal vectors are
compared once and counted as often as they occur.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablestream.llm.common import Batches, arrow, settle
from tablestream.llm.graph import components

#: Centroids are fitted on the vectors with the smallest hashes, at most so many.
SAMPLE = 20_000
#: Vectors a cell should hold, over all labels, and the most cells there can be.
PER_CELL, MOST_CELLS = 4096, 256
ROUNDS = 10
#: Home vectors and vectors they meet in one block.
HOME_BLOCK, MEET_BLOCK = 1024, 2048


def kmeans(x: np.ndarray, k: int, seed: int = 1) -> np.ndarray:
    """Unit centroids of unit vectors; an empty cell keeps its old centroid."""
    rng = np.random.default_rng(seed)
    centres = x[rng.choice(len(x), size=min(k, len(x)), replace=False)].copy()
    for _ in range(ROUNDS):
        home = (x @ centres.T).argmax(axis=1)
        total = np.zeros_like(centres)
        np.add.at(total, home, x)
        norm = np.linalg.norm(total, axis=1, keepdims=True)
        centres = np.where(norm > 1e-12, total / np.maximum(norm, 1e-12), centres)
    return centres


def places(x: np.ndarray, centres: np.ndarray, reach: float) -> tuple[np.ndarray, np.ndarray]:
    """Home cells, and which other cells each vector visits."""
    near = x @ centres.T
    home = near.argmax(axis=1)
    apart = np.linalg.norm(centres[:, None] - centres[None], axis=2)
    lead = near[np.arange(len(x)), home][:, None] - near
    visits = lead <= reach / 2 * apart[home] + 1e-9
    visits[np.arange(len(x)), home] = False
    return home, visits


def _vectors(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(b, "<f8") for b in column.to_pylist()]


def valid(embedding: str, label: str):
    bad = F.exists(
        embedding, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(float("inf")))
    )
    some = F.exists(embedding, lambda v: v != 0)
    return F.coalesce(F.col(label).isNotNull() & ~bad & some, F.lit(False))


def unit(classes: DataFrame) -> DataFrame:
    """``embedding`` as bytes of a unit vector of doubles."""

    def step(batches: Batches):
        for batch in batches:
            out = []
            for v in batch.column(4).to_pylist():
                x = np.array(v, "<f8")
                # Scaled first: squares of large components would overflow.
                x = x / np.abs(x).max()
                out.append((x / np.linalg.norm(x)).tobytes())
            columns = [*batch.columns[:4], pa.array(out, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["uid", "label", "dim", "n", "unit"])

    rows = classes.select("uid", "label", "dim", "n", "embedding")
    return arrow(rows, step, "uid bigint, label string, dim int, n bigint, unit binary")


def located(units: DataFrame, centres: dict[int, np.ndarray], reach: float) -> DataFrame:
    def step(batches: Batches):
        for batch in batches:
            homes, visits = [], []
            for dim, raw in zip(batch.column(2).to_pylist(), batch.column(4).to_pylist()):
                x = np.frombuffer(raw, "<f8")[None]
                home, other = places(x, centres[dim], reach) if dim in centres else ([0], [[]])
                homes.append(int(home[0]))
                visits.append(np.flatnonzero(other[0]).tolist())
            columns = [
                *batch.columns,
                pa.array(homes, pa.int32()),
                pa.array(visits, pa.list_(pa.int32())),
            ]
            names = ["uid", "label", "dim", "n", "unit", "home", "visits"]
            yield pa.RecordBatch.from_arrays(columns, names)

    return arrow(
        units,
        step,
        "uid bigint, label string, dim int, n bigint, unit binary, home int, visits array<int>",
    )


def _centres(units: DataFrame, cells: int) -> dict[int, np.ndarray]:
    """Per dimension; a dimension that the sample lacks has one cell."""
    sample = units.select("dim", "unit").orderBy(F.xxhash64("unit"), "unit").limit(SAMPLE)
    by_dim: dict[int, list[np.ndarray]] = {}
    for r in sample.collect():
        by_dim.setdefault(r["dim"], []).append(np.frombuffer(bytes(r["unit"]), "<f8"))
    return {d: kmeans(np.stack(v), cells) for d, v in by_dim.items()}


def meetings(rows: DataFrame) -> DataFrame:
    """Rows dealt to blocks: as home vectors once per part of what they meet, and as
    what is met once per part of the home vectors."""
    cell = ["label", "dim", "cell"]
    met = rows.withColumn("cell", F.explode(F.concat(F.array("home"), "visits")))
    size = met.groupBy(*cell).agg(
        F.ceil(F.count_if(F.col("cell") == F.col("home")) / HOME_BLOCK).cast("int").alias("nb"),
        F.ceil(F.count("*") / MEET_BLOCK).cast("int").alias("nq"),
    )
    met = met.join(size, cell).where("nb > 0")
    part = F.pmod(F.xxhash64("uid"), F.col("nb")).cast("int")
    other = F.pmod(F.xxhash64("uid", F.lit(7)), F.col("nq")).cast("int")

    def upto(n: str):
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    kept = [*cell, "uid", "n", "unit", "home", "visits"]
    index = met.where("cell = home").select(
        *kept, F.lit(True).alias("index"), part.alias("b"), upto("nq").alias("q")
    )
    query = met.select(*kept, F.lit(False).alias("index"), upto("nb").alias("b"), other.alias("q"))
    return index.unionByName(query)


def compare(threshold: float):
    """Links within one block: how many each vector gets, and whom it hangs on."""

    def block(t: pa.Table) -> pa.Table:
        flag = t.column("index").to_numpy()
        cell = t.column("cell")[0].as_py()
        uid, n, home = (t.column(c).to_numpy() for c in ("uid", "n", "home"))
        x = np.stack(_vectors(t.column("unit")))
        visits = t.column("visits").to_pylist()
        own, met = np.flatnonzero(flag), np.flatnonzero(~flag)
        if not len(own) or not len(met):
            return pa.table({"uid": [], "links": [], "root": []}, LINKS)
        linked = x[own] @ x[met].T >= threshold
        linked &= uid[own][:, None] != uid[met][None]
        guest = home[met] != cell
        # A pair of two homes may meet in both; it counts in the smaller cell.
        for j in np.flatnonzero(guest & (home[met] < cell) & linked.any(axis=0)).tolist():
            back = home[met[j]]
            hit = np.flatnonzero(linked[:, j])
            linked[hit[[back in visits[own[i]] for i in hit.tolist()]], j] = False
        rows, columns = linked.any(axis=1), linked.any(axis=0)
        linked, own, met, guest = linked[rows][:, columns], own[rows], met[columns], guest[columns]
        if not len(own):
            return pa.table({"uid": [], "links": [], "root": []}, LINKS)
        to_met = n[own] @ linked
        to_own = linked[:, guest] @ n[met][guest]
        top = np.iinfo(np.int64).max
        a, b = uid[own].copy(), uid[met].copy()
        while True:
            low_b = np.minimum(b, np.where(linked, a[:, None], top).min(axis=0))
            low_a = np.minimum(a, np.where(linked, low_b[None], top).min(axis=1))
            if (low_a == a).all() and (low_b == b).all():
                break
            a, b = low_a, low_b
        return pa.table(
            {
                "uid": np.concatenate([uid[own], uid[met]]),
                "links": np.concatenate([to_own, to_met]).astype(np.int64),
                "root": np.concatenate([a, b]),
            },
            LINKS,
        )

    return block


LINKS = pa.schema([("uid", pa.int64()), ("links", pa.int64()), ("root", pa.int64())])


def near_duplicates(
    vectors: DataFrame,
    threshold: float = 0.93,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """``vec_id, n_links, component_id, kept``, a row per row of ``vectors``.

    Only vectors of the same label and length are compared. Null, zero or non-finite
    vectors, those with a null component and those without a label link with nothing
    and are kept. Equal rows link with each other, also those with equal ids. The
    component is the smallest id in it, null ids left aside; a null id is kept if it
    has no other. Other columns are not carried.
    """
    if not 0 < threshold <= 1:
        raise ValueError("the threshold is over 0 and at most 1")
    rows = vectors.select(
        vectors[id_col].cast("bigint").alias("vec_id"),
        vectors[label_col].cast("string").alias("label"),
        vectors[vector_col].cast("array<double>").alias("embedding"),
    )
    rows = rows.withColumn("good", valid("embedding", "label")).withColumns(
        {
            "k1": F.when(F.col("good"), F.xxhash64("label", "embedding")),
            "k2": F.when(F.col("good"), F.xxhash64(F.lit(1), "label", "embedding")),
        }
    )
    classes = (
        rows.where("good")
        .groupBy("k1", "k2")
        .agg(
            F.first("label").alias("label"),
            F.first("embedding").alias("embedding"),
            F.count("*").alias("n"),
            F.min("vec_id").alias("least"),
        )
        .withColumns({"dim": F.size("embedding"), "uid": F.monotonically_increasing_id()})
    )
    classes = settle(classes, "classes")
    units = settle(unit(classes), "units")
    cells = int(min(MOST_CELLS, max(1, units.count() // PER_CELL)))
    reach = float(np.sqrt(2 - 2 * threshold))
    placed = settle(located(units, _centres(units, cells), reach), "placed")
    found = (
        meetings(placed)
        .groupBy("label", "dim", "cell", "b", "q")
        .applyInArrow(compare(threshold), "uid bigint, links bigint, root bigint")
    )
    found = settle(found, "links")
    roots = components(found.select(F.col("uid").alias("a"), F.col("root").alias("b")))
    sums = found.groupBy("uid").agg(F.sum("links").alias("links"))
    tied = classes.select("k1", "k2", "uid", "n", "least").join(sums, "uid", "left")
    tied = tied.join(roots, tied["uid"] == roots["node"], "left").select(
        "k1",
        "k2",
        "least",
        (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
        F.coalesce("root", "uid").alias("root"),
    )
    tied = settle(tied, "tied")
    least = tied.groupBy("root").agg(F.min("least").alias("component"))
    known = settle(tied.join(least, "root").select("k1", "k2", "n_links", "component"), "known")
    out = rows.join(known, ["k1", "k2"], "left")
    component = F.when(F.col("good"), F.col("component")).otherwise(F.col("vec_id"))
    return out.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
