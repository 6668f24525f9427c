"""Near-duplicate vectors by a forest of random-projection trees with spill.

1. Vectors become unit vectors in double precision. Equal unit vectors are one class with a count of its members.
   Between tasks a vector travels as it came, in single precision where that loses nothing.
2. Trees are fitted on a bounded sample: ``SAMPLE`` classes with the smallest hash. Each level of a tree projects on a
   random direction; each node splits at the median of its sample. A vector within ``SPILL`` of the split goes to both
   sides, so close vectors are rarely parted, and never in all trees at once in practice. Depth follows the number of
   classes, up to ``MAX_DEPTH``: the forest that is broadcast has at most ``TREES * 2**MAX_DEPTH`` thresholds (4 MB).
3. Every class is indexed in all trees. Leaves compare their vectors, in tiles if they are large, and pass on spanning
   edges of pairs with cosine >= ``LEAST``; the union of all leaves' edges gives the components.
4. Inside each component every pair is compared once, in tiles, and links are counted per class, weighted by members.

Vectors that are null, zero, empty or hold a null or non-finite component link with nothing; vectors of different lengths
never link. Repeated rows are vectors of their own. A null vec_id is larger than any other. An empty table gives an
empty result; other columns are left aside.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlink.llm.clusters import components, linked_sets, meetings, per_meeting
from spendlink.llm.common import map_arrow, table
from spendlink.sources.shared import materialize

LEAST = 0.95
TREES = 8
SPILL = 0.015
LEAF = 128
MAX_DEPTH = 16
SAMPLE = 8192
TILE = 512


def unit(values) -> np.ndarray | None:
    """The unit vector in double precision, or None if there is none."""
    if values is None or len(values) == 0 or any(x is None for x in values):
        return None
    v = np.array(values, np.float64)
    if not np.isfinite(v).all():
        return None
    top = np.abs(v).max()
    if top == 0:
        return None
    v /= top  # so that squares neither overflow nor vanish
    return v / np.sqrt(v @ v)


def packed(values) -> bytes:
    exact = np.array(values, "<f8")
    with np.errstate(over="ignore"):
        single = exact.astype("<f4")
    return (single if (single == exact).all() else exact).tobytes()


def units(rows: DataFrame) -> DataFrame:
    """(vec_id, node, dim, vector) for rows(vec_id, embedding): packed vectors, null where there is no unit vector."""

    def work(batch):
        vectors = [unit(x.as_py()) for x in batch.column(1)]
        node = [None if v is None else hashlib.blake2b(v.tobytes(), digest_size=16).digest() for v in vectors]
        raw = [None if v is None else packed(x.as_py()) for v, x in zip(vectors, batch.column(1), strict=True)]
        dim = [None if v is None else len(v) for v in vectors]
        return pa.record_batch(
            [batch.column(0), pa.array(node, pa.binary()), pa.array(dim, pa.int32()), pa.array(raw, pa.binary())],
            ["vec_id", "node", "dim", "vector"],
        )

    kind = rows.schema["vec_id"].dataType.simpleString()
    return map_arrow(rows.select("vec_id", "embedding"), work, f"vec_id {kind}, node binary, dim int, vector binary")


class Tree:
    """One direction per level; one threshold per node (heap order, the root at 1)."""

    def __init__(self, sample: np.ndarray, depth: int, seed: int):
        rng = np.random.Generator(np.random.PCG64([seed, sample.shape[1]]))
        directions = rng.normal(size=(sample.shape[1], max(depth, 1)))
        self.directions = directions / np.linalg.norm(directions, axis=0)
        self.depth, self.thresholds = depth, np.zeros(1 << max(depth, 1))
        projected = sample @ self.directions
        inside = {1: np.arange(len(sample))}
        for level in range(depth):
            below = {}
            for node, rows in inside.items():
                p = projected[rows, level]
                t = self.thresholds[node] = np.median(p) if len(p) else 0.0
                below[2 * node], below[2 * node + 1] = rows[p < t], rows[p >= t]
            inside = below

    def leaves(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, leaf) pairs; a row near a split is on both sides."""
        projected = vectors @ self.directions
        row, node = np.arange(len(vectors)), np.ones(len(vectors), np.int64)
        for level in range(self.depth):
            away = projected[row, level] - self.thresholds[node]
            left, right = away < SPILL, away >= -SPILL
            row, node = np.concatenate([row[left], row[right]]), np.concatenate([2 * node[left], 2 * node[right] + 1])
        return row, node


def matrix(column, dim: int) -> np.ndarray:
    """Unit vectors, in double precision, of packed ones."""
    raw = column.to_pylist()
    if all(len(r) == 4 * dim for r in raw):
        v = np.frombuffer(b"".join(raw), "<f4").reshape(-1, dim).astype(np.float64)
    else:
        v = np.array([np.frombuffer(r, "<f4" if len(r) == 4 * dim else "<f8") for r in raw], np.float64).reshape(-1, dim)
    v /= np.abs(v).max(axis=1, keepdims=True, initial=0)
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def forest(classes: DataFrame, trees: int = TREES, leaf: int = LEAF, sample: int = SAMPLE) -> dict[int, list[Tree]]:
    """Trees for every vector length, fitted on ``sample`` classes of it at most."""
    out = {}
    for dim, n in classes.groupBy("dim").agg(F.count(F.lit(1))).collect():
        depth = min(MAX_DEPTH, max(0, int(np.ceil(np.log2(n / leaf)))))
        picked = classes.filter(F.col("dim") == dim).select("vector", "node").orderBy(F.xxhash64("node"), "node").limit(sample)
        vectors = matrix(picked.select("vector").toArrow().column("vector"), dim)
        out[dim] = [Tree(vectors, depth, seed) for seed in range(trees)]
    return out


def leaf_rows(classes: DataFrame, grown: dict[int, list[Tree]]) -> DataFrame:
    """(leaf, node): every class in every leaf it falls into."""
    shared = classes.sparkSession.sparkContext.broadcast(grown)

    def work(batch):
        dims = batch.column(1).to_numpy()
        out = []
        for dim in np.unique(dims):
            part = batch.filter(pa.array(dims == dim))
            vectors = matrix(part.column(2), int(dim))
            for k, tree in enumerate(shared.value[int(dim)]):
                row, node = tree.leaves(vectors)
                leaf = (int(dim) << 32) + (k << 24) + node
                out.append(pa.record_batch([pa.array(leaf), part.column(0).take(pa.array(row))], ["leaf", "node"]))
        return pa.Table.from_batches(out)

    return map_arrow(classes.select("node", "dim", "vector"), work, "leaf bigint, node binary")


def _crossing(t: pa.Table) -> np.ndarray | None:
    return t.column("tile").to_numpy() if t.column("first")[0].as_py() != t.column("second")[0].as_py() else None


def close_edges(met: DataFrame) -> DataFrame:
    """Spanning edges (a, b) of the close pairs of each leaf."""

    def work(t: pa.Table):
        node, v, tile = t.column("node").to_pylist(), matrix(t.column("vector"), t.column("dim")[0].as_py()), _crossing(t)
        close = v @ v.T >= LEAST
        if tile is not None:
            close &= tile[:, None] != tile[None, :]
        root = linked_sets(len(node), lambda i, others: close[i, others]) if np.triu(close, 1).any() else np.arange(len(node))
        apart = np.flatnonzero(root != np.arange(len(node)))
        ends = [pa.array([node[i] for i in apart], pa.binary()), pa.array([node[r] for r in root[apart]], pa.binary())]
        return pa.record_batch(ends, ["a", "b"])

    return per_meeting(met.select("leaf", "first", "second", "tile", "node", "dim", "vector"), "leaf", work, "a binary, b binary")


def link_counts(met: DataFrame) -> DataFrame:
    """(node, links) per meeting of met(group, node, n, dim, vector)."""

    def work(t: pa.Table):
        v, tile, weight = matrix(t.column("vector"), t.column("dim")[0].as_py()), _crossing(t), t.column("n").to_numpy()
        close = v @ v.T >= LEAST
        np.fill_diagonal(close, False)
        if tile is not None:
            close &= tile[:, None] != tile[None, :]
        return pa.record_batch([t.column("node").combine_chunks(), pa.array((close @ weight).astype(np.int64))], ["node", "links"])

    return per_meeting(met.select("group", "first", "second", "tile", "node", "n", "dim", "vector"), "group", work, "node binary, links bigint")


def near_vectors(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", **fitted) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row."""
    all_rows = materialize(units(rows.select(F.col(id_col).alias("vec_id"), F.col(vector_col).alias("embedding"))), "units")
    first = F.struct(F.col("vec_id").isNull().alias("none"), "vec_id")
    classes = (
        all_rows.filter(F.col("node").isNotNull()).groupBy("node")
        .agg(F.count(F.lit(1)).alias("n"), F.min(first).alias("first"), F.min("dim").alias("dim"), F.min("vector").alias("vector"))
    )
    classes = materialize(classes.select("node", "n", "first.none", F.col("first.vec_id").alias("least"), "dim", "vector"), "classes")
    placed = materialize(leaf_rows(classes, forest(classes, **fitted)), "leaves")
    vectors = classes.select("node", "dim", "vector")
    # Places first, vectors last: a vector is shuffled once for each meeting, not for the grouping before it.
    groups = components(close_edges(meetings(placed, "leaf", "node", TILE).join(vectors, "node")), "groups").withColumnRenamed("root", "group")
    members = groups.join(classes, "node")
    links = link_counts(meetings(members, "group", "node", TILE)).groupBy("node").agg(F.sum("links").alias("links"))
    best = members.groupBy("group").agg(F.min(F.struct("none", "least")).alias("best"))
    grouped = groups.join(best, "group").select("node", F.col("best.least").alias("group_least"))
    per_class = classes.select("node", "n", "least").join(links, "node", "left").join(grouped, "node", "left").select(
        "node", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("group_least", "least").alias("component")
    )
    component = F.coalesce("component", "vec_id")
    return all_rows.select("vec_id", "node").join(per_class, "node", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), component.cast("bigint").alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))
