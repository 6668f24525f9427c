"""Centroid clustering (Lloyd's rounds) that rescans only vectors whose bounds have run out.

1. Vectors of the wanted length without null or non-finite components are kept; a component x becomes floor(``SCALE`` * x). They are
   packed into blocks of at most ``BLOCK`` vectors, without a shuffle. The starting centroids are the ``clusters`` vectors with
   the smallest sha256 of ``2:<id>``.
2. The first pass compares every vector with every centroid. From then on a vector is known by its gap: the distance to the second
   nearest centroid less that to its own. Each cluster of a block keeps a heap of gaps.
3. When centroids move, a gap shrinks at most by the drift of its own centroid and the largest drift of another. That sum is
   accumulated per cluster; a gap enters its heap raised by what had accumulated by then, so a heap is never touched when
   centroids move. While the least gap of a heap is no more than its cluster's accumulated drift, the vector is popped, compared
   exactly with all centroids and pushed into the heap of its cluster. All others keep their centroid unseen.
4. Each pass writes the blocks with their heaps, and what moved: per block, the difference of counts and component sums of each
   cluster. Those are summed in tasks first, then by Spark; the driver gets one number per cluster and component.

Distances, sums and centroids are whole numbers and exact; bounds are floating point, lowered by more than their rounding error, so a
tie always leads to an exact comparison, which the smaller number wins. Every pass is a written table, so a lost executor
costs a part of one pass. State per vector is one gap, a place and a cluster; broadcast are the centroids alone.

Repeated rows are vectors of their own; of equal hashes (repeated ids) the smaller vector starts first; a null id counts as the empty
text in the hash. With fewer vectors than clusters each is a start. A component of 2**27 or more after scaling ends the job
with an error, as distances need no longer fit a long. An empty table, or one without kept vectors, gives an empty result;
other columns are left aside.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlink.llm.common import table
from spendlink.sources.shared import materialize

CLUSTERS, DIM, ROUNDS = 40, 64, 5
SCALE = 256
BLOCK = 1024
LARGEST = 1 << 27
#: Below this, all sums of a distance are whole numbers that doubles hold exactly.
EXACT_IN_DOUBLES = 1 << 22
SLACK = 1e-9


def usable(rows: DataFrame, id_col: str, vector_col: str, dim: int) -> DataFrame:
    """(vec_id, vector) of the vectors of length ``dim`` whose components are all finite."""
    finite = F.forall(vector_col, lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    kept = rows.filter((F.size(vector_col) == dim) & finite)
    return kept.select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))


def scaled(vectors: np.ndarray) -> np.ndarray:
    cells = np.floor(SCALE * vectors)
    if len(cells) and np.abs(cells).max() >= LARGEST:
        raise ValueError(f"a component beyond {LARGEST // SCALE}: distances would not fit a long")
    return cells.astype(np.int64)


def starts(kept: DataFrame, clusters: int) -> np.ndarray:
    name = F.concat(F.lit("2:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    first = kept.select(F.sha2(name, 256).alias("hash"), "vector").orderBy("hash", "vector").limit(clusters).collect()
    return scaled(np.array([r.vector for r in first], np.float64))


def squared(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances, a row per vector."""
    top = max(np.abs(vectors).max(initial=0), np.abs(centroids).max(initial=0))
    if top < EXACT_IN_DOUBLES:
        v, c = vectors.astype(np.float64), centroids.astype(np.float64)
        return ((v * v).sum(axis=1)[:, None] + (c * c).sum(axis=1)[None, :] - 2 * (v @ c.T)).astype(np.int64)
    out = np.empty((len(vectors), len(centroids)), np.int64)
    for k, c in enumerate(centroids):
        out[:, k] = ((vectors - c) ** 2).sum(axis=1)
    return out


def nearest(vectors: np.ndarray, centroids: np.ndarray, drifted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest centroid, and the gap to the second, lowered by ``SLACK`` and raised by the drift so far."""
    d = squared(vectors, centroids)
    own = d.argmin(axis=1)
    if len(centroids) == 1:
        return own, np.full(len(vectors), math.inf)
    two = np.sqrt(np.partition(d, 1, axis=1)[:, :2].astype(np.float64))
    so_far = drifted[own]
    return own, two[:, 1] - two[:, 0] - SLACK * (1 + two[:, 1] + so_far) + so_far


@dataclass
class Block:
    """Vectors with their clusters, and one heap of (gap, place) per cluster."""

    ids: pa.Array
    cells: np.ndarray
    cluster: np.ndarray
    heaps: list[list[tuple[float, int]]]

    FIELDS = ("ids", "cells", "cluster", "sizes", "gaps", "places", "moved", "distance")

    @classmethod
    def first(cls, ids: pa.Array, cells: np.ndarray, centroids: np.ndarray) -> Block:
        own, gaps = nearest(cells, centroids, np.zeros(len(centroids)))
        heaps = [[(gaps[i].item(), i) for i in np.flatnonzero(own == k).tolist()] for k in range(len(centroids))]
        for heap in heaps:
            heapify(heap)
        return cls(ids, cells, own, heaps)

    @classmethod
    def read(cls, batch: pa.RecordBatch, at: int, dim: int) -> Block:
        raw = {n: batch.column(n)[at].as_buffer() for n in ("cells", "cluster", "sizes", "gaps", "places")}
        cluster = np.frombuffer(raw["cluster"], "<i4").astype(np.int64)
        wide = raw["cells"].size == 8 * dim * len(cluster)
        cells = np.frombuffer(raw["cells"], "<i8" if wide else "<i2").reshape(-1, dim).astype(np.int64)
        entries = list(zip(np.frombuffer(raw["gaps"], "<f8").tolist(), np.frombuffer(raw["places"], "<i4").tolist(), strict=True))
        heaps, start = [], 0
        for size in np.frombuffer(raw["sizes"], "<i4").tolist():  # written in heap order
            heaps.append(entries[start : start + size])
            start += size
        return cls(batch.column("ids")[at].values, cells, cluster, heaps)

    def expire(self, drifted: np.ndarray) -> np.ndarray:
        """Places of the vectors whose gap has run out, popped from their heaps."""
        out = []
        for heap, limit in zip(self.heaps, drifted.tolist(), strict=True):
            while heap and heap[0][0] <= limit:
                out.append(heappop(heap)[1])
        return np.array(out, np.int64)

    def rescan(self, places: np.ndarray, centroids: np.ndarray, drifted: np.ndarray) -> None:
        own, gaps = nearest(self.cells[places], centroids, drifted)
        for place, cluster, gap in zip(places.tolist(), own.tolist(), gaps.tolist(), strict=True):
            heappush(self.heaps[cluster], (gap, place))
        self.cluster[places] = own

    def sums(self, places: np.ndarray, clusters: int) -> np.ndarray:
        """A row per cluster: how many of the vectors at ``places`` it has, and their component sums."""
        out = np.zeros((clusters, self.cells.shape[1] + 1), np.int64)
        np.add.at(out[:, 0], self.cluster[places], 1)
        np.add.at(out[:, 1:], self.cluster[places], self.cells[places])
        return out

    def record(self, moved: np.ndarray, centroids: np.ndarray | None) -> pa.RecordBatch:
        """The written row; with ``centroids``, the last pass's, it has the distances."""
        narrow = self.cells.astype("<i2")
        cells = narrow if (narrow == self.cells).all() else self.cells.astype("<i8")
        entries = [e for heap in self.heaps for e in heap]
        parts = [
            cells, self.cluster.astype("<i4"), np.array([len(h) for h in self.heaps], "<i4"),
            np.array([g for g, _ in entries], "<f8"), np.array([p for _, p in entries], "<i4"), moved.astype("<i8"),
            np.empty(0, "<i8") if centroids is None else ((self.cells - centroids[self.cluster]) ** 2).sum(axis=1).astype("<i8"),
        ]
        ids = pa.ListArray.from_arrays(pa.array([0, len(self.ids)], pa.int32()), self.ids)
        return pa.record_batch([ids, *(pa.array([p.tobytes()], pa.binary()) for p in parts)], list(self.FIELDS))


def _schema(kind: str) -> str:
    return f"ids array<{kind}>, " + ", ".join(f"{name} binary" for name in Block.FIELDS[1:])


def first_pass(kept: DataFrame, centroids: np.ndarray, last: bool) -> DataFrame:
    dim = centroids.shape[1]

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                cells = scaled(part.column(1).flatten().to_numpy().reshape(-1, dim))
                block = Block.first(part.column(0), cells, centroids)
                yield block.record(block.sums(np.arange(len(cells)), len(centroids)), centroids if last else None)

    return kept.mapInArrow(run, _schema(kept.schema["vec_id"].dataType.simpleString()))


def next_pass(state: DataFrame, centroids: np.ndarray, drifted: np.ndarray, last: bool) -> DataFrame:
    clusters, dim = centroids.shape

    def run(batches):
        for batch in batches:
            for at in range(batch.num_rows):
                block = Block.read(batch, at, dim)
                expired = block.expire(drifted)
                before = block.sums(expired, clusters)
                if len(expired):
                    block.rescan(expired, centroids, drifted)
                yield block.record(block.sums(expired, clusters) - before, centroids if last else None)

    return state.mapInArrow(run, state.schema)


def moved_sums(state: DataFrame, clusters: int, dim: int) -> np.ndarray:
    """What a pass moved, over all blocks: Python integers, a row per cluster (count, component sums)."""

    def run(batches):
        total = np.zeros(clusters * (dim + 1), np.int64)
        for batch in batches:
            for moved in batch.column(0):
                total += np.frombuffer(moved.as_buffer(), "<i8")
        cell = np.flatnonzero(total)
        yield pa.record_batch([pa.array(cell.astype(np.int32)), pa.array(total[cell])], ["cell", "n"])

    partial = state.select("moved").mapInArrow(run, "cell int, n bigint")
    out = np.zeros(clusters * (dim + 1), object)
    for r in partial.groupBy("cell").agg(F.sum(F.col("n").cast("decimal(38,0)")).alias("n")).collect():
        out[r.cell] = int(r.n)
    return out.reshape(clusters, dim + 1)


def averages(centroids: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """Floors of the exact means; a cluster without vectors keeps its centroid."""
    rows = [[s // row[0] for s in row[1:]] if row[0] else old.tolist() for old, row in zip(centroids, sums, strict=True)]
    return np.array(rows, np.int64)


def shrinkage(old: np.ndarray, new: np.ndarray) -> np.ndarray:
    """How far the gaps of each cluster may shrink at most: its own drift and the largest of another."""
    drift = np.sqrt(((new - old) ** 2).sum(axis=1).astype(np.float64)) * (1 + SLACK)
    others = np.array([np.delete(drift, k).max(initial=0.0) for k in range(len(drift))])
    return drift + others


COLUMNS = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def clustered(
    rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", clusters: int = CLUSTERS, dim: int = DIM, rounds: int = ROUNDS
) -> DataFrame:
    """``COLUMNS`` for every kept vector."""
    spark = rows.sparkSession
    kept = usable(rows, id_col, vector_col, dim)
    kind = kept.schema["vec_id"].dataType.simpleString()
    centroids = starts(kept, clusters)
    if not len(centroids):
        empty = f"vec_id {kind}, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
        return spark.createDataFrame([], empty)
    clusters = len(centroids)
    state = materialize(first_pass(kept, centroids, last=not rounds), "clusters")
    sums = np.zeros((clusters, dim + 1), object)
    drifted = np.zeros(clusters)
    for k in range(rounds):
        sums = sums + moved_sums(state, clusters, dim)
        moved = averages(centroids, sums)
        drifted = drifted + shrinkage(centroids, moved)
        centroids = moved
        state = materialize(next_pass(state, centroids, drifted, last=k == rounds - 1), "clusters")

    def spread(batches):
        for batch in batches:
            for ids, cluster, distance in zip(batch.column(0), batch.column(1), batch.column(2), strict=True):
                columns = [np.frombuffer(cluster.as_buffer(), "<i4"), np.frombuffer(distance.as_buffer(), "<i8")]
                yield pa.record_batch([ids.values, *map(pa.array, columns)], COLUMNS[:3])

    found = state.select("ids", "cluster", "distance").mapInArrow(spread, f"vec_id {kind}, cluster int, distance bigint")
    per_cluster = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).cast("bigint").alias("n"))
    inertia = {r.cluster: r.n for r in per_cluster.collect()}  # one row per cluster
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    known = spark.createDataFrame([(k, n, names[k]) for k, n in inertia.items()], "cluster int, cluster_inertia bigint, centroid_sha256 string")
    total = F.lit(sum(inertia.values())).cast("bigint").alias("inertia")
    return found.join(F.broadcast(known), "cluster").select(*COLUMNS[:4], total, COLUMNS[5])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustered(table(spark, sf_dir, "embeddings"))


def _sql() -> str:
    """Plain Lloyd rounds, one after another."""

    def assigned(k: int) -> str:
        square = "list_sum(list_transform(list_zip(p.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
        return f"""a{k} AS MATERIALIZED (
  SELECT r, min({{'d': d, 'c': c}}) AS best FROM (SELECT p.r, c.c, CAST({square} AS BIGINT) AS d FROM kept p, c{k} c) GROUP BY r)"""

    def averaged(k: int) -> str:
        return f"""s{k} AS MATERIALIZED (
  SELECT c, i, CAST(sum(x) AS HUGEINT) AS s, count(*) AS n
  FROM (SELECT best.c AS c, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM kept JOIN a{k} USING (r)) GROUP BY c, i),
m{k} AS (SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS v FROM s{k} GROUP BY c),
c{k + 1} AS MATERIALIZED (SELECT c, coalesce(m.v, o.v) AS v FROM c{k} o LEFT JOIN m{k} m USING (c))"""

    rounds = ",\n".join(f"{assigned(k)},\n{averaged(k)}" for k in range(ROUNDS))
    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE len(embedding) = {DIM} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h, v) - 1 AS c, v FROM (
    SELECT sha256('2:' || coalesce(CAST(vec_id AS VARCHAR), '')) AS h, v FROM kept ORDER BY h, v LIMIT {CLUSTERS})),
{rounds},
{assigned(ROUNDS)}
SELECT vec_id, CAST(best.c AS INTEGER) AS cluster, best.d AS distance,
  CAST(sum(best.d) OVER (PARTITION BY best.c) AS BIGINT) AS cluster_inertia, CAST(sum(best.d) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM a{ROUNDS} JOIN kept USING (r) JOIN c{ROUNDS} c ON c.c = best.c
"""


SQL = _sql()
