"""Groups, tiles and connected components for operators on pairs.

A large group is cut into tiles; each pair of tiles is a meeting, a task of bounded size, so that no group has to fit in
one task and no pair is ever a row.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlink.llm.common import release
from spendlink.sources.shared import materialize


def meetings(rows: DataFrame, group: str, member: str, tile: int) -> DataFrame:
    """``rows`` with ``group_size`` and one copy per meeting: (tile, first, second), ``first`` <= ``second``.

    Groups of one are left out. A group of up to ``tile`` members is one meeting without copies.
    """
    sizes = rows.groupBy(group).agg(F.count(F.lit(1)).alias("group_size")).filter("group_size > 1")
    sized = rows.join(sizes, group)
    tiles = F.ceil(F.col("group_size") / tile).cast("int")
    placed = sized.withColumn("tile", F.pmod(F.xxhash64(member), tiles).cast("int"))
    other = F.explode(F.sequence(F.lit(0), tiles - 1))
    met = placed.withColumn("__other", other)
    return met.withColumn("first", F.least("tile", "__other")).withColumn("second", F.greatest("tile", "__other")).drop("__other")


def by_key(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Consecutive rows of equal keys, across batches."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(batch.num_rows, bool)
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        starts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for a, b in zip(starts, starts[1:], strict=False):
            key = tuple(c[a] for c in columns)
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = key
    if held:
        yield pa.Table.from_batches(held)


def per_meeting(rows: DataFrame, group: str, work: Callable[[pa.Table], pa.RecordBatch | None], schema: str) -> DataFrame:
    """``work`` on the rows of each meeting. Meetings follow one another in a partition; one is held at a time."""
    keys = [group, "first", "second"]

    def run(batches):
        made = []
        for table in by_key(batches, keys):
            out = work(table)
            if out is not None and out.num_rows:
                made.append(out)
            if len(made) >= 512:
                yield from pa.Table.from_batches(made).combine_chunks().to_batches()
                made = []
        if made:
            yield from pa.Table.from_batches(made).combine_chunks().to_batches()
        release()

    return rows.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, schema)


class Forest:
    """Union-find over places 0..n-1; the smallest place is the root."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def join(self, places: np.ndarray) -> None:
        """All ``places`` and what hangs together with them become one set."""
        roots = np.unique(self.root[places])
        if len(roots) > 1:
            self.root[np.isin(self.root, roots)] = roots[0]


def linked_sets(n: int, linked: Callable[[int, np.ndarray], np.ndarray]) -> np.ndarray:
    """Roots of the sets that links make; ``linked(i, others)`` says which of ``others`` link with i.

    Places that already hang together are not compared again.
    """
    forest = Forest(n)
    for i in range(n - 1):
        others = np.arange(i + 1, n)
        others = others[forest.root[others] != forest.root[i]]
        if len(others):
            hit = others[linked(i, others)]
            if len(hit):
                forest.join(np.concatenate([[i], hit]))
    return forest.root


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, root) for every node of edges(a, b); root is the smallest node of its connected component.

    Alternating star contraction: each round hangs the larger neighbours of a node, then the smaller ones, on its smallest
    neighbour. Rounds grow with the logarithm of a component's diameter; each is written to the shared folder.
    """
    now = materialize(edges.select("a", "b").filter("a <> b").distinct(), name)
    seen = None
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        large = materialize(large, name)  # every edge now leads from the larger to the smaller node
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(down, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = materialize(moved.unionByName(down.select("a", F.col("m").alias("b"))).distinct(), name)
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    stars = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return stars.unionByName(stars.select(F.col("root").alias("node"), "root").distinct())
