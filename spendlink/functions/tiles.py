"""Arrow UDF that ranks the candidates of one tile for the item texts of another.

Input rows are pairs of bounded tiles made by Spark; output per row is the list of surviving hits. No pair leaves the
UDF unless it is among the best ``k`` of its item within the tile and reaches the cutoff.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql.functions import arrow_udf

from spendlink.functions.similarity import Texts, characters, lcs_bound, lcs_lengths, parts, percent, slice_pairs

HITS = "array<struct<i: int, j: int, score: double>>"


def _lists(column: pa.ListArray):
    """Flattened texts, first element and size of each list."""
    offsets = column.offsets.to_numpy()
    return column.values.slice(offsets[0], offsets[-1] - offsets[0]), offsets[:-1] - offsets[0], np.diff(offsets)


def _load(column: pa.ListArray):
    """Characters of each list."""
    texts, at, n = _lists(column)
    total = np.concatenate(([0], np.cumsum(characters(texts))))
    return total[at + n] - total[at]


def _top_k(group, score, k: int):
    """Positions of the k best of each group, earlier positions first among equals. Groups come in ascending order."""
    if not len(group):
        return np.empty(0, dtype=np.int64)
    start = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
    if k == 1:
        size = np.diff(np.append(start, len(group)))
        top = np.flatnonzero(score == np.repeat(np.maximum.reduceat(score, start), size))
        return top[np.concatenate(([True], group[top[1:]] != group[top[:-1]]))]
    order = np.lexsort((-score, group))
    first = np.searchsorted(group, group, side="left")
    return np.sort(order[np.arange(len(order)) - first < k])


def _rank_slice(a: Texts, b: Texts, i, j, digits: int, cutoff: float, k: int):
    """Positions and scores of the hits among the pairs ``(i, j)``; ``i`` ascending, ``j`` ascending within ``i``."""
    size = a.length.take(i) + b.length.take(j)
    slack = 0.5 / 10**digits + 1e-9
    bound = np.where(size > 0, 200.0 * lcs_bound(a, b, i, j) / np.maximum(size, 1), 100.0) + slack
    alive = np.flatnonzero(bound >= cutoff)
    i, j, size, bound = i[alive], j[alive], size[alive], bound[alive]
    # The k most promising pairs of each item first; the rest only if they could still reach the k-th score.
    probe = _top_k(i, bound, k)
    score = np.full(len(i), -1.0)
    score[probe] = percent(lcs_lengths(a, b, i[probe], j[probe]), size[probe], digits)
    member = np.cumsum(np.concatenate(([False], i[1:] != i[:-1]))) if len(i) else np.empty(0, dtype=np.int64)
    groups = int(member[-1]) + 1 if len(i) else 0
    floor = np.full(groups, np.inf)
    np.minimum.at(floor, member[probe], score[probe])
    floor[np.bincount(member, minlength=groups) < k] = -1.0
    rest = np.flatnonzero((score < 0) & (bound >= floor[member]))
    score[rest] = percent(lcs_lengths(a, b, i[rest], j[rest]), size[rest], digits)
    good = np.flatnonzero((score >= 0) & (score >= cutoff))
    good = good[_top_k(i[good], score[good], k)]
    return alive[good], score[good]


def _rank_rows(left: pa.ListArray, right: pa.ListArray, digits: int, cutoff: float, k: int) -> pa.ListArray:
    """Hits of each row; all texts of the rows are prepared at once."""
    left_texts, left_at, left_n = _lists(left)
    right_texts, right_at, right_n = _lists(right)
    a, b = Texts(left_texts), Texts(right_texts)
    ends = np.cumsum(left_n.astype(np.int64) * right_n)
    total, step = int(ends[-1]) if len(ends) else 0, slice_pairs(a, b)
    parts = [(np.empty(0, np.int64),) * 3 + (np.empty(0),)]
    for at in range(0, total, step):
        pair = np.arange(at, min(at + step, total))
        row = np.searchsorted(ends, pair, side="right")
        inner = pair - (ends - left_n.astype(np.int64) * right_n)[row]
        i = left_at[row] + inner // right_n[row]
        j = right_at[row] + inner % right_n[row]
        hit, score = _rank_slice(a, b, i, j, digits, cutoff, k)
        parts.append((row[hit], i[hit] - left_at[row[hit]], j[hit] - right_at[row[hit]], score))
    row, i, j, score = (np.concatenate(p) for p in zip(*parts))
    offsets = np.concatenate(([0], np.cumsum(np.bincount(row, minlength=len(left)))))
    hits = pa.StructArray.from_arrays(
        [pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(score, pa.float64())], names=["i", "j", "score"]
    )
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), hits)


def rank_batch(left: pa.ListArray, right: pa.ListArray, digits: int, cutoff: float, k: int) -> pa.ListArray:
    """Hits of each row of a batch of any size, worked off in parts of bounded size; a part has one row at least."""
    ranked = [
        _rank_rows(left.slice(at, end - at), right.slice(at, end - at), digits, cutoff, k)
        for at, end in parts(_load(left) + _load(right))
    ]
    return pa.concat_arrays(ranked or [_rank_rows(left, right, digits, cutoff, k)])


def best_in_tile(items: Column, candidates: Column, digits: int, cutoff: float, k: int) -> Column:
    """Hits ``(i, j, score)`` per row; candidates must come ordered by their tie-break id."""

    @arrow_udf(HITS)
    def rank(left: pa.Array, right: pa.Array) -> pa.Array:
        return rank_batch(left, right, digits, cutoff, k)

    return rank(items, candidates)
