"""Rare q-grams of a text: two texts that can reach a score have one of them in common.

A text of length n has n - q + 1 grams; a gram that occurs again is a gram of its own (its second, third, ... occurrence). Let two
texts of lengths a and b have a longest common subsequence of m characters, so a - m characters are deleted and b - m inserted.
A deleted character breaks q grams at most, an inserted one q - 1; what is left is common:
``common >= (2q - 1) m - (q - 1) (a + b + 1)``. A score of c asks for ``m >= c (a + b) / 200``, and the shortest partner that can give
it has ``b = c a / (200 - c)``. That makes a least number of common grams from a text's own length alone. With all grams in one
order, texts that share t of their grams share one of the first ``grams - t + 1`` of either; with the rarest first, those are
few and rare.

Texts too short for a bound of one gram give all their grams, for partners that have a bound, and meet one another in the cell 0.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql.functions import arrow_udf

from spendlink.functions.similarity import PART_CHARACTERS, Texts, characters, parts

#: The share of its length that a text's bound must have for a gram size to be of use. Longer grams are rarer but need a higher score;
#: with shorter ones, most texts of a block share a frequent gram.
USEFUL = {5: 0.45, 4: 0.2}
_STEP = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Grams:
    """``size`` is q; a text of length n shares at least ``slope * n - (size - 1)`` grams with every partner of the score."""

    size: int
    slope: float

    def least_common(self, length):
        return np.ceil(self.slope * length - (self.size - 1) - 1e-6).astype(np.int64)

    def cells_sql(self, length: str) -> str:
        """How many cells a text of a length goes to."""
        least = f"int(ceil({self.slope!r}D * {length} - {self.size - 1} - 1e-6))"
        grams = f"greatest({length} - {self.size - 1}, 0)"
        return f"if({least} < 1, {grams} + 1, {grams} - {least} + 1)"


def gram_plan(score: float) -> Grams | None:
    """The grams to use for a least score in percent; None if no gram size bounds enough."""
    for size, share in USEFUL.items():
        slope = ((2 * size - 1) * score / 200 - (size - 1)) * 200 / (200 - score) if score < 200 else math.inf
        if slope >= share:
            return Grams(size, slope)
    return None


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def gram_tokens(texts: Texts, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Text number and token of every gram; equal grams of a text have tokens by their occurrence. No token is 0."""
    grams = np.maximum(texts.length - size + 1, 0)
    row = np.repeat(np.arange(len(grams)), grams)
    at = np.arange(len(row)) - np.repeat(np.cumsum(grams) - grams, grams) + texts.start[row]
    token = np.zeros(len(row), np.uint64)
    for k in range(size):
        token = _mixed(token * _STEP + texts.points[at + k] + np.uint64(1))
    order = np.lexsort((token, row))
    row, token = row[order], token[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (token[1:] != token[:-1])
    nth = np.arange(len(row)) - np.maximum.accumulate(np.where(new, np.arange(len(row)), 0))
    token = _mixed(token + nth.astype(np.uint64) * _STEP).astype(np.int64)
    return row, np.where(token == 0, 1, token)


def _lists(rows: list[np.ndarray], tokens: list[np.ndarray], count: int) -> pa.Array:
    row = np.concatenate(rows) if rows else np.empty(0, np.int64)
    offsets = np.concatenate(([0], np.cumsum(np.bincount(row, minlength=count))))
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(tokens) if tokens else np.empty(0, np.int64)))


def all_tokens(text: Column, plan: Grams) -> Column:
    """Every gram of a text."""

    @arrow_udf("array<bigint>")
    def tokens(texts: pa.Array) -> pa.Array:
        rows, found = [], []
        for start, end in parts(characters(texts), PART_CHARACTERS):
            row, token = gram_tokens(Texts(texts.slice(start, end - start)), plan.size)
            rows.append(row + start)
            found.append(token)
        return _lists(rows, found, len(texts))

    return tokens(text)


def rare_cells(text: Column, plan: Grams, common: list[tuple[int, int]]) -> Column:
    """The cells of a text: its rarest grams as far as its bound needs them. ``common`` has the counts of frequent tokens; the
    others are rarer than those and ordered by token."""
    known = np.array(sorted(t for t, _ in common), np.int64)
    counts = np.array([n for _, n in sorted(common)], np.int64)

    @arrow_udf("array<bigint>")
    def cells(texts: pa.Array) -> pa.Array:
        rows, found = [], []
        for start, end in parts(characters(texts), PART_CHARACTERS):
            part = Texts(texts.slice(start, end - start))
            row, token = gram_tokens(part, plan.size)
            frequency = np.zeros(len(token), np.int64)
            if len(known):
                place = np.minimum(np.searchsorted(known, token), len(known) - 1)
                frequency = np.where(known[place] == token, counts[place], 0)
            order = np.lexsort((token, frequency, row))
            row, token = row[order], token[order]
            grams = np.bincount(row, minlength=end - start)
            rank = np.arange(len(row)) - np.repeat(np.cumsum(grams) - grams, grams)
            least = plan.least_common(part.length)
            use = rank < np.where(least < 1, grams, grams - least + 1)[row]
            short = np.flatnonzero(least < 1)
            row, token = np.concatenate([row[use], short]), np.concatenate([token[use], np.zeros(len(short), np.int64)])
            order = np.argsort(row, kind="stable")
            rows.append(row[order] + start)
            found.append(token[order])
        return _lists(rows, found, len(texts))

    return cells(text)
