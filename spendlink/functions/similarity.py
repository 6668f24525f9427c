"""Similarity score of two normalised texts: ``2 * LCS / (len_a + len_b)`` as a rounded percentage.

Spark has no longest-common-subsequence function (``levenshtein`` charges a substitution once, this score charges it
twice), so one Arrow UDF holds the kernel. It works on whole batches: the bit-parallel recurrence
``U = V & M[c]; V = (V + U) | (V - U)`` (Hyyro 2004) runs over all pairs of a slice at once, one text position per
step. Blocking, tiling, filtering and ranking are Spark's work; see ``operators.match``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql.functions import arrow_udf

from spendlink.functions.normalize import fast_form, fuzzy_form

WORD = 64
MAX_WORDS = 16
SIGNATURE_WORDS = 2
SLICE_PAIRS = 1 << 16
MASK_CELLS = 1 << 22
# Characters prepared at once. A batch with more is worked off in parts, so memory does not follow the batch size.
PART_CHARACTERS = 1 << 20
# Texts up to 2 ** NARROW characters share a code table; longer ones only with texts of their own doubling of length.
NARROW = 8
POINT_BITS = 21
ALL_ONES = np.uint64(0xFFFFFFFFFFFFFFFF)


def percent(lcs, total, digits: int):
    """Rounded percentage, half to even; two empty texts score 100."""
    ratio = np.divide(2.0 * lcs, total, out=np.ones(len(total)), where=total > 0)
    return np.round(100.0 * ratio, digits)


def parts(load, budget: int = PART_CHARACTERS):
    """Consecutive slices whose loads sum to at most ``budget``; a row beyond it goes alone."""
    start = total = 0
    for row, n in enumerate(load):
        if row > start and total + n > budget:
            yield start, row
            start, total = row, 0
        total += n
    if start < len(load):
        yield start, len(load)


def characters(strings: pa.Array):
    """Length of each string, null as 0."""
    return pc.fill_null(pc.utf8_length(strings), 0).to_numpy(zero_copy_only=False).astype(np.int64)


class Texts:
    """Code points of a batch of strings, plus a character-occurrence signature per string."""

    def __init__(self, strings: pa.Array):
        strings = pc.fill_null(strings, "")
        self.strings = strings
        self.length = characters(strings)
        self.start = np.cumsum(self.length) - self.length
        self.points = np.frombuffer("".join(strings.to_pylist()).encode("utf-32-le"), dtype=np.uint32)
        self.signature = self._signatures()

    def _signatures(self):
        """One bit per hashed (character, n-th occurrence). A bit set on one side only proves a character unmatched."""
        out = np.zeros((SIGNATURE_WORDS, len(self.length)), dtype=np.uint64)
        if not len(self.points):
            return out
        # Text number and character in one number: sorted, equal characters of a text stand side by side.
        key = (np.repeat(np.arange(len(self.length)), self.length) << POINT_BITS) | self.points
        key.sort()
        new_run = np.concatenate(([True], key[1:] != key[:-1]))
        nth = np.arange(len(key))
        nth -= np.maximum.accumulate(np.where(new_run, nth, 0))
        key &= (1 << POINT_BITS) - 1
        slot = ((key * 7 + nth * 37) % (WORD * SIGNATURE_WORDS)).astype(np.uint8)
        filled = np.flatnonzero(self.length)
        for w in range(SIGNATURE_WORDS):
            bits = np.where(slot // WORD == w, np.uint64(1) << (slot % WORD).astype(np.uint64), np.uint64(0))
            out[w, filled] = np.bitwise_or.reduceat(bits, self.start[filled])
        return out

    def positions(self, rows):
        """Row number, position in the row and code point of every character of the given rows."""
        n = self.length[rows]
        row = np.repeat(np.arange(len(rows)), n)
        place = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        return row, place, self.points[self.start[rows][row] + place]


def lcs_bound(a: Texts, b: Texts, i, j):
    """Upper bound of the LCS length from lengths and signatures."""
    only_a = np.zeros(len(i), dtype=np.int16)
    only_b = np.zeros(len(i), dtype=np.int16)
    for w in range(SIGNATURE_WORDS):
        sa, sb = a.signature[w].take(i), b.signature[w].take(j)
        differing = sa ^ sb
        only_a += np.bitwise_count(differing & sa)
        only_b += np.bitwise_count(differing & sb)
    return np.minimum(a.length.take(i) - only_a, b.length.take(j) - only_b)


def _renumber(values, size: int):
    """Distinct values in order, and the place of each value among them."""
    used = np.zeros(size, dtype=bool)
    used[values] = True
    distinct = np.flatnonzero(used)
    place = np.empty(size, dtype=np.int64)
    place[distinct] = np.arange(len(distinct))
    return distinct, place[values]


def _lcs_words(pattern: Texts, text: Texts, i, j, words: int):
    """Pairs whose pattern fits the given number of machine words; the text may have any length."""
    rows, row_of = _renumber(i, len(pattern.length))
    cols, col_of = _renumber(j, len(text.length))
    pat_row, pat_pos, pat_points = pattern.positions(rows)
    alphabet, pat_code = np.unique(pat_points, return_inverse=True)
    # Column 0 stands for every character absent from the patterns.
    masks = np.zeros((words, len(rows), len(alphabet) + 1), dtype=np.uint64)
    np.bitwise_or.at(masks, (pat_pos // WORD, pat_row, pat_code + 1), np.uint64(1) << (pat_pos % WORD).astype(np.uint64))
    n_txt = text.length[cols]
    width = int(n_txt.max(initial=0))
    codes = np.zeros((width, len(cols)), dtype=np.int32)
    txt_col, txt_pos, txt_points = text.positions(cols)
    if len(alphabet):
        at = np.minimum(np.searchsorted(alphabet, txt_points), len(alphabet) - 1)
        codes[txt_pos, txt_col] = np.where(alphabet[at] == txt_points, at + 1, 0)

    # Longest texts first, so that the pairs still running are a prefix.
    order = np.argsort((width - n_txt)[col_of].astype(np.uint16 if width < 1 << 16 else np.int64), kind="stable")
    row_of, col_of = row_of[order], col_of[order]
    running = np.searchsorted(-n_txt[col_of], -np.arange(width), side="left")
    flat = masks.reshape(words, -1)
    base = row_of * masks.shape[2]
    v = np.full((words, len(order)), ALL_ONES)
    for p in range(width):
        n = running[p]
        at = base[:n] + codes[p].take(col_of[:n])
        carry = None
        for w in range(words):
            old, m = v[w, :n], flat[w].take(at)
            u = old & m
            total = old + u
            if words > 1:
                over = total < u
                if carry is not None:
                    total += carry
                    over |= total < carry
                carry = over.astype(np.uint64)
            v[w, :n] = total | (old ^ u)
    out = np.zeros(len(order), dtype=np.int64)
    length = pattern.length[rows][row_of]
    for w in range(words):
        left = np.clip(length - w * WORD, 0, WORD).astype(np.uint64)
        low = np.where(left >= WORD, ALL_ONES, (np.uint64(1) << (left % np.uint64(WORD))) - np.uint64(1))
        out[order] += np.bitwise_count(~v[w] & low)
    return out


def _lcs_long(pattern: Texts, text: Texts, i, j):
    """Pairs of very long texts: the same recurrence on Python integers, whole texts."""
    out = np.empty(len(i), dtype=np.int64)
    masks, current = {}, -1
    for at in np.argsort(i, kind="stable"):
        row = int(i[at])
        if row != current:
            masks, current = {}, row
            for pos, ch in enumerate(pattern.strings[row].as_py()):
                masks[ch] = masks.get(ch, 0) | (1 << pos)
            full = (1 << int(pattern.length[row])) - 1
        v = full
        for ch in text.strings[int(j[at])].as_py():
            u = v & masks.get(ch, 0)
            v = ((v + u) | (v - u)) & full
        out[at] = int(pattern.length[row]) - v.bit_count()
    return out


def lcs_lengths(a: Texts, b: Texts, i, j):
    """LCS length of each pair ``a[i], b[j]``; the shorter text is the pattern."""
    out = np.empty(len(i), dtype=np.int64)
    la, lb = a.length[i], b.length[j]
    swap = lb < la
    needed = np.maximum(-(-np.minimum(la, lb) // WORD), 1)
    words = 1 << np.ceil(np.log2(needed)).astype(int)
    # The code table of a group is as wide as its longest text, so lengths in it stay within one doubling.
    width = np.maximum(np.ceil(np.log2(np.maximum(np.maximum(la, lb), 1))).astype(int), NARROW)
    kind = words * WORD + width
    for side, (pattern, text, pi, ti) in ((False, (a, b, i, j)), (True, (b, a, j, i))):
        for which in np.unique(kind[swap == side]):
            size = which // WORD
            group = np.flatnonzero((swap == side) & (kind == which))
            step = max(256, len(i) // int(size))
            for at in range(0, len(group), step):
                part = group[at : at + step]
                if size <= MAX_WORDS:
                    out[part] = _lcs_words(pattern, text, pi[part], ti[part], int(size))
                else:
                    out[part] = _lcs_long(pattern, text, pi[part], ti[part])
    return out


def slice_pairs(a: Texts, b: Texts) -> int:
    """Pairs handled at once, so that the mask table stays small even for large alphabets."""
    letters = max(len(np.unique(a.points)), len(np.unique(b.points)), 1)
    return max(256, min(SLICE_PAIRS, MASK_CELLS // letters))


def _pair_score(digits: int):
    @arrow_udf("double")
    def score(left: pa.Array, right: pa.Array) -> pa.Array:
        out = np.empty(len(left))
        for start, end in parts(characters(left) + characters(right)):
            a, b = Texts(left.slice(start, end - start)), Texts(right.slice(start, end - start))
            step = slice_pairs(a, b)
            for at in range(0, end - start, step):
                i = np.arange(at, min(at + step, end - start))
                out[start + i] = percent(lcs_lengths(a, b, i, i), a.length[i] + b.length[i], digits)
        missing = pc.or_(pc.is_null(left), pc.is_null(right)).to_numpy(zero_copy_only=False)
        return pa.array(out, mask=missing)

    return score


def similarity(left: Column, right: Column, digits: int) -> Column:
    """Score of two texts taken as they are."""
    return _pair_score(digits)(left, right)


def fuzzy_score(left: Column, right: Column) -> Column:
    """Token-sort score, a whole number from 0 to 100; both sides normalised."""
    return similarity(fuzzy_form(left), fuzzy_form(right), 0)


def fast_score(query: Column, stored: Column) -> Column:
    """Two-digit score of a normalised query against a stored form taken as is."""
    return similarity(fast_form(query), stored, 2)
