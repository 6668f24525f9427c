"""Which of many needles each text contains: the kernel of the substring join, on UTF-8 bytes.

A needle without blanks or punctuation lies inside one word of a text, and texts share most of their words. So the needles of a
word are found once per tile, by looking its windows up in a table, and a text takes the union over its distinct words.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa

#: ASCII letters, digits and every byte from 0x80 on are part of words, all else is a blank. Any classes would do that judge each
#: byte alone, the same way in needles and texts.
BLANKED = bytes(b if 0x30 <= b <= 0x39 or 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))
#: Longest window looked up. A longer word of a needle is looked up by its first bytes and then compared.
WINDOW = 16
HEAD = 4


def words(text: bytes) -> list[bytes]:
    return text.translate(BLANKED).split()


class Heads(dict):
    """By the first ``HEAD`` bytes at a place: the keys of words that begin there, and the lengths of longer ones to look up."""

    def __init__(self, keys_of_words: set[bytes]):
        super().__init__()
        self.keys_of_words = keys_of_words
        self.longer: dict[bytes, set[int]] = {}
        for key in keys_of_words:
            if len(key) > HEAD:
                self.longer.setdefault(key[:HEAD], set()).add(len(key))

    def __missing__(self, head: bytes) -> tuple[tuple[bytes, ...], tuple[int, ...]]:
        short = tuple(w for n in range(1, len(head) + 1) if (w := head[:n]) in self.keys_of_words)
        self[head] = found = short, tuple(self.longer.get(head, ()))
        return found


class Needles(dict):
    """Distinct needles; as a dictionary, the numbers of those that are sure to be in a text, by word of the text.

    A needle is sure to be in a text with the word if it is one word of ``WINDOW`` bytes at most. Others are possible, and are sought
    in the text: those found by their key, the first bytes of that word of theirs which the fewest needles have (``doubts``).
    Needles without words are sought in every text.
    """

    def __init__(self, needles: list[bytes]):
        super().__init__()
        self.needles = needles
        self.sure: dict[bytes, int] = {}
        self.possible: dict[bytes, list[int]] = {}
        self.everywhere: list[int] = []
        self.doubts: dict[bytes, list[int]] = {}
        keys = [[w[:WINDOW] for w in words(n)] for n in needles]
        shared = Counter(k for own in keys for k in set(own))
        for number, (needle, own) in enumerate(zip(needles, keys, strict=True)):
            if not own:
                self.everywhere.append(number)
            elif own == [needle]:
                self.sure[needle] = number
            else:
                key = min(own, key=lambda k: (shared[k], -len(k), k))
                self.possible.setdefault(key, []).append(number)
        self.heads = Heads(self.sure.keys() | self.possible.keys())

    def __missing__(self, word: bytes) -> tuple[int, ...]:
        hits, windows, heads = set(), set(), self.heads
        for i in range(len(word)):
            short, lengths = heads[word[i : i + HEAD]]
            if short:
                windows.update(short)
            for size in lengths:
                if (w := word[i : i + size]) in heads.keys_of_words:
                    windows.add(w)
        for w in windows:
            if w in self.sure:
                hits.add(self.sure[w])
            if w in self.possible:
                self.doubts.setdefault(word, []).extend(self.possible[w])
        self[word] = found = tuple(hits)
        return found

    def inside(self, text: bytes) -> list[int]:
        """Numbers of the needles that ``text`` contains, in order."""
        own = set(words(text))
        hits = set().union(*map(self.__getitem__, own))
        doubtful = set(self.everywhere).union(*(self.doubts[w] for w in own & self.doubts.keys()))
        hits.update(m for m in doubtful if self.needles[m] in text)
        return sorted(hits)


def contained(needles: pa.Array, texts: pa.Array) -> pa.Array:
    """For each binary text, the list of the binary ``needles`` inside it."""
    table = Needles(needles.to_pylist())
    hits = [table.inside(t.as_py()) for t in texts]
    offsets = np.concatenate(([0], np.cumsum([len(h) for h in hits]))).astype(np.int32)
    numbers = np.fromiter((m for h in hits for m in h), dtype=np.int64, count=int(offsets[-1]))
    return pa.ListArray.from_arrays(pa.array(offsets), needles.take(pa.array(numbers)))
