"""PPM of the registered depth against plain Python, and what depth tells apart."""

import math
import random

import numpy as np
import pytest
from collections import Counter, defaultdict

from spendlink.llm import lm
from spendlink.llm.common import table
from spendlink.llm.queries import QUERIES
from tests.llm.test_lm import SCHEMA, held


class Deep:
    """The same model of any order, symbol by symbol."""

    def __init__(self, texts, order):
        self.order, self.trie = order, defaultdict(Counter)
        for text in texts:
            x = [256] * order + [*text, 256]
            for i in range(order, len(x)):
                for k in range(order + 1):
                    self.trie[tuple(x[i - k : i])][x[i]] += 1

    def probability(self, context, symbol):
        p, excluded = 1.0, set()
        for k in range(self.order, -1, -1):
            counts = {s: n for s, n in self.trie.get(context[self.order - k :], {}).items() if s not in excluded}
            if not counts:
                continue
            escape = len(counts) if len(counts) < 257 - len(excluded) else 0
            total = sum(counts.values()) + escape
            if symbol in counts:
                return p * counts[symbol] / total
            p *= escape / total
            excluded |= set(counts)
        return p / (257 - len(excluded))

    def score(self, text):
        x = [256] * self.order + [*text, 256]
        return sum(math.log10(self.probability(tuple(x[i - self.order : i]), x[i])) for i in range(self.order, len(x)))


def test_registered_depth(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, (r.text or "").encode()) for r in table(spark, sf, "documents").collect()]
    model = Deep([t for i, t in rows if not held(i)], lm.DEPTH)
    got = {r.doc_id: r.score for r in QUERIES["op8_lm_scoring"](spark, sf).collect()}
    some = sorted(rows, key=lambda r: len(r[1]))[::7][:20]
    assert len(got) == len(rows) and lm.DEPTH >= 5
    assert [got[i] for i, _ in some] == pytest.approx([model.score(t) for _, t in some], rel=1e-5)


@pytest.mark.parametrize("order", [2, 3, 5])
def test_odd_texts(spark, order):
    texts = [None, "", "a", "abcabcabcabd", "É\U0001f600 x\x00y", "ab" * 300, "abcabx", "abcdefgh", "zzzzzzzz"] * 3
    rows = [(i, t, "", 1) for i, t in enumerate(texts)] + [(None, "abc", "", 1), (100, "never seen: qqqq", "", 1)]
    plain = Deep([(t or "").encode() for i, t, *_ in rows if not held(i)], order)
    got = lm.lm_scores(spark.createDataFrame(rows, SCHEMA), order).collect()
    want = {i: plain.score((t or "").encode()) for i, t, *_ in rows}
    assert len(got) == len(rows)
    assert {r.doc_id: r.score for r in got} == pytest.approx(want, rel=1e-5)


def test_depth_tells_repeats_from_salad(spark):
    """A held-out text that repeats training text scores above one with the same byte trigrams in another order."""
    rng = random.Random(3)
    words = ["".join(rng.choice("abcde") for _ in range(6)) for _ in range(60)]
    train = " ".join(rng.choice(words) for _ in range(2000))
    salad = train[:2]
    follow = defaultdict(list)
    for i in range(len(train) - 2):
        follow[train[i : i + 2]].append(train[i + 2])
    while len(salad) < 900:
        salad += rng.choice(follow[salad[-2:]])
    out = [i for i in range(100) if held(i)][:2]
    learn = next(i for i in range(100) if not held(i))
    rows = [(learn, train, "", 1), (out[0], train[300:1200], "", 1), (out[1], salad, "", 1)]
    score = {r.doc_id: r.score for r in lm.lm_scores(spark.createDataFrame(rows, SCHEMA), lm.DEPTH).collect()}
    assert score[out[0]] - score[out[1]] > 200


def test_pairs_dense_and_sorted(monkeypatch):
    texts = [b"abracadabra", b"", bytes(range(256)) * 2]
    code, number = lm.pairs(texts, 5)
    monkeypatch.setattr(lm, "DENSE", 0)
    again = lm.pairs(texts, 5)
    assert np.array_equal(code, again[0]) and np.array_equal(number, again[1]) and np.all(np.diff(code) > 0)


def test_pairs_of_large_slices_are_not_sorted(monkeypatch):
    rng = np.random.default_rng(3)
    texts = [rng.integers(0, 256, n, np.uint8).tobytes() for n in (0, 1, 63, 64, 65, 3000)] + [b"abracadabra" * 200]
    monkeypatch.setattr(lm, "DENSE", 0)
    monkeypatch.setattr(lm, "MARKED", 0)
    code, number = lm.pairs(texts, 5)
    monkeypatch.undo()
    monkeypatch.setattr(lm, "DENSE", 0)
    monkeypatch.setattr(lm, "RANKED", 100)
    monkeypatch.setattr(np, "unique", lambda *a, **k: pytest.fail("sorted"))
    again = lm.pairs(texts, 5)
    assert np.array_equal(code, again[0]) and np.array_equal(number, again[1]) and again[1].dtype == np.int32
