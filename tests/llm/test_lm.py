"""PPM with exclusion and the unigram base against plain Python."""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from spendlink.llm import lm
from spendlink.llm.common import table


class Plain:
    """The same model, symbol by symbol."""

    def __init__(self, texts):
        self.trie = defaultdict(Counter)
        for text in texts:
            x = [256, 256, *text, 256]
            for i in range(2, len(x)):
                for order in (0, 1, 2):
                    self.trie[tuple(x[i - order : i])][x[i]] += 1

    def probability(self, context, symbol):
        p, excluded = 1.0, set()
        for order in (2, 1, 0):
            counts = {s: n for s, n in self.trie.get(context[2 - order :], {}).items() if s not in excluded}
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
        x = [256, 256, *text, 256]
        return sum(math.log10(self.probability(tuple(x[i - 2 : i]), x[i])) for i in range(2, len(x)))


def held(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2


def expected(rows):
    texts = [(i, (t or "").encode()) for i, t in rows]
    model = Plain([t for i, t in texts if not held(i)])
    split = [(i, [*re.findall(rb"[^\x20\x09-\x0D]+", t.lower()), b" "]) for i, t in texts]
    c = Counter(w for i, ws in split if not held(i) for w in ws)
    n, v = sum(c.values()), len(c)
    out = []
    for (i, t), (_, ws) in zip(texts, split, strict=True):
        base = sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws)
        out.append((i, held(i), len(ws), sum(c[w] > 0 for w in ws), n, base, model.score(t)))
    return sorted(out, key=str)


def check(got, want):
    assert [r[:5] for r in got] == [r[:5] for r in want]
    for g, w in zip(got, want, strict=True):
        assert g[5:] == pytest.approx(w[5:], rel=1e-5, abs=1e-5)


SCHEMA = "doc_id bigint, text string, row string, training int"


def test_odd_rows(spark):
    rows = [(i, f"The cat {i % 5} sat\ton the Mat É\x0bé x") for i in range(40)]
    rows += [(None, None), (50, ""), (51, None), (3, "The cat"), (3, "The cat"), (52, "the " * 1000 + "aß"), (53, "\U0001f600" * 300), (54, " \n ")]
    got = lm.lm_scores(spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA)).collect()
    check(sorted(map(tuple, got), key=str), expected(rows))


def test_no_training_and_empty(spark):
    only = [(i, "ab") for i in range(60) if held(i)]
    got = lm.lm_scores(spark.createDataFrame([(*r, "", 0) for r in only], SCHEMA)).collect()
    check(sorted(map(tuple, got), key=str), expected(only))
    assert lm.lm_scores(spark.createDataFrame([], SCHEMA)).collect() == []


def test_probabilities_sum_to_one():
    texts = [b"abracadabra", b"", bytes(range(256)) * 2]
    context, symbol, _ = lm.coded(texts)
    values, n = np.unique(context.astype(np.int64) * 257 + symbol, return_counts=True)
    model = lm.Model(values // 257, values % 257, n)
    assert np.allclose((10.0 ** model.log10.astype(float)).sum(axis=1), 1, atol=1e-4)


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in table(spark, sf, "documents").collect()]
    got = sorted(map(tuple, lm.query(spark, sf).collect()), key=str)
    check(got, expected(rows))
    bits = [-r[6] / max(1, len(t or "")) for r, (_, t) in zip(sorted(got), sorted(rows), strict=True)]
    assert np.mean(bits) < np.log10(257)
