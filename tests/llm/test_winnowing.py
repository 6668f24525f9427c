"""Winnowing against a plain walk over all windows, and its guarantee on shared runs."""

import hashlib
import random
from functools import lru_cache

import numpy as np
import pytest

from spendlink.llm import winnowing
from spendlink.llm.common import table

M = 1 << 64


@lru_cache(1 << 20)
def scrambled(x):
    for _ in range(2):
        x = (x ^ (x >> 32)) * 0xD6E8FEB86659FD93 % M
    return x ^ (x >> 32)


STEP = pow(0x9E3779B97F4A7C15, -1, M)


def gram_hash(gram):
    value = 0
    for c in reversed(gram):
        value = (value * STEP + scrambled(ord(c) + 1)) % M
    return scrambled(value) >> 20


def plain(text, gram=winnowing.GRAM, window=winnowing.WINDOW):
    if not text:
        return []
    gram = min(gram, len(text))
    known = {g: gram_hash(g) for g in {text[i : i + gram] for i in range(len(text) - gram + 1)}}
    h = [known[text[i : i + gram]] for i in range(len(text) - gram + 1)]
    keys = [(x, -i) for i, x in enumerate(h)]
    window = min(window, len(h))
    chosen = {-min(keys[s : s + window])[1] for s in range(len(h) - window + 1)}
    return [(i, h[i]) for i in sorted(chosen)]


def fingerprint(text):
    at, h = winnowing.winnow(winnowing.code_points(text))
    return list(zip(at.tolist(), h.tolist(), strict=True))


def some_text(rng, n, letters="abcé\U0001f600 "):
    return "".join(rng.choice(letters) for _ in range(n))


def test_chosen_grams(monkeypatch):
    rng = random.Random(3)
    texts = ["", "a", "ab" * 9, "x" * 19, "x" * 20, "x" * 64, "x" * 300, "ab" * 200, *(some_text(rng, n) for n in (21, 63, 64, 65, 500, 3000))]
    for text in texts:
        assert fingerprint(text) == plain(text)
    monkeypatch.setattr(winnowing, "CHUNK", 64)
    winnowing.powers.cache_clear()
    for text in texts:
        assert fingerprint(text) == plain(text)
    winnowing.powers.cache_clear()


def test_rightmost_of_ties():
    text = "q" * 200  # all grams are equal: every window chooses its last
    assert [p for p, _ in fingerprint(text)] == list(range(winnowing.WINDOW - 1, 200 - winnowing.GRAM + 1))


def test_guarantee():
    rng = random.Random(8)
    for _ in range(200):
        run = some_text(rng, winnowing.GRAM + winnowing.WINDOW - 1)
        (x, a), (y, b) = ((some_text(rng, rng.randrange(200)), some_text(rng, rng.randrange(200))) for _ in range(2))
        left, right = fingerprint(x + run + a), fingerprint(y + run + b)
        own = {(p - len(x), h) for p, h in left} & {(p - len(y), h) for p, h in right}
        assert any(0 <= p <= winnowing.WINDOW - 1 for p, _ in own)


def likeness(a, b):
    a, b = {h for _, h in a}, {h for _, h in b}
    return len(a & b) / len(a | b) if a or b else 1.0


def expected(rows):
    key = lambda r: (r[0] is not None, r[0] or 0)
    rows = sorted(((i, t or "") for i, t in rows), key=key, reverse=True)
    out = []
    for k, (doc_id, text) in enumerate(rows):
        following = rows[(k + 1) % len(rows)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        a, b, c = plain(text), plain(edited), plain(following)
        written = [",".join(f"{h:011x}:{p}" for p, h in f) for f in (a, b)]
        out.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), *written, likeness(a, b), likeness(a, c)))
    return out


def run(spark, rows):
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id bigint, text string, block string, copies int")
    out = winnowing.with_neighbours(df)
    assert out.columns == winnowing.COLUMNS
    return [tuple(r) for r in out.collect()]


def test_neighbours(spark):
    rng = random.Random(5)
    rows = [(i, some_text(rng, rng.randrange(400))) for i in rng.sample(range(-50, 10_000), 120)] + [(None, some_text(rng, 90))]
    rows += [(20_000, None), (20_001, ""), (20_002, "y" * 70_000)]
    assert sorted(run(spark, rows), key=str) == sorted(expected(rows), key=str)


def test_small_tables(spark):
    assert run(spark, []) == []
    for rows in ([(1, "alone " * 30)], [(None, None)], [(1, "a" * 100), (2, "b" * 100)]):
        assert sorted(run(spark, rows), key=str) == sorted(expected(rows), key=str)


def test_repeated_rows(spark):
    """Copies have one another next, the last has what follows; rows of one id stay together."""
    a, b, c = "alpha " * 40, "beta " * 40, "gamma " * 40
    out = run(spark, [(5, a)] * 7 + [(4, b), (4, c)])
    assert sorted(r[0] for r in out) == [4, 4] + [5] * 7
    assert sum(r[6] == 1.0 for r in out) == 6  # one of the seven is next to a text of id 4
    assert {(r[0], r[3]) for r in out} == {(5, winnowing.written(*winnowing.winnow(winnowing.code_points(a))))} | {
        (4, winnowing.written(*winnowing.winnow(winnowing.code_points(t)))) for t in (b, c)
    }
    assert len({r[3] for r in run(spark, [(i, a) for i in range(30)])}) == 1


def test_operator(spark):
    rows = [(1, None), (2, "z" * 100), (None, "abc")]
    got = {r.doc_id: r for r in winnowing.fingerprints(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert [(x.position, x.hash) for x in got[2].fingerprint] == plain("z" * 100)
    assert got[1].n_chars == 0 and got[1].fingerprint == [] and len(got[None].fingerprint) == 1


@pytest.mark.parametrize("size", [2_000_000])
def test_long_text(size):
    """Chunks of a long text choose what the whole does."""
    rng = np.random.default_rng(1)
    points = rng.integers(97, 105, size).astype(np.uint32)
    at, h = winnowing.winnow(points)
    part, own = winnowing.winnow(points[700_000:900_000])
    inner = slice(200, -200)
    assert set(zip((part[inner] + 700_000).tolist(), own[inner].tolist(), strict=True)) <= set(zip(at.tolist(), h.tolist(), strict=True))
    assert np.diff(at).max() <= winnowing.WINDOW


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in table(spark, sf, "documents").collect()]
    assert sorted(tuple(r) for r in winnowing.query(spark, sf).collect()) == sorted(expected(rows))
