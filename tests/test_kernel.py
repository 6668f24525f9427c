import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from spendlink.functions import similarity, tiles
from tests import model


def random_texts(rnd, n, alphabet="aabcde fgh", longest=30):
    return ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, longest))) for _ in range(n)]


def lists(rows):
    return pa.array(rows, pa.list_(pa.string()))


@pytest.mark.parametrize("budget", [1, 50, 400])
def test_parts_of_a_batch_do_not_change_its_hits(monkeypatch, budget):
    """Rows with empty lists, null texts and texts beyond the budget; a batch that is itself a slice."""
    rnd = random.Random(budget)
    left = lists([[], ["abc", None, ""], *([random_texts(rnd, rnd.randint(0, 6)) for _ in range(30)]), ["ab" * 700, "é|#"]])
    right = lists([["a"], ["abc", ""], *([random_texts(rnd, rnd.randint(0, 6)) for _ in range(30)]), ["ba" * 900, "é|#", "ab"]])
    left, right = left.slice(1), right.slice(1)
    whole = tiles.rank_batch(left, right, 2, 30.0, 2)
    monkeypatch.setattr(tiles, "parts", lambda load: similarity.parts(load, budget))
    assert tiles.rank_batch(left, right, 2, 30.0, 2).equals(whole)
    assert len(tiles.rank_batch(left.slice(0, 0), right.slice(0, 0), 2, 30.0, 2)) == 0


def test_memory_does_not_follow_the_batch():
    """64 MB of texts in meetings of mixed lengths, one text of 200,000 characters among short ones."""
    rnd = random.Random(5)
    texts = ["".join(rnd.choices("abcdefgh ", k=1000)) for _ in range(64)]
    rows = [[texts[(7 * r + n) % 64][: 1 + (r * n) % 1000] for n in range(64)] for r in range(1000)]
    rows[500] = ["".join(rnd.choices("abcdefgh", k=200_000)), *rows[500]]
    left = lists([[t + "x" * 1000 for t in r] for r in rows])
    right = lists([["y" * 100] for _ in rows[:-500]] + [[r[0]] for r in rows[-500:]])
    assert left.nbytes > 64 << 20
    tracemalloc.start()
    try:
        hits = tiles.rank_batch(left, right, 0, 90.0, 1)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert len(hits) == 1000
    assert hits[500].as_py()[0]["score"] >= 90
    assert peak < 1 << 30


def test_code_tables_of_mixed_lengths():
    """One long text among many short ones neither widens their table nor changes a length."""
    rnd = random.Random(9)
    short = random_texts(rnd, 300, longest=60)
    a = similarity.Texts(pa.array([*short, "abcde" * 4_000]))
    b = similarity.Texts(pa.array([*reversed(short), "fgh a" * 12]))
    i = np.arange(301)
    tracemalloc.start()
    try:
        got = similarity.lcs_lengths(a, b, i, i)
        got_long = similarity.lcs_lengths(a, b, np.full(300, 300), np.arange(300))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 16 << 20
    pairs = list(zip([*short, "abcde" * 4_000], [*reversed(short), "fgh a" * 12]))
    assert got[:300].tolist() == [model.lcs(x, y) for x, y in pairs[:300]]
    alone = [similarity.lcs_lengths(a, b, np.array([300]), np.array([j]))[0] for j in (0, 100, 200)]
    assert got_long[::100].tolist() == alone
