"""The projection forest against all pairs."""

import math

import numpy as np

from spendlink.llm import embeddings
from spendlink.llm.common import table


def expected(rows):
    v = [embeddings.unit(x) for _, x in rows]
    ids, parent, links = [i for i, _ in rows], list(range(len(rows))), [0] * len(rows)

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a + 1, len(rows)):
            if v[a] is not None and v[b] is not None and len(v[a]) == len(v[b]) and v[a] @ v[b] >= 0.95:
                links[a] += 1
                links[b] += 1
                parent[find(a)] = find(b)
    least = {}
    for i in range(len(rows)):
        key = (ids[i] is None, ids[i] or 0)
        least[find(i)] = min(least.get(find(i), key), key)
    root = [None if least[find(i)][0] else least[find(i)][1] for i in range(len(rows))]
    return sorted(((ids[i], links[i], root[i], ids[i] == root[i]) for i in range(len(rows))), key=str)


def run(spark, rows, **fitted):
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], "vec_id bigint, embedding array<double>, node string, n int")
    return sorted((tuple(r) for r in embeddings.near_vectors(df, **fitted).collect()), key=str)


def some_rows():
    rng = np.random.default_rng(2)
    rows = []
    for center in rng.normal(size=(20, 16)):
        rows += [(len(rows) + k, (center + rng.normal(0, s, 16)).tolist()) for k, s in enumerate(rng.choice([0.0, 0.05, 0.2], 8))]
    odd = [None, [], [0.0] * 16, [1.0, None] * 8, [math.nan] * 16, [math.inf] + [0.0] * 15, [1.0, 2.0], [2.0, 4.0], [1e300] * 16, [1e-300] * 16]
    rows += [(1000 + i, x) for i, x in enumerate(odd)] + [(None, rows[0][1]), (None, None), (3, rows[3][1])]
    return rows


def test_brute_force(spark, monkeypatch):
    rows = some_rows()
    want = expected(rows)
    assert run(spark, rows) == want
    monkeypatch.setattr(embeddings, "TILE", 3)
    assert run(spark, rows, trees=8, leaf=16, sample=64) == want


def test_empty(spark):
    assert run(spark, []) == []
    assert run(spark, [(5, None)]) == [(5, 0, 5, True)]


def test_recall(spark):
    """Links found against brute force, most of them just above the threshold: at least 0.9."""
    sf = "/root/testdata/sf0.1"
    given = [(r.vec_id, r.embedding) for r in table(spark, sf, "embeddings").collect()]
    v = np.array([embeddings.unit(x) for _, x in given])
    rng = np.random.default_rng(4)
    noise = rng.normal(size=v.shape)
    noise -= (noise * v).sum(axis=1, keepdims=True) * v
    noise /= np.linalg.norm(noise, axis=1, keepdims=True)
    cosine = rng.uniform(0.95, 0.97, (len(v), 1))
    near = cosine * v + np.sqrt(1 - cosine**2) * noise
    rows = given + [(100_000 + i, x.tolist()) for i, x in enumerate(near)]
    u = np.concatenate([v, [embeddings.unit(x) for x in near.tolist()]])
    true = (u @ u.T >= 0.95).sum(axis=1) - 1
    got = {r[0]: r[1] for r in run(spark, rows)}
    found = np.array([got[i] for i, _ in rows])
    assert (found <= true).all() and true.sum() >= 2000
    assert found.sum() >= 0.97 * true.sum(), found.sum() / true.sum()


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.vec_id, r.embedding) for r in table(spark, sf, "embeddings").collect()]
    assert sorted((tuple(r) for r in embeddings.query(spark, sf).collect()), key=str) == expected(rows)
