"""Heaps of gaps against plain Lloyd rounds in Python integers."""

import hashlib
import math

import duckdb
import numpy as np
import pytest

from spendlink.llm import centroids
from spendlink.llm.common import table


def plain(rows, clusters=40, dim=64, rounds=5):
    kept = [
        (i, [math.floor(256 * x) for x in v]) for i, v in rows
        if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)
    ]
    name = lambda i: hashlib.sha256(f"2:{'' if i is None else i}".encode()).hexdigest()
    center = [v for _, v in sorted(kept, key=lambda r: (name(r[0]), r[1]))[:clusters]]

    def assign():
        d = [[sum((a - b) ** 2 for a, b in zip(v, c, strict=True)) for c in center] for _, v in kept]
        return [min(zip(row, range(len(row)), strict=True)) for row in d]

    for _ in range(rounds):
        best = assign()
        for k in range(len(center)):
            own = [v for (_, v), (_, c) in zip(kept, best, strict=True) if c == k]
            if own:
                center[k] = [sum(column) // len(own) for column in zip(*own, strict=True)]
    best = assign()
    inertia = [sum(d for d, c in best if c == k) for k in range(len(center))]
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in center]
    return sorted(((i, c, d, inertia[c], sum(inertia), digest[c]) for (i, _), (d, c) in zip(kept, best, strict=True)), key=str)


def run(spark, rows, **options):
    df = spark.createDataFrame([(*r, 7, b"clash") for r in rows], "vec_id bigint, embedding array<double>, cluster int, cells binary")
    out = centroids.clustered(df, **options)
    assert out.columns == centroids.COLUMNS
    return sorted((tuple(r) for r in out.collect()), key=str)


def some_rows(n, dim=64, seed=3, spread=0.3):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(25, dim))
    return [(i, (middle[rng.integers(25)] + rng.normal(0, spread, dim)).tolist()) for i in range(n)]


ODD = [None, [], [0.0] * 63, [0.0] * 63 + [None], [math.nan] * 64, [math.inf] + [0.0] * 63, [0.0] * 65]


def test_rounds(spark, monkeypatch):
    rows = some_rows(400) + [(1000 + i, v) for i, v in enumerate(ODD)] + [(None, [0.25] * 64), (3, [-0.25] * 64), (3, [-0.25] * 64)]
    want = plain(rows)
    assert run(spark, rows) == want
    monkeypatch.setattr(centroids, "BLOCK", 7)
    assert run(spark, rows) == want


def test_ties(spark):
    """Vectors midway between centroids, and copies of centroids, go to the smaller number in every round."""
    rows = [(i, [float(x), float(y)]) for i, (x, y) in enumerate((x, y) for x in range(12) for y in range(12))]
    rows += [(200 + i, rows[5][1]) for i in range(30)]
    for clusters in (1, 2, 9):
        for rounds in (0, 1, 6):
            got = run(spark, rows, clusters=clusters, dim=2, rounds=rounds)
            assert got == plain(rows, clusters, 2, rounds)


def test_large_components(spark):
    rows = [(i, [v * 200_000 for v in vector]) for i, vector in some_rows(60, dim=4)]
    rows = [(i, [max(-5e5, min(5e5, x)) for x in v]) for i, v in rows]
    assert run(spark, rows, clusters=5, dim=4) == plain(rows, 5, 4)
    with pytest.raises(Exception, match="would not fit"):
        run(spark, [(1, [6e5] * 4), (2, [0.0] * 4)], clusters=2, dim=4)


def test_small_tables(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, None), (2, [])]) == []
    assert run(spark, some_rows(1)) == plain(some_rows(1))
    same = [(i, [0.5] * 64) for i in range(90)]
    assert run(spark, same) == plain(same)


def test_most_vectors_are_not_rescanned():
    rng = np.random.default_rng(1)
    middle = rng.normal(size=(20, 16)) * 300
    cells = (middle[rng.integers(20, size=900)] + rng.normal(0, 20, (900, 16))).astype(np.int64)
    center = cells[:20].copy()
    block = centroids.Block.first(None, cells, center)
    drifted, seen = np.zeros(20), []
    for _ in range(6):
        new = np.array([cells[block.cluster == k].mean(axis=0) if (block.cluster == k).any() else center[k] for k in range(20)]).astype(np.int64)
        drifted += centroids.shrinkage(center, new)
        center = new
        expired = block.expire(drifted)
        seen.append(len(expired))
        if len(expired):
            block.rescan(expired, center, drifted)
        assert (block.cluster == centroids.squared(cells, center).argmin(axis=1)).all()
        assert sorted(p for heap in block.heaps for _, p in heap) == list(range(900))
    assert seen[-1] < 300


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.vec_id, r.embedding) for r in table(spark, sf, "embeddings").collect()]
    want = plain(rows)
    assert sorted((tuple(r) for r in centroids.query(spark, sf).collect()), key=str) == want
    db = duckdb.connect()
    db.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{sf}/embeddings.parquet'")
    found = db.sql(centroids.SQL)
    order = [found.columns.index(c) for c in centroids.COLUMNS]
    assert sorted((tuple(r[i] for i in order) for r in found.fetchall()), key=str) == want
