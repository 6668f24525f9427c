"""The pruned join against all pairs."""

import random
import re

import numpy as np

from spendlink.llm import jaccard
from spendlink.llm.common import table


def shingles(text):
    w = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    k = min(5, len(w))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if w else set()


def expected(rows):
    sets = [shingles(t) for _, t in rows]
    where = {}
    for i, s in enumerate(sets):
        for x in s:
            where.setdefault(x, []).append(i)
    parent, links = list(range(len(rows))), [0] * len(rows)

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, s in enumerate(sets):
        common = {}
        for x in s:
            for j in where[x]:
                if j > i:
                    common[j] = common.get(j, 0) + 1
        for j, c in common.items():
            if 5 * c >= 4 * (len(s) + len(sets[j]) - c):
                links[i] += 1
                links[j] += 1
                parent[find(i)] = find(j)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(find(i), []).append(rows[i][0])
    least = {g: min((x is None, x or 0) for x in ids) for g, ids in groups.items()}
    return sorted(((rows[i][0], None if least[find(i)][0] else least[find(i)][1], links[i]) for i in range(len(rows))), key=str)


def run(spark, rows):
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id bigint, text string, node string, n int")
    return sorted((tuple(r) for r in jaccard.near_duplicates(df).select("doc_id", "class_id", "n_links").collect()), key=str)


def test_brute_force(spark, monkeypatch):
    rnd = random.Random(3)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []
    for g in range(25):
        text = [rnd.choice(vocabulary) for _ in range(rnd.choice([6, 30, 120, 400]))]
        for _ in range(rnd.choice([1, 2, 5, 12])):
            copy = list(text)
            for _ in range(rnd.choice([0, 0, 1, 2, 3])):
                copy[rnd.randrange(len(copy))] = rnd.choice(vocabulary)
            rows.append((len(rows), " ".join(copy)))
    rows += [(None, "a b c"), (900, "A, b. c"), (901, None), (902, ""), (903, "!!"), (904, "!!"), (905, "é ü"), (3, rows[3][1]), (906, rows[3][1].upper())]
    rows += [(1000 + i, "one two three four five six " * 3000 + ("x" if i else "")) for i in range(3)]
    assert run(spark, rows) == expected(rows)
    # Small tiles: large groups are cut.
    monkeypatch.setattr(jaccard, "TILE", 3)
    monkeypatch.setattr(jaccard, "BUCKET_TILE", 2)
    assert run(spark, rows) == expected(rows)


def test_ids_that_are_texts(spark):
    """Ids with separators in them do not run into their texts."""
    base = " ".join(f"w{i}" for i in range(60))
    rows = [("k1", base), ("c", base + " end"), ("k2|" + base, "t"), ("k2", base + "|t"), (None, "p|q"), ("-", "p|q"), ("1:x", "y"), ("x", "1:y")]
    df = spark.createDataFrame(rows, "doc_id string, text string")
    out = jaccard.near_duplicates(df).collect()
    assert len({r.key for r in out}) == len(rows)
    linked = {r.doc_id: r.n_links for r in out}
    assert linked["k1"] == 2 and linked["k2|" + base] == 0


def test_dense_intersections():
    rng = np.random.default_rng(5)
    sets = [np.unique(rng.integers(0, 9000, 6000).astype(np.uint64)) for _ in range(12)]
    i, j = np.triu_indices(12, 1)
    want = [len(np.intersect1d(sets[a], sets[b])) for a, b in zip(i, j, strict=True)]
    assert jaccard._intersections(sets, i, j).tolist() == want


def test_empty(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, None)]) == [(1, 1, 0)]


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in table(spark, sf, "documents").collect()]
    got = sorted((tuple(r) for r in jaccard.query(spark, sf).collect()), key=str)
    assert got == expected(rows) and any(r[2] for r in got)
