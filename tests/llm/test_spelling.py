"""The trie frontier against all pairs of words."""

import random
import re
import zlib
from collections import Counter

import duckdb

from spendlink.llm import spelling
from spendlink.llm.common import table

LOWER = {c: c + 32 for c in range(0x41, 0x5B)}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def counted(rows):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    return {w: k for w, k in n.items() if len(w) >= 7 and k >= 2}


def expected(rows):
    n = counted(rows)
    near = {w: [v for v in n if abs(len(w) - len(v)) < 2 and one_edit(w, v)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return sorted((w, form[w], root(w), n[w], len(near[w]), n[form[w]] if form[w] else None) for w in n)


def run(spark, rows):
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id bigint, text string, word string, n int")
    out = spelling.variants(df)
    assert out.columns == spelling.COLUMNS
    return sorted(tuple(r) for r in out.collect())


def test_words(spark):
    """Runs, letters beyond ASCII, left-out code points, ids that are null."""
    rng = random.Random(2)
    some = ["Überzeugung", "überzeugung", "naïveté_", "ÀÉÎÕÜÿþ", "straße", "x÷y×zabcd", "Élan" * 3, "abcdefgħijklm", "Zürichseén"]
    rows = [(rng.choice([None, *range(500)]), " ".join(rng.choices(some, k=6))) for _ in range(400)] + [(1, None), (2, "")]
    assert run(spark, rows) == expected(rows)


def test_all_pairs(spark, monkeypatch):
    """Random words over few letters are near one another in every way, repeated letters and chains of forms among them."""
    monkeypatch.setattr(spelling, "SPLIT", 5)
    rng = random.Random(4)
    words = {"".join(rng.choices("abÿ", weights=(6, 3, 1), k=rng.randrange(7, 11))) for _ in range(700)} | {"a" * k for k in range(6, 30)}
    words |= {"aaaaaaab" + "c" * k for k in range(12)} | {"q" * 300, "q" * 301, "q" * 150 + "r" + "q" * 150}
    times = {w: rng.choice([1, 2, 2, 3, 20, 30, 400]) for w in sorted(words)}
    rows = [(i, f"{w} " * k) for i, (w, k) in enumerate(times.items())]
    got = run(spark, rows)
    assert got == expected(rows)
    assert any(r[1] is not None and r[1] != r[2] for r in got)  # chains of forms


def test_small_tables(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, "short words only"), (2, None)]) == []
    assert run(spark, [(i, "singular") for i in range(40)]) == expected([(i, "singular") for i in range(40)])


def test_long_word(spark):
    rows = [(i, "k" * 20_000 + tail) for i in range(6) for tail in (" ", "z ")]
    assert run(spark, rows) == expected(rows)


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in table(spark, sf, "documents").collect()]
    want = expected(rows)
    assert sorted(tuple(r) for r in spelling.query(spark, sf).collect()) == want
    db = duckdb.connect()
    db.sql(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    found = db.sql(spelling.SQL)
    order = [found.columns.index(c) for c in spelling.COLUMNS]
    assert sorted(tuple(r[i] for i in order) for r in found.fetchall()) == want
