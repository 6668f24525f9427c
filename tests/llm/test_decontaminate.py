"""The positional index against a brute-force search."""

import hashlib
import re
from collections import Counter

import duckdb
import pytest

from spendlink.llm import decontaminate
from spendlink.llm.common import table

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def expected(docs, items):
    wins = {}
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - 9)) if w else ():
            wins.setdefault(tuple(w[i : i + 10]), set()).add(str(item) if item is not None else "")
    out = []
    for doc_id, text in docs:
        w, hit, who, near = words(text), set(), set(), set()
        whole = Counter(w)
        for win, owners in wins.items():
            for i in range(len(w) - len(win) + 1):
                if tuple(w[i : i + len(win)]) == win:
                    hit |= set(range(i, i + len(win)))
                    who |= owners
            need = len(win) - len(win) // 5
            if (Counter(win) & whole).total() >= need and any((Counter(win) & Counter(w[i : i + 19])).total() >= need for i in range(max(1, len(w) - 18))):
                near |= owners
        digest = hashlib.sha256(",".join(sorted(who)).encode()).hexdigest()
        out.append((doc_id, len(w), len(hit), len(who), digest, bool(hit), len(near), ",".join(sorted(near))))
    return sorted(out, key=str)


A = "one two three four five six seven eight nine ten eleven twelve"
DOCS = [
    (1, f"x {A} y"), (2, A.upper().replace(" ", ", ")), (3, "one two three four five six seven eight nine ten"), (4, None), (5, ""),
    (6, "Straße é" * 3 + " kurz und GUT"), (7, "kurz und gut kurz und gut kurz und gut"), (7, "kurz und gut"), (8, "the " * 500), (None, A),
    (9, "two one three four five six seven eight nine ten eleven"), (10, f"{A} " * 200), (11, "ÀB àb"),
]
ITEMS = [(10, A), (9, A), (2, "kurz und gut"), (3, None), (4, " .,;"), (5, "the " * 30), (5, "the"), (None, "ÀB àb"), (77, "absent word")]


def run(spark, docs, items, **more):
    d = spark.createDataFrame([(*x, "clash", 1) for x in docs], "doc_id bigint, text string, row string, n_hit int")
    i = spark.createDataFrame([(*x, "clash") for x in items], "item_id bigint, text string, words string")
    out = decontaminate.contamination(d, i, **more)
    return sorted((tuple(r) for r in out.select(*decontaminate.COLUMNS).collect()), key=str)


@pytest.mark.parametrize("block", [decontaminate.BLOCK, 3])
def test_brute_force(spark, block):
    assert run(spark, DOCS, ITEMS, block=block) == expected(DOCS, ITEMS)


def replaced(text, at, word):
    w = text.split()
    return " ".join([*w[:at], word, *w[at + 1 :]])


def test_proximity(spark, monkeypatch):
    """Every single word replaced, by a word of other documents or by an unknown one; scattered, shuffled and repeated words."""
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    docs = [(k, f"some words {replaced(item, k, 'unknown')} and more") for k in range(10)]
    docs += [(20 + k, replaced(replaced(item, k, "beta"), 9 - k, "gamma")) for k in range(10)]
    docs += [(40, " x ".join(item.split())), (41, " x y ".join(item.split())), (42, " ".join(reversed(item.split()))), (43, "alpha " * 30)]
    docs += [(50 + k, " ".join(w for w in item.split() if w != "alpha")) for k in range(5)]  # alpha is the rarest word
    items = [(1, item), (2, replaced(item, 4, "nowhere")), (3, "the the the the the ox ox ox ox ox"), (4, "one two"), (5, "iota kappa alpha beta gamma")]
    docs += [(60, "the ox the ox the ox the ox"), (61, "the ox the ox the the the the the the the"), (62, "two words and one"), (63, "one two " * 40)]
    want = expected(docs, items)
    assert run(spark, docs, items) == want
    near = {r[0]: r[7].split(",") for r in want}
    assert all("1" in near[k] for k in (*range(10), 40, 42, 50)) and "1" not in near[41] and "2" in near[50]
    monkeypatch.setattr(decontaminate, "SLICE", 3)
    assert run(spark, docs, items, block=7) == want


def test_empty(spark):
    assert run(spark, [], ITEMS) == []
    assert run(spark, DOCS, []) == expected(DOCS, [])
    assert run(spark, [(1, None), (2, "")], ITEMS) == expected([(1, None), (2, "")], ITEMS)


def test_query_and_sql(spark):
    sf = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in table(spark, sf, "documents").select("doc_id", "text").collect()]
    items = [tuple(r) for r in table(spark, sf, "benchmark").select("item_id", "text").collect()]
    got = sorted((tuple(r) for r in decontaminate.query(spark, sf).collect()), key=str)
    assert got == expected(docs, items) and any(r[5] for r in got)
    duck = duckdb.connect()
    for name in ("documents", "benchmark"):
        duck.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    assert sorted(duck.execute(decontaminate.SQL).fetchall(), key=str) == got
