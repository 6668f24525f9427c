"""Repeated strings against a table of all windows; the sort against ``sorted``."""

import hashlib
import random

from hypothesis import given
from hypothesis import strategies as st

from spendlink.llm import suffixes
from spendlink.llm.common import table


def expected(rows):
    """Rows in order of (id, place); every window is looked up among the earlier ones."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0, i))
    seen, out = set(), []
    for i in order:
        text = (rows[i][1] or "").encode()
        gone = bytearray(len(text))
        for a in range(len(text) - 99):
            w = text[a : a + 100]
            if w in seen:
                gone[a : a + 100] = b"\1" * 100
            seen.add(w)
        kept = bytes(b for b, g in zip(text, gone, strict=True) if not g)
        spans = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        out.append((rows[i][0], len(text), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def run(spark, rows):
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id bigint, text string, row string, place int").coalesce(1)
    return sorted((tuple(r)[:5] for r in suffixes.without_repeats(df).collect()), key=str)


def some_rows():
    rnd = random.Random(8)

    def noise(n):
        return "".join(rnd.choice("abcdefgh é") for _ in range(n))

    passages = [noise(n) for n in (99, 100, 101, 130, 400, 1500)]
    rows = []
    for i in range(60):
        parts = [noise(rnd.randrange(0, 250))]
        for _ in range(rnd.randrange(3)):
            p = rnd.choice(passages)
            cut = rnd.randrange(len(p)) if rnd.random() < 0.4 else 0
            parts += [p[cut:], noise(rnd.randrange(0, 60))]
        rows.append((i, "".join(parts)))
    rows += [(i + 100, rows[i][1]) for i in range(5)]
    rows += [(200, "x" * 5000), (201, "x" * 150), (202, "xy" * 300), (203, None), (204, ""), (205, "short"), (5, rows[5][1]), (5, rows[7][1]), (None, passages[4])]
    rnd.shuffle(rows)
    return rows


def test_brute_force(spark, monkeypatch):
    rows = some_rows()
    want = expected(rows)
    assert run(spark, rows) == want
    monkeypatch.setattr(suffixes, "HOT", 3)
    monkeypatch.setattr(suffixes, "CHUNK", 500)
    assert run(spark, rows) == want


@given(st.lists(st.binary(max_size=70).map(lambda b: b"p" * 40 + b) | st.binary(max_size=12), max_size=40))
def test_sort(strings):
    order = suffixes.deep_shallow(strings)
    assert sorted(order) == list(range(len(strings))) and [strings[i] for i in order] == sorted(strings)


@given(st.lists(st.text("ab", max_size=12).map(str.encode), max_size=30))
def test_blind_trie(strings):
    trie = suffixes.BlindTrie(strings)
    for i in range(len(strings)):
        trie.add(i)
    assert [strings[i] for i in trie.order()] == sorted(strings)


def test_empty(spark):
    assert run(spark, []) == []


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in table(spark, sf, "documents").collect()]
    got = sorted((tuple(r) for r in suffixes.query(spark, sf).collect()), key=str)
    assert got == expected(rows) and any(r[2] for r in got)
