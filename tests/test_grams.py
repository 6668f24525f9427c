"""Rare grams lose no pair, and a hot block needs fewer copies with them."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from spendlink.functions.grams import Grams, gram_plan, gram_tokens
from spendlink.functions.similarity import Texts
from spendlink.operators import match
from spendlink.sources.shared import materialize
from tests import model
from tests.test_match import found, frames


def edited(rnd, text, edits, alphabet="abcde fgh"):
    text = list(text)
    for _ in range(edits):
        at = rnd.randrange(len(text) + 1)
        if rnd.random() < 0.5 and text:
            del text[min(at, len(text) - 1)]
        else:
            text.insert(at, rnd.choice(alphabet))
    return "".join(text)


def some_texts(rnd, n, shortest=0, longest=40, alphabet="aabcde fgh"):
    seeds = ["".join(rnd.choices(alphabet, k=rnd.randint(shortest, longest))) for _ in range(n // 4)]
    return [edited(rnd, rnd.choice(seeds), rnd.randrange(8)) for _ in range(n)]


@pytest.mark.parametrize("size", [2, 3, 4, 5])
def test_common_grams_of_any_pair(size):
    rnd = random.Random(size)
    for score in (70, 80, 85, 89.5, 92.5, 95, 99.5, 100):
        slope = ((2 * size - 1) * score / 200 - (size - 1)) * 200 / (200 - score)
        plan = Grams(size, slope)
        for _ in range(400):
            a = "".join(rnd.choices("ab ", k=rnd.randint(0, 40)))
            b = edited(rnd, a, rnd.randrange(9))
            total = len(a) + len(b)
            if total == 0 or 200 * model.lcs(a, b) / total < score:
                continue
            row, token = gram_tokens(Texts(pa.array([a, b])), size)
            common = len(set(token[row == 0].tolist()) & set(token[row == 1].tolist()))
            assert common >= max(plan.least_common(np.array([len(a), len(b)])))


def test_plans():
    assert gram_plan(60) is None and gram_plan(84.5) is None
    assert gram_plan(89.5).size == 4 and gram_plan(94.5).size == 5 and gram_plan(100).size == 5


CASES = [(85, 1, 0), (90, 5, 2), (92, 1, 2), (95, 3, 0), (100, 1, 0)]


def both_sides(spark, rnd, texts):
    """Hot blocks; the candidates are the items, slightly edited, twice."""
    items = [(rnd.choice(["hot", "hot", "b"]), t) for t in texts]
    candidates = [(rnd.choice(["hot", "hot", "c"]), i, edited(rnd, t, rnd.randrange(4))) for i, t in enumerate(texts * 2)]
    return items, candidates, *frames(spark, items, candidates)


@pytest.mark.parametrize("cutoff, k, digits", CASES)
def test_brute_force(spark, cutoff, k, digits):
    """Tiles of 4, so that cells win; short, blank and equal texts."""
    rnd = random.Random(cutoff)
    items, candidates, left, right = both_sides(spark, rnd, [*some_texts(rnd, 60, 0, 24), "", "a", "ab", "aaaaaaaaaaaa", "é\U0001f600ß b é\U0001f600ß"])
    got = match.best_matches(left, right, cutoff=cutoff, k=k, digits=digits, block=["block"], item_tile=4, candidate_tile=4)
    want = model.best(set(items), candidates, cutoff, k, digits)
    assert found(got) == want and len(want) > 10


@pytest.mark.parametrize("cutoff, k, digits", CASES)
def test_no_pair_is_lost(spark, monkeypatch, cutoff, k, digits):
    """More and longer texts, with and without blocks, against the same match without cells."""
    rnd = random.Random(cutoff + 1)
    texts = [*some_texts(rnd, 400), *some_texts(rnd, 60, 60, 300), *some_texts(rnd, 60, 5, 30, "aé\U0001f600ß b")]
    _, _, left, right = both_sides(spark, rnd, texts)

    def results():
        options = {"cutoff": cutoff, "k": k, "digits": digits, "item_tile": 8, "candidate_tile": 8}
        single = match.best_matches(left.select("text"), right.drop("block"), **options)
        blocked = found(match.best_matches(left, right, block=["block"], **options))
        return blocked, {(r.text, r.cand_id, r.score, r.rank) for r in single.collect()}

    with_cells = results()
    monkeypatch.setattr(match, "gram_plan", lambda score: None)
    assert results() == with_cells and len(with_cells[0]) > 100


def test_copies_of_a_hot_block(spark, monkeypatch):
    """Sentences of the given documents in one block, some 400 tiles a side: at least five times fewer rows meet."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    words = F.filter(F.split("text", " "), lambda w: F.length(w) > 2)
    cut = docs.select("doc_id", F.explode(F.transform(F.sequence(F.lit(0), F.lit(5)), lambda i: F.array_join(F.slice(words, i * 6 + 1, 6), " "))).alias("text"))
    texts = materialize(cut.filter("length(text) > 20").distinct(), "sentences")
    left = texts.filter("doc_id % 2 = 0").selectExpr("'x' AS block", "text")
    right = texts.filter("doc_id % 2 = 1").selectExpr("'x' AS block", "doc_id AS cand_id", "text")
    rows = []

    def counted(met, keys, *_):
        rows.append(met.count())
        return met.sparkSession.createDataFrame([], ", ".join(["block string", *(["cell bigint"] if "cell" in keys else []), "text string, cand_id bigint, score double"]))

    monkeypatch.setattr(match, "_hits", counted)
    run = lambda: match.best_matches(left, right, cutoff=95, block=["block"], item_tile=64, candidate_tile=64)
    run()
    by_grams = sum(rows)
    rows.clear()
    monkeypatch.setattr(match, "gram_plan", lambda score: None)
    run()
    assert by_grams > 0 and sum(rows) >= 5 * by_grams, (sum(rows), by_grams)


def test_plan_without_pairs(spark):
    left, right = frames(spark, [("a", "some text of a kind")] * 3, [("a", 1, "some text of the kind")])
    plan = match.best_matches(left, right, cutoff=90, block=["block"])._jdf.queryExecution().executedPlan().toString()
    assert not any(slow in plan for slow in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"))
