import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from spendlink.operators.match import best_matches
from tests import model


def frames(spark, items, candidates):
    left = spark.createDataFrame(items, "block string, text string")
    return left, spark.createDataFrame(candidates, "block string, cand_id long, text string")


def found(df):
    return {(r.block, r.text, r.cand_id, r.score, r.rank) for r in df.select("block", "text", "cand_id", "score", "rank").collect()}


def random_texts(rnd, n, alphabet="aabcde fgh", longest=30):
    return ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, longest))) for _ in range(n)]


@pytest.mark.parametrize("cutoff, k, digits", [(70, 1, 0), (60, 5, 2), (0, 1, 2), (0, 3, 0), (100, 1, 0)])
def test_equals_brute_force_with_tiny_tiles(spark, cutoff, k, digits):
    """Tiles of 8: one block of 120 texts is cut into many tiles and bands, the small ones are not."""
    rnd = random.Random(cutoff + k)
    blocks = ["hot"] * 8 + ["b", "c"]
    items = [(rnd.choice(blocks), t) for t in random_texts(rnd, 150)]
    candidates = [(rnd.choice(blocks), i, t) for i, t in enumerate(random_texts(rnd, 150) + [t for _, t in items[:20]])]
    left, right = frames(spark, items + items[:30], candidates)
    got = best_matches(left, right, cutoff=cutoff, k=k, digits=digits, block=["block"], item_tile=8, candidate_tile=8)
    assert found(got) == model.best(set(items), candidates, cutoff, k, digits)


def test_long_texts_and_near_equal_ties(spark):
    """Above 200 characters a different text can round to 100 too; the smaller id must win over the equal text."""
    base = "abcdefghij" * 30
    items = [("x", base), ("x", base[:150])]
    candidates = [("x", 5, base), ("x", 3, base + "z"), ("x", 9, base[:150]), ("x", 1, "q" * 300)]
    left, right = frames(spark, items, candidates)
    got = best_matches(left, right, cutoff=50, block=["block"])
    assert found(got) == model.best(set(items), candidates, 50, 1, 0)
    assert {r[2] for r in found(got) if r[1] == base} == {3}


def test_blank_and_null(spark):
    left, right = frames(spark, [("a", ""), ("a", None), (None, "x"), ("z", "x")], [("a", 1, ""), ("a", 2, None), (None, 3, "x")])
    assert found(best_matches(left, right, cutoff=0, block=["block"])) == {("a", "", 1, 100.0, 1)}


def test_without_block(spark):
    rnd = random.Random(5)
    items, candidates = random_texts(rnd, 60), random_texts(rnd, 40)
    left = spark.createDataFrame([(t,) for t in items], "text string")
    right = spark.createDataFrame(list(enumerate(candidates)), "cand_id long, text string")
    got = best_matches(left, right, cutoff=55, item_tile=16, candidate_tile=16)
    expected = model.best({(0, t) for t in items}, [(0, i, t) for i, t in enumerate(candidates)], 55, 1, 0)
    assert {(0, r.text, r.cand_id, r.score, r.rank) for r in got.collect()} == expected


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.text("ab c", max_size=12), min_size=1, max_size=12),
    st.lists(st.text("ab c", max_size=12), min_size=1, max_size=12),
    st.sampled_from([0, 50, 80]),
    st.sampled_from([1, 2]),
)
def test_property(spark, items, candidates, cutoff, k):
    rows = [("x", i, t) for i, t in enumerate(candidates)]
    left, right = frames(spark, [("x", t) for t in items], rows)
    got = best_matches(left, right, cutoff=cutoff, k=k, block=["block"], item_tile=3, candidate_tile=3)
    assert found(got) == model.best({("x", t) for t in items}, rows, cutoff, k, 0)


def test_plan_has_no_pairwise_join(spark):
    left, right = frames(spark, [("a", "x")], [("a", 1, "y")])
    plan = best_matches(left, right, cutoff=70, block=["block"])._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in plan
    for slow in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert slow not in plan
