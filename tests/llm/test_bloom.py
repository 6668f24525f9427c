"""Filters before joins: no row is lost, few others pass."""

import random

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from spendlink.llm import jaccard
from spendlink.llm.bloom import bloom, has


def test_no_false_negatives(spark):
    hashes = np.array([r.hash for r in spark.range(4000).select(F.xxhash64("id").alias("hash")).collect()])
    places = spark.range(0, 4000, 40).select(F.xxhash64("id").alias("hash"))
    passed = set(np.flatnonzero(has(bloom(places), hashes)).tolist())
    assert passed >= set(range(0, 4000, 40)) and len(passed) < 110
    assert not has(bloom(places.filter("hash is null")), hashes).any()


def test_kept_texts_are_not_shuffled(spark, tmp_path):
    """Rows are dropped by number, word borders included, without dealing out the texts of those that stay."""
    step = 1 << 33
    numbers = [k * step + i for k in range(3) for i in range(300)]
    rows = [(k % 50, None if k % 7 == 0 else f"text {k}", n) for k, n in enumerate(numbers)] + [(None, "x", 300)]
    spark.createDataFrame(rows, "doc_id bigint, text string, n bigint").write.parquet(f"{tmp_path}/docs")
    drop = {0, 1, 62, 63, 64, 127, 300, step, step + 63, step + 299, 2 * step + 128}
    gone = spark.createDataFrame([(n,) for n in drop] * 2, "row bigint")
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    spark.conf.set(threshold, "-1")
    try:
        left = corpus_pipeline.without(spark.read.parquet(f"{tmp_path}/docs"), "n", gone)
        got = sorted((tuple(r) for r in left.collect()), key=str)
        plan = left._jdf.queryExecution().executedPlan().toString()
        whole = corpus_pipeline.without(spark.read.parquet(f"{tmp_path}/docs"), "n", gone.limit(0))
        assert whole.count() == len(rows)
    finally:
        spark.conf.unset(threshold)
    assert left.columns == ["doc_id", "text"]
    assert got == sorted([(i, t) for i, t, n in rows if n not in drop], key=str)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_only_candidates_are_shipped(spark, monkeypatch):
    """Texts without candidates and buckets of one member are not dealt out."""
    rnd = random.Random(4)
    words = [" ".join(f"w{rnd.randrange(10**6)}" for _ in range(40)) for _ in range(300)]
    rows = [(k, w) for k, w in enumerate(words)] + [(1000, words[7] + " end"), (1001, words[9] + " end")]
    shipped = {}

    def counted(name):
        function = getattr(jaccard, name)

        def run(*args):
            out = function(*args)
            shipped[name] = out.count()
            return out

        return run

    for name in ("packed", "banded_in"):
        monkeypatch.setattr(jaccard, name, counted(name))
    out = {r.doc_id: (r.class_id, r.n_links) for r in jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert out == {k: (k, 0) for k in range(300)} | {k: (k, 1) for k in (7, 9)} | {1000: (7, 1), 1001: (9, 1)}
    assert 4 <= shipped["packed"] < 20 and shipped["banded_in"] < 4 * jaccard.BANDS + 100
