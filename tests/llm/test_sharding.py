"""Feistel sharding against a plain loop."""

import math
import struct
import zlib

import xxhash
from pyspark.sql import functions as F

from spendlink.llm import sharding

SCHEMA = "doc_id bigint, text string, shard string, row string"


def model(number, rows, seed=sharding.SEED):
    base = math.isqrt(rows - 1) + 1
    while True:
        left, right = divmod(number, base)
        for k in range(sharding.ROUNDS):
            h = xxhash.xxh64(struct.pack("<q", right), seed=42).intdigest()
            h = xxhash.xxh64(struct.pack("<q", seed + k), seed=h).intdigest()
            h -= (h >> 63) << 64
            left, right = right, (left + h % base) % base
        number = left * base + right
        if number < rows:
            return number


def test_permutation(spark):
    for n in (1, 2, 3, 5, 10, 17, 100, 1000, 1025):
        got = [r[0] for r in spark.range(n).select(sharding.permuted(F.col("id"), n)).collect()]
        assert sorted(got) == list(range(n))
        if n > 1:
            assert got == [model(i, n) for i in range(n)]


def test_rows_law_with_odd_rows(spark):
    rows = [(i, f"text {i}", "clash", None) for i in range(50)] + [(3, "text 3", "clash", None)] * 4
    rows += [(None, None, None, None), (60, "", None, None), (61, None, None, None), (62, "é" * 1000, None, None)]
    out = sharding.feistel_shards(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(out) == len(rows)
    counts = {}
    for r in out:
        counts.setdefault(r.shard, []).append(r.slot)
    assert max(map(len, counts.values())) - min(map(len, counts.values())) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in counts.values())
    expected = sorted((-1 if i is None else i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, *_ in rows)
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.size, r.text_crc32) for r in out) == expected
    again = sharding.feistel_shards(spark.createDataFrame(rows[::-1], SCHEMA).repartition(5)).collect()
    assert sorted(map(str, again)) == sorted(map(str, out))


def test_empty(spark):
    assert sharding.feistel_shards(spark.createDataFrame([], SCHEMA)).collect() == []


def test_query(spark):
    out = sharding.query(spark, "/root/testdata/sf0.001")
    assert out.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    got = sorted((r.shard, r.slot) for r in out.collect())
    n = len(got)
    assert got == sorted((i % 8, i // 8) for i in range(n))
