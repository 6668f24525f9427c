"""Sharding by a keyed permutation of global row numbers.

Rows get numbers 0 to N-1 in the order of (id, text checksum, size): range partitions hold consecutive runs, a row's
place inside its partition comes from the partition itself, and only one row per partition goes through the window
that adds the starts. A Feistel network permutes the numbers: a number is written as two digits of base
``ceil(sqrt(N))``, and each round adds a keyed hash of one digit to the other. The digits span slightly more than N
numbers; a result of N or more is permuted again until it falls below N (cycle walking), which keeps the map a
permutation of 0..N-1. Shard and slot are the remainder and the quotient of the new number by the shard count, so shard
sizes differ by at most one and slots have no gaps. Anyone who knows N and the seed can compute where a row went.

Null texts have size 1 (no bytes, plus one) and checksum 0. Repeated rows get numbers, hence slots, of their own; rows
with equal id, checksum and size are interchangeable. A null id sorts first. An empty table gives an empty result.
Other columns are left aside.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spendlink.llm.common import table
from spendlink.sources.shared import materialize

ROUNDS = 6
SEED = 20240229
#: A walk can visit every number beyond N once at most. Beyond this many steps (probability under (2/sqrt(N))**64) the
#: job fails instead of returning a wrong place.
MAX_WALK = 64
SLOT_BITS = 33


def permuted(number: Column, rows: int, seed: int = SEED, rounds: int = ROUNDS) -> Column:
    """The place of ``number`` (0 to ``rows`` - 1) in a permutation of the same range."""
    base = max(1, math.isqrt(rows - 1) + 1) if rows else 1
    keys = F.array(*(F.lit(seed + k).cast("bigint") for k in range(rounds)))

    def mixed(pair: Column, key: Column) -> Column:
        left, right = pair["left"], pair["right"]
        noise = F.pmod(F.xxhash64(right, key), F.lit(base))
        return F.struct(right.alias("left"), F.pmod(left + noise, F.lit(base)).cast("bigint").alias("right"))

    def step(value: Column) -> Column:
        start = F.struct(
            F.floor(value / F.lit(base)).cast("bigint").alias("left"), F.pmod(value, F.lit(base)).cast("bigint").alias("right")
        )
        return F.aggregate(keys, start, mixed, lambda pair: pair["left"] * F.lit(base) + pair["right"])

    steps = min(base * base - rows + 1, MAX_WALK)
    walk = F.sequence(F.lit(1), F.lit(max(1, steps)))
    first = F.lit(-1).cast("bigint")
    # -1 stands for "not yet permuted"; from the first step on, only numbers outside the range walk on.
    walked = F.aggregate(
        walk,
        F.struct(number.cast("bigint").alias("at"), first.alias("done")),
        lambda s, _: F.when(s["done"] >= 0, s).otherwise(
            F.transform(
                F.array(step(s["at"])),
                lambda x: F.struct(x.alias("at"), F.when(x < rows, x).otherwise(first).alias("done")),
            )[0]
        ),
        lambda s: s["done"],
    )
    return F.when(walked >= 0, walked).otherwise(F.raise_error(F.lit("the walk did not end")).cast("bigint"))


def numbered(df: DataFrame, order: list[str]) -> tuple[DataFrame, int]:
    """``df`` with ``row`` = 0, 1, 2, ... in ``order``, and the number of rows."""
    placed = materialize(
        df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__slot", F.monotonically_increasing_id()),
        "numbered",
    )
    part = F.shiftright("__slot", SLOT_BITS)
    sizes = placed.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    total = sizes.agg(F.coalesce(F.sum("__n"), F.lit(0))).first()[0]
    placed = placed.withColumn("__part", part).withColumn("__place", F.col("__slot").bitwiseAND(F.lit((1 << SLOT_BITS) - 1)))
    # One row per partition: the broadcast is bounded by the number of partitions.
    joined = placed.join(F.broadcast(starts), "__part")
    return joined.withColumn("row", F.col("__start") + F.col("__place")).drop("__slot", "__part", "__place", "__start"), total


def feistel_shards(df: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for every row."""
    text = F.col(text_col)
    narrow = df.select(
        F.col(id_col).alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("bigint").alias("size"),
        F.crc32(F.coalesce(text, F.lit(""))).alias("text_crc32"),
    )
    rows, total = numbered(narrow, ["doc_id", "text_crc32", "size"])
    rows = rows.withColumn("__to", permuted(F.col("row"), total, seed))
    return rows.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        F.pmod("__to", F.lit(shards)).cast("int").alias("shard"),
        F.floor(F.col("__to") / shards).cast("bigint").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feistel_shards(table(spark, sf_dir, "documents"))
