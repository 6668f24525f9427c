"""Duplicate marking and consecutive surrogate ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spendlink.functions.clean import composite_key
from spendlink.sources.shared import materialize

SLOT_BITS = 33


def with_key(items: DataFrame) -> DataFrame:
    return items.withColumn("key", composite_key(F.col("clean_number"), F.col("clean_manufacturer"), F.col("clean_description")))


def mark_duplicates(items: DataFrame, key: str = "key", row_id: str = "row_id") -> DataFrame:
    """``is_duplicate`` is false for the row with the smallest id of its key.

    The survivors come from a partial aggregation and are joined back on the row id, not on the key, so a key held by
    a third of all rows neither sorts in one task nor skews the join.
    """
    survivors = items.groupBy(key).agg(F.min(row_id).alias(row_id)).select(row_id, F.lit(False).alias("is_duplicate"))
    return items.join(survivors, row_id, "left").withColumn("is_duplicate", F.coalesce("is_duplicate", F.lit(True)))


def surrogate_ids(df: DataFrame, key: str = "key", out: str = "pim") -> DataFrame:
    """``(key, id)`` with ids 0, 1, 2, ... in key order over the distinct keys.

    Range partitioning puts the keys in order across partitions; ``monotonically_increasing_id`` numbers them inside
    each partition. The numbered keys are written out, because partition sizes and numbering must come from one and
    the same placement. Only one row per partition goes through the offset window.
    """
    placed = materialize(
        df.select(key)
        .distinct()
        .repartitionByRange(key)
        .sortWithinPartitions(key)
        .withColumn("slot", F.monotonically_increasing_id()),
        "slots",
    ).selectExpr(f"`{key}`", f"shiftright(slot, {SLOT_BITS}) AS part", f"slot & {(1 << SLOT_BITS) - 1} AS place")
    sizes = placed.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    return placed.join(F.broadcast(starts), "part").selectExpr(f"`{key}`", f"start + place AS `{out}`")


def with_surrogate_id(df: DataFrame, key: str = "key", out: str = "pim") -> DataFrame:
    return df.join(surrogate_ids(df, key, out), key)
