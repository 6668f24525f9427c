"""Dictionary and reference lookups: left joins that keep every item."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlink.functions.concepts import concept_info, first_code
from spendlink.functions.tags import merge_tags, promote_if
from spendlink.operators.spread import spread_join

UNKNOWN = "UNKNOWN"


def left_attach(df: DataFrame, extra: DataFrame, keys: list[str]) -> DataFrame:
    """Left join on null-safe keys that are unique in ``extra``. AQE splits a key that floods one partition."""
    renamed = extra.selectExpr(*(f"`{c}` AS `_k_{c}`" if c in keys else f"`{c}`" for c in extra.columns))
    condition = F.expr(" AND ".join(f"`{c}` <=> `_k_{c}`" for c in keys))
    return df.join(renamed, condition, "left").drop(*(f"_k_{c}" for c in keys))


def enrich_distinct(df: DataFrame, keys: list[str], enrich: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Run ``enrich`` once per distinct input and attach what it adds."""
    return left_attach(df, enrich(df.select(*keys).distinct()), keys)


def canonical_manufacturer(items: DataFrame, aliases: DataFrame, fans: dict[int, int] | None = None) -> DataFrame:
    """``canonical_manufacturer`` from ``(alias, canonical)``; ``UNKNOWN`` without a hit.

    ``fans`` spread the items of frequent manufacturers, see ``operators.spread``.
    """
    named = aliases.selectExpr("alias AS clean_manufacturer", "canonical AS canonical_manufacturer")
    return spread_join(items, named, ["clean_manufacturer"], fans=fans or {}).withColumn(
        "canonical_manufacturer", F.coalesce("canonical_manufacturer", F.lit(UNKNOWN))
    )


def attach_class_code(
    items: DataFrame, predictions: DataFrame, how: str = "inner", fans: dict[int, int] | None = None
) -> DataFrame:
    """First predicted class per surrogate id. Items without a prediction are dropped unless ``how='left'``.

    ``fans`` spread the items of frequent ids, see ``operators.spread``.
    """
    first = predictions.selectExpr(f"CAST(pim_key AS {items.schema['pim'].dataType.simpleString()}) AS pim", "first AS class_code")
    return spread_join(items, first, ["pim"], how, fans=fans or {})


def one_answer(responses: DataFrame, key: str) -> DataFrame:
    """One answer per key, the smallest text, so that a repeated answer does not multiply items."""
    return responses.groupBy(key).agg(F.min("response").alias("response"))


def attach_concept_code(items: DataFrame, responses: DataFrame) -> DataFrame:
    """Concept code by drug name from a table of JSON answers; an untagged item with a code becomes a drug."""
    codes = one_answer(responses, "drug_name").select("drug_name", first_code(F.col("response")).alias("concept_code"))
    coded = left_attach(items, codes, ["drug_name"]).withColumn("concept_code", F.coalesce("concept_code", F.lit("")))
    return coded.withColumn("tag", promote_if(F.col("tag"), F.col("concept_code") != ""))


def concept_answers(responses: DataFrame) -> DataFrame:
    """``(concept_code, info)`` of every XML answer.

    Parsing takes long for the few bytes of an answer, so the answers are dealt to tasks by number: by size, a file or a shuffle of
    a million answers is one or two tasks.
    """
    partitions = int(responses.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = responses.select("concept_code", "response").repartition(partitions)
    return dealt.select("concept_code", concept_info(F.col("response")).alias("info"))


def attach_concept_info(items: DataFrame, responses: DataFrame) -> DataFrame:
    """Brand names, ingredients and species tags by concept code from a table of XML answers."""
    info = concept_answers(one_answer(responses.filter("concept_code <> ''"), "concept_code"))
    none = "cast(array() AS array<string>)"
    return (
        left_attach(items, info, ["concept_code"])
        .withColumns(
            {
                "brand_names": F.expr(f"coalesce(info.brand_names, {none})"),
                "ingredients": F.expr(f"coalesce(info.ingredients, {none})"),
                "tag": merge_tags(F.col("tag"), F.expr(f"coalesce(info.species_tags, {none})")),
            }
        )
        .drop("info")
    )
