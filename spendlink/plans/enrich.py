"""Enrichment of raw items up to the checkpoint."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlink.functions import clean
from spendlink.operators.dedup import mark_duplicates, with_key, with_surrogate_id
from spendlink.operators.keywords import tag_keywords
from spendlink.operators.lookup import attach_class_code, canonical_manufacturer
from spendlink.operators.products import attach_products
from spendlink.operators.spread import frequent_keys
from spendlink.sources.shared import materialize
from spendlink.sources.sinks import classifier_request


def clean_items(items: DataFrame) -> DataFrame:
    return items.withColumns(
        {
            "clean_description": clean.clean_description(F.col("item_description")),
            "clean_manufacturer": clean.clean_manufacturer(F.col("manufacturer")),
            "clean_number": clean.clean_item_number(F.col("item_number")),
        }
    )


def name_drugs(items: DataFrame, keywords: DataFrame) -> DataFrame:
    """First-token drug name, strength, and the keyword columns."""
    split = items.withColumns(
        {
            "drug_name": clean.first_token(F.col("clean_description")),
            "drug_strength": clean.after_first_token(F.col("clean_description")),
        }
    )
    return tag_keywords(split, keywords)


def prepare(items: DataFrame, aliases: DataFrame, keywords: DataFrame) -> DataFrame:
    """Clean, key, duplicates, canonical manufacturer, drug name and tag. Needs a unique ``row_id``."""
    cleaned = clean_items(items)
    fans = frequent_keys(cleaned, ["clean_manufacturer"])
    return name_drugs(canonical_manufacturer(mark_duplicates(with_key(cleaned)), aliases, fans), keywords)


def enrich(
    items: DataFrame,
    aliases: DataFrame,
    keywords: DataFrame,
    classify: Callable[[DataFrame], DataFrame],
    human: DataFrame,
    animal: DataFrame,
    how: str = "inner",
) -> DataFrame:
    """All enrichment steps. ``classify`` turns the classifier request into predictions ``(pim_key, first)``; items without one are
    dropped unless ``how`` is ``left``.

    The prepared items feed the ids, the request, the product lookup and the result, so they are written out once. The items are
    written before: duplicates are found in one read of them and marked in another, which must number rows alike.
    """
    items = materialize(items, "items")
    numbered = with_surrogate_id(materialize(prepare(items, aliases, keywords), "prepared"))
    predictions = classify(classifier_request(numbered))
    return attach_products(attach_class_code(numbered, predictions, how), human, animal)
