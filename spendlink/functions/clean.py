"""Cleaning of raw item fields. Every function maps Column -> Column and stays inside code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Legal-form suffixes, tried once each, in this order. The order decides the result.
LEGAL_SUFFIXES = (
    "t/t",
    "llc",
    "inc",
    "usa",
    "sa",
    "corporation",
    "corp",
    "co",
    "incorporated",
    "i",
)


def clean_description(description: Column) -> Column:
    """Drop ``@``, trim, lower."""
    return F.lower(F.trim(F.translate(description, "@", "")))


def clean_text(text: Column) -> Column:
    """Trim, lower, drop ``, @ .``, fold whitespace runs to one blank, trim."""
    bare = F.translate(F.lower(F.trim(text)), ",@.", "")
    return F.trim(F.regexp_replace(bare, r"\s+", " "))


def strip_legal_suffixes(text: Column) -> Column:
    """Remove trailing legal forms. One pass over the list, so ``a llc inc`` keeps its ``llc``."""
    for suffix in LEGAL_SUFFIXES:
        text = F.regexp_replace(text, f" {suffix}$", "")
    return F.trim(text)


def clean_manufacturer(manufacturer: Column) -> Column:
    return strip_legal_suffixes(clean_text(manufacturer))


def clean_item_number(number: Column) -> Column:
    """Trim and drop leading zeros, keeping the last character of an all-zero number."""
    return F.regexp_replace(F.trim(number), r"^0+(?!$)", "")


def composite_key(number: Column, manufacturer: Column, description: Column) -> Column:
    """``number#manufacturer#description`` with each whitespace run written as ``_``."""
    parts = [F.coalesce(c, F.lit("")) for c in (number, manufacturer, description)]
    return F.regexp_replace(F.concat_ws("#", *parts), r"\s+", "_")


def first_token(clean_desc: Column) -> Column:
    """Text before the first whitespace, without ``,`` and ``.``: the presumed product name."""
    return F.translate(F.get(F.split(clean_desc, r"\s", 2), F.lit(0)), ",.", "")


def after_first_token(clean_desc: Column) -> Column:
    """Text after the first whitespace (strength, form); null for a single token."""
    return F.get(F.split(clean_desc, r"\s", 2), F.lit(1))
