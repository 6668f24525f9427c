"""Keyword extraction from cleaned descriptions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlink.functions.tags import DRUG
from spendlink.operators.lookup import enrich_distinct

# Every character that separates tokens, control separators and Unicode blanks included.
TOKEN_BREAK = r"[\\s\\x0b\\x1c-\\x1f\\x85\\p{Z}]+"


def keyword_hits(descriptions: DataFrame, keywords: DataFrame, text: str) -> DataFrame:
    """First hit (``dosage``, ``dosage_fullname``) and all full names (``keywords``) per description with a hit."""
    tokens = descriptions.selectExpr(f"`{text}`", f"posexplode(split(`{text}`, '{TOKEN_BREAK}')) AS (pos, keyword)")
    return (
        tokens.join(keywords, "keyword")
        .groupBy(text)
        .agg(
            F.expr("min(struct(pos, keyword, full_name)) AS first_hit"),
            F.sort_array(F.collect_set("full_name")).alias("keywords"),
        )
        .selectExpr(f"`{text}`", "first_hit.keyword AS dosage", "first_hit.full_name AS dosage_fullname", "keywords")
    )


def tag_keywords(items: DataFrame, keywords: DataFrame, text: str = "clean_description") -> DataFrame:
    """Adds ``dosage``, ``dosage_fullname``, ``keywords`` and ``tag``; blanks where no token is a keyword."""
    found = enrich_distinct(items, [text], lambda d: keyword_hits(d, keywords, text))
    return found.withColumns(
        {
            "tag": F.expr(f"if(dosage IS NULL, '', '{DRUG}')"),
            "dosage": F.expr("coalesce(dosage, '')"),
            "dosage_fullname": F.expr("coalesce(dosage_fullname, '')"),
            "keywords": F.expr("coalesce(keywords, cast(array() AS array<string>))"),
        }
    )
