"""Match of every item description against the priority list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlink.functions.tags import promote_if
from spendlink.operators.lookup import left_attach
from spendlink.operators.match import SCORERS, best_matches
from spendlink.sources.shared import materialize


def priority_entries(priority: DataFrame, scorer: str) -> DataFrame:
    """Distinct clean descriptions with the row number and the original text of their first row."""
    column = "processed_clean_desc" if SCORERS[scorer].stored_form else "clean_description"
    first = F.expr("min(struct(row_no, item_description)) AS first_row")
    return priority.groupBy(F.col(column).alias("clean")).agg(first).selectExpr(
        "clean", "first_row.row_no AS cand_id", "first_row.item_description AS priority_desc"
    )


def match_priority(
    items: DataFrame, priority: DataFrame, *, scorer: str, cutoff: float, reused: bool = False
) -> DataFrame:
    """Adds ``priority_flag``, ``priority_accuracy`` and ``priority_desc``; a flagged untagged item becomes a drug.

    ``reused`` writes the matches out first, for callers that need the new tag more than once.
    """
    rule = SCORERS[scorer]
    entries = priority_entries(priority, scorer)
    keyed = items.withColumn("_text", rule.item_form(F.coalesce("item_description", F.lit(""))))
    best = best_matches(
        keyed.selectExpr("_text AS text"),
        entries.select(rule.candidate_form(F.col("clean")).alias("text"), "cand_id"),
        cutoff=cutoff,
        digits=rule.digits,
    )
    named = best.join(entries, "cand_id").selectExpr("text AS _text", "score AS priority_accuracy", "priority_desc")
    if reused:
        named = materialize(named, "priority-matches")
    flagged = left_attach(keyed, named, ["_text"]).drop("_text")
    return flagged.withColumn("priority_flag", F.col("priority_accuracy").isNotNull()).withColumn(
        "tag", promote_if(F.col("tag"), F.col("priority_flag"))
    )
