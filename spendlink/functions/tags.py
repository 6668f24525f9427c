"""Rules that set or extend the item tag."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DRUG = "Drug"


def promote_if(tag: Column, condition: Column) -> Column:
    """A blank tag becomes ``Drug`` where the condition holds; any other tag stays."""
    return F.when((tag == "") & condition, F.lit(DRUG)).otherwise(tag)


def merge_tags(tag: Column, new_tags: Column) -> Column:
    """Append an array of tags, comma-separated, leaving out blanks on either side."""
    added = F.array_join(F.sort_array(new_tags), ",")
    return F.concat_ws(",", F.nullif(tag, F.lit("")), F.nullif(added, F.lit("")))
