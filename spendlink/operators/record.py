"""Price records behind a match."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlink.schema import PRICE_STATISTICS

STDDEV = "stdevprice"


def effective_prices(prices: DataFrame) -> DataFrame:
    """One set of statistics per record: the invoice value if present, else the purchase-order value.

    A missing deviation counts as 0 on either side before the choice, so the invoice's 0 wins over the order's value.
    """
    chosen = [
        f"coalesce({c}invoice, 0) AS {name}" if c == STDDEV else f"coalesce({c}invoice, {c}po) AS {name}"
        for c, name in PRICE_STATISTICS.items()
    ]
    return prices.selectExpr(
        "id", "proddesc AS matched_item", "uom", "totalnumberoforders AS number_of_orders", *chosen
    )


def new_spend_records(prices: DataFrame) -> DataFrame:
    return prices.selectExpr(
        "id",
        "itemdesc AS matched_item",
        "quantity",
        "manufacturer AS matched_manufacturer",
        "pricepaid AS price_paid",
        "totalspend AS total_spend",
        "uom",
    )


def record_id_by_text(records: DataFrame, text: str) -> DataFrame:
    """Smallest record id per text: the row a fetch by description returns."""
    return records.groupBy(F.col(text).alias("description")).agg(F.min("id").alias("id"))


def fetch_by_id(matches: DataFrame, records: DataFrame) -> DataFrame:
    """Left join on ``id``: only winners carry the wide record; a winner without a record keeps its score.

    Of repeated ids the least record counts, so a match never multiplies. Matches without an id go around the join.
    """
    wide = [c for c in records.columns if c != "id"]
    one = records.filter("id IS NOT NULL").groupBy("id").agg(F.min(F.struct(*wide)).alias("r")).select("id", "r.*")
    found = matches.filter("id IS NOT NULL").join(one, "id", "left")
    return found.unionByName(matches.filter("id IS NULL"), allowMissingColumns=True)
