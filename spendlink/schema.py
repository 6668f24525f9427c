"""Schemas and column lists of the data that enters and leaves the engine."""

from __future__ import annotations

from pyspark.sql import types as T

# External column names of the item sheet, in position order.
ITEM_SHEET = T.StructType(
    [
        T.StructField("Item_Description", T.StringType()),
        T.StructField("Item Number ", T.StringType()),
        T.StructField("Manufacturer", T.StringType()),
    ]
)
ITEM_COLUMNS = ["item_description", "item_number", "manufacturer"]

# External columns of the class-code predictions. Probabilities are numbers here.
PREDICTIONS = T.StructType(
    [T.StructField("pim_key", T.LongType())]
    + [
        T.StructField(name, T.StringType())
        for name in (
            "company_name",
            "part_number",
            "description",
            "data_set",
            "first",
            "secondCategory",
            "thirdCategory",
        )
    ]
    + [T.StructField(name, T.DoubleType()) for name in ("1stProb", "2ndProb", "3rdProb")]
)

# Checkpoint: our column names in position order, with types.
CHECKPOINT = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("item_description", T.StringType()),
        T.StructField("item_number", T.StringType()),
        T.StructField("manufacturer", T.StringType()),
        T.StructField("canonical_manufacturer", T.StringType()),
        T.StructField("drug_name", T.StringType()),
        T.StructField("tag", T.StringType()),
        T.StructField("is_duplicate", T.BooleanType()),
        T.StructField("pim", T.LongType()),
        T.StructField("class_code", T.StringType()),
        T.StructField("proprietary_name", T.StringType()),
        T.StructField("non_proprietary_name", T.StringType()),
        T.StructField("ndc", T.StringType()),
        T.StructField("ndc_labeler", T.StringType()),
        T.StructField("ndc_accuracy", T.DoubleType()),
    ]
)

# The nine statistics stored once per purchase order side and once per invoice side.
PRICE_STATISTICS = {
    "totalnumberofunitspurchased": "total_quantity",
    "minprice": "min_price",
    "maxprice": "max_price",
    "avgprice": "mean_price",
    "stdevprice": "stddev_price",
    "percentile25thprice": "p25_price",
    "percentile50thprice": "p50_price",
    "percentile75thprice": "p75_price",
    "percentile99thprice": "p99_price",
}
