"""Input relations derived from the given tables.

The derivations are SQL expressions both dialects read alike; ``RELATIONS`` holds them as select lists over one table.
"""

from __future__ import annotations

import os
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlink.functions.normalize import fast_form
from spendlink.sources.shared import new_path

NAME_TYPE = "p_name || ' ' || p_type"
TYPE_NAME = "p_type || ' ' || p_name"
CANONICAL = "replace(p_brand, 'Brand#', 'BRAND ')"
FIRST_WORD = "split_part(p_name, ' ', 1)"
UOM = "CASE p_size % 3 WHEN 0 THEN 'EA' WHEN 1 THEN 'BX' ELSE 'CS' END"

DESCRIPTION = f"""CASE WHEN p_partkey % 11 = 0 THEN '. ' || p_name
                       WHEN p_partkey % 5 = 0 THEN p_name
                       ELSE CASE WHEN p_partkey % 7 = 0 THEN '@' ELSE '' END || {NAME_TYPE}
                            || CASE p_partkey % 3 WHEN 0 THEN ' TAB' WHEN 1 THEN ' caps' ELSE '' END END"""
MAKER = """p_brand || CASE p_partkey % 6 WHEN 0 THEN ' Inc.' WHEN 1 THEN ', LLC' WHEN 2 THEN ' Corp USA'
                                         WHEN 3 THEN '  co' WHEN 4 THEN ' LLC Inc' ELSE '' END"""
NUMBER = "lpad(CAST(p_partkey AS STRING), 8, '0')"

# Every part is listed twice: once as is, once as a differently written copy that cleans to the same text.
ITEMS = [
    [
        "p_partkey AS row_id",
        f"{DESCRIPTION} AS item_description",
        f"{NUMBER} AS item_number",
        f"{MAKER} AS manufacturer",
        "CAST(p_size AS STRING) AS class_code",
    ],
    [
        "p_partkey + 1000000000 AS row_id",
        f"'  ' || upper(replace({DESCRIPTION}, '@', '')) || ' ' AS item_description",
        "' ' || CAST(p_partkey AS STRING) AS item_number",
        "p_brand || '  inc' AS manufacturer",
        "CAST(p_size AS STRING) AS class_code",
    ],
]

# Wide alias sheet: outdated rows first, then the valid ones. Brands 1 to 3 are unlisted, brand 25 has a blank name.
BRAND = "CAST(replace(p_brand, 'Brand#', '') AS INT)"
LISTED = f"{BRAND} > 3"
ALIAS_OLD = [
    f"'OLD ' || {BRAND} AS canonical", "2 AS n",
    f"'brand#' || {BRAND} AS a1", f"'brand#' || {BRAND} || ' old' AS a2", "'unused' AS a3",
]
ALIAS_NEW = [
    f"CASE WHEN {BRAND} = 25 THEN '' ELSE {CANONICAL} END AS canonical", "2 AS n",
    f"'brand#' || {BRAND} AS a1", f"'brand#' || {BRAND} || ' llc' AS a2", "'unused' AS a3",
]

KEYWORD_ROWS = [
    ("TAB", "Tab Old"), ("caps", "Capsule"), ("ECONOMY", "Economy Pack"), ("promo", "promotion"), ("tab", "Tablet"),
]

# The priority sheet: one row per promoted part, so that most clean descriptions occur in many rows.
PRIORITY = [
    f"'Priority ' || {NAME_TYPE} || ' no ' || p_partkey AS `Item Description`",
    f"lower({NAME_TYPE}) AS `Clean Description`",
]
PROMOTED = "p_type = 'PROMO'"

CLASS_PRODUCTS = ["p_partkey AS id", "p_size AS unspscclasscode", f"{TYPE_NAME} AS proddesc"]
MAKER_PRODUCTS = ["p_partkey AS id", f"{CANONICAL} AS mfrcanonicalname", f"{TYPE_NAME} AS proddesc"]
NEW_SPEND = [
    "p_partkey AS id",
    f"CASE WHEN p_partkey % 11 = 0 THEN '. ' || p_name WHEN p_partkey % 3 = 0 THEN {FIRST_WORD}"
    " ELSE p_name END AS itemdesc",
    f"{CANONICAL} AS mfrcanonicalname",
    "CAST(p_size AS DOUBLE) AS quantity",
    "p_brand AS manufacturer",
    "p_retailprice AS pricepaid",
    "p_retailprice * p_size AS totalspend",
    f"{UOM} AS uom",
]

# Price statistics per part and side, from whole cents so that both dialects agree to the last bit.
CENTS = "CAST(round(l_extendedprice * 100) AS BIGINT)"
SIDES = {"po": "l_linestatus = 'O'", "invoice": "l_linestatus = 'F' AND l_returnflag = 'R'"}
PRICE_AGGREGATES = ["count(*) AS totalnumberoforders"] + [
    expression
    for side, rows in SIDES.items()
    for expression in (
        f"sum(CASE WHEN {rows} THEN l_quantity END) AS totalnumberofunitspurchased{side}",
        f"count(CASE WHEN {rows} THEN 1 END) AS n_{side}",
        f"min(CASE WHEN {rows} THEN {CENTS} END) AS lo_{side}",
        f"max(CASE WHEN {rows} THEN {CENTS} END) AS hi_{side}",
        f"sum(CASE WHEN {rows} THEN {CENTS} END) AS sum_{side}",
    )
]
PRICE_COLUMNS = [
    "p_partkey AS id", f"{TYPE_NAME} AS proddesc", f"{UOM} AS uom", "totalnumberoforders",
] + [
    expression
    for side in SIDES
    for expression in (
        f"totalnumberofunitspurchased{side}",
        f"lo_{side} / CAST(100 AS DOUBLE) AS minprice{side}",
        f"hi_{side} / CAST(100 AS DOUBLE) AS maxprice{side}",
        f"CAST(sum_{side} AS DOUBLE) / nullif(n_{side}, 0) AS avgprice{side}",
        f"CASE WHEN n_{side} > 1 THEN (hi_{side} - lo_{side}) / CAST(400 AS DOUBLE) END AS stdevprice{side}",
        f"(3 * lo_{side} + hi_{side}) / CAST(400 AS DOUBLE) AS percentile25thprice{side}",
        f"(lo_{side} + hi_{side}) / CAST(200 AS DOUBLE) AS percentile50thprice{side}",
        f"(lo_{side} + 3 * hi_{side}) / CAST(400 AS DOUBLE) AS percentile75thprice{side}",
        f"(lo_{side} + 99 * hi_{side}) / CAST(10000 AS DOUBLE) AS percentile99thprice{side}",
    )
]

VET = "(p_name LIKE 'hot %' OR p_name LIKE 'cold %')"
HUMAN_PRODUCTS = [
    "p_partkey AS id",
    "p_name AS proprietaryname",
    "CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE 'TABLET' END AS dosageformname",
    "p_size || ' in 1 BOTTLE' AS packagedescription",
    f"{NUMBER} AS productndc",
    "p_type AS nonproprietaryname",
    "p_brand AS labelername",
]
ANIMAL_PRODUCTS = [
    "p_partkey AS id",
    "CASE WHEN p_name LIKE 'hot %' THEN p_name ELSE 'vet ' || p_type END AS proprietaryname",
    "p_name AS nonproprietaryname",
    f"{NUMBER} AS ndc",
    "p_brand AS labelername",
]

PREDICTIONS = [
    "p_partkey AS pim_key", "p_brand AS company_name", f"{NUMBER} AS part_number", "p_name AS description",
    "'best' AS data_set", "CAST(p_size AS STRING) AS first", "'' AS secondCategory", "'' AS thirdCategory",
    "0.5 AS `1stProb`", "0.25 AS `2ndProb`", "0.125 AS `3rdProb`",
]

JSON_ANSWER = """CASE p_partkey % 4 WHEN 0 THEN '[]'
                       WHEN 1 THEN '[{"code":"C' || p_partkey || '"}]'
                       WHEN 2 THEN '[{"code":"C' || p_partkey || '"},{"code":"other"}]'
                       ELSE '[{"name":"no code"}]' END"""
JSON_BY_DRUG = """CASE length(drug_name) % 3 WHEN 0 THEN '[{"code":"D' || drug_name || '"}]'
                       WHEN 1 THEN '[]' ELSE '[{"code":"D' || drug_name || '"},{"code":"other"}]' END"""

SPECIES = {
    "inferedhuman": "CASE WHEN p_partkey % 2 = 0 THEN 'US' ELSE 'XX' END",
    "inferedvet": "CASE WHEN p_partkey % 3 = 0 THEN 'US' ELSE '' END",
}
XML_ANSWER = f"""'<answer><allRelatedGroup><conceptGroup><tty>BN</tty>'
    || '<conceptProperties><name>' || p_name || '</name></conceptProperties>'
    || '<conceptProperties><name>' || p_brand || '</name></conceptProperties></conceptGroup>'
    || '<conceptGroup><tty>IN</tty><conceptProperties><name>' || p_type || '</name><inferedhuman>'
    || {SPECIES['inferedhuman']} || '</inferedhuman><inferedvet>' || {SPECIES['inferedvet']}
    || '</inferedvet></conceptProperties></conceptGroup><conceptGroup><tty>XX</tty></conceptGroup></allRelatedGroup>'
    || CASE WHEN p_partkey % 13 = 0 THEN '<broken' ELSE '</answer>' END"""
CONCEPT_XML = ["'C' || p_partkey AS concept_code", f"{XML_ANSWER} AS response"]


class Inputs:
    """The relations as DataFrames over one folder of the given tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(os.path.join(self.sf_dir, f"{name}.parquet"))

    def scratch(self, name: str) -> str:
        """A new folder under the session's shared folder."""
        return new_path(self.spark, name)

    @cached_property
    def part(self) -> DataFrame:
        return self.table("part")

    @cached_property
    def documents(self) -> DataFrame:
        return self.table("documents")

    @cached_property
    def items(self) -> DataFrame:
        plain, copies = (self.part.selectExpr(*columns) for columns in ITEMS)
        return plain.unionByName(copies)

    @cached_property
    def alias_sheet(self) -> DataFrame:
        brands = self.part.filter(LISTED).select("p_brand").distinct()
        return brands.selectExpr(*ALIAS_OLD).unionByName(brands.selectExpr(*ALIAS_NEW))

    @cached_property
    def keyword_sheet(self) -> DataFrame:
        return self.spark.createDataFrame(KEYWORD_ROWS, "keyword string, full_name string")

    @cached_property
    def priority_sheet(self) -> DataFrame:
        listed = self.part.filter(PROMOTED).selectExpr("p_partkey", *PRIORITY)
        return listed.withColumn("processed clean desc", fast_form(F.col("Clean Description")))

    @cached_property
    def priority(self) -> DataFrame:
        """As the reader would number it, but with the part key as row number."""
        return self.priority_sheet.selectExpr(
            "`Item Description` AS item_description",
            "`Clean Description` AS clean_description",
            "`processed clean desc` AS processed_clean_desc",
            "p_partkey AS row_no",
        )

    def _with_stored_form(self, columns: list[str]) -> DataFrame:
        return self.part.selectExpr(*columns).withColumn("prodcleandesc", fast_form(F.col("proddesc")))

    @cached_property
    def class_products(self) -> DataFrame:
        return self._with_stored_form(CLASS_PRODUCTS)

    @cached_property
    def maker_products(self) -> DataFrame:
        return self._with_stored_form(MAKER_PRODUCTS)

    @cached_property
    def new_spend(self) -> DataFrame:
        return self.part.selectExpr(*NEW_SPEND)

    @cached_property
    def prices(self) -> DataFrame:
        lines = self.table("lineitem").groupBy("l_partkey").agg(*(F.expr(e) for e in PRICE_AGGREGATES))
        return lines.join(self.part, F.expr("l_partkey = p_partkey")).selectExpr(*PRICE_COLUMNS)

    @cached_property
    def human(self) -> DataFrame:
        return self.part.filter(f"NOT {VET}").selectExpr(*HUMAN_PRODUCTS)

    @cached_property
    def animal(self) -> DataFrame:
        return self.part.filter(VET).selectExpr(*ANIMAL_PRODUCTS)

    @cached_property
    def predictions(self) -> DataFrame:
        return self.part.selectExpr(*PREDICTIONS)

    @cached_property
    def codes_by_drug(self) -> DataFrame:
        drugs = self.part.selectExpr(f"{FIRST_WORD} AS drug_name").distinct()
        return drugs.selectExpr("drug_name", f"{JSON_BY_DRUG} AS response")

    @cached_property
    def concept_xml(self) -> DataFrame:
        return self.part.selectExpr(*CONCEPT_XML)
