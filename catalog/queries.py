"""The registry: ``@query(name, sql)`` on a function from :class:`Inputs` to a DataFrame."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import fixtures as fx
from catalog import sql as q
from catalog.fixtures import Inputs
from catalog.sql import Query
from spendlink.functions import clean, concepts, normalize, similarity, tags
from spendlink.operators import dedup, keywords, lookup, match, priority, products, record, spread
from spendlink.plans import enrich, price, run
from spendlink.plans.price import Settings
from spendlink.sources import readers, records, sinks
from spendlink.sources.shared import materialize

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: Query | str | None = None):
    def register(build: Callable[[Inputs], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: build(Inputs(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = str(sql if isinstance(sql, Query) else Query(sql))
        return build

    return register


def prepared(t: Inputs) -> DataFrame:
    return enrich.prepare(t.items, readers.alias_pairs(t.alias_sheet), readers.keyword_pairs(t.keyword_sheet))


def text_of(array: str) -> str:
    return f"array_join({array}, '|') AS {array}"


# --- Sources and sinks -----------------------------------------------------------------------------------------

ITEM_FIELDS = ["item_description", "item_number", "manufacturer"]


@query("s01_item_scan", "SELECT item_description, item_number, manufacturer, count(*) AS n FROM items GROUP BY ALL")
def _(t):
    path = t.scratch("items")
    sinks.write(t.items.select(*ITEM_FIELDS), path, "csv")
    return readers.read_items(t.spark, path).groupBy(*ITEM_FIELDS).agg(F.count(F.lit(1)).alias("n"))


@query("s02_alias_map", "SELECT alias, canonical FROM aliases")
def _(t):
    return readers.alias_pairs(t.alias_sheet)


@query(
    "s03_keyword_map",
    "SELECT keyword, full_name, count(p_partkey) AS parts FROM keywords"
    " LEFT JOIN part ON lower(p_type) = keyword GROUP BY ALL",
)
def _(t):
    pairs = readers.keyword_pairs(t.keyword_sheet)
    return (
        pairs.join(t.part, F.expr("lower(p_type) = keyword"), "left")
        .groupBy("keyword", "full_name")
        .agg(F.count("p_partkey").alias("parts"))
    )


@query("s04_priority_list", "SELECT item_description, clean_description, processed_clean_desc FROM priority")
def _(t):
    return readers.priority_list(t.priority_sheet.drop("p_partkey")).drop("row_no")


# The same sheets written as files from whole texts, with quotes, commas and line breaks, and read by the real readers. Rows are
# written in the order of their ids, so the order in the files decides which row wins.
def sheet_file(t: Inputs, name: str, columns: list[str], header: bool = True) -> str:
    path = t.scratch(name)
    rows = t.documents.orderBy("doc_id").selectExpr(*columns)
    sinks.write(rows, path, "csv") if header else rows.write.options(escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)
    return path


@query(
    "s02_alias_map_file",
    """SELECT alias, arg_max('maker ' || (doc_id % 13), doc_id * 4 + pos) AS canonical FROM (
         SELECT doc_id, unnest(aliases) AS alias, generate_subscripts(aliases, 1) AS pos FROM (
           SELECT doc_id, list_slice([text, left(text, 20), source], 1, doc_id % 4) AS aliases FROM documents))
       WHERE alias <> '' GROUP BY alias""",
)
def _(t):
    sheet = ["'maker ' || (doc_id % 13) AS canonical", "doc_id % 4 AS n", "text AS a1", "left(text, 20) AS a2", "source AS a3"]
    return readers.read_alias_map(t.spark, sheet_file(t, "aliases", sheet))


@query(
    "s03_keyword_map_file",
    """SELECT keyword, arg_max(full_name, doc_id) AS full_name FROM (
         SELECT doc_id, lower(nullif(left(text, 12), '')) AS keyword, lower(nullif(text, '')) AS full_name FROM documents) GROUP BY keyword""",
)
def _(t):
    sheet = ["left(text, 12) AS keyword", "text AS full_name"]
    return readers.read_keyword_map(t.spark, sheet_file(t, "keywords", sheet, header=False))


@query(
    "s04_priority_list_file",
    """SELECT coalesce(text, '') AS item_description, coalesce(left(text, 30), '') AS clean_description,
         coalesce(lang || ', "' || source || '"', '') AS processed_clean_desc, row_number() OVER (ORDER BY doc_id) - 1 AS row_no FROM documents""",
)
def _(t):
    sheet = [
        "doc_id AS no", "text AS `Item Description`", "left(text, 30) AS `Clean Description`", "1 AS a", "text AS `say ""b"", c`",
        """lang || ', "' || source || '"' AS `processed clean desc`""", "2 AS d", "3 AS e", "4 AS f", "text AS tenth",
    ]
    return readers.read_priority_list(t.spark, sheet_file(t, "priority", sheet))


CHECKPOINT_SQL = (
    "SELECT key, item_description, item_number, manufacturer, canonical_manufacturer, drug_name, tag,"
    " CAST(is_duplicate AS INT) AS is_duplicate, pim, class_code, CAST(row_id AS VARCHAR) AS ndc FROM numbered"
)


def checkpoint_rows(t: Inputs) -> DataFrame:
    numbered = dedup.with_surrogate_id(prepared(t))
    blank = {c: F.lit(None).cast("string") for c in ("proprietary_name", "non_proprietary_name", "ndc_labeler")}
    return numbered.withColumns(
        {**blank, "ndc": F.col("row_id").cast("string"), "ndc_accuracy": F.lit(None).cast("double")}
    )


def checkpoint_view(df: DataFrame) -> DataFrame:
    return df.withColumn("is_duplicate", F.col("is_duplicate").cast("int")).select(
        "key", *ITEM_FIELDS, "canonical_manufacturer", "drug_name", "tag", "is_duplicate", "pim", "class_code", "ndc"
    )


@query("s05_checkpoint_reload", CHECKPOINT_SQL)
def _(t):
    path = t.scratch("checkpoint")
    sinks.write_checkpoint(checkpoint_rows(t), path, "csv")
    return checkpoint_view(readers.read_checkpoint(t.spark, path, "csv"))


@query(
    "s06_prediction_scan",
    'SELECT pim_key, company_name, part_number, description, data_set, first, CAST("1stProb" AS DOUBLE) AS p1,'
    ' CAST("2ndProb" AS DOUBLE) AS p2, CAST("3rdProb" AS DOUBLE) AS p3 FROM predictions',
)
def _(t):
    path = t.scratch("predictions")
    sinks.write(t.predictions, path, "csv")
    scanned = readers.read_predictions(t.spark, path)
    return scanned.selectExpr(
        "pim_key", "company_name", "part_number", "description", "data_set", "first",
        "`1stProb` AS p1", "`2ndProb` AS p2", "`3rdProb` AS p3",
    )


@query("s07_table_scan", "SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY l_partkey")
def _(t):
    lines = readers.read_table(t.spark, f"{t.sf_dir}/lineitem.parquet")
    return lines.groupBy("l_partkey").agg(F.count(F.lit(1)).alias("n"))


@query("s08_checkpoint_sink", CHECKPOINT_SQL)
def _(t):
    return checkpoint_view(sinks.write_checkpoint(checkpoint_rows(t), t.scratch("checkpoint")))


@query(
    "s09_result_sink",
    "SELECT row_id, key, CAST(is_duplicate AS INT) AS is_duplicate FROM marked",
)
def _(t):
    marked = dedup.mark_duplicates(dedup.with_key(enrich.clean_items(t.items))).select("row_id", "key", "is_duplicate")
    path = sinks.write_result(marked, t.scratch("result"), "Project1", 70, "UNSPSC_CODE", "csv")
    return t.spark.read.option("header", True).schema("row_id long, key string, is_duplicate int").csv(path)


REQUEST_SQL = """SELECT pim AS "PIM_KEY", canonical_manufacturer AS "COMPANY_NAME", sha256(key) AS "PART_NUMBER",
item_description AS "PRODUCT_DESCRIPTION", '' AS "UNSPSC" FROM numbered WHERE NOT is_duplicate"""


@query("s10_classifier_request", REQUEST_SQL)
def _(t):
    return sinks.classifier_request(dedup.with_surrogate_id(prepared(t)))


@query("s10_classifier_request_file", REQUEST_SQL)
def _(t):
    path = t.scratch("classifier_request")
    sinks.write_classifier_request(sinks.classifier_request(dedup.with_surrogate_id(prepared(t))), path)
    names = ["PIM_KEY", "COMPANY_NAME", "PART_NUMBER", "PRODUCT_DESCRIPTION", "UNSPSC"]
    rows = records.read_records(t.spark, path, header=True).select(records.parsed(F.col("record"), names).alias("r"))
    return rows.selectExpr("CAST(r.PIM_KEY AS BIGINT) AS PIM_KEY", *(f"coalesce(r.{n}, '') AS {n}" for n in names[1:]))


# --- Projections and scalar functions --------------------------------------------------------------------------


@query("p01_clean_description", "SELECT row_id, clean_description FROM cleaned")
def _(t):
    return t.items.select("row_id", clean.clean_description(F.col("item_description")).alias("clean_description"))


@query("p02_clean_text", f"SELECT doc_id, {q.clean_text('text')} AS clean FROM documents")
def _(t):
    return t.documents.select("doc_id", clean.clean_text(F.col("text")).alias("clean"))


@query("p03_strip_legal_suffixes", "SELECT row_id, manufacturer, clean_manufacturer FROM cleaned")
def _(t):
    return t.items.select("row_id", "manufacturer", clean.clean_manufacturer(F.col("manufacturer")).alias("clean_manufacturer"))


@query("p04_clean_item_number", "SELECT row_id, clean_number FROM cleaned")
def _(t):
    return t.items.select("row_id", clean.clean_item_number(F.col("item_number")).alias("clean_number"))


@query("p05_composite_key", "SELECT row_id, key FROM keyed")
def _(t):
    return dedup.with_key(enrich.clean_items(t.items)).select("row_id", "key")


@query("p06_first_token", "SELECT row_id, drug_name, drug_strength FROM named")
def _(t):
    text = clean.clean_description(F.col("item_description"))
    return t.items.select(
        "row_id", clean.first_token(text).alias("drug_name"), clean.after_first_token(text).alias("drug_strength")
    )


@query("p07_keyword_extraction", "SELECT row_id, dosage, dosage_fullname, tag, keywords FROM prepared")
def _(t):
    found = keywords.tag_keywords(enrich.clean_items(t.items), readers.keyword_pairs(t.keyword_sheet))
    return found.selectExpr("row_id", "dosage", "dosage_fullname", "tag", text_of("keywords"))


@query(
    "p08_blank_columns",
    "SELECT p_partkey, p_name, proprietaryname FROM part LEFT JOIN"
    " (SELECT id AS p_partkey, proprietaryname FROM animal) USING (p_partkey)",
)
def _(t):
    plain = t.part.filter(f"NOT {fx.VET}").select("p_partkey", "p_name")
    named = t.animal.selectExpr("id AS p_partkey", "proprietaryname").join(t.part.select("p_partkey", "p_name"), "p_partkey")
    return named.unionByName(plain, allowMissingColumns=True)


@query(
    "p09_select_rename_drop",
    "SELECT item_description, item_number, manufacturer, canonical_manufacturer, drug_name, tag, key,"
    " CAST(is_duplicate AS INT) AS excluded FROM prepared",
)
def _(t):
    return prepared(t).select(
        *ITEM_FIELDS, "canonical_manufacturer", "drug_name", "tag", "key",
        F.col("is_duplicate").cast("int").alias("excluded"),
    )


STATISTICS = {
    "totalnumberofunitspurchased": "total_quantity", "minprice": "min_price", "maxprice": "max_price",
    "avgprice": "mean_price", "stdevprice": "stddev_price", "percentile25thprice": "p25_price",
    "percentile50thprice": "p50_price", "percentile75thprice": "p75_price", "percentile99thprice": "p99_price",
}
EFFECTIVE = ", ".join(
    f"coalesce({c}invoice, 0) AS {n}" if c == "stdevprice" else f"coalesce({c}invoice, {c}po) AS {n}"
    for c, n in STATISTICS.items()
)
PRICE_SQL = f"SELECT id, proddesc AS matched_item, uom, totalnumberoforders AS number_of_orders, {EFFECTIVE} FROM prices"
SPEND_SQL = (
    "SELECT id, itemdesc AS matched_item, quantity, manufacturer AS matched_manufacturer, pricepaid AS price_paid,"
    " totalspend AS total_spend, uom FROM new_spend"
)


@query("p10_invoice_over_order", PRICE_SQL)
def _(t):
    return record.effective_prices(t.prices)


@query("p11_null_deviation", f"SELECT id, stddev_price, count(*) AS n FROM ({PRICE_SQL}) GROUP BY id, stddev_price")
def _(t):
    return record.effective_prices(t.prices).groupBy("id", "stddev_price").agg(F.count(F.lit(1)).alias("n"))


@query(
    "p12_tag_promotion",
    "SELECT row_id, CASE WHEN tag = '' AND class_code = '7' THEN 'Drug' ELSE tag END AS tag FROM prepared",
)
def _(t):
    return prepared(t).select("row_id", tags.promote_if(F.col("tag"), F.expr("class_code = '7'")).alias("tag"))


CODE = "coalesce(json_extract_string(response, '$[0].code'), '')"


@query(
    "p13_tag_by_concept",
    f"SELECT row_id, CASE WHEN tag = '' AND coalesce({CODE}, '') <> '' THEN 'Drug' ELSE tag END AS tag"
    " FROM prepared LEFT JOIN codes_by_drug USING (drug_name)",
)
def _(t):
    return lookup.attach_concept_code(prepared(t), t.codes_by_drug).select("row_id", "tag")


@query(
    "p14_tag_merge",
    "SELECT row_id, concat_ws(',', nullif(tag, ''), CASE WHEN class_code < '2' THEN 'Animal_Drug,Human_Drug'"
    " WHEN class_code < '3' THEN 'Human_Drug' END) AS tag FROM prepared",
)
def _(t):
    new = F.expr(
        "CASE WHEN class_code < '2' THEN array('Human_Drug', 'Animal_Drug')"
        " WHEN class_code < '3' THEN array('Human_Drug') ELSE array() END"
    )
    return prepared(t).select("row_id", tags.merge_tags(F.col("tag"), new).alias("tag"))


@query("p15_struct_fields", "SELECT id, itemdesc, quantity, pricepaid, uom FROM new_spend")
def _(t):
    packed = t.new_spend.selectExpr("id", "struct(itemdesc, quantity, pricepaid, uom) AS record")
    return packed.select("id", "record.*")


@query("p17_part_number", "SELECT row_id, sha256(key) AS part_number FROM keyed")
def _(t):
    return dedup.with_key(enrich.clean_items(t.items)).selectExpr("row_id", "sha2(key, 256) AS part_number")


@query("p18_fast_form", f"SELECT doc_id, {q.fast_form('text')} AS form FROM documents")
def _(t):
    return t.documents.select("doc_id", normalize.fast_form(F.col("text")).alias("form"))


@query("p19_fuzzy_form", f"SELECT doc_id, {q.fuzzy_form('text')} AS form FROM documents")
def _(t):
    return t.documents.select("doc_id", normalize.fuzzy_form(F.col("text")).alias("form"))


@query("p20_first_json_code", f"SELECT p_partkey, {CODE} AS code FROM (SELECT p_partkey, {fx.JSON_ANSWER} AS response FROM part)")
def _(t):
    return t.part.select("p_partkey", concepts.first_code(F.expr(fx.JSON_ANSWER)).alias("code"))


SOUND = "p_partkey % 13 <> 0"
XML_SQL = (
    "SELECT 'C' || p_partkey AS concept_code,"
    f" CASE WHEN {SOUND} THEN p_name || '|' || p_brand ELSE '' END AS brand_names,"
    f" CASE WHEN {SOUND} THEN p_type ELSE '' END AS ingredients,"
    f" CASE WHEN {SOUND} THEN concat_ws('|', CASE WHEN p_partkey % 3 = 0 THEN 'Animal_Drug' END,"
    " CASE WHEN p_partkey % 2 = 0 THEN 'Human_Drug' END) ELSE '' END AS species_tags FROM part"
)


@query("p21_xml_concepts", XML_SQL)
def _(t):
    return lookup.concept_answers(t.concept_xml).select("concept_code", "info.*").selectExpr(
        "concept_code", *(text_of(c) for c in ("brand_names", "ingredients", "species_tags"))
    )


# --- Filters and routes ----------------------------------------------------------------------------------------


@query("f01_drug_split", "SELECT tag = 'Drug' AS is_drug, count(*) AS n FROM prepared GROUP BY 1")
def _(t):
    return prepared(t).groupBy(F.expr("tag = 'Drug'").alias("is_drug")).agg(F.count(F.lit(1)).alias("n"))


@query("f02_first_occurrences", "SELECT row_id, key FROM marked WHERE NOT is_duplicate")
def _(t):
    marked = dedup.mark_duplicates(dedup.with_key(enrich.clean_items(t.items)))
    return marked.filter("NOT is_duplicate").select("row_id", "key")


@query(
    "f03_manufacturer_route",
    "SELECT row_id, CASE WHEN tag = '' THEN 'class' ELSE 'maker' END AS route FROM prepared",
)
def _(t):
    routed = prepared(t).withColumn("block", F.expr(price.MANUFACTURER_ROUTE))
    return routed.selectExpr("row_id", "if(coalesce(block, 'maker:') LIKE 'class:%', 'class', 'maker') AS route")


@query(
    "f04_new_spend_route",
    "SELECT row_id, CASE WHEN drug_name <> '' THEN 'text:' || drug_name WHEN canonical_manufacturer <> ''"
    " THEN 'maker:' || lower(nullif(canonical_manufacturer, 'UNKNOWN')) ELSE 'text:' || item_description END AS block FROM prepared",
)
def _(t):
    return prepared(t).selectExpr("row_id", f"{price.NEW_SPEND_ROUTE} AS block")


FUZZY_ITEM = q.fuzzy_form("item_description")
FAST_ITEM = q.fast_form("item_description")
CLASS = "'class:' || CAST(CAST({} AS DOUBLE) AS VARCHAR)"
MAKER = "'maker:' || lower({})"
ITEM_MAKER = MAKER.format("nullif(canonical_manufacturer, 'UNKNOWN')")


def item_side(block: str, form: str, source: str = "prepared") -> str:
    return f"SELECT {block} AS block, {form} AS text FROM {source}"


def catalogue_side(block: str, form: str, source: str) -> str:
    return f"SELECT {block} AS block, {form} AS text, id AS cand_id FROM {source}"


CLASS_ITEMS = item_side(CLASS.format("class_code"), FUZZY_ITEM, "items")
CLASS_ITEMS_FAST = item_side(CLASS.format("class_code"), FAST_ITEM, "items")
CLASS_SIDE = catalogue_side(CLASS.format("unspscclasscode"), q.fuzzy_form("proddesc"), "class_products")
CLASS_SIDE_FAST = catalogue_side(CLASS.format("unspscclasscode"), "prodcleandesc", "class_products")
HITS_SQL = "SELECT block, text, cand_id, score, rank FROM best"


def class_hits(t: Inputs, scorer: str, cutoff: float, k: int) -> DataFrame:
    rule = match.SCORERS[scorer]
    source = "prodcleandesc" if rule.stored_form else "proddesc"
    return match.best_matches(
        t.items.select(
            F.expr("'class:' || CAST(CAST(class_code AS DOUBLE) AS STRING)").alias("block"),
            rule.item_form(F.col("item_description")).alias("text"),
        ),
        t.class_products.select(
            F.expr("'class:' || CAST(CAST(unspscclasscode AS DOUBLE) AS STRING)").alias("block"),
            rule.candidate_form(F.col(source)).alias("text"),
            F.col("id").alias("cand_id"),
        ),
        cutoff=cutoff, k=k, digits=rule.digits, block=["block"],
    )


@query("f05_score_cutoff", Query(HITS_SQL, **q.best_ctes(CLASS_ITEMS, CLASS_SIDE, 85, 0, 1)))
def _(t):
    return class_hits(t, "FUZZY", 85, 1)


@query("f06_blank_drug_guard", "SELECT drug_name, count(*) AS n FROM prepared WHERE drug_name <> '' GROUP BY drug_name")
def _(t):
    return prepared(t).filter("drug_name <> ''").groupBy("drug_name").agg(F.count(F.lit(1)).alias("n"))


# --- Joins -----------------------------------------------------------------------------------------------------


@query("j01_canonical_manufacturer", "SELECT row_id, canonical_manufacturer FROM canonical")
def _(t):
    named = lookup.canonical_manufacturer(enrich.clean_items(t.items), readers.alias_pairs(t.alias_sheet))
    return named.select("row_id", "canonical_manufacturer")


@query(
    "j01_spread_join",
    "SELECT row_id, i.manufacturer, n FROM items i LEFT JOIN"
    " (SELECT manufacturer, count(*) AS n FROM items WHERE row_id % 3 > 0 GROUP BY manufacturer) USING (manufacturer)",
)
def _(t):
    counted = t.items.filter("row_id % 3 > 0").groupBy("manufacturer").agg(F.count(F.lit(1)).alias("n"))
    return spread.spread_join(t.items, counted, ["manufacturer"], by=["row_id"]).select("row_id", "manufacturer", "n")


@query("j02_enrich_distinct", f"SELECT row_id, {FUZZY_ITEM} AS form FROM items")
def _(t):
    def forms(inputs: DataFrame) -> DataFrame:
        return inputs.withColumn("form", normalize.fuzzy_form(F.col("item_description")))

    return lookup.enrich_distinct(t.items, ["item_description"], forms).select("row_id", "form")


@query("j03_surrogate_id_join", "SELECT row_id, key, dense_rank() OVER (ORDER BY key) - 1 AS pim FROM keyed")
def _(t):
    return dedup.with_surrogate_id(dedup.with_key(enrich.clean_items(t.items))).select("row_id", "key", "pim")


@query(
    "j04_attach_prediction",
    "SELECT row_id, item_description, p.first AS class_code FROM items JOIN predictions p ON row_id = pim_key",
)
def _(t):
    numbered = t.items.drop("class_code").withColumn("pim", F.col("row_id"))
    return lookup.attach_class_code(numbered, t.predictions).select("row_id", "item_description", "class_code")


NAMES_SQL = (
    "SELECT id, lower(proprietaryname) AS name FROM human UNION SELECT id, lower(nonproprietaryname) FROM human"
)
HUMAN_HITS = (
    f"SELECT DISTINCT drug_name, id FROM (SELECT DISTINCT drug_name FROM prepared WHERE drug_name <> '')"
    f" JOIN ({NAMES_SQL}) ON contains(name, drug_name)"
)


@query("j05_substring_join", HUMAN_HITS)
def _(t):
    drugs = prepared(t).select("drug_name").filter("drug_name <> ''")
    hits = products.products_by_name(drugs, t.human, ["proprietaryname", "nonproprietaryname"])
    return hits.select("drug_name", "id")


WORDS_SQL = "SELECT DISTINCT unnest(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+')) AS needle FROM benchmark"


@query(
    "j05_substring_join_texts",
    "SELECT doc_id, count(*) AS words, min(needle) AS first_word, max(needle) AS last_word FROM"
    f" (SELECT doc_id, needle FROM documents JOIN ({WORDS_SQL}) ON needle <> '' AND contains(lower(text), needle))"
    " GROUP BY doc_id",
)
def _(t):
    words = t.table("benchmark").selectExpr("explode(split(lower(text), '[^\\\\p{L}\\\\p{N}]+')) AS needle")
    named = t.documents.selectExpr("doc_id", "lower(text) AS name")
    return (
        products.contained_in(words, named)
        .selectExpr("digest", "size(needles) AS n", "array_min(needles) AS first", "array_max(needles) AS last")
        .join(named.selectExpr("doc_id", f"{products.digest('name')} AS digest"), "digest")
        .groupBy("doc_id")
        .agg(F.sum("n").alias("words"), F.min("first").alias("first_word"), F.max("last").alias("last_word"))
    )


RECORD_TEXT = " || '|' || ".join(f"coalesce({c}, 'None')" for c in products.RECORD_FIELDS)
DRUG_TEXTS = f"SELECT DISTINCT drug_name, {FUZZY_ITEM} AS text FROM prepared WHERE tag = 'Drug' AND drug_name <> ''"
ANIMAL_SQL = (
    "SELECT drug_name, arg_min(id, name_rank * 10000000000 + id) AS id FROM (SELECT drug_name, id,"
    " CASE WHEN contains(lower(proprietaryname), drug_name) THEN 1 ELSE 2 END AS name_rank FROM unmatched JOIN animal"
    " ON contains(lower(proprietaryname), drug_name) OR contains(lower(nonproprietaryname), drug_name))"
    " GROUP BY drug_name"
)
NDC_CTES = {
    "drug_texts": DRUG_TEXTS,
    "human_hits": HUMAN_HITS,
    "human_texts": f"SELECT id, {q.fuzzy_form(RECORD_TEXT)} AS record_text FROM human",
    "unmatched": "SELECT DISTINCT drug_name FROM drug_texts WHERE drug_name NOT IN (SELECT drug_name FROM human_hits)",
    "animal_hits": ANIMAL_SQL,
    **q.best_ctes(
        "SELECT drug_name AS block, text FROM drug_texts",
        "SELECT drug_name AS block, record_text AS text, id AS cand_id FROM human_hits JOIN human_texts USING (id)",
        0, 0, 1,
    ),
    "found": "SELECT block AS drug_name, text, proprietaryname AS proprietary_name, nonproprietaryname AS"
    " non_proprietary_name, productndc AS ndc, labelername AS ndc_labeler, score AS ndc_accuracy FROM best"
    " JOIN human ON cand_id = id UNION ALL SELECT drug_name, text, proprietaryname, nonproprietaryname, ndc,"
    " labelername, NULL FROM drug_texts JOIN animal_hits USING (drug_name) JOIN animal USING (id)",
    "with_products": "SELECT p.*, proprietary_name, non_proprietary_name, ndc, ndc_labeler, ndc_accuracy FROM"
    f" (SELECT *, {FUZZY_ITEM} AS text FROM prepared) p LEFT JOIN found f ON p.tag = 'Drug'"
    " AND p.drug_name = f.drug_name AND p.text = f.text",
}
NDC_COLUMNS = ["proprietary_name", "non_proprietary_name", "ndc", "ndc_labeler", "ndc_accuracy"]


@query("j06_product_cascade", Query(f"SELECT row_id, tag, {', '.join(NDC_COLUMNS)} FROM with_products", **NDC_CTES))
def _(t):
    return products.attach_products(prepared(t), t.human, t.animal).select("row_id", "tag", *NDC_COLUMNS)


def link_ctes(items: str, catalogue: str, records: str, scorer: str, cutoff: float, k: int, source="prepared") -> dict:
    """``linked`` = items with match records. ``items`` gives (row_id, block, text), ``catalogue`` (block, text,
    cand_id, description)."""
    digits = match.SCORERS[scorer].digits
    if scorer == "FAST_FUZZY":
        winners = "SELECT DISTINCT block, text, cand_id AS id, score, rank FROM best"
    else:
        winners = (
            "SELECT block, text, score, min(rank) AS rank, any_value(r.id) AS id FROM best JOIN"
            " (SELECT block, cand_id, description FROM catalogue_rows) USING (block, cand_id) LEFT JOIN"
            " (SELECT matched_item, min(id) AS id FROM records GROUP BY matched_item) r ON description = matched_item"
            " GROUP BY block, text, description, score"
        )
    return {
        "item_rows": items,
        "catalogue_rows": catalogue,
        "records": records,
        **q.best_ctes("SELECT block, text FROM item_rows", "SELECT block, text, cand_id FROM catalogue_rows", cutoff, digits, k),
        "winners": winners,
        "linked": f"SELECT s.*, w.score AS accuracy, w.rank, records.* EXCLUDE (id) FROM {source} s JOIN item_rows i USING"
        " (row_id) LEFT JOIN winners w ON i.block = w.block AND i.text = w.text LEFT JOIN records ON w.id = records.id",
    }


def item_rows(block: str, scorer: str, source: str = "prepared") -> str:
    form = FAST_ITEM if scorer == "FAST_FUZZY" else FUZZY_ITEM
    return f"SELECT row_id, {block} AS block, {form} AS text FROM {source}"


def catalogue_rows(block: str, table: str, description: str, stored: str, scorer: str) -> str:
    text = stored if scorer == "FAST_FUZZY" else q.fuzzy_form(description)
    return f"SELECT {block} AS block, {text} AS text, id AS cand_id, {description} AS description FROM {table}"


def class_catalogue(scorer: str) -> str:
    return catalogue_rows(CLASS.format("unspscclasscode"), "class_products", "proddesc", "prodcleandesc", scorer)


def maker_catalogue(scorer: str) -> str:
    return catalogue_rows(MAKER.format("mfrcanonicalname"), "maker_products", "proddesc", "prodcleandesc", scorer)


def spend_catalogue(block: str, scorer: str) -> str:
    return catalogue_rows(block, "new_spend", "itemdesc", "itemdesc", scorer)


PRICE_COLUMNS = [
    "accuracy", "rank", "matched_item", "uom", "number_of_orders", "total_quantity", "min_price", "max_price",
    "mean_price", "stddev_price", "p25_price", "p50_price", "p75_price", "p99_price",
]
SPEND_COLUMNS = [
    "accuracy", "rank", "matched_item", "quantity", "matched_manufacturer", "price_paid", "total_spend", "uom",
]
LINK_SQL = "SELECT row_id, {} FROM linked"
TEXT = "'text:' || {}"

VARIANTS = {
    "FUZZY": ("fuzzy", 70),
    "FAST_FUZZY": ("fast", 60),
}
for scorer, (label, cutoff) in VARIANTS.items():
    one, five = Settings(cutoff, scorer), Settings(cutoff, scorer, only_top=False)

    def sql(block, catalogue, records, columns, k, scorer=scorer, cutoff=cutoff):
        return Query(
            LINK_SQL.format(", ".join(columns)),
            **link_ctes(item_rows(block, scorer), catalogue, records, scorer, cutoff, k),
        )

    by_class = (CLASS.format("class_code"), class_catalogue(scorer), PRICE_SQL, PRICE_COLUMNS)
    by_maker = (ITEM_MAKER, maker_catalogue(scorer), PRICE_SQL, PRICE_COLUMNS)

    @query(f"j07_class_code_{label}", sql(*by_class, 1))
    def _(t, s=one):
        return price.match_by_class_code(prepared(t), t.class_products, t.prices, s).select("row_id", *PRICE_COLUMNS)

    @query(f"j07_class_code_{label}_top5", sql(*by_class, 5))
    def _(t, s=five):
        return price.match_by_class_code(prepared(t), t.class_products, t.prices, s).select("row_id", *PRICE_COLUMNS)

    @query(f"j08_manufacturer_{label}", sql(*by_maker, 1))
    def _(t, s=one):
        return price.price_by_manufacturer(prepared(t), t.maker_products, t.prices, s).select("row_id", *PRICE_COLUMNS)

    by_drug = (TEXT.format("drug_name"), spend_catalogue(TEXT.format("lower(itemdesc)"), scorer), SPEND_SQL, SPEND_COLUMNS)

    @query(f"j09_drug_name_{label}", sql(*by_drug, 1))
    def _(t, s=one):
        return price.spend_by_drug(prepared(t), t.new_spend, s).select("row_id", *SPEND_COLUMNS)

    by_spend_maker = (
        ITEM_MAKER, spend_catalogue(MAKER.format("mfrcanonicalname"), scorer),
        SPEND_SQL, SPEND_COLUMNS,
    )

    @query(f"j10_new_spend_manufacturer_{label}", sql(*by_spend_maker, 1))
    def _(t, s=one):
        return price.spend_by_manufacturer(prepared(t), t.new_spend, s).select("row_id", *SPEND_COLUMNS)

    by_text = (
        TEXT.format("item_description"), spend_catalogue(TEXT.format("lower(itemdesc)"), scorer),
        SPEND_SQL, SPEND_COLUMNS,
    )

    @query(f"j11_whole_description_{label}", sql(*by_text, 1))
    def _(t, s=one):
        return price.spend_by_description(prepared(t), t.new_spend, s).select("row_id", *SPEND_COLUMNS)


WINNERS = q.best_ctes(CLASS_ITEMS_FAST, CLASS_SIDE_FAST, 80, 2, 1)


@query("j12_record_by_id", Query(f"SELECT block, text, r.* FROM best JOIN ({PRICE_SQL}) r ON cand_id = r.id", **WINNERS))
def _(t):
    hits = class_hits(t, "FAST_FUZZY", 80, 1).withColumnRenamed("cand_id", "id").drop("score", "rank")
    return record.fetch_by_id(hits, record.effective_prices(t.prices))


@query("j13_record_by_description", f"SELECT matched_item AS description, min(id) AS id FROM ({PRICE_SQL}) GROUP BY 1")
def _(t):
    return record.record_id_by_text(record.effective_prices(t.prices), "matched_item")


def priority_ctes(scorer: str, cutoff: float, source: str) -> dict:
    """``flagged`` = the source with the priority columns."""
    stored = scorer == "FAST_FUZZY"
    column = "processed_clean_desc" if stored else "clean_description"
    form = FAST_ITEM if stored else FUZZY_ITEM
    entry_form = "clean" if stored else q.fuzzy_form("clean")
    ctes = q.best_ctes(
        f"SELECT 0 AS block, {form} AS text FROM {source}",
        f"SELECT 0 AS block, {entry_form} AS text, cand_id FROM priority_entries",
        cutoff, match.SCORERS[scorer].digits, 1,
    )
    renamed = {name: f"p_{name}" for name in ctes}
    ctes = {renamed[name]: _rename(body, renamed) for name, body in ctes.items()}
    return {
        "priority_entries": f"SELECT {column} AS clean, min(row_no) AS cand_id, arg_min(item_description, row_no) AS"
        f" priority_desc FROM priority GROUP BY {column}",
        **ctes,
        "flagged": "SELECT s.* EXCLUDE (tag, form), score IS NOT NULL AS priority_flag, score AS priority_accuracy,"
        " priority_desc, CASE WHEN tag = '' AND score IS NOT NULL THEN 'Drug' ELSE tag END AS tag"
        f" FROM (SELECT *, {form} AS form FROM {source}) s LEFT JOIN p_best ON form = p_best.text"
        " LEFT JOIN priority_entries USING (cand_id)",
    }


def _rename(body: str, names: dict[str, str]) -> str:
    return re.sub(r"\b(" + "|".join(names) + r")\b", lambda m: names[m.group()], body)


for scorer, (label, cutoff) in VARIANTS.items():
    PRIORITY_SQL = "SELECT row_id, CAST(priority_flag AS INT) AS priority_flag, priority_accuracy, priority_desc, tag FROM flagged"

    @query(f"j14_priority_match_{label}", Query(PRIORITY_SQL, **priority_ctes(scorer, cutoff, "prepared")))
    def _(t, scorer=scorer, cutoff=cutoff):
        found = priority.match_priority(prepared(t), t.priority, scorer=scorer, cutoff=cutoff)
        return found.selectExpr(
            "row_id", "CAST(priority_flag AS INT) AS priority_flag", "priority_accuracy", "priority_desc", "tag"
        )


@query(
    "j15_first_original_description",
    "SELECT clean_description AS clean, min(row_no) AS cand_id, arg_min(item_description, row_no) AS priority_desc"
    " FROM priority GROUP BY 1",
)
def _(t):
    return priority.priority_entries(t.priority, "FUZZY")


@query(
    "j16_concept_code",
    f"SELECT row_id, drug_name, coalesce({CODE}, '') AS concept_code FROM prepared LEFT JOIN codes_by_drug USING (drug_name)",
)
def _(t):
    return lookup.attach_concept_code(prepared(t), t.codes_by_drug).select("row_id", "drug_name", "concept_code")


@query(
    "j17_concept_info",
    Query(
        "SELECT row_id, coalesce(brand_names, '') AS brand_names, coalesce(ingredients, '') AS ingredients,"
        " concat_ws(',', nullif(tag, ''), nullif(replace(coalesce(species_tags, ''), '|', ','), '')) AS tag"
        " FROM (SELECT *, 'C' || (row_id - 500) AS concept_code FROM prepared)"
        " LEFT JOIN concept_answers USING (concept_code)",
        concept_answers=XML_SQL,
    ),
)
def _(t):
    coded = prepared(t).withColumn("concept_code", F.expr("'C' || (row_id - 500)"))
    return lookup.attach_concept_info(coded, t.concept_xml).selectExpr(
        "row_id", text_of("brand_names"), text_of("ingredients"), "tag"
    )


# --- Similarity ------------------------------------------------------------------------------------------------

SCORE_PAIRS = "SELECT p_partkey, {a} AS a, {b} AS b FROM part"


@query(
    "m01_fuzzy_score",
    Query(
        "SELECT p_partkey, score FROM pair_rows JOIN scored USING (a, b)",
        pair_rows=SCORE_PAIRS.format(a=q.fuzzy_form(fx.DESCRIPTION), b=q.fuzzy_form(f"{fx.TYPE_NAME} || '_' || p_brand")),
        **q.score_ctes("pair_rows", 0),
    ),
)
def _(t):
    left, right = F.expr(fx.DESCRIPTION), F.expr(f"{fx.TYPE_NAME} || '_' || p_brand")
    return t.part.select("p_partkey", similarity.fuzzy_score(left, right).alias("score"))


@query(
    "m02_fast_score",
    Query(
        "SELECT p_partkey, score FROM pair_rows JOIN scored USING (a, b)",
        pair_rows=SCORE_PAIRS.format(a=q.fast_form(fx.DESCRIPTION), b=f"{fx.TYPE_NAME} || '_' || p_brand"),
        **q.score_ctes("pair_rows", 2),
    ),
)
def _(t):
    left, right = F.expr(fx.DESCRIPTION), F.expr(f"{fx.TYPE_NAME} || '_' || p_brand")
    return t.part.select("p_partkey", similarity.fast_score(left, right).alias("score"))


@query(
    "m03_lcs_ratio",
    Query(
        "SELECT c_custkey, score FROM pair_rows JOIN scored USING (a, b)",
        pair_rows="SELECT c_custkey, c_name AS a, c_mktsegment || '#' || (c_custkey * 7919) AS b FROM customer",
        **q.score_ctes("pair_rows", 2),
    ),
)
def _(t):
    segment = F.expr("c_mktsegment || '#' || (c_custkey * 7919)")
    return t.table("customer").select("c_custkey", similarity.similarity(F.col("c_name"), segment, 2).alias("score"))


@query(
    "m03_lcs_ratio_long_texts",
    Query(
        "SELECT a AS text, cand_id, score, CAST(1 AS INTEGER) AS rank FROM (SELECT a, cand_id, score, row_number() OVER (PARTITION BY a"
        " ORDER BY score DESC, cand_id) AS place FROM met JOIN scored USING (a, b) WHERE score >= 60) WHERE place = 1",
        turns=f"SELECT DISTINCT coalesce({q.fuzzy_form('text')}, '') AS a FROM conversations",
        passages=f"SELECT coalesce({q.fuzzy_form('text')}, '') AS b, item_id AS cand_id FROM benchmark",
        # Only lengths that can reach the cutoff.
        met="SELECT a, b, cand_id FROM turns JOIN passages ON 200 * least(length(a), length(b)) >= 59 * (length(a) + length(b))",
        **q.long_score_ctes("met", 0),
    ),
)
def _(t):
    """Whole conversation turns against whole benchmark passages, longer than one machine word."""
    turns = t.table("conversations").select(normalize.fuzzy_form(F.col("text")).alias("text"))
    passages = t.table("benchmark").select(
        normalize.fuzzy_form(F.col("text")).alias("text"), F.col("item_id").alias("cand_id")
    )
    return match.best_matches(turns, passages, cutoff=60)


# --- Aggregations ----------------------------------------------------------------------------------------------


@query("a01_distinct_values", "SELECT DISTINCT clean_manufacturer FROM cleaned")
def _(t):
    return enrich.clean_items(t.items).select("clean_manufacturer").distinct()


@query("a02_distinct_keys", "SELECT DISTINCT key FROM keyed")
def _(t):
    return dedup.with_key(enrich.clean_items(t.items)).select("key").distinct()


@query("a03_best_match", Query("SELECT block, text, score FROM best", **q.best_ctes(CLASS_ITEMS, CLASS_SIDE, 0, 0, 1)))
def _(t):
    return class_hits(t, "FUZZY", 0, 1).select("block", "text", "score")


@query("a04_keyword_set", "SELECT clean_description, keywords FROM keyword_hits")
def _(t):
    texts = enrich.clean_items(t.items).select("clean_description").distinct()
    hits = keywords.keyword_hits(texts, readers.keyword_pairs(t.keyword_sheet), "clean_description")
    return hits.selectExpr("clean_description", text_of("keywords"))


# Whole texts as a priority list; every document is a row.
LISTED_TEXTS = ["text AS item_description", "coalesce(left(text, 8), '') AS clean_description", "coalesce(source, '') AS processed_clean_desc", "doc_id AS row_no"]


@query("a05_distinct_entries_of_texts", "SELECT DISTINCT coalesce(source, '') AS clean FROM documents")
def _(t):
    return priority.priority_entries(t.documents.selectExpr(*LISTED_TEXTS), "FAST_FUZZY").select("clean")


@query(
    "j15_first_original_description_of_texts",
    "SELECT coalesce(left(text, 8), '') AS clean, min(doc_id) AS cand_id, arg_min(text, doc_id) AS priority_desc FROM documents GROUP BY 1",
)
def _(t):
    return priority.priority_entries(t.documents.selectExpr(*LISTED_TEXTS), "FUZZY")


@query("a05_distinct_entries", "SELECT DISTINCT processed_clean_desc AS clean FROM priority")
def _(t):
    return priority.priority_entries(t.priority, "FAST_FUZZY").select("clean")


@query(
    "a06_distinct_top5",
    Query(
        "SELECT block, text, count(*) AS kept, max(score) AS best_score FROM winners GROUP BY block, text",
        **link_ctes(
            item_rows(CLASS.format("class_code"), "FUZZY", "items"), class_catalogue("FUZZY"), PRICE_SQL, "FUZZY", 70, 5, "items"
        ),
    ),
)
def _(t):
    hits = class_hits(t, "FUZZY", 70, 5)
    described = price.class_entries(t.class_products).selectExpr("block", "id AS cand_id", "description")
    kept = price.distinct_matches(hits, described)
    return kept.groupBy("block", "text").agg(F.count(F.lit(1)).alias("kept"), F.max("score").alias("best_score"))


@query("a07_distinct_rows", "SELECT DISTINCT proprietaryname, nonproprietaryname, labelername FROM animal")
def _(t):
    return t.animal.select("proprietaryname", "nonproprietaryname", "labelername").distinct()


# --- Windows, ids, top-k ---------------------------------------------------------------------------------------


@query("w01_duplicate_marking", "SELECT row_id, key, CAST(is_duplicate AS INT) AS is_duplicate FROM marked")
def _(t):
    marked = dedup.mark_duplicates(dedup.with_key(enrich.clean_items(t.items)))
    return marked.select("row_id", "key", F.col("is_duplicate").cast("int").alias("is_duplicate"))


@query("w02_surrogate_id", "SELECT DISTINCT key, dense_rank() OVER (ORDER BY key) - 1 AS pim FROM keyed")
def _(t):
    return dedup.surrogate_ids(dedup.with_key(enrich.clean_items(t.items)))


@query("w03_dense_rank", "SELECT row_id, dense_rank() OVER (ORDER BY key) AS pim FROM keyed")
def _(t):
    numbered = dedup.with_surrogate_id(dedup.with_key(enrich.clean_items(t.items)))
    return numbered.selectExpr("row_id", "pim + 1 AS pim")


TOP_K = {
    "t01_best_one_cutoff": ("FAST_FUZZY", 75, 1),
    "t02_best_five_cutoff": ("FAST_FUZZY", 75, 5),
    "t03_best_one": ("FAST_FUZZY", 0, 1),
    "t04_best_or_none": ("FUZZY", 90, 1),
    "t05_stable_order": ("FUZZY", 0, 5),
}
for name, (scorer, cutoff, k) in TOP_K.items():
    sides = (CLASS_ITEMS, CLASS_SIDE) if scorer == "FUZZY" else (CLASS_ITEMS_FAST, CLASS_SIDE_FAST)

    @query(name, Query(HITS_SQL, **q.best_ctes(*sides, cutoff, match.SCORERS[scorer].digits, k)))
    def _(t, scorer=scorer, cutoff=cutoff, k=k):
        return class_hits(t, scorer, cutoff, k)


@query(
    "t06_any_one",
    Query("SELECT drug_name, id FROM animal_hits", **{**NDC_CTES, "unmatched": f"SELECT DISTINCT {fx.FIRST_WORD} AS drug_name FROM part"}),
)
def _(t):
    drugs = t.part.selectExpr(f"{fx.FIRST_WORD} AS drug_name").distinct()
    return products.animal_matches(drugs, t.animal).select("drug_name", "id")


# --- Set operations --------------------------------------------------------------------------------------------


@query("u01_drug_union", Query("SELECT tag, count(*) AS n, count(ndc) AS with_ndc FROM with_products GROUP BY tag", **NDC_CTES))
def _(t):
    found = products.attach_products(prepared(t), t.human, t.animal)
    return found.groupBy("tag").agg(F.count(F.lit(1)).alias("n"), F.count("ndc").alias("with_ndc"))


def mode_ctes(mode: str, scorer: str, cutoff: float, k: int, source: str) -> dict:
    """``linked`` for a composed mode over an item relation that has tag, drug name and canonical manufacturer."""
    class_, maker = CLASS.format("class_code"), ITEM_MAKER
    if mode == "UNSPSC_CODE":
        return link_ctes(item_rows(class_, scorer, source), class_catalogue(scorer), PRICE_SQL, scorer, cutoff, k, source)
    if mode == "MANUFACTURER":
        block = f"CASE WHEN tag = '' THEN {class_} ELSE {maker} END"
        catalogue = f"{class_catalogue(scorer)} UNION ALL {maker_catalogue(scorer)}"
        return link_ctes(item_rows(block, scorer, source), catalogue, PRICE_SQL, scorer, cutoff, k, source)
    block = (
        f"CASE WHEN drug_name <> '' THEN {TEXT.format('drug_name')} WHEN canonical_manufacturer <> '' THEN {maker}"
        f" ELSE {TEXT.format('item_description')} END"
    )
    by_text = spend_catalogue(TEXT.format("lower(itemdesc)"), scorer)
    catalogue = f"{by_text} UNION ALL {spend_catalogue(MAKER.format('mfrcanonicalname'), scorer)}"
    return link_ctes(item_rows(block, scorer, source), catalogue, SPEND_SQL, scorer, cutoff, k, source)


@query(
    "u02_class_and_manufacturer",
    Query(
        "SELECT tag, count(*) AS n, count(accuracy) AS matched, sum(accuracy) AS total FROM linked GROUP BY tag",
        **mode_ctes("MANUFACTURER", "FUZZY", 70, 1, "prepared"),
    ),
)
def _(t):
    linked = price.match_by_manufacturer(prepared(t), t.class_products, t.maker_products, t.prices, Settings(70))
    return linked.groupBy("tag").agg(
        F.count(F.lit(1)).alias("n"), F.count("accuracy").alias("matched"), F.sum("accuracy").alias("total")
    )


@query(
    "u03_new_spend_routes",
    Query(
        "SELECT drug_name, count(*) AS n, count(accuracy) AS matched, sum(accuracy) AS total FROM linked GROUP BY drug_name",
        **mode_ctes("NEW_SPEND_INFO", "FUZZY", 50, 1, "prepared"),
    ),
)
def _(t):
    linked = price.match_new_spend(prepared(t), t.new_spend, Settings(50))
    return linked.groupBy("drug_name").agg(
        F.count(F.lit(1)).alias("n"), F.count("accuracy").alias("matched"), F.sum("accuracy").alias("total")
    )


@query(
    "u04_file_append",
    "SELECT item_description, count(*) AS n FROM (SELECT item_description FROM items UNION ALL"
    " SELECT item_description FROM items) GROUP BY 1",
)
def _(t):
    paths = [t.scratch("items"), t.scratch("items")]
    for path in paths:
        sinks.write(t.items.select(*ITEM_FIELDS), path, "csv")
    return readers.read_items(t.spark, paths).groupBy("item_description").agg(F.count(F.lit(1)).alias("n"))


# --- Composed runs ---------------------------------------------------------------------------------------------

CLASSIFIED = {
    "request": "SELECT pim, 1 + length(item_description) % 50 AS first FROM numbered WHERE NOT is_duplicate",
    "classified": "SELECT n.* EXCLUDE (class_code), CAST(r.first AS VARCHAR) AS class_code FROM numbered n"
    " JOIN request r USING (pim)",
}


def classify(request: DataFrame) -> DataFrame:
    """Stand-in for the external classifier."""
    return request.selectExpr("PIM_KEY AS pim_key", "CAST(1 + length(PRODUCT_DESCRIPTION) % 50 AS STRING) AS first")


def enriched(t: Inputs) -> DataFrame:
    aliases, words = readers.alias_pairs(t.alias_sheet), readers.keyword_pairs(t.keyword_sheet)
    return enrich.enrich(t.items.drop("class_code"), aliases, words, classify, t.human, t.animal)


ENRICHED = {
    **NDC_CTES,
    **CLASSIFIED,
    "enriched": "SELECT row_id, key, item_description, item_number, manufacturer, canonical_manufacturer, drug_name, c.tag,"
    " CAST(is_duplicate AS INT) AS is_duplicate, pim, class_code, proprietary_name, non_proprietary_name, w.ndc,"
    " ndc_labeler, ndc_accuracy FROM classified c JOIN (SELECT row_id, proprietary_name, non_proprietary_name, ndc,"
    " ndc_labeler, ndc_accuracy FROM with_products) w USING (row_id)",
}
ENRICHED_COLUMNS = [
    "row_id", "key", *ITEM_FIELDS, "canonical_manufacturer", "drug_name", "tag", "is_duplicate", "pim", "class_code",
    *NDC_COLUMNS,
]


@query("e01_full_enrichment", Query(f"SELECT {', '.join(ENRICHED_COLUMNS)} FROM enriched", **ENRICHED))
def _(t):
    return enriched(t).withColumn("is_duplicate", F.col("is_duplicate").cast("int")).select(*ENRICHED_COLUMNS)


def run_mode(t: Inputs, items: DataFrame, mode: str, scorer: str, threshold: int, only_top: bool = True) -> DataFrame:
    job = run.Job(threshold, mode, "Project1", "FULL", scorer, only_top)
    tables = {
        "unique_products_unspsc": t.class_products, "unique_products": t.maker_products,
        "price_info": t.prices, "price_info_new": t.new_spend,
    }
    return run.match_prices(job, materialize(items, "cleaned"), t.priority, tables.__getitem__)


RUN_COLUMNS = ["row_id", "tag", "CAST(priority_flag AS INT) AS priority_flag", "priority_accuracy", "priority_desc"]


def run_sql(mode: str, scorer: str, cutoff: float, k: int, columns: list[str]) -> Query:
    listed = ", ".join([*RUN_COLUMNS, *columns])
    return Query(
        f"SELECT {listed} FROM linked",
        **{**priority_ctes(scorer, cutoff, "prepared"), **mode_ctes(mode, scorer, cutoff, k, "flagged")},
    )


@query("e02_resume_from_checkpoint", Query(
    "SELECT key, tag, class_code, accuracy, rank, matched_item, mean_price FROM linked",
    **{**CLASSIFIED, **priority_ctes("FAST_FUZZY", 70, "classified"), **mode_ctes("UNSPSC_CODE", "FAST_FUZZY", 70, 1, "flagged")},
))
def _(t):
    numbered = dedup.with_surrogate_id(prepared(t).drop("class_code"))
    classified = lookup.attach_class_code(numbered, classify(sinks.classifier_request(numbered)))
    blank = {c: F.lit(None).cast("string") for c in ("proprietary_name", "non_proprietary_name", "ndc", "ndc_labeler")}
    rows = classified.withColumns({**blank, "ndc_accuracy": F.lit(None).cast("double")})
    path = t.scratch("checkpoint")
    sinks.write_checkpoint(rows, path)
    return run_mode(t, readers.read_checkpoint(t.spark, path), "UNSPSC_CODE", "FAST_FUZZY", 70).select(
        "key", "tag", "class_code", "accuracy", "rank", "matched_item", "mean_price"
    )


RUNS = {
    "e03_class_code_run": ("UNSPSC_CODE", "FUZZY", 70, True),
    "e03_class_code_run_fast": ("UNSPSC_CODE", "FAST_FUZZY", 70, True),
    "e04_manufacturer_run": ("MANUFACTURER", "FUZZY", 60, True),
    "e04_manufacturer_run_fast_top5": ("MANUFACTURER", "FAST_FUZZY", 60, False),
    "e05_new_spend_run": ("NEW_SPEND_INFO", "FUZZY", 50, True),
    "e05_new_spend_run_fast_top5": ("NEW_SPEND_INFO", "FAST_FUZZY", 50, False),
}
for name, (mode, scorer, cutoff, only_top) in RUNS.items():
    columns = SPEND_COLUMNS if mode == "NEW_SPEND_INFO" else PRICE_COLUMNS

    @query(name, run_sql(mode, scorer, cutoff, 1 if only_top else 5, columns))
    def _(t, mode=mode, scorer=scorer, cutoff=cutoff, only_top=only_top, columns=columns):
        return run_mode(t, prepared(t), mode, scorer, cutoff, only_top).selectExpr(*RUN_COLUMNS, *columns)


@query("p16_explode_matches", Query("SELECT row_id, rank, accuracy FROM linked", **mode_ctes("UNSPSC_CODE", "FUZZY", 70, 5, "prepared")))
def _(t):
    linked = price.match_by_class_code(prepared(t), t.class_products, t.prices, Settings(70, only_top=False))
    return linked.select("row_id", "rank", "accuracy")
