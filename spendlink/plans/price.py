"""Price matching: which block an item is compared in, its winners, and their price records.

The five variants and the two composed modes are one call of :func:`link` each. A block is a string such as
``class:42.0``, ``maker:acme`` or ``text:aspirin``; a mode that routes items differently gives each item the block of
its route and joins the catalogues of all routes into one, so one match serves the whole mode.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlink.operators.lookup import UNKNOWN
from spendlink.operators.match import SCORERS, best_matches
from spendlink.operators.record import effective_prices, fetch_by_id, new_spend_records, record_id_by_text

TOP = 5


@dataclass(frozen=True)
class Settings:
    """``scorer`` is FUZZY or FAST_FUZZY; ``only_top`` keeps one match per item, otherwise the best five.

    ``exact_case`` compares an item's manufacturer as it stands; ``both_forms`` has FAST_FUZZY normalise the catalogue's text too, where
    it is stored as it came (new spend).
    """

    threshold: int
    scorer: str = "FUZZY"
    only_top: bool = True
    exact_case: bool = False
    both_forms: bool = False

    @property
    def k(self) -> int:
        return 1 if self.only_top else TOP


# Blocks as SQL expressions. Class codes are numbers on one side and text on the other.
def class_block(code: str) -> str:
    return f"concat('class:', try_cast({code} AS double))"


def maker_block(name: str, lower: bool = True) -> str:
    return f"concat('maker:', lower({name}))" if lower else f"concat('maker:', {name})"


def item_maker_block(lower: bool = True) -> str:
    """An unknown manufacturer matches nothing: the null block leaves the match before any shuffle."""
    return maker_block(f"nullif(canonical_manufacturer, '{UNKNOWN}')", lower)


def text_block(text: str) -> str:
    return f"concat('text:', {text})"


def entries(catalogue: DataFrame, block: str, description: str, clean: str) -> DataFrame:
    """Catalogue rows in match form; ``clean`` is the stored form the fast scorer compares with."""
    return catalogue.selectExpr(f"{block} AS block", "id", f"{description} AS description", f"{clean} AS clean")


def class_entries(products: DataFrame) -> DataFrame:
    return entries(products, class_block("unspscclasscode"), "proddesc", "prodcleandesc")


def maker_entries(products: DataFrame) -> DataFrame:
    return entries(products, maker_block("mfrcanonicalname"), "proddesc", "prodcleandesc")


def spend_text_entries(spend: DataFrame) -> DataFrame:
    return entries(spend, text_block("lower(itemdesc)"), "itemdesc", "itemdesc")


def spend_maker_entries(spend: DataFrame) -> DataFrame:
    return entries(spend, maker_block("mfrcanonicalname"), "itemdesc", "itemdesc")


def distinct_matches(best: DataFrame, described: DataFrame) -> DataFrame:
    """Matches of one item with the same description and score, counted once."""
    return (
        best.join(described, ["block", "cand_id"])
        .groupBy("block", "text", "description", "score")
        .agg(F.min("rank").alias("rank"))
    )


def link(items: DataFrame, catalogue: DataFrame, records: DataFrame, settings: Settings, block: str) -> DataFrame:
    """Every item, once per kept match, with its score and record; unmatched items once, with nulls."""
    rule = SCORERS[settings.scorer]
    keyed = items.withColumns(
        {"_block": F.expr(block), "_text": rule.item_form(F.coalesce("item_description", F.lit("")))}
    )
    source = F.col("clean" if rule.stored_form else "description")
    form = rule.item_form if settings.both_forms else rule.candidate_form
    best = best_matches(
        keyed.selectExpr("_block AS block", "_text AS text"),
        catalogue.select("block", form(source).alias("text"), F.col("id").alias("cand_id")),
        cutoff=settings.threshold,
        k=settings.k,
        digits=rule.digits,
        block=["block"],
    )
    # Matches are told apart by id and score (fast) or description and score; copies among the best k count once.
    if rule.stored_form:
        winners = (
            best.groupBy("block", "text", "cand_id", "score")
            .agg(F.min("rank").alias("rank"))
            .withColumnRenamed("cand_id", "id")
        )
    else:
        described = catalogue.selectExpr("block", "id AS cand_id", "description")
        winners = (
            distinct_matches(best, described)
            .join(record_id_by_text(records, "matched_item"), "description", "left")
            .drop("description")
        )
    found = fetch_by_id(winners, records).drop("id")
    found = found.withColumnsRenamed({"block": "_block", "text": "_text", "score": "accuracy"})
    return keyed.join(found, ["_block", "_text"], "left").drop("_block", "_text")


def match_by_class_code(items: DataFrame, class_products: DataFrame, prices: DataFrame, settings: Settings) -> DataFrame:
    return link(items, class_entries(class_products), effective_prices(prices), settings, class_block("class_code"))


def price_by_manufacturer(
    items: DataFrame, maker_products: DataFrame, prices: DataFrame, settings: Settings, exact_case: bool = False
) -> DataFrame:
    """Both manufacturer names are lowered; ``exact_case`` compares the item's name as it stands."""
    block = item_maker_block(lower=not (exact_case or settings.exact_case))
    return link(items, maker_entries(maker_products), effective_prices(prices), settings, block)


def spend_by_drug(items: DataFrame, spend: DataFrame, settings: Settings) -> DataFrame:
    return link(items, spend_text_entries(spend), new_spend_records(spend), settings, text_block("drug_name"))


def spend_by_manufacturer(
    items: DataFrame, spend: DataFrame, settings: Settings, exact_case: bool = False
) -> DataFrame:
    block = item_maker_block(lower=not (exact_case or settings.exact_case))
    return link(items, spend_maker_entries(spend), new_spend_records(spend), settings, block)


def spend_by_description(items: DataFrame, spend: DataFrame, settings: Settings) -> DataFrame:
    return link(items, spend_text_entries(spend), new_spend_records(spend), settings, text_block("item_description"))


def manufacturer_route(lower: bool = True) -> str:
    """Untagged items go by class code, tagged ones by manufacturer."""
    return f"if(tag = '', {class_block('class_code')}, {item_maker_block(lower)})"


def new_spend_route(lower: bool = True) -> str:
    """By drug name if there is one, else by manufacturer, else by the whole description. The drug name is the first token
    of any description, so nearly all items take the first route."""
    return (
        f"CASE WHEN drug_name <> '' THEN {text_block('drug_name')}"
        f" WHEN canonical_manufacturer <> '' THEN {item_maker_block(lower)}"
        f" ELSE {text_block('item_description')} END"
    )


MANUFACTURER_ROUTE, NEW_SPEND_ROUTE = manufacturer_route(), new_spend_route()


def match_by_manufacturer(
    items: DataFrame, class_products: DataFrame, maker_products: DataFrame, prices: DataFrame, settings: Settings
) -> DataFrame:
    catalogue = class_entries(class_products).unionByName(maker_entries(maker_products))
    return link(items, catalogue, effective_prices(prices), settings, manufacturer_route(not settings.exact_case))


def match_new_spend(items: DataFrame, spend: DataFrame, settings: Settings) -> DataFrame:
    catalogue = spend_text_entries(spend).unionByName(spend_maker_entries(spend))
    return link(items, catalogue, new_spend_records(spend), settings, new_spend_route(not settings.exact_case))
