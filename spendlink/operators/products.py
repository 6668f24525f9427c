"""Product lookup by drug name: substring join, best record, fallback to the animal catalogue."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlink.functions.contains import contained
from spendlink.functions.normalize import fuzzy_form
from spendlink.functions.tags import DRUG
from spendlink.operators.lookup import left_attach
from spendlink.operators.match import best_matches
from spendlink.sources.shared import materialize

# Characters of names, and needles, that meet in one group; a needle longer than LONG characters counts for several.
NAME_TILE = 8 << 20
NEEDLE_TILE = 1 << 16
LONG = 256
# Order of the fields in the text a description is scored against; a missing field reads "None".
RECORD_FIELDS = (
    "proprietaryname",
    "dosageformname",
    "packagedescription",
    "productndc",
    "nonproprietaryname",
    "labelername",
)


def digest(text: str) -> str:
    return f"unhex(md5({text}))"


def _tiles(texts: DataFrame, column: str, load: str, size: int) -> int:
    total = texts.agg(F.expr(f"sum({load.format(column)})").alias("total")).first().total
    return max(1, -int(-(total or 0) // size))


def contained_in(
    needles: DataFrame, names: DataFrame, name_tile: int = NAME_TILE, needle_tile: int = NEEDLE_TILE
) -> DataFrame:
    """``(digest, needles)``: each distinct name that contains a needle, by its digest, and an array of those inside it.

    Both sides' distinct texts are dealt by hash to tiles of bounded size. A name tile meets every needle tile in one group, where
    ``functions.contains`` looks the needles up word by word; a name is copied once per needle tile, 65,536 needles, and no pair
    is a row unless it is a hit.
    """
    needles = needles.select("needle").filter("needle <> ''").distinct()
    names = names.select("name").filter("name <> ''")
    across = _tiles(names, "name", "length({})", name_tile)
    down = _tiles(needles, "needle", f"greatest(1D, length({{}}) / {LONG})", needle_tile)
    tile = "int(pmod(xxhash64({}), {}))".format
    left = needles.selectExpr(
        f"explode(sequence(0, {across - 1})) AS across", f"{tile('needle', down)} AS down", "CAST(needle AS BINARY) AS needle"
    )
    right = names.distinct().selectExpr(
        f"{tile('name', across)} AS across", f"explode(sequence(0, {down - 1})) AS down",
        f"{digest('name')} AS digest", "CAST(name AS BINARY) AS name",
    )

    def meet(some: pa.Table, texts: pa.Table) -> pa.Table:
        inside = contained(some["needle"].combine_chunks(), texts["name"].combine_chunks())
        found = pa.table({"digest": texts["digest"].combine_chunks(), "needles": inside})
        return found.filter(pc.greater(pc.list_value_length(inside), 0))

    cells = left.groupBy("across", "down").cogroup(right.groupBy("across", "down"))
    met = cells.applyInArrow(meet, "digest binary, needles array<binary>")
    if down > 1:
        met = met.groupBy("digest").agg(F.flatten(F.collect_list("needles")).alias("needles"))
    return met.selectExpr("digest", "CAST(needles AS ARRAY<STRING>) AS needles")


def contains_join(needles: DataFrame, names: DataFrame) -> DataFrame:
    """All ``(needle, digest, name)`` with the needle inside the name; the digest stands for the name."""
    pairs = contained_in(needles, names).selectExpr("digest", "explode(needles) AS needle")
    named = names.select("name").filter("name <> ''").distinct().selectExpr(f"{digest('name')} AS digest", "name")
    return pairs.join(named, "digest").select("needle", "digest", "name")


def with_content_id(products: DataFrame) -> DataFrame:
    """A table without ``id`` gets a digest of its columns, so that ties fall the same way in every run."""
    if "id" in products.columns:
        return products
    fields = ", ".join(f"`{c}`" for c in products.columns)
    return products.distinct().selectExpr(f"sha2(to_json(struct({fields})), 256) AS id", "*")


def products_by_name(drugs: DataFrame, products: DataFrame, name_columns: list[str]) -> DataFrame:
    """``(drug_name, id, name_rank)``: products whose lower-cased names contain the drug name.

    ``name_rank`` is the position of the first name column that contains it.
    """
    per_column = [f"struct({rank} AS name_rank, lower({c}) AS name)" for rank, c in enumerate(name_columns, start=1)]
    named = products.selectExpr("id", f"inline(array({', '.join(per_column)}))").filter("name IS NOT NULL")
    hits = contained_in(drugs.selectExpr("drug_name AS needle"), named)
    pairs = hits.selectExpr("explode(needles) AS needle", "digest")
    by_digest = named.selectExpr("id", "name_rank", f"{digest('name')} AS digest")
    return (
        pairs.join(by_digest, "digest")
        .groupBy(F.col("needle").alias("drug_name"), "id")
        .agg(F.min("name_rank").alias("name_rank"))
    )


def human_matches(items: DataFrame, hits: DataFrame, products: DataFrame) -> DataFrame:
    """Best-scoring record per ``(drug_name, text)``, without a cutoff; ``text`` is the normalised description."""
    record = F.concat_ws("|", *(F.coalesce(F.col(c), F.lit("None")) for c in RECORD_FIELDS))
    texts = products.select("id", fuzzy_form(record).alias("text"))
    candidates = hits.join(texts, "id").selectExpr("drug_name", "text", "id AS cand_id")
    best = best_matches(items, candidates, cutoff=0, block=["drug_name"])
    return best.selectExpr("drug_name", "text", "cand_id AS id", "score AS ndc_accuracy").join(
        products.selectExpr("id", "proprietaryname", "nonproprietaryname", "productndc AS ndc", "labelername"), "id"
    )


def animal_matches(drugs: DataFrame, products: DataFrame) -> DataFrame:
    """One product per drug: by proprietary name if any, else by non-proprietary name, smallest id first."""
    best = (
        products_by_name(drugs, products, ["proprietaryname", "nonproprietaryname"])
        .groupBy("drug_name")
        .agg(F.expr("min(struct(name_rank, id)) AS best"))
        .selectExpr("drug_name", "best.id AS id")
    )
    return best.join(products.select("id", "proprietaryname", "nonproprietaryname", "ndc", "labelername"), "id")


FIELDS = [
    "proprietaryname AS proprietary_name",
    "nonproprietaryname AS non_proprietary_name",
    "ndc",
    "labelername AS ndc_labeler",
    "ndc_accuracy",
]


def match_products(drug_texts: DataFrame, human: DataFrame, animal: DataFrame) -> DataFrame:
    """Product fields per ``(drug_name, text)``; animal products only for drugs without a human one, unscored."""
    drugs = drug_texts.select("drug_name").distinct()
    hits = materialize(products_by_name(drugs, human, ["proprietaryname", "nonproprietaryname"]), "product-hits")
    scored = human_matches(drug_texts, hits, human)
    unmatched = drugs.join(hits.select("drug_name").distinct(), "drug_name", "left_anti")
    fallback = animal_matches(unmatched, animal).withColumn("ndc_accuracy", F.lit(None).cast("double"))
    return (
        scored.selectExpr("drug_name", "text", *FIELDS)
        .unionByName(drug_texts.join(fallback, "drug_name").selectExpr("drug_name", "text", *FIELDS))
    )


def attach_products(items: DataFrame, human: DataFrame, animal: DataFrame) -> DataFrame:
    """NDC fields for items tagged as drugs; null elsewhere.

    The distinct drug texts and the substring hits are each used several times, so they are written out once.
    """
    human, animal = with_content_id(human), with_content_id(animal)
    keyed = items.withColumns(
        {
            "_drug": F.expr(f"if(tag = '{DRUG}' AND drug_name <> '', drug_name, null)"),
            "_text": fuzzy_form(F.coalesce("item_description", F.lit(""))),
        }
    )
    texts = keyed.filter("_drug IS NOT NULL").selectExpr("_drug AS drug_name", "_text AS text").distinct()
    texts = materialize(texts, "drug-texts")
    found = match_products(texts, human, animal).withColumnsRenamed({"drug_name": "_drug", "text": "_text"})
    return left_attach(keyed, found, ["_drug", "_text"]).drop("_drug", "_text")
