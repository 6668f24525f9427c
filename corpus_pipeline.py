"""From raw documents to token ids: five stages, each written as Parquet and read again as the next one's documents.

Every stage takes (spark, docs, sf_dir). All but the last return the columns of ``docs`` as they came; the rows they drop:

* toxicity: documents scored 0.5 or more;
* near_duplicates: all but one document (smallest id, then first row) of each group linked by Jaccard similarity 0.8;
* decontamination: documents with a ten-word window of the benchmark;
* secrets: no rows; secrets in texts are replaced by ``<secret:kind>``;
* tokens: no rows; returns doc_id, lang, source, n_tokens, ids, and whether the ids decode to the text.

Rows are told apart by a number, written once with the stage's documents, so rows with equal ids are judged each. Null and empty texts
pass all filters (they have no words) and encode to no tokens. Missing ``lang`` or ``source`` columns are left out. Empty
tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlink.llm import bpe, decontaminate, jaccard, secrets, toxicity
from spendlink.llm.common import numbered, table, unused
from spendlink.sources.shared import materialize


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    score = unused(docs, "__toxicity")
    machine = toxicity.train(docs, table(spark, sf_dir, "labels"), ~toxicity.held_out())
    scored = toxicity.with_score(docs, machine, out=score)
    return scored.filter(F.col(score) < 0.5).drop(score)


def without(stored: DataFrame, row: str, rows: DataFrame) -> DataFrame:
    """``stored`` without the rows numbered in rows(row), and without its column of numbers ``row``.

    Texts are not shuffled for it: the numbers are broadcast as maps of 64 bits. They follow one another within a task, so that is less
    than a byte per document.
    """
    bit = "shiftleft(1L, cast({0} & 63L as int))".format
    gone = rows.groupBy(F.shiftright("row", 6).alias("__word")).agg(F.expr(f"bit_or({bit('row')})").alias("__bits"))
    marked = stored.withColumn("__word", F.shiftright(row, 6)).join(F.broadcast(gone), "__word", "left")
    return marked.filter(f"coalesce(__bits, 0L) & {bit(row)} = 0").drop("__word", "__bits", row)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    name = unused(docs, "__row")
    stored = numbered(docs, name)
    found = jaccard.near_duplicates(stored, key=F.col(name).cast("string")).filter(F.col("group").isNotNull())
    row = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", F.col("key").cast("bigint").alias("row"))
    found = materialize(found.select("group", row.alias("r")), "near-duplicates")
    kept = found.groupBy("group").agg(F.min("r").alias("r")).select(F.col("r.row").alias("row"))
    return without(stored, name, found.select("r.row").join(kept, "row", "left_anti"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    name = unused(docs, "__row")
    stored = numbered(docs, name)
    judged = decontaminate.contamination(stored, table(spark, sf_dir, "benchmark"), row_col=name)
    return without(stored, name, judged.filter("contaminated").select("row"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.masked(docs, added=secrets.EXAMPLE_OWNERS, independent=True)


def to_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    kept = docs.select(*(c for c in ("doc_id", "lang", "source", "text") if c in docs.columns))
    return bpe.round_trip(kept, bpe.default_path()).drop("text")


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", mask_secrets),
    ("tokens", to_tokens),
]

#: No SQL can express the learned stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
