"""A complete run: FULL enriches and checkpoints, PARTIAL resumes from the checkpoint, both match and write prices."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlink.operators.priority import match_priority
from spendlink.plans.enrich import enrich
from spendlink.plans.price import Settings, match_by_class_code, match_by_manufacturer, match_new_spend
from spendlink.sources import manifest, readers, sinks

# Accepted arguments.
MODES = ("UNSPSC_CODE", "MANUFACTURER", "NEW_SPEND_INFO")
PROCESSES = ("FULL", "PARTIAL")
SCORER_NAMES = ("FUZZY", "FAST_FUZZY")


@dataclass(frozen=True)
class Job:
    threshold: int
    mode: str
    project: str
    process: str
    scorer: str
    only_top: bool = True
    exact_case: bool = False
    both_forms: bool = False
    #: Items the classifier does not answer for stay, without a class code.
    keep_unclassified: bool = False

    @classmethod
    def parse(cls, args: list[str], **options: bool) -> Job:
        """``threshold mode project FULL|PARTIAL FUZZY|FAST_FUZZY [only_top]``; only ``false`` turns only_top off."""
        if len(args) not in (5, 6):
            raise ValueError("expected: threshold mode project FULL|PARTIAL FUZZY|FAST_FUZZY [only_top]")
        threshold, mode, project, process, scorer = args[:5]
        job = cls(
            int(threshold), mode.upper(), project, process.upper(), scorer.upper(),
            not (len(args) == 6 and args[5].upper() == "FALSE"), **options,
        )
        for value, allowed in ((job.mode, MODES), (job.process, PROCESSES), (job.scorer, SCORER_NAMES)):
            if value not in allowed:
                raise ValueError(f"{value!r} is not one of {', '.join(allowed)}")
        return job

    @property
    def settings(self) -> Settings:
        return Settings(self.threshold, self.scorer, self.only_top, self.exact_case, self.both_forms)


class Tables:
    """Inputs by name. Files live under one folder; reference tables may come over JDBC instead."""

    def __init__(self, spark: SparkSession, root: str, jdbc: dict | None = None):
        self.spark, self.root, self.jdbc = spark, root.rstrip("/"), jdbc

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def enrichment_files(self) -> list[str]:
        """Files a checkpoint is made from; reference tables over JDBC are not among them."""
        tables = [] if self.jdbc else ["product_package.parquet", "animal_product.parquet"]
        return [self.path(n) for n in ("items", "alias_map.csv", "keyword_map.csv", "predictions.csv", *tables)]

    def table(self, name: str) -> DataFrame:
        if self.jdbc:
            return readers.read_table(self.spark, name, fmt="jdbc", **self.jdbc)
        return readers.read_table(self.spark, self.path(f"{name}.parquet"))


def match_prices(job: Job, items: DataFrame, priority: DataFrame, table) -> DataFrame:
    """Priority match, then the price match of the mode. ``table`` gives a reference table by name."""
    # Only the manufacturer mode routes by the tag, so only there the price match depends on the priority match.
    by_tag = job.mode == "MANUFACTURER"
    flagged = match_priority(items, priority, scorer=job.scorer, cutoff=job.threshold, reused=by_tag)
    if job.mode == "UNSPSC_CODE":
        return match_by_class_code(flagged, table("unique_products_unspsc"), table("price_info"), job.settings)
    if job.mode == "MANUFACTURER":
        return match_by_manufacturer(
            flagged, table("unique_products_unspsc"), table("unique_products"), table("price_info"), job.settings
        )
    return match_new_spend(flagged, table("price_info_new"), job.settings)


class AnswerMissing(Exception):
    """The request is written; the run can go on once the classifier's answer is there."""


class AnswerStale(Exception):
    """The answer belongs to another request."""


def verified_answer(spark: SparkSession, request: DataFrame, path: str, request_path: str) -> DataFrame:
    """Predictions whose part numbers, hashes of the item keys, agree with the request. Ids alone prove nothing: they are
    places in key order and shift with every new item."""
    try:
        answer = readers.read_predictions(spark, path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        raise AnswerMissing(f"request written to {request_path}, no answer at {path}") from error
    asked = request.select(F.col("PIM_KEY").alias("asked_id"), F.col("PART_NUMBER").alias("asked_number"))
    given = answer.select("pim_key", "part_number")
    differs = F.col("asked_number").isNull() | ~F.col("part_number").eqNullSafe(F.col("asked_number"))
    stale = given.join(asked, F.col("pim_key").eqNullSafe(F.col("asked_id")), "left").filter(differs)
    if stale.limit(1).count():
        raise AnswerStale(f"{path} does not answer {request_path}")
    return answer


def enriched_items(spark: SparkSession, job: Job, inputs: Tables, checkpoint: str) -> DataFrame:
    if job.process == "PARTIAL":
        try:
            items = readers.read_checkpoint(spark, checkpoint)
        except AnalysisException as error:
            raise manifest.CheckpointUnverified(f"no checkpoint at {checkpoint}") from error
        manifest.verify(spark, checkpoint, items)
        return items

    def classify(request: DataFrame) -> DataFrame:
        # The classifier is an external program: one run writes the request, a later one finds the answer.
        path = f"{checkpoint.rpartition('/')[0]}/classifier_request"
        sinks.write_classifier_request(request, path)
        return verified_answer(spark, request, inputs.path("predictions.csv"), path)

    used = manifest.fingerprint(spark, inputs.enrichment_files())
    items = enrich(
        readers.read_items(spark, inputs.path("items")),
        readers.read_alias_map(spark, inputs.path("alias_map.csv")),
        readers.read_keyword_map(spark, inputs.path("keyword_map.csv")),
        classify,
        inputs.table("product_package"),
        inputs.table("animal_product"),
        how="left" if job.keep_unclassified else "inner",
    )
    manifest.begin(spark, checkpoint)
    written = sinks.write_checkpoint(items, checkpoint)
    manifest.complete(spark, checkpoint, written, used)
    return written


def run(spark: SparkSession, job: Job, inputs: Tables, output: str, fmt: str = "parquet") -> str:
    """Execute the job; returns the path of the result."""
    checkpoint = f"{output.rstrip('/')}/{job.project}/cleaned"
    items = enriched_items(spark, job, inputs, checkpoint)
    priority = readers.read_priority_list(spark, inputs.path("priority_list.csv"))
    result = match_prices(job, items, priority, inputs.table)
    return sinks.write_result(result, output, job.project, job.threshold, job.mode, fmt)
