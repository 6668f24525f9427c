"""Headline queries, timed. Prints one JSON line.

Environment: ``BENCH_SF_DIR`` (folder of the tables), ``BENCH_CPUS`` (local cores).
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from catalog.fixtures import Inputs
from catalog.queries import QUERIES, enriched
from spendlink import Job, Tables, run
from spendlink.sources import sinks

# Complete runs from a checkpoint to the written result: what the published figures time.
RUNS = [
    f"{threshold} {mode} bench PARTIAL {scorer}"
    for threshold, mode in ((70, "UNSPSC_CODE"), (60, "MANUFACTURER"), (50, "NEW_SPEND_INFO"))
    for scorer in ("FAST_FUZZY", "FUZZY")
]
OPERATORS = [
    "e01_full_enrichment",
    "j05_substring_join",
    "j06_product_cascade",
    "j07_class_code_fuzzy_top5",
    "j14_priority_match_fuzzy",
    "p18_fast_form",
    "p19_fuzzy_form",
    "w01_duplicate_marking",
    "w02_surrogate_id",
]


def session(cpus: str) -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("spendlink-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )


def timed(spark: SparkSession, name: str, sf_dir: str) -> float:
    """From building the plan to the last row produced."""
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def prepare(spark: SparkSession, sf_dir: str) -> tuple[Tables, str]:
    """Checkpoint, priority list and reference tables as a run expects to find them; not timed."""
    t = Inputs(spark, sf_dir)
    root = t.scratch("bench")
    sinks.write(t.priority_sheet.drop("p_partkey").coalesce(1), f"{root}/priority_list.csv", "csv")
    for name, df in {
        "unique_products_unspsc": t.class_products,
        "unique_products": t.maker_products,
        "price_info": t.prices,
        "price_info_new": t.new_spend,
    }.items():
        df.write.parquet(f"{root}/{name}.parquet")
    sinks.write_checkpoint(enriched(t), f"{root}/out/bench/cleaned")
    return Tables(spark, root), f"{root}/out"


def timed_run(spark: SparkSession, job: Job, tables: Tables, output: str) -> float:
    start = time.perf_counter()
    run(spark, job, tables, output, "csv")
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    tables, output = prepare(spark, sf_dir)
    # One untimed run: start-up of the JVM and of the Python workers is not part of the published figures either.
    timed_run(spark, Job.parse(RUNS[0].split()), tables, output)
    seconds = {}
    for line in RUNS:
        job = Job.parse(line.split())
        seconds[f"run_{job.mode}_{job.scorer}".lower()] = round(timed_run(spark, job, tables, output), 3)
    for name in OPERATORS:
        seconds[name] = round(timed(spark, name, sf_dir), 3)
    result = {
        "metric": "total time of six complete runs and nine operators",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir).removeprefix("sf"),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
