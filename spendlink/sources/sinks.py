"""Writers: checkpoint, results, classifier request. All write from the executors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlink.schema import CHECKPOINT
from spendlink.sources.readers import read_checkpoint


# Keep blanks and quotes as they are.
CSV_OPTIONS = {
    "header": True,
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def write(df: DataFrame, path: str, fmt: str) -> None:
    options = CSV_OPTIONS if fmt == "csv" else {}
    df.write.mode("overwrite").format(fmt).options(**options).save(path)


def flat(df: DataFrame) -> DataFrame:
    """Arrays as JSON text and flags as 0/1, for CSV."""
    kinds = dict(df.dtypes)
    return df.select(
        *(
            F.to_json(F.col(c)).alias(c)
            if kinds[c].startswith(("array", "struct", "map"))
            else F.col(c).cast("int").cast("string").alias(c)
            if kinds[c] == "boolean"
            else F.col(c)
            for c in df.columns
        )
    )


def write_checkpoint(items: DataFrame, path: str, fmt: str = "parquet") -> DataFrame:
    """Write the enriched items once and go on from the written table, so nothing upstream runs twice."""
    kept = items.select(*(F.col(f.name).cast(f.dataType) for f in CHECKPOINT))
    write(flat(kept) if fmt == "csv" else kept, path, fmt)
    return read_checkpoint(items.sparkSession, path, fmt)


def result_path(output: str, project: str, threshold: int, mode: str) -> str:
    name = f"{threshold}_NewPriceInfo" if mode == "NEW_SPEND_INFO" else f"{threshold}_{mode}_PriceInfo"
    return f"{output.rstrip('/')}/{project}/{name}"


def write_result(df: DataFrame, output: str, project: str, threshold: int, mode: str, fmt: str = "parquet") -> str:
    path = result_path(output, project, threshold, mode)
    write(flat(df) if fmt == "csv" else df, path, fmt)
    return path


def classifier_request(items: DataFrame, random_part_number: bool = False) -> DataFrame:
    """One row per first occurrence. The part number is a hash of the key, or a random UUID on request."""
    part_number = "uuid()" if random_part_number else "sha2(key, 256)"
    return items.filter("NOT is_duplicate").selectExpr(
        "pim AS PIM_KEY",
        "canonical_manufacturer AS COMPANY_NAME",
        f"{part_number} AS PART_NUMBER",
        "item_description AS PRODUCT_DESCRIPTION",
        "'' AS UNSPSC",
    )


def write_classifier_request(request: DataFrame, path: str) -> None:
    write(request, path, "csv")
