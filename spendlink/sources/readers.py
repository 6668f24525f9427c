"""Readers. Spreadsheets are expected as CSV; every reader also takes Parquet.

CSV keeps item numbers as text, so leading zeros survive until cleaning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendlink.schema import CHECKPOINT, ITEM_COLUMNS, ITEM_SHEET, PREDICTIONS
from spendlink.sources.records import header_names, parsed, read_records


def _by_position(df: DataFrame, names: list[str]) -> DataFrame:
    return df.toDF(*names, *df.columns[len(names) :]).select(*names)


def _positional_csv(spark: SparkSession, path, names: list[str], header: bool, **options) -> DataFrame:
    text = T.StructType([T.StructField(n, T.StringType()) for n in names])
    return spark.read.schema(text).options(header=header, enforceSchema=True, **options).csv(path)


def read_items(spark: SparkSession, path, fmt: str = "csv", **options) -> DataFrame:
    """All files of a folder (or a list of paths): three columns by position, header skipped, null as blank.

    Adds ``source_file`` and ``row_id``, the row's number in the order of files and rows. A file Spark cannot read fails the scan; none is read
    twice. CSV is split into many tasks also where quoted fields have line breaks. With reader options (another separator, say) Spark's
    own reader takes over, one task per file unless they have ``multiLine=False``; there, and for formats without
    row positions, ``row_id`` follows the scan, so write the items before they are used twice.
    """
    if fmt == "csv" and not options:
        records = read_records(spark, path, header=True)
        items = records.select(parsed(F.col("record"), ITEM_COLUMNS).alias("r"), "source_file", F.col("place").alias("row_id"))
        return items.select("r.*", "source_file", "row_id").fillna("", subset=ITEM_COLUMNS).select(*ITEM_COLUMNS, "source_file", "row_id")
    if fmt == "csv":
        raw = spark.read.schema(ITEM_SHEET).options(**{"header": True, "multiLine": True, "escape": '"', **options}).csv(path)
    else:
        raw = spark.read.format(fmt).options(**options).load(path)
    source = F.col("_metadata.file_path").alias("source_file")
    if fmt != "parquet":
        named = raw.select(*raw.columns[:3], source, F.monotonically_increasing_id()).toDF(*ITEM_COLUMNS, "source_file", "row_id")
        return named.fillna("", subset=ITEM_COLUMNS)
    named = raw.select(*raw.columns[:3], source, "_metadata.row_index").toDF(*ITEM_COLUMNS, "source_file", "row_index")
    sizes = named.groupBy("source_file").agg((F.max("row_index") + 1).alias("n"))  # a row per file
    before = Window.orderBy("source_file").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("source_file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    numbered = named.join(starts, "source_file").withColumn("row_id", F.col("start") + F.col("row_index"))
    return numbered.fillna("", subset=ITEM_COLUMNS).select(*ITEM_COLUMNS, "source_file", "row_id")


def alias_pairs(sheet: DataFrame, order: Column | None = None) -> DataFrame:
    """Wide alias sheet to ``(alias, canonical)``.

    First column canonical name, second the number n of aliases, then n aliases; later rows (by ``order``) and columns win.
    """
    canonical, count, *aliases = (c for c in sheet.columns if c != "place")
    listed = sheet.select(
        F.col(canonical).alias("canonical"),
        (F.monotonically_increasing_id() if order is None else order).alias("row_no"),
        F.slice(F.array(*aliases), F.lit(1), F.greatest(F.col(count).try_cast("int"), F.lit(0))).alias("aliases"),
    )
    pairs = listed.select("canonical", "row_no", F.posexplode("aliases").alias("pos", "alias"))
    return (
        pairs.filter("alias IS NOT NULL")
        .groupBy("alias")
        .agg(F.expr("max(struct(row_no, pos, canonical)).canonical AS canonical"))
    )


def read_alias_map(spark: SparkSession, path) -> DataFrame:
    """The sheet is ragged: the largest alias count, not the header, says how many columns are read."""
    records = read_records(spark, path, header=True)
    counts = records.select(parsed(F.col("record"), ["canonical", "n"]).alias("r"))
    widest = counts.agg(F.max(F.expr("try_cast(r.n AS INT)"))).first()[0] or 0
    names = ["canonical", "n", *(f"alias_{i}" for i in range(max(1, widest)))]
    sheet = records.select(parsed(F.col("record"), names).alias("r"), "place").select("r.*", "place")
    return alias_pairs(sheet, F.col("place"))


def keyword_pairs(sheet: DataFrame, order: Column | None = None) -> DataFrame:
    """Two columns to lower-cased ``(keyword, full_name)``; the last row (by ``order``) of a keyword wins."""
    keyword, full_name = sheet.columns[:2]
    numbered = sheet.select(
        F.lower(keyword).alias("keyword"),
        F.lower(full_name).alias("full_name"),
        (F.monotonically_increasing_id() if order is None else order).alias("row_no"),
    )
    return numbered.groupBy("keyword").agg(F.expr("max(struct(row_no, full_name)).full_name AS full_name"))


def read_keyword_map(spark: SparkSession, path) -> DataFrame:
    records = read_records(spark, path, header=False)
    sheet = records.select(parsed(F.col("record"), ["keyword", "full_name"]).alias("r"), "place").select("r.*", "place")
    return keyword_pairs(sheet, F.col("place"))


# Headers of the priority sheet that are used.
PRIORITY_COLUMNS = {
    "Item Description": "item_description",
    "Clean Description": "clean_description",
    "processed clean desc": "processed_clean_desc",
}
PRIORITY_WIDTH = 9


def priority_list(sheet: DataFrame, row_no: Column | None = None) -> DataFrame:
    """The three text columns among the first nine, with a row number."""
    names = [c for c in PRIORITY_COLUMNS if c in sheet.columns[:PRIORITY_WIDTH]]
    if len(names) < len(PRIORITY_COLUMNS):
        raise ValueError(f"the first {PRIORITY_WIDTH} columns must have {', '.join(PRIORITY_COLUMNS)}")
    used = [F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(name) for c, name in PRIORITY_COLUMNS.items()]
    return sheet.select(*used, (F.monotonically_increasing_id() if row_no is None else row_no).alias("row_no"))


def read_priority_list(spark: SparkSession, path) -> DataFrame:
    """Rows are numbered in file order, so the first original of a clean description is the same at every read."""
    names = header_names(spark, path)
    records = read_records(spark, path, header=True)
    rows = records.select(parsed(F.col("record"), names[:PRIORITY_WIDTH]).alias("r"), "place").select("r.*", "place")
    return priority_list(rows, F.col("place"))


def read_predictions(spark: SparkSession, path, header: bool = True) -> DataFrame:
    """Quotes are doubled inside quoted fields and line breaks are kept; a row of another width fails the read."""
    records = read_records(spark, path, header)
    return records.select(parsed(F.col("record"), PREDICTIONS, mode="FAILFAST").alias("r")).select("r.*")


def read_checkpoint(spark: SparkSession, path, fmt: str = "parquet") -> DataFrame:
    """The 15 columns by position; null text reads as blank, except in the product fields."""
    if fmt == "csv":
        raw = _positional_csv(spark, path, CHECKPOINT.names, header=True, multiLine=True, escape='"')
        flags = F.col("is_duplicate").isin("1", "true")
    else:
        raw = _by_position(spark.read.format(fmt).load(path), CHECKPOINT.names)
        flags = F.col("is_duplicate").cast("boolean")
    typed = raw.withColumn("is_duplicate", flags).select(*(F.col(f.name).cast(f.dataType) for f in CHECKPOINT))
    return typed.fillna("", subset=[f.name for f in CHECKPOINT[:10] if f.dataType == T.StringType()])


def read_table(spark: SparkSession, source: str, *, fmt: str = "parquet", **options) -> DataFrame:
    """A reference table by one interface: files by path, or ``fmt='jdbc'`` with the table name as ``source``.

    A JDBC read is split by ``partitionColumn``, ``lowerBound``, ``upperBound`` and ``numPartitions``.
    """
    if fmt == "jdbc":
        return spark.read.format("jdbc").options(dbtable=source, **options).load()
    return spark.read.format(fmt).options(**options).load(source)
