"""Records of CSV files with quoted line breaks, read by many tasks per file, and numbered in file order.

Spark's reader makes a file with line breaks in quoted fields one task. Here Spark cuts files into splits of lines as it does with any
text, and two passes find the records:

1. A line starts either a record or inside a quoted field. For both cases every split works out how many records it starts and in which
   case its end is. One row per split comes to the driver, which holds the list of splits for its scheduling anyway; going
   through them in file order tells how each one really starts, and the number of its first record.
2. Every split cuts its lines into records. A record that crosses into later splits is put together from its pieces, at most two per split.

Records are then parsed by Spark's own ``from_csv``. The second pass must see the same splits as the first; Spark derives them from
the cores it has, so a split that the first pass has not seen fails the read instead of mixing up rows.

Quotes are doubled inside quoted fields. A quote inside an unquoted field is a character like any other; what follows a closing quote belongs
to the value up to the next comma. Lines end with a line feed, or with carriage return and line feed; empty lines between records
are skipped. A file that ends inside a quoted field has its rest as the last record.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

WHOLE, OPEN, REST = 0, 1, 2
_FROM_CSV = {"quote": '"', "escape": '"', "multiLine": "true", "lineSep": "\n"}


def ends_quoted(line: str, quoted: bool) -> bool:
    """Whether the end of a line is inside a quoted field, if its beginning is or isn't."""
    at = 0
    while True:
        if quoted:
            end = line.find('"', at)
            while end >= 0 and line.startswith('"', end + 1):
                end = line.find('"', end + 2)
            if end < 0:
                return True
            quoted, at = False, end + 1
        elif line.startswith('"', at):
            quoted, at = True, at + 1
            continue
        comma = line.find(",", at)
        if comma < 0:
            return False
        at = comma + 1


def _lines(spark: SparkSession, path) -> DataFrame:
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select("_metadata.file_path", "_metadata.file_block_start", "value")


def _by_split(batches: Iterator[pa.RecordBatch]):
    """((file, start), line) one after another."""
    for batch in batches:
        for file, start, line in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            yield (file, start), line


def splits(lines: DataFrame) -> DataFrame:
    """(file, start, ends, quoted_ends, records, quoted_records) of every split, if it starts with a record or in a quoted field."""

    def run(batches):
        held, quoted, count = None, [False, True], [0, 0]

        def row():
            columns = [[held[0]], [held[1]], [quoted[0]], [quoted[1]], [count[0]], [count[1]]]
            kinds = [pa.string(), pa.int64(), pa.bool_(), pa.bool_(), pa.int64(), pa.int64()]
            names = ["file", "start", "ends", "quoted_ends", "records", "quoted_records"]
            return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

        for split, line in _by_split(batches):
            if split != held:
                if held is not None:
                    yield row()
                held, quoted, count = split, [False, True], [0, 0]
            for case in (0, 1):
                if not quoted[case] and line not in ("", "\r"):
                    count[case] += 1
                if '"' in line:
                    quoted[case] = ends_quoted(line, quoted[case])
        if held is not None:
            yield row()

    return lines.mapInArrow(run, "file string, start bigint, ends boolean, quoted_ends boolean, records bigint, quoted_records bigint")


def beginnings(rows: list, header: bool) -> dict[tuple[str, int], tuple[bool, int, bool]]:
    """How each split starts, the number of its first record, and whether that is a file's header, which has no number."""
    out, number, file, quoted, wanted = {}, 0, None, False, False
    for r in sorted(rows, key=lambda r: (r.file, r.start)):
        if r.file != file:
            file, quoted, wanted = r.file, False, header
        count = r.quoted_records if quoted else r.records
        out[r.file, r.start] = (quoted, number, wanted and count > 0)
        number += count - (wanted and count > 0)
        wanted = wanted and not count
        quoted = r.quoted_ends if quoted else r.ends
    return out


def pieces(lines: DataFrame, known: dict[tuple[str, int], tuple[bool, int, bool]]) -> DataFrame:
    """(file, start, kind, place, text): whole records, the beginning of one that goes on in the next split (``OPEN``), and what a
    split has of a record begun before it (``REST``). Headers are left out; one that goes on has a null place."""
    shared = lines.sparkSession.sparkContext.broadcast(known)

    def run(batches):
        held, quoted, place, rows, kind, parts, header = None, False, 0, [], WHOLE, [], False

        def batch():
            nonlocal rows
            kinds = [pa.string(), pa.int64(), pa.int8(), pa.int64(), pa.string()]
            made = pa.record_batch([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], ["file", "start", "kind", "place", "text"])
            rows = []
            return made

        def close(now):
            nonlocal parts, place, header
            text = "\n".join(parts)
            named = header and now != REST
            if not named or now == OPEN:
                rows.append((*held, now, None if named else place, text.removesuffix("\r") if now != OPEN else text))
            place += now != REST and not named
            header = header and not named
            parts = []

        for split, line in _by_split(batches):
            if split != held:
                if parts:
                    close(REST if kind == REST else OPEN)
                held = split
                if split not in shared.value:
                    raise RuntimeError(f"{split[0]} was split otherwise before, now at {split[1]}: fix spark.sql.files.minPartitionNum")
                quoted, place, header = shared.value[split]
                kind = REST if quoted else WHOLE
            if not quoted and line in ("", "\r"):
                continue
            parts.append(line)
            if '"' in line:
                quoted = ends_quoted(line, quoted)
            if not quoted:
                close(kind)
                kind = WHOLE
            if len(rows) >= 4096:
                yield batch()
        if parts:
            close(REST if kind == REST else OPEN)
        if rows:
            yield batch()

    return lines.mapInArrow(run, "file string, start bigint, kind tinyint, place bigint, text string")


def read_records(spark: SparkSession, path, header: bool) -> DataFrame:
    """(source_file, place, record): every record of the files, numbered 0, 1, 2, ... in file order, without headers."""
    lines = _lines(spark, path)
    found = pieces(lines, beginnings(splits(lines).collect(), header))
    whole = found.filter(F.col("kind") == WHOLE).select("file", "place", "text")
    # A rest comes before what opens in the same split; what opens and the rests after it are one record.
    order = Window.partitionBy("file").orderBy("start", F.desc("kind"))
    crossing = found.filter(F.col("kind") != WHOLE).withColumn("nth", F.sum((F.col("kind") == OPEN).cast("int")).over(order))
    joined = crossing.groupBy("file", "nth").agg(
        F.min(F.when(F.col("kind") == OPEN, F.col("place"))).alias("place"),
        F.array_sort(F.collect_list(F.struct("start", (-F.col("kind")).alias("k"), "text"))).alias("parts"),
    )
    text = F.regexp_replace(F.array_join(F.transform("parts", lambda p: p["text"]), "\n"), "\r$", "")
    records = whole.unionByName(joined.filter("place IS NOT NULL").select("file", "place", text.alias("text")))
    return records.select(F.col("file").alias("source_file"), "place", F.col("text").alias("record"))


def parsed(record: Column, fields: list[str] | T.StructType, mode: str = "PERMISSIVE") -> Column:
    """A struct by position, of text columns if only names are given; missing fields are null, further ones are left out, unless
    ``mode`` is FAILFAST."""
    kinds = [(n, "string") for n in fields] if isinstance(fields, list) else [(f.name, f.dataType.simpleString()) for f in fields]
    schema = ", ".join(f"`{n.replace('`', '``')}` {kind}" for n, kind in kinds)
    return F.from_csv(record, schema, {**_FROM_CSV, "mode": mode})


def header_names(spark: SparkSession, path) -> list[str]:
    try:
        return spark.read.options(header=True, multiLine=True, escape='"').csv(path).columns
    except AnalysisException as error:
        if error.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        return []
