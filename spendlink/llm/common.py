"""Helpers shared by the text operators."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlink.sources.shared import materialize

#: ASCII upper case to lower case; every byte that cannot be part of a word to a blank. Bytes from 0x80 on belong to
#: words, so this works on UTF-8 as it does on code points.
WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unused(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def numbered(df: DataFrame, row: str) -> DataFrame:
    """``df`` with row numbers in ``row``, written once: files are split by the cores of the moment, so two reads may
    number the same rows differently."""
    return materialize(df.withColumn(row, F.monotonically_increasing_id()), "numbered")


def fold(doc_id: str, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % parts


def words_of(text: bytes | None) -> list[bytes]:
    """Lower-cased words of a UTF-8 text: runs of ASCII letters, digits and everything from U+0080 on."""
    return text.translate(WORD_BYTES).split() if text else []


def as_bytes(column: pa.Array) -> pa.Array:
    """The UTF-8 bytes of a text column, without decoding."""
    return column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary())


#: Bytes of a batch that are worked off at once.
PART_BYTES = 8 << 20


def release() -> None:
    """Give memory that finished work held back to the system; Python workers live on and serve other stages."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def map_arrow(
    df: DataFrame, work: Callable[[pa.RecordBatch], pa.RecordBatch | pa.Table | None], schema: str, whole: bool = False
) -> DataFrame:
    """``work`` on each Arrow batch, which Spark bounds in rows and bytes, in parts of about ``PART_BYTES``; ``whole`` batches are for work
    that sums up what it reads."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            step = batch.num_rows if whole else max(1, batch.num_rows * PART_BYTES // max(PART_BYTES, batch.nbytes))
            for at in range(0, batch.num_rows, step or 1):
                out = work(batch.slice(at, step))
                if out is not None:
                    yield from out.to_batches() if isinstance(out, pa.Table) else [out]
        del batches
        release()

    return df.mapInArrow(run, schema)
