"""A blocked Bloom filter over 64-bit hashes, 8 MB at any size.

It spares rows a shuffle that a join would drop anyway. A full filter lets more rows pass and costs time; the join behind it decides.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK_BITS, BIT = 7, 19


def _bits(gram: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    g = gram.astype(np.uint64)
    mask = np.uint64((1 << BIT) - 1)
    return (g >> np.uint64(64 - BLOCK_BITS)).astype(np.int64), [
        ((g >> np.uint64(k * BIT)) & mask).astype(np.int64) for k in range(3)
    ]


def bloom(places: DataFrame) -> np.ndarray:
    """One row of bits per block, of places(hash); every block is filled by one task."""

    def run(batches):
        held, bits = None, None
        for batch in batches:
            block, places = _bits(batch.column(1).to_numpy())
            for b in np.unique(block):
                if b != held:
                    if held is not None:
                        yield piece(held, bits)
                    held, bits = b, np.zeros(1 << BIT, bool)
                for p in places:
                    bits[p[block == b]] = True
        if held is not None:
            yield piece(held, bits)

    def piece(block, bits):
        return pa.record_batch([pa.array([block], pa.int32()), pa.array([np.packbits(bits).tobytes()], pa.binary())], ["block", "bits"])

    block = F.shiftrightunsigned("hash", 64 - BLOCK_BITS).cast("int").alias("block")
    placed = places.select(block, "hash").repartition("block").sortWithinPartitions("block")
    out = np.zeros((1 << BLOCK_BITS, 1 << (BIT - 3)), np.uint8)
    for row in placed.mapInArrow(run, "block int, bits binary").toLocalIterator():
        out[row.block] |= np.frombuffer(row.bits, np.uint8)
    return out


def has(filled: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    block, places = _bits(hashes)
    keep = np.ones(len(hashes), bool)
    for p in places:
        keep &= (filled[block, p >> 3] >> (7 - (p & 7)).astype(np.uint8)) & 1 > 0
    return keep
