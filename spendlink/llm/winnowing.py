"""Document fingerprints by winnowing, and the likeness of each document to its neighbour and to an edited form of itself.

1. Every run of ``GRAM`` code points is a gram. Its hash is a polynomial, rolled along the text: prefix sums of
   ``c * B**-i`` modulo 2**64 give every gram by one difference, scrambled to ``HASH_BITS`` bits.
2. Of each ``WINDOW`` consecutive grams the one of the smallest hash is chosen, of equal ones the rightmost. Hash and position of
   every chosen gram are the fingerprint. Two texts that share a run of ``GRAM + WINDOW - 1`` code points choose the same gram in
   it, so such a run never goes unseen; no match shorter than ``GRAM`` is ever reported.
3. Likeness is the Jaccard similarity of the distinct hashes.
4. For the neighbours, rows are put into descending order of id by range: cut points come from a range partitioning of ids alone, each
   row finds its block by them, and the first row of a block goes to the block before as well, where it ends the walk. A block is
   walked in order with two texts in memory; texts cross the network once, packed.

The work on a text goes in chunks, so memory beyond the text itself does not follow its length.

A null text counts as empty; an empty text has no grams and an empty fingerprint; a text of fewer code points than a gram is
one gram; one of fewer grams than a window is one window. Two empty fingerprints have likeness 1, an empty and another 0. Rows of
equal id follow one another by a hash of their texts; rows equal in id and text are counted before they are shuffled,
and each is the next of the one before. A null id comes last. A single row is its own next. An empty table gives an empty result;
other columns are left aside.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlink.llm.common import as_bytes, map_arrow, table

GRAM, WINDOW = 20, 45
HASH_BITS = 44
PLACE_BITS = 64 - HASH_BITS
CHUNK = 1 << 18
#: Texts and fingerprints handed over at once, in bytes.
OUTPUT = 4 << 20
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_PLACES = np.uint64((1 << PLACE_BITS) - 1)


def scrambled(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


@lru_cache(maxsize=2)
def powers(base: int, count: int) -> np.ndarray:
    out = np.full(count, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


def gram_hashes(points: np.ndarray, size: int) -> np.ndarray:
    """The hash of each ``size`` consecutive code points, ``CHUNK + WINDOW + size`` of them at most."""
    many = CHUNK + WINDOW + size
    sums = np.zeros(len(points) + 1, np.uint64)
    np.cumsum(scrambled(points.astype(np.uint64) + np.uint64(1)) * powers(_INVERSE, many)[: len(points)], out=sums[1:])
    rolled = (sums[size:] - sums[:-size]) * powers(_BASE, many)[: len(points) - size + 1]
    return scrambled(rolled) >> np.uint64(PLACE_BITS)


def window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` consecutive values."""
    done = 1
    while 2 * done <= width:
        values = np.minimum(values[:-done], values[done:])
        done *= 2
    rest = width - done
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def winnow(points: np.ndarray, gram: int = GRAM, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the chosen grams, by position."""
    if not len(points):
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    gram = min(gram, len(points))
    grams = len(points) - gram + 1
    window = min(window, grams)
    positions, hashes = [], []
    for first in range(0, grams - window + 1, CHUNK):
        last = min(first + CHUNK, grams - window + 1) + window - 1
        h = gram_hashes(points[first : last + gram - 1], gram)
        # The place counts down in the low bits, so of equal hashes the rightmost is the least.
        keys = window_minima(h << np.uint64(PLACE_BITS) | (_PLACES - np.arange(len(h), dtype=np.uint64)), window)
        at = (_PLACES - (keys & _PLACES)).astype(np.int64)
        new = np.ones(len(at), bool)
        new[1:] = at[1:] != at[:-1]
        positions.append(at[new] + first)
        hashes.append(h[at[new]])
    at, h = np.concatenate(positions), np.concatenate(hashes)
    new = np.ones(len(at), bool)
    new[1:] = at[1:] != at[:-1]  # two chunks may choose the same gram
    return at[new], h[new]


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two sets of hashes."""
    a, b = np.unique(a), np.unique(b)
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def written(positions: np.ndarray, hashes: np.ndarray) -> str:
    """``hash:position`` of each chosen gram, comma-joined; the hash in hexadecimal."""
    return ",".join([f"{h:011x}:{p}" for h, p in zip(hashes.tolist(), positions.tolist(), strict=True)])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """doc_id, n_chars and the fingerprint (position, hash) of every row."""
    one = pa.struct([("position", pa.int32()), ("hash", pa.int64())])

    def work(batch):
        sizes, lists = [], []
        for text in as_bytes(batch.column(1)):
            points = code_points((text.as_py() or b"").decode())
            at, h = winnow(points, gram, window)
            sizes.append(len(points))
            lists.append([{"position": p, "hash": x} for p, x in zip(at.tolist(), h.tolist(), strict=True)])
        return pa.record_batch([batch.column(0), pa.array(sizes, pa.int64()), pa.array(lists, pa.list_(one))], ["doc_id", "n_chars", "fingerprint"])

    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = narrow.schema["doc_id"].dataType.simpleString()
    return map_arrow(narrow, work, f"doc_id {kind}, n_chars bigint, fingerprint array<struct<position:int,hash:bigint>>")


# --- Neighbours ------------------------------------------------------------------------------------------------


def block_starts(keyed: DataFrame, blocks: int) -> list[tuple]:
    """The first key of each block of keyed(doc_id, digest), in ascending order: at most ``blocks`` keys, whatever the input."""
    key = F.struct("doc_id", "digest")
    parts = keyed.select(key.alias("key")).repartitionByRange(blocks, F.desc("key"))
    found = parts.groupBy(F.spark_partition_id().alias("part")).agg(F.max("key").alias("key")).select("key").collect()
    return sorted(place_of(r.key.doc_id, r.key.digest) for r in found)


def place_of(doc_id, digest: int) -> tuple:
    """A key as Spark orders it: null below everything."""
    return (0, digest) if doc_id is None else (1, doc_id, digest)


def dealt(docs: DataFrame, blocks: int) -> DataFrame:
    """(block, tail, doc_id, digest, copies, size, packed): each row in its block, and the first of a block, as tail, in the block before.

    Rows of a batch that are equal in id and text travel as one.
    """
    keyed = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("digest"), "text")
    starts = block_starts(keyed.select("doc_id", "digest"), blocks)
    count = len(starts)

    def work(batch):
        seen: dict[tuple, int] = {}
        for row in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), as_bytes(batch.column(2)).to_pylist(), strict=True):
            row = (row[0], row[1], row[2] or b"")
            seen[row] = seen.get(row, 0) + 1
        out = []
        for (doc_id, digest, text), copies in seen.items():
            at = bisect_left(starts, place_of(doc_id, digest))
            block = count - 1 - min(at, count - 1)
            line = (doc_id, digest, copies, len(text), pa.compress(text, codec="zstd", asbytes=True))
            out.append((block, False, *line))
            if at < count and starts[at] == place_of(doc_id, digest):
                out.append(((block - 1) % count, True, *line))
        kinds = [pa.int32(), pa.bool_(), batch.schema.field(0).type, pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        names = ["block", "tail", "doc_id", "digest", "copies", "size", "packed"]
        return pa.record_batch([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"block int, tail boolean, doc_id {kind}, digest bigint, copies bigint, size bigint, packed binary"
    return map_arrow(keyed, work, schema)


@dataclass
class Document:
    """A text of the walk with its fingerprint; ``copies`` rows are equal to it."""

    key: tuple
    copies: int
    text: str

    def __post_init__(self):
        self.points = code_points(self.text)
        self.positions, self.hashes = winnow(self.points)

    def beside(self, following: Document) -> tuple:
        """The columns of a row that ``following`` comes next to."""
        half = len(self.points) // 2
        kept = len(self.points) - half
        edited = self.text[:kept] + following.text[:half]
        positions, hashes = winnow(np.concatenate([self.points[:kept], following.points[:half]]))
        return (
            len(self.points), hashlib.sha256(edited.encode()).hexdigest(), written(self.positions, self.hashes),
            written(positions, hashes), likeness(self.hashes, hashes), likeness(self.hashes, following.hashes),
        )


COLUMNS = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
_KINDS = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]


def with_neighbours(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``COLUMNS`` for every row: fingerprints of the text and of the text whose second half is that of the next
    document's beginning, in descending order of id, and what they have in common."""
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["block", "tail", F.desc_nulls_last("doc_id"), F.desc("digest"), "packed"]
    placed = dealt(narrow, 4 * partitions).repartition(partitions, "block").sortWithinPartitions(*order)
    kind = narrow.schema["doc_id"].dataType

    def run(batches):
        held, rows, size, id_type = None, [], 0, None

        def made():
            nonlocal rows, size
            columns = [pa.array([r[0] for r in rows], id_type), *(pa.array([r[i + 1] for r in rows], k) for i, k in enumerate(_KINDS))]
            rows, size = [], 0
            return pa.record_batch(columns, COLUMNS)

        def lines(following):
            """Rows of the held text: its copies have one another next, the last of them has ``following``."""
            if held.copies > 1:
                line = held.beside(held)
                for _ in range(held.copies - 1):
                    yield held.key[1], *line
            yield held.key[1], *held.beside(following)

        for batch in batches:
            id_type = batch.schema.field("doc_id").type
            for block, tail, doc_id, digest, copies, length, packed in zip(*(c for c in batch.columns), strict=True):
                key = (block.as_py(), doc_id.as_py(), digest.as_py(), packed.as_py())
                tail, copies = tail.as_py(), copies.as_py()
                if tail and held is None:
                    continue  # the block's end is known already
                if held is not None and not tail and held.key == key:
                    held.copies += copies
                    continue
                text = pa.decompress(key[3], length.as_py(), codec="zstd", asbytes=True).decode()
                now = Document(key, copies, text)
                if held is not None:
                    for line in lines(now):
                        rows.append(line)
                        size += len(line[3]) + len(line[4]) + 256
                        if size >= OUTPUT:
                            yield made()
                held = None if tail else now
        if rows:
            yield made()

    schema = (
        f"doc_id {kind.simpleString()}, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double"
    )
    return placed.mapInArrow(run, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_neighbours(table(spark, sf_dir, "documents"))
