"""Near-duplicate join on word shingles: Jaccard similarity of 0.8 or more.

1. A text becomes the set of its distinct runs of ``WORDS`` words (64-bit hashes; a text of fewer words is one run) and a
   signature of ``BANDS * ROWS`` MinHash values. Equal sets are one class with a count of its members from here on.
2. Classes that agree in a whole band are candidates. In each bucket, MinHash values (their low bytes) are compared in
   steps of ``STEP``; after each step a pair is dropped once the posterior probability (uniform prior) that its
   similarity reaches the threshold is below ``TOLERANCE``. Classes already connected are not compared again, and only
   the spanning edges of a bucket leave the task.
3. The survivors' connected components are small and alike; inside each, every pair is compared once: sizes, then the
   same Bayesian pruning, then exactly on the shingle sets. Buckets and components of any size are cut into tiles.
4. Exact links are counted per class and weighted by members; their components are the groups.

A pair of similarity 0.8 is in no common bucket with probability (1 - 0.8**5)**48 = 5e-9 and is pruned wrongly with a
probability of the order of ``TOLERANCE`` per step; both vanish for closer pairs. False pairs never pass the exact check.

Most buckets have one member and most texts no candidate. Bloom filters keep both out of the shuffles; exact joins follow.

Words are those of the decontamination operator. Texts without words (null, empty, signs only) link with nothing.
Rows with equal sets, repeated rows among them, link with each other. A null id is larger than any other when a group's
smallest id is taken. An empty table gives an empty result; other columns are left aside.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlink.llm.bloom import bloom, has
from spendlink.llm.clusters import Forest, components, linked_sets, meetings, per_meeting
from spendlink.llm.common import as_bytes, map_arrow, table, words_of
from spendlink.sources.shared import materialize

WORDS = 5
THRESHOLD = (4, 5)
BANDS, ROWS = 48, 5
STEP, COMPARED = 16, 128
TOLERANCE = 1e-9
BUCKET_TILE, TILE = 1024, 256
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers (the finalizer of splitmix64; its constants are fixed values)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Hasher:
    """Word hashes, remembered up to a bound, and from them shingle sets."""

    LIMIT = 200_000

    def __init__(self):
        self.kept: dict[bytes, int] = {}

    def _word(self, word: bytes) -> int:
        if len(self.kept) > self.LIMIT:
            self.kept = {}
        h = self.kept[word] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        return h

    def shingles(self, text: bytes | None) -> np.ndarray:
        """Sorted distinct shingle hashes."""
        words = words_of(text)
        if not words:
            return np.empty(0, np.uint64)
        get = self.kept.get
        h = np.array([get(w) or self._word(w) for w in words], np.uint64)
        size = min(WORDS, len(h))
        out = np.full(len(h) - size + 1, size, np.uint64)
        for k in range(size):
            out = mixed(out * _GOLDEN + h[k : len(h) - size + 1 + k])
        return np.unique(out)


@lru_cache
def multipliers(count: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.Generator(np.random.PCG64(11))
    a = rng.integers(0, 1 << 63, count, np.uint64) * np.uint64(2) + np.uint64(1)
    return a, rng.integers(0, 1 << 63, count, np.uint64)


def minhash(shingles: np.ndarray, count: int = BANDS * ROWS) -> np.ndarray:
    """``count`` MinHash values of a non-empty set."""
    a, b = multipliers(count)
    out = np.full(count, np.iinfo(np.uint64).max)
    for first in range(0, len(shingles), 512):
        part = shingles[first : first + 512]
        values = part[None, :] * a[:, None] + b[:, None]
        out = np.minimum(out, (values ^ (values >> np.uint64(32))).min(axis=1))
    return mixed(out)


def least_matches() -> list[int]:
    """After 16, 32, ... compared values: the fewest matches that keep a pair.

    With a uniform prior, the similarity after m matches in n is Beta(m + 1, n - m + 1); it reaches t with probability
    P(Binomial(n + 1, t) <= m).
    """
    t = THRESHOLD[0] / THRESHOLD[1]
    out = []
    for n in range(STEP, COMPARED + 1, STEP):
        tail, m = 0.0, -1
        while tail < TOLERANCE:
            m += 1
            tail += comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
        out.append(m)
    return out


LEAST = least_matches()


def survivors(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Places of the pairs (rows of two signature arrays) that incremental comparison keeps."""
    at = np.arange(len(left))
    matches = np.zeros(len(left), np.int32)
    for k, least in enumerate(LEAST):
        part = slice(k * STEP, (k + 1) * STEP)
        matches += (left[at, part] == right[at, part]).sum(axis=1, dtype=np.int32)
        keep = matches >= least
        at, matches = at[keep], matches[keep]
        if not len(at):
            break
    return at


def _signatures(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, COMPARED)


def signed(docs: DataFrame) -> DataFrame:
    """(doc_id, key, node, size, signature, bands) for docs(doc_id, text, key): node identifies the shingle set."""
    hasher = Hasher()

    def work(batch):
        node, size, signature, bands = [], [], [], []
        for text in as_bytes(batch.column(2)):
            s = hasher.shingles(text.as_py())
            size.append(len(s))
            if len(s):
                values = minhash(s)
                node.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                signature.append(values[:COMPARED].astype(np.uint8).tobytes())
                keys = np.full(BANDS, 1, np.uint64)
                for r in range(ROWS):
                    keys = mixed(keys * _GOLDEN + values.reshape(BANDS, ROWS)[:, r])
                bands.append(keys.astype(np.int64))
            else:
                node.append(None)
                signature.append(None)
                bands.append(None)
        return pa.record_batch(
            [
                batch.column(0), batch.column(1), pa.array(node, pa.binary()), pa.array(size, pa.int64()),
                pa.array(signature, pa.binary()), pa.array(bands, pa.list_(pa.int64())),
            ],
            ["doc_id", "key", "node", "size", "signature", "bands"],
        )

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, key string, node binary, size bigint, signature binary, bands array<bigint>"
    return map_arrow(docs.select("doc_id", "key", "text"), work, schema)


def banded_in(each: DataFrame, shared: DataFrame) -> DataFrame:
    """(node, bucket) of each(node, buckets) for the buckets of ``shared``, and for few others, which a join drops."""
    filled = each.sparkSession.sparkContext.broadcast(bloom(shared.select(F.col("bucket").alias("hash"))))

    def work(batch):
        lists = batch.column(1)
        bucket = lists.flatten().to_numpy()
        keep = np.flatnonzero(has(filled.value, bucket))
        node = batch.column(0).take(pa.array(lists.value_parent_indices().to_numpy()[keep]))
        return pa.record_batch([node, pa.array(bucket[keep])], ["node", "bucket"])

    return map_arrow(each.select("node", "buckets"), work, "node binary, bucket bigint")


def candidate_edges(classes: DataFrame) -> DataFrame:
    """Spanning edges (a, b) of the surviving pairs of each bucket of classes(node, signature, bands)."""
    each = classes.select("node", F.transform("bands", lambda value, band: F.xxhash64(band, value)).alias("buckets"))
    sizes = each.select(F.explode("buckets").alias("bucket")).groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    shared = materialize(sizes.filter("n > 1").select("bucket"), "shared")
    # Written before anything else happens, so that a bucket with very many members can be split over tasks.
    banded = materialize(banded_in(each, shared).join(shared, "bucket"), "buckets")
    rows = meetings(banded, "bucket", "node", BUCKET_TILE).join(classes.select("node", "signature"), "node")

    def work(t: pa.Table):
        signature, node = _signatures(t.column("signature")), t.column("node").to_pylist()
        crossing = t.column("first")[0].as_py() != t.column("second")[0].as_py()
        tile = t.column("tile").to_numpy()

        def linked(i, others):
            hit = np.zeros(len(others), bool)
            hit[survivors(np.broadcast_to(signature[i], (len(others), COMPARED)), signature[others])] = True
            return hit & (tile[others] != tile[i]) if crossing else hit

        root = linked_sets(len(node), linked)
        apart = np.flatnonzero(root != np.arange(len(node)))
        ends = [pa.array([node[i] for i in apart], pa.binary()), pa.array([node[r] for r in root[apart]], pa.binary())]
        return pa.record_batch(ends, ["a", "b"])

    columns = ["bucket", "first", "second", "tile", "node", "signature"]
    return per_meeting(rows.select(*columns), "bucket", work, "a binary, b binary")


def _intersections(sets: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of sets i and j, pair by pair."""
    if len(i) <= 4 * len(sets):
        return np.array([len(np.intersect1d(sets[a], sets[b], assume_unique=True)) for a, b in zip(i, j, strict=True)], np.int64)
    sizes = [len(s) for s in sets]
    values, place, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(sets)), sizes)
    use = times[place] > 1
    order = np.argsort(place[use], kind="stable")
    place, owner = place[use][order], owner[use][order]
    common = np.zeros((len(sets), len(sets)), np.float32)
    _, column = np.unique(place, return_inverse=True)
    for first in range(0, int(column[-1]) + 1 if len(column) else 0, 4096):
        a, b = np.searchsorted(column, [first, first + 4096])
        x = np.zeros((len(sets), 4096), np.float32)
        x[owner[a:b], column[a:b] - first] = 1
        common += x @ x.T
    return common[i, j].astype(np.int64)


def packed(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """docs(key, text) with compressed texts, as they cross the network: the length, then the bytes.

    Those with a key of wanted(key), and few others, which a join drops.
    """
    filled = docs.sparkSession.sparkContext.broadcast(bloom(wanted.select(F.xxhash64("key").alias("hash"))))

    def work(batch):
        batch = batch.filter(pa.array(has(filled.value, batch.column(2).to_numpy())))
        texts = [t.as_py() or b"" for t in as_bytes(batch.column(1))]
        small = [len(t).to_bytes(8, "little") + pa.compress(t, codec="zstd", asbytes=True) for t in texts]
        return pa.record_batch([batch.column(0), pa.array(small, pa.binary())], ["key", "text"])

    return map_arrow(docs.select("key", "text", F.xxhash64("key")), work, "key string, text binary")


def unpacked(text: bytes) -> bytes:
    return pa.decompress(text[8:], int.from_bytes(text[:8], "little"), codec="zstd", asbytes=True)


def exact_links(members: DataFrame) -> DataFrame:
    """(node, links, root) per meeting for members(group, node, n, signature, text): links weighted by n. Texts are packed."""
    hasher = Hasher()
    up, down = THRESHOLD

    def work(t: pa.Table):
        node, signature, weight = t.column("node").to_pylist(), _signatures(t.column("signature")), t.column("n").to_numpy()
        sets = [hasher.shingles(unpacked(x.as_py())) for x in t.column("text")]
        size = np.array([len(s) for s in sets])
        i, j = np.triu_indices(len(node), 1)
        if t.column("first")[0].as_py() != t.column("second")[0].as_py():
            tile = t.column("tile").to_numpy()
            other = tile[i] != tile[j]
            i, j = i[other], j[other]
        fits = down * np.minimum(size[i], size[j]) >= up * np.maximum(size[i], size[j])
        i, j = i[fits], j[fits]
        alive = np.concatenate(
            [f + survivors(signature[i[f : f + 65536]], signature[j[f : f + 65536]]) for f in range(0, len(i), 65536)] or [[]]
        ).astype(np.int64)
        i, j = i[alive], j[alive]
        common = _intersections(sets, i, j)
        real = down * common >= up * (size[i] + size[j] - common)
        i, j = i[real], j[real]
        links = np.bincount(i, weight[j], len(node)) + np.bincount(j, weight[i], len(node))
        forest = Forest(len(node))
        for a in np.unique(i):
            forest.join(np.concatenate([[a], j[i == a]]))
        at = np.flatnonzero(links)
        return pa.record_batch(
            [
                pa.array([node[k] for k in at], pa.binary()), pa.array(links[at].astype(np.int64)),
                pa.array([node[r] for r in forest.root[at]], pa.binary()),
            ],
            ["node", "links", "root"],
        )

    columns = ["group", "first", "second", "tile", "node", "n", "signature", "text"]
    return per_meeting(members.select(*columns), "group", work, "node binary, links bigint, root binary")


def row_key(id_col: str, text_col: str) -> Column:
    """A digest of id and text; the id's length says where it ends, so no two pairs read alike."""
    row_id = F.col(id_col).cast("string")
    named = F.when(row_id.isNull(), "-").otherwise(F.concat(F.length(row_id).cast("string"), F.lit(":"), row_id))
    return F.md5(F.concat(named, F.lit("|"), F.coalesce(F.col(text_col), F.lit(""))))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", key: Column | None = None) -> DataFrame:
    """(doc_id, key, group, class_id, n_links) for every row.

    ``key``, a string, must identify a row's text; by default it is made of id and text. ``group`` names the group, null for
    a text without words.
    """
    key = row_key(id_col, text_col) if key is None else key
    narrow = docs.select(F.col(id_col).alias("doc_id"), key.alias("key"), F.col(text_col).alias("text"))
    rows = materialize(signed(narrow), "signed")
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")
    classes = (
        rows.filter(F.col("node").isNotNull())
        .groupBy("node")
        .agg(
            F.count(F.lit(1)).alias("n"), F.min(first).alias("first"), F.min("signature").alias("signature"),
            F.min("bands").alias("bands"),
        )
        .select("node", "n", F.col("first.none").alias("none"), F.col("first.doc_id").alias("least"), F.col("first.key").alias("key"), "signature", "bands")
    )
    classes = materialize(classes, "classes")
    candidates = components(candidate_edges(classes), "candidates")
    wanted = candidates.withColumnRenamed("root", "group").join(classes.select("node", "n", "key", "signature"), "node")
    wanted = materialize(wanted, "wanted")
    # Only candidates' texts are needed again, one for each class.
    texts = packed(narrow, wanted).join(wanted.select("key", "node"), "key").groupBy("node").agg(F.first("text").alias("text"))
    members = meetings(wanted.select("group", "node", "n", "signature"), "group", "node", TILE).join(texts, "node")
    found = materialize(exact_links(members), "links")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    groups = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")), "groups")
    ids = classes.select("node", "none", "least")
    best = groups.join(ids, "node").groupBy("root").agg(F.min(F.struct("none", "least")).alias("best"))
    grouped = groups.join(best, "root").select("node", "root", F.col("best.least").alias("group_least"))
    per_class = (
        classes.select("node", "n", "least").join(links, "node", "left").join(grouped, "node", "left")
        .select("node", F.coalesce("root", "node").alias("group"), (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("group_least", "least").alias("class_id"))
    )
    return rows.select("doc_id", "key", "node").join(per_class, "node", "left").select(
        "doc_id", "key", "group", F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("n_links", F.lit(0)).alias("n_links")
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links")
