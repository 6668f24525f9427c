"""Language-model scores by prediction by partial matching (PPM) over bytes, and unigram base scores.

**Model.** A text is its UTF-8 bytes and an end symbol. All training texts are counted into a trie of byte contexts of up
to ``order`` symbols (the start of a text counts as end symbols); the registered query uses ``DEPTH`` = 5. A symbol is
coded in its longest known context; there it has ``count / (total + distinct)``, and the escape to the next shorter
context has ``distinct / (total + distinct)``. Symbols of the longer context are excluded from the shorter ones; below
order 0 the symbols not yet excluded are equally likely. A context that has all symbols left needs no escape. The
probabilities of a context therefore sum to 1, and so do those of all texts.

**Tables.** One pass cuts the documents into slices and writes a table: the slice's packed texts; its distinct
(context, symbol) pairs with their training counts; its distinct tokens with theirs. Pairs and tokens are packed by a hash
(for pairs, of the three nearest symbols) into ``BUCKETS`` rows a slice. Each bucket gathers its rows from all slices,
sums the counts, works out the probability of every pair, and answers each slice's row in its own order; a slice then
meets its answers. What is gathered grows with the distinct pairs of the corpus; none of it is collected or broadcast but
the pairs of order 2, of which there are at most 257**3, as the lower orders serve all buckets. Texts are read once.

**Base score.** Tokens of the whole corpus are counted exactly, in the same buckets; the logarithms are added per document.

Null and empty texts consist of the end token (and end symbol) alone. Repeated rows are learned from and scored each; a
null id counts as the empty id. An empty table gives an empty result; without training rows the counts are 0 and the model
is uniform. Other columns are left aside.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlink.llm.common import as_bytes, fold, map_arrow, table
from spendlink.sources.shared import materialize

FOLDS, HELD_OUT = 7, 2
#: The order up to which counts serve all buckets, and the least a model can have.
ORDER = 2
#: The order of the registered query.
DEPTH = 5
END = 256
SYMBOLS = 257
#: Bytes of text that are put together in one go.
SLICE = 1 << 23
BUCKETS = 1024
#: Cells of a dense table that numbers contexts; up to MARKED they are marked and ranked, beyond it sorted.
DENSE, MARKED = 1 << 24, 1 << 27
#: Symbols ranked at once.
RANKED = 1 << 20
#: Kinds of rows.
TEXTS, PAIRS, TOKENS, LOW = range(4)


def symbols(texts: list[bytes], order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """All texts in one array, ``order`` end symbols before each and after the last; and where each text starts."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    out = np.full(int(sizes.sum()) + order * (len(texts) + 1), END, np.int16)
    starts = order + np.concatenate([[0], np.cumsum(sizes + order)])[:-1] if len(texts) else np.empty(0, np.int64)
    inner = np.ones(len(out), bool)
    inner[:order] = False
    for k in range(order):
        inner[starts + sizes + k] = False
    out[inner] = np.frombuffer(b"".join(texts), np.uint8)
    return out, starts


def coded(texts: list[bytes]):
    """Per symbol to be coded: the number of its context (two symbols) and the symbol; and the first one of each text."""
    x, starts = symbols(texts)
    x = x.astype(np.int32)
    context = x[:-2] * SYMBOLS + x[1:-1]
    symbol = x[2:]
    keep = np.ones(len(symbol), bool)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    keep[starts + sizes + 1 - 2] = False  # the second end symbol only parts the texts
    first = np.concatenate([[0], np.cumsum(sizes + 1)])[:-1]
    return context[keep], symbol[keep], first


def _ranked(key: np.ndarray, cells: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys, ascending, and the place of each key among them, from a map of marks: no key is sorted."""
    seen = np.zeros(-(-cells // 64) * 64, bool)
    seen[key] = True
    known = np.flatnonzero(seen)
    marks = np.packbits(seen, bitorder="little").view("<u8")
    del seen
    before = np.cumsum(np.bitwise_count(marks), dtype=np.int32)
    before = np.concatenate([np.zeros(1, np.int32), before[:-1]])
    number = np.empty(len(key), np.int32)
    for first in range(0, len(key), RANKED):
        part = key[first : first + RANKED]
        word, bit = part >> 6, (part & 63).astype(np.uint64)
        lower = marks[word] & ((np.uint64(1) << bit) - np.uint64(1))
        number[first : first + RANKED] = before[word] + np.bitwise_count(lower)
    return known, number


def pairs(texts: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct (context, symbol) pairs, ascending, and the place of each coded symbol's pair among them. A pair is a
    number to the base 257: the nearest symbol of the context, the next one, ..., the symbol itself."""
    x, starts = symbols(texts, order)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    keep = np.ones(len(x) - order, bool)
    for k in range(1, order):
        keep[starts + sizes + k - order] = False
    used = np.flatnonzero(np.bincount(x, minlength=SYMBOLS))
    place = np.zeros(SYMBOLS, np.int16)
    place[used] = np.arange(len(used))
    x, k = place[x], len(used)
    code, number = np.zeros(1, np.int64), np.zeros(int(keep.sum()), np.int32)
    for at in [*range(order - 1, -1, -1), order]:
        part = x[at : len(x) - order + at][keep]
        cells = len(code) * k
        key = number.astype(np.int64) if cells >= 1 << 31 else number
        key *= k
        key += part
        if cells <= DENSE:
            seen = np.zeros(cells, bool)
            seen[key] = True
            known = np.flatnonzero(seen)
            names = np.empty(cells, np.int32)
            names[known] = np.arange(len(known), dtype=np.int32)
            number = names[key]
        elif cells <= MARKED:
            known, number = _ranked(key, cells)
        else:
            known, number = np.unique(key, return_inverse=True)
            number = number.astype(np.int32)
        code = code[known // k] * SYMBOLS + used[known % k]
    return code, number


def bucket_of(code: np.ndarray, order: int) -> np.ndarray:
    near = (code // SYMBOLS ** max(1, order - 2)).astype(np.uint64)
    return ((near * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)).astype(np.int64) % BUCKETS


def token_bucket(token: bytes) -> int:
    return zlib.crc32(token) % BUCKETS


class Model:
    """The whole model of order 2 as a dense table: ``row[context]`` is the row of ``log10`` with the symbols' log
    probabilities. Tests hold the packed pairs against it."""

    def __init__(self, context: np.ndarray, symbol: np.ndarray, n: np.ndarray):
        known, place = np.unique(context, return_inverse=True)
        order1 = np.zeros((SYMBOLS, SYMBOLS))
        np.add.at(order1, (context % SYMBOLS, symbol), n)
        order0 = order1.sum(axis=0)
        self.row = np.empty(SYMBOLS * SYMBOLS, np.int32)
        self.row[:] = len(known) + np.arange(SYMBOLS * SYMBOLS) % SYMBOLS
        self.row[known] = np.arange(len(known))
        self.log10 = np.empty((len(known) + SYMBOLS, SYMBOLS), np.float32)
        by_row = np.argsort(place, kind="stable")
        bounds = np.searchsorted(place[by_row], np.arange(len(known) + 1))
        for first in range(0, len(known), 2048):
            last = min(first + 2048, len(known))
            part = by_row[bounds[first] : bounds[last]]
            counts = np.zeros((last - first, SYMBOLS))
            counts[place[part] - first, symbol[part]] = n[part]
            self.log10[first:last] = _blend([counts, order1[known[first:last] % SYMBOLS], order0])
        self.log10[len(known) :] = _blend([order1, order0])

    def score(self, texts: list[bytes]) -> np.ndarray:
        """log10 probability of each text."""
        out = np.empty(len(texts))
        first, size = 0, 0
        for i, text in enumerate(texts):
            size += len(text)
            if size >= SLICE or i + 1 == len(texts):
                context, symbol, starts = coded(texts[first : i + 1])
                out[first : i + 1] = np.add.reduceat(self.log10[self.row[context], symbol].astype(np.float64), starts)
                first, size = i + 1, 0
        return out


def _blend(levels: list[np.ndarray]) -> np.ndarray:
    """log10 probabilities from counts of ever shorter contexts, with escapes and exclusion."""
    p = np.zeros(levels[0].shape)
    left = np.ones((len(p), 1))
    out = np.zeros(p.shape, bool)
    for counts in levels:
        n = np.where(out, 0.0, counts)
        total = n.sum(axis=1, keepdims=True)
        distinct = (n > 0).sum(axis=1, keepdims=True)
        escape = np.where(distinct < (~out).sum(axis=1, keepdims=True), distinct, 0)
        known = distinct > 0
        bottom = np.where(known, total + escape, 1.0)
        p += left * n / bottom
        left = np.where(known, left * escape / bottom, left)
        out |= n > 0
    rest = (~out).sum(axis=1, keepdims=True)
    p = np.where(out, p, left / np.maximum(rest, 1))
    return np.log10(np.maximum(p, 1e-300)).astype(np.float32)


class Low:
    """Counts up to order 2, from the distinct pairs of order 2 (ascending) and their training counts."""

    def __init__(self, code: np.ndarray, n: np.ndarray):
        self.code, self.n = code, n.astype(float)
        near, symbol = code // SYMBOLS**2, code % SYMBOLS
        self.n1 = np.zeros((SYMBOLS, SYMBOLS))
        np.add.at(self.n1, (near, symbol), self.n)
        self.n0 = self.n1.sum(axis=0)
        self.context, inverse = np.unique(code // SYMBOLS, return_inverse=True)
        size = len(self.context)
        self.by_context = [
            np.bincount(inverse, w, size) for w in (self.n, np.ones(len(code)), self.n1[near, symbol])
        ]
        self.by_near = [self.n1.sum(axis=1), (self.n1 > 0).sum(axis=1), ((self.n1 > 0) * self.n0).sum(axis=1)]

    def levels(self, code: np.ndarray, symbol: np.ndarray, order: int):
        """For orders 2, 1 and 0: the symbol's count, the context's total and distinct symbols, and what the symbols of the
        context count in the next shorter one."""
        context = code // SYMBOLS ** (order - 1)
        near = context // SYMBOLS
        yield _at(self.code, self.n, context * SYMBOLS + symbol), *(_at(self.context, a, context) for a in self.by_context)
        yield self.n1[near, symbol], *(a[near] for a in self.by_near)
        yield self.n0[symbol], *(np.full(len(code), float(a)) for a in (self.n0.sum(), (self.n0 > 0).sum(), 0))


def _at(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    if not len(keys):
        return np.zeros(len(wanted))
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], 0.0)


def probabilities(code: np.ndarray, n: np.ndarray, low: Low, order: int) -> np.ndarray:
    """log10 probability of each distinct pair (ascending). All pairs that share their three nearest symbols must be there;
    pairs that no training text has count 0."""
    symbol = code % SYMBOLS
    levels = []  # from the longest context on: count, total, distinct, what its symbols count one level below
    counted = list(low.levels(code, symbol, order))
    below = counted[0][0]
    for k in range(ORDER + 1, order + 1):
        context = code // SYMBOLS ** (order - k + 1)
        _, first, inverse = np.unique(context * SYMBOLS + symbol, return_index=True, return_inverse=True)
        sums = np.bincount(inverse, n, len(first))
        _, of = np.unique(context, return_inverse=True)
        owner, seen = of[first], sums > 0
        by_context = [np.bincount(owner, w, of.max() + 1) for w in (sums, seen, seen * below[first])]
        levels.append((sums[inverse], *(a[of] for a in by_context)))
        below = sums[inverse]
    levels = levels[::-1] + counted
    p, left, done = np.zeros(len(code)), np.ones(len(code)), np.zeros(len(code), bool)
    out, out_n = np.zeros(len(code)), np.zeros(len(code))  # symbols excluded so far, and what they count here
    for count, total, distinct, next_n in levels:
        rest, kinds = total - out_n, distinct - out
        escape = np.where(kinds < SYMBOLS - out, kinds, 0)
        known = kinds > 0
        bottom = np.where(known, rest + escape, 1.0)
        hit = ~done & (count > 0)
        p[hit] = (left * count / bottom)[hit]
        left = np.where(known, left * escape / bottom, left)
        done |= hit
        out, out_n = distinct, next_n
    p = np.where(done, p, left / np.maximum(SYMBOLS - out, 1))
    return np.log10(np.maximum(p, 1e-300))


def tokens_of(text: bytes | None) -> list[bytes]:
    return text.lower().split() if text else []


def _pack(values: np.ndarray) -> bytes:
    """8 bytes of raw size, then the bytes, compressed."""
    raw = values.tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True) if raw else bytes(8)


def _unpack(data: bytes, kind) -> np.ndarray:
    size = int.from_bytes(data[:8], "little")
    return np.frombuffer(pa.decompress(data[8:], size, codec="zstd", asbytes=True) if size else b"", kind)


def _keys(code: np.ndarray) -> bytes:
    return _pack(np.diff(code, prepend=0))


def slices(docs: DataFrame, order: int) -> DataFrame:
    """(slice, kind, bucket, keys, n, total, ids): see the module's text. docs(row, doc_id, text, training)."""
    schema = f"slice bigint, kind int, bucket int, keys binary, n binary, total bigint, ids array<{docs.schema['doc_id'].dataType.simpleString()}>"

    def work(batch):
        out, first, size = [], 0, 0
        for i, text in enumerate(as_bytes(batch.column(2))):
            size += len(text.as_py() or b"")
            if size >= SLICE or i + 1 == batch.num_rows:
                out.append(_slice(batch.slice(first, i + 1 - first)))
                first, size = i + 1, 0
        return pa.Table.from_batches(out)

    def _slice(batch):
        texts = [t.as_py() or b"" for t in as_bytes(batch.column(2))]
        training = batch.column(3).to_numpy(zero_copy_only=False)
        name = batch.column(0)[0].as_py()  # row numbers are unique, so the first one names the slice
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        raw = np.frombuffer(b"".join(texts), np.uint8)
        rows = [(TEXTS, 0, _pack(raw), _pack(np.stack([sizes, training.astype(np.int64)])), int(training.sum()))]
        del raw
        code, number = pairs(texts, order)
        n = np.bincount(number[np.repeat(training, sizes + 1)], minlength=len(code))
        near = code // SYMBOLS ** (order - 1) * SYMBOLS + code % SYMBOLS
        low, inverse = np.unique(near, return_inverse=True)
        low_n = np.bincount(inverse, n, len(low)).astype(np.int64)
        rows.append((LOW, 0, _keys(low[low_n > 0]), _pack(low_n[low_n > 0]), 0))
        del number
        bucket = bucket_of(code, order)
        by = np.argsort(bucket, kind="stable")
        ends = np.searchsorted(bucket[by], np.arange(BUCKETS + 1))
        for b in np.unique(bucket).tolist():
            part = by[ends[b] : ends[b + 1]]
            rows.append((PAIRS, b, _keys(code[part]), _pack(n[part].astype(np.uint32)), 0))
        counts: dict[bytes, int] = {}
        for text, learned in zip(texts, training.tolist(), strict=True):
            for t in tokens_of(text):
                counts[t] = counts.get(t, 0) + learned
        parts: dict[int, list[bytes]] = {}
        for t in counts:
            parts.setdefault(token_bucket(t), []).append(t)
        for b, own in parts.items():
            n = np.array([counts[t] for t in own], np.uint32)
            rows.append((TOKENS, b, _pack(np.frombuffer(b" ".join(own), np.uint8)), _pack(n), int(n.sum(dtype=np.int64))))
        ids = pa.ListArray.from_arrays(pa.array([0, *[batch.num_rows] * len(rows)], pa.int32()), batch.column(1))
        kinds, buckets, keys, ns, totals = zip(*rows, strict=True)
        return pa.record_batch(
            [
                pa.array([name] * len(rows), pa.int64()), pa.array(kinds, pa.int32()), pa.array(buckets, pa.int32()), pa.array(keys, pa.binary()),
                pa.array(ns, pa.binary()), pa.array(totals, pa.int64()), ids,
            ],
            ["slice", "kind", "bucket", "keys", "n", "total", "ids"],
        )

    return map_arrow(docs.select("row", "doc_id", "text", "training"), work, schema, whole=True)


def low_counts(rows: DataFrame) -> Low:
    """What comes to the driver is bounded by the number of pairs of order 2."""

    def work(batch):
        code = np.concatenate([np.cumsum(_unpack(k, np.int64)) for k in batch.column(0).to_pylist()])
        n = np.concatenate([_unpack(k, np.int64) for k in batch.column(1).to_pylist()])
        code, inverse = np.unique(code, return_inverse=True)
        return pa.record_batch([pa.array(code), pa.array(np.bincount(inverse, n, len(code)).astype(np.int64))], ["code", "n"])

    counted = map_arrow(rows.filter(F.col("kind") == LOW).select("keys", "n"), work, "code bigint, n bigint", whole=True)
    t = counted.groupBy("code").agg(F.sum("n").alias("n")).toArrow()
    code, n = t.column("code").to_numpy(), t.column("n").to_numpy()
    by = np.argsort(code)
    return Low(code[by], n[by])


def answers(rows: DataFrame, low: Low, order: int) -> DataFrame:
    """(slice, kind, bucket, keys, known): each row of pairs with their log probabilities, each row of tokens with their
    counts; ``known`` is the bucket's number of training tokens, on its first row."""
    shared = rows.sparkSession.sparkContext.broadcast(low)

    def work(t: pa.Table) -> pa.Table:
        keys, counts = t.column("keys").to_pylist(), [_unpack(n, np.uint32) for n in t.column("n").to_pylist()]
        sizes = np.array([len(n) for n in counts])
        n, known = np.concatenate(counts).astype(float), 0
        if t.column("kind")[0].as_py() == PAIRS:
            code, inverse = np.unique(np.concatenate([np.cumsum(_unpack(k, np.int64)) for k in keys]), return_inverse=True)
            values = probabilities(code, np.bincount(inverse, n, len(code)), shared.value, order)[inverse].astype("<f4")
        else:
            place: dict[bytes, int] = {}
            of = np.array([place.setdefault(w, len(place)) for k in keys for w in _unpack(k, np.uint8).tobytes().split(b" ")])
            sums = np.bincount(of, n, len(place))
            known, values = int((sums > 0).sum()), sums[of].astype("<i8")
        ends = np.cumsum(sizes)
        out = [_pack(values[e - s : e]) for s, e in zip(sizes.tolist(), ends.tolist(), strict=True)]
        return pa.table({
            "slice": t.column("slice"), "kind": t.column("kind"), "bucket": t.column("bucket"), "keys": pa.array(out, pa.binary()),
            "known": pa.array([known] + [0] * (len(out) - 1), pa.int64()),
        })

    asked = rows.filter(F.col("kind").isin(PAIRS, TOKENS)).select("slice", "kind", "bucket", "keys", "n")
    return asked.groupBy("kind", "bucket").applyInArrow(work, "slice bigint, kind int, bucket int, keys binary, known bigint")


def lm_scores(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row of docs(doc_id, text)."""
    held_out = fold("doc_id", FOLDS) == HELD_OUT
    numbered = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text", (~held_out).alias("training"))
    rows = materialize(slices(numbered, order), "lm-slices")
    answered = materialize(answers(rows, low_counts(rows), order), "lm-answers")
    # Every training text has one end token besides its words; it is no word, so no bucket has it.
    learned = rows.filter(F.col("kind").isin(TEXTS, TOKENS)).groupBy("kind").agg(F.sum("total").alias("n")).collect()
    ends = sum(r.n for r in learned if r.kind == TEXTS)
    n = sum(r.n for r in learned)
    v = answered.agg(F.coalesce(F.sum("known"), F.lit(0)).alias("v")).first().v + (ends > 0)

    def add(t: pa.Table) -> pa.Table:
        kind, bucket, keys = t.column("kind").to_numpy(), t.column("bucket").to_numpy(), t.column("keys")
        head = int(np.flatnonzero(kind == TEXTS)[0])
        sizes, training = _unpack(t.column("n")[head].as_py(), np.int64).reshape(2, -1)
        raw, stops = _unpack(keys[head].as_py(), np.uint8).tobytes(), np.cumsum(sizes)
        texts = [raw[e - s : e] for s, e in zip(sizes.tolist(), stops.tolist(), strict=True)]

        def gathered(of, dtype):
            at = np.flatnonzero(kind == of)
            at = at[np.argsort(bucket[at])]
            return np.concatenate([np.empty(0, dtype), *(_unpack(keys[i].as_py(), dtype) for i in at.tolist())])

        code, number = pairs(texts, order)
        logs = np.empty(len(code), np.float32)
        logs[np.argsort(bucket_of(code, order), kind="stable")] = gathered(PAIRS, "<f4")
        score, ends_at = np.empty(len(texts)), np.concatenate([[0], np.cumsum(sizes + 1)])
        first = 0
        while first < len(texts):  # a million symbols at a time, or one text
            last = max(first + 1, int(np.searchsorted(ends_at, ends_at[first] + (1 << 20), "right")) - 1)
            part = logs[number[ends_at[first] : ends_at[last]]].astype(float)
            score[first:last] = np.add.reduceat(part, ends_at[first:last] - ends_at[first])
            first = last
        del logs, number, code
        place: dict[bytes, int] = {}
        number = [np.array([place.setdefault(w, len(place)) for w in tokens_of(text)], np.int32) for text in texts]
        count = np.empty(len(place))
        buckets = np.fromiter(map(token_bucket, place), np.int64, len(place))
        count[np.argsort(buckets, kind="stable")] = gathered(TOKENS, "<i8")
        words = np.fromiter(map(len, number), np.int64, len(number))
        doc = np.repeat(np.arange(len(texts)), words)
        c = count[np.concatenate(number)]
        n_known = np.bincount(doc, c > 0, len(texts)).astype(np.int64) + (ends > 0)
        base = np.bincount(doc, np.log10(c + 1), len(texts)) + np.log10(ends + 1) - (words + 1) * np.log10(n + v + 1)
        return pa.table({
            "doc_id": t.column("ids")[head].values, "held_out": pa.array(training == 0), "n_tokens": pa.array(words + 1),
            "n_known": pa.array(n_known), "train_tokens": pa.array([n] * len(texts), pa.int64()), "base_score": pa.array(base), "score": pa.array(score),
        })

    texts = rows.filter(F.col("kind") == TEXTS).select("slice", "kind", "bucket", "keys", "n", "ids")
    none = [F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in ("n", "ids")]
    met = texts.unionByName(answered.select("slice", "kind", "bucket", "keys", *none))
    kind = docs.schema["doc_id"].dataType.simpleString()
    # A group is one slice of documents, of bounded size.
    return met.groupBy("slice").applyInArrow(
        add, f"doc_id {kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    )


def query(spark: SparkSession, sf_dir: str, order: int = ORDER) -> DataFrame:
    return lm_scores(table(spark, sf_dir, "documents"), order)


def deep_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registered query."""
    return query(spark, sf_dir, DEPTH)
