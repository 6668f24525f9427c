"""Removal of repeated byte strings by sorting suffixes, deep-shallow.

Every byte covered by a ``LENGTH``-byte string that also starts earlier (smaller document, or same document and earlier
start) is removed; strings are judged on the input.

1. **Anchors.** Each string (window) of 100 bytes has one anchor: its 32-byte gram of the smallest hash, the leftmost of
   equal ones. The choice depends on the window's bytes alone, so equal windows have equal anchors at equal places.
   Consecutive windows share an anchor; about one position in 35 is one.
2. Occurrences with the same bytes over all windows of their anchor are one class. All of a class but its first are
   removed as they are. Inside a batch this is settled before anything is shuffled, so however often a passage occurs, an
   anchor has one row per batch and class.
3. Classes are sorted by anchor and walked through; only the current anchor's class firsts are held. What an anchor with
   one class holds is unique and done with. A blocked Bloom filter (8 MB at any size) of the others' places picks their
   bytes in a second pass over the texts; a full filter costs time, not results.
4. Firsts of classes that share an anchor but differ elsewhere are compared: their suffixes from the anchor on, and
   the reversed prefixes before it, are sorted deep-shallow. Multikey quicksort goes by words of 8 bytes to a depth of
   ``SHALLOW``; what is tied there goes into a blind trie, which branches on bytes without reading those between, and
   orders a string with one comparison. Neighbours' common prefixes then say which windows are equal.
5. An anchor with more than ``HOT`` classes is split by its windows: each window's digest is grouped by itself.

Null texts count as empty; texts under 100 bytes lose nothing and make nothing earlier. Documents of equal id are ordered
by their place in the input, so of repeated rows the first stays; a null id comes first. An empty table gives an empty
result; other columns are left aside.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlink.llm.bloom import bloom, has
from spendlink.llm.clusters import by_key
from spendlink.llm.common import as_bytes, map_arrow, numbered, release, table
from spendlink.llm.jaccard import mixed
from spendlink.sources.shared import materialize

LENGTH, GRAM = 100, 32
SPAN = LENGTH - GRAM + 1
CHUNK = 1 << 20
SHALLOW = 48
HOT = 4096
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BYTES = np.random.Generator(np.random.PCG64(5)).integers(1, 1 << 63, 256, np.uint64)


def _power(n: int) -> np.uint64:
    return np.uint64(pow(int(_BASE), n, 1 << 64))


def _doubled(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of 2n-grams from those of n-grams."""
    return h[:-n] * _power(n) + h[n:]


def anchors(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """For all anchors of ``texts``: text number, gram hash, class hash, place, windows before and after the first.

    ``place`` is the gram's offset; its windows start from ``place - before`` to ``place - before + more``.
    """
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    ends = np.cumsum(sizes)
    none = (np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.uint64), *(np.empty(0, np.int64),) * 3)
    if not len(texts) or sizes.max() < LENGTH:
        return none
    raw = np.frombuffer(b"".join(texts), np.uint8)
    h = {1: _BYTES[raw]}
    for n in (1, 2, 4, 8, 16, 32):
        h[2 * n] = _doubled(h[n], n)
    count = len(raw) - LENGTH + 1
    whole = (h[64][:count] * _power(32) + h[32][64 : 64 + count]) * _power(4) + h[4][96 : 96 + count]
    gram = mixed(h[32])
    del h
    key = (gram & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(gram), dtype=np.uint64)
    least, width = key, 1
    while 2 * width <= SPAN:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    rest = SPAN - width
    least = np.minimum(least[: len(least) - rest], least[rest:]) if rest else least
    place = (least[:count] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    text = np.repeat(np.arange(len(texts)), sizes)[:count]
    start = np.flatnonzero(np.arange(count) + LENGTH <= ends[text])
    if not len(start):
        return none
    place, text = place[start], text[start]
    new = np.ones(len(start), bool)
    new[1:] = (place[1:] != place[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(start)) - 1
    s, e, p, t = start[first], start[last], place[first], text[first]
    same = mixed(whole[s] * _BASE + mixed(whole[e] + ((p - s) * LENGTH + (e - s)).astype(np.uint64)))
    return t, gram[p], same, p - (ends - sizes)[t], p - s, e - s


def chunks(texts):
    """(first, texts) in runs of about ``CHUNK`` bytes."""
    held, first, size = [], 0, 0
    for i, text in enumerate(texts):
        held.append(text.as_py() or b"")
        size += len(held[-1])
        if size >= CHUNK:
            yield first, held
            held, first, size = [], i + 1, 0
    if held:
        yield first, held


def place_hash(row: np.ndarray, place: np.ndarray) -> np.ndarray:
    return mixed(mixed(row.astype(np.uint64)) + place.astype(np.uint64))


def packed_window(place, before, more):
    """Place, windows before and windows after the first in one number; both counts are below 128."""
    return place << 14 | before << 7 | more


def occurrences(docs: DataFrame) -> DataFrame:
    """(gram, same, doc_id, row, window): the first occurrence of each class in a batch, and, with a null ``same`` and a
    key of their own, the others."""

    def work(batch):
        parts = []
        for first, texts in chunks(as_bytes(batch.column(2))):
            t, gram, same, place, before, more = anchors(texts)
            parts.append((t + first, gram, same, packed_window(place, before, more)))
        t, gram, same, window = (np.concatenate(x) for x in zip(*parts, strict=True))
        ids = batch.column(0)
        rank = pa.compute.rank(ids, sort_keys="ascending", null_placement="at_start", tiebreaker="first").to_numpy()[t]
        order = np.lexsort((window, rank, same, gram))
        t, gram, same, window = t[order], gram[order], same[order], window[order]
        again = np.zeros(len(t), bool)
        again[1:] = (gram[1:] == gram[:-1]) & (same[1:] == same[:-1])
        row = batch.column(1).to_numpy()[t]
        key = np.where(again, mixed(row.astype(np.uint64)), gram).astype(np.int64)
        return pa.record_batch(
            [pa.array(key), pa.array(same.astype(np.int64), mask=again), ids.take(pa.array(t)), pa.array(row), pa.array(window)],
            ["gram", "same", "doc_id", "row", "window"],
        )

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"gram bigint, same bigint, doc_id {kind}, row bigint, window bigint"
    return map_arrow(docs.select("doc_id", "row", "text"), work, schema, whole=True)


def settled(found: DataFrame) -> DataFrame:
    """(row, window, gram, classes): occurrences to be removed as they are (gram is null), and the first occurrence of
    every class of an anchor that has several."""

    def run(batches):
        out = [[], [], [], []]
        gram, same, firsts, hot = None, None, [], False

        def add(row, window, of, classes):
            for column, value in zip(out, (row, window, of, classes), strict=True):
                column.append(value)

        def close():
            nonlocal firsts, hot
            if len(firsts) > 1 or hot:
                for row, window in firsts:
                    add(row, window, gram, HOT + 1 if hot else len(firsts))
            firsts, hot = [], False

        def flush():
            nonlocal out
            types = [pa.int64(), pa.int64(), pa.int64(), pa.int64()]
            made = pa.record_batch([pa.array(c, t) for c, t in zip(out, types, strict=True)], ["row", "window", "gram", "classes"])
            out = [[], [], [], []]
            return made

        for batch in batches:
            g, s = batch.column(0).to_numpy(), batch.column(1)
            removed = s.is_null().to_numpy(zero_copy_only=False)
            s = s.fill_null(0).to_numpy()
            row, window = batch.column(2).to_numpy(), batch.column(3).to_numpy()
            at = np.flatnonzero(removed)
            if len(at):
                yield pa.record_batch(
                    [pa.array(row[at]), pa.array(window[at]), *(pa.nulls(len(at), pa.int64()),) * 2], ["row", "window", "gram", "classes"]
                )
            # Anchors with one row inside this batch are done with, but for the ends of the batch.
            use = np.flatnonzero(~removed)
            gu = g[use]
            alone = np.zeros(len(use), bool)
            if len(use) > 2:
                alone[1:-1] = (gu[1:-1] != gu[:-2]) & (gu[1:-1] != gu[2:])
            for i in use[~alone].tolist():
                if g[i] != gram:
                    close()
                    gram, same = g[i].item(), None
                if same is not None and s[i] == same:
                    add(row[i].item(), window[i].item(), None, None)
                    continue
                same = s[i].item()
                firsts.append((row[i].item(), window[i].item()))
                if len(firsts) > HOT:  # held no longer: this anchor's classes go another way
                    hot = True
                    for r, w in firsts:
                        add(r, w, gram, HOT + 1)
                    firsts = []
            if len(out[0]) > 50_000:
                yield flush()
        close()
        if out[0]:
            yield flush()
        release()

    order = ["gram", "same", "doc_id", "row", "window"]
    placed = found.repartition("gram").sortWithinPartitions(*order)
    return placed.select("gram", "same", "row", "window").mapInArrow(run, "row bigint, window bigint, gram bigint, classes bigint")


# --- Sorting ---------------------------------------------------------------------------------------------------


def common_prefix(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low, high = 0, n  # a[:low] == b[:low], a[:high] != b[:high]
    while high - low > 1:
        mid = (low + high) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid
    return low


class BlindTrie:
    """A compacted trie whose inner nodes know their depth and branching bytes only; the end of a string sorts first.

    An inner node is [depth, {byte or -1: node}], a leaf the list of the numbers of equal strings.
    """

    def __init__(self, strings: list[bytes]):
        self.strings, self.root = strings, None

    @staticmethod
    def _inner(node) -> bool:
        return len(node) == 2 and isinstance(node[1], dict)

    def _byte(self, i: int, depth: int) -> int:
        s = self.strings[i]
        return s[depth] if depth < len(s) else -1

    def add(self, i: int) -> None:
        if self.root is None:
            self.root = [0, {self._byte(i, 0): [i]}]
            return
        node = self.root
        while True:  # blind: only branching bytes are looked at
            below = node[1].get(self._byte(i, node[0]))
            if below is None or not self._inner(below):
                break
            node = below
        other = below[0] if below is not None else self._leaf(node)
        depth = common_prefix(self.strings[i], self.strings[other])
        if depth == len(self.strings[i]) == len(self.strings[other]) and below is not None:
            below.append(i)  # equal strings share a leaf
            return
        node, parent, edge = self.root, None, None
        while self._inner(node) and node[0] < depth:
            parent, edge = node, self._byte(i, node[0])
            node = node[1][edge]
        if self._inner(node) and node[0] == depth:
            node[1][self._byte(i, depth)] = [i]
        else:
            split = [depth, {self._byte(other, depth): node, self._byte(i, depth): [i]}]
            if parent is None:
                self.root = split
            else:
                parent[1][edge] = split

    def _leaf(self, node):
        while self._inner(node):
            node = next(iter(node[1].values()))
        return node[0]

    def order(self) -> list[int]:
        out, stack = [], [self.root] if self.root is not None else []
        while stack:
            node = stack.pop()
            if self._inner(node):
                stack += [node[1][b] for b in sorted(node[1], reverse=True)]
            else:
                out += node
        return out


def deep_shallow(strings: list[bytes]) -> list[int]:
    """The strings' numbers in sorted order."""
    out: list[int] = []
    todo = [(list(range(len(strings))), 0)] if strings else []
    while todo:
        group, depth = todo.pop()
        if len(group) == 1:
            out += group
        elif depth >= SHALLOW:
            trie = BlindTrie([strings[i][depth:] for i in group])
            for k in range(len(group)):
                trie.add(k)
            out += [group[k] for k in trie.order()]
        else:  # multikey quicksort by words of 8 bytes, longer strings after their own beginnings
            word = [(strings[i][depth : depth + 8], len(strings[i]) >= depth + 8) for i in group]
            pivot = word[len(word) // 2]
            less = [i for i, w in zip(group, word, strict=True) if w < pivot]
            equal = [i for i, w in zip(group, word, strict=True) if w == pivot]
            more = [i for i, w in zip(group, word, strict=True) if w > pivot]
            # Strings that end inside the word are equal; others differ further on.
            rest = (more, depth), (equal, depth + 8 if pivot[1] else SHALLOW), (less, depth)
            todo += [(g, d) for g, d in rest if g]
    return out


def _ranked(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Place of each string in sorted order, and common prefixes of neighbours (entry k: k - 1 and k; entry 0 is -1)."""
    order = deep_shallow(strings)
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    shared = [-1] + [common_prefix(strings[a], strings[b]) for a, b in zip(order, order[1:], strict=False)]
    return place, np.array(shared)


def repeated_windows(strings: list[bytes], before: np.ndarray, more: np.ndarray) -> list[tuple[int, int, int]]:
    """(string, first, last): runs of windows, by their start in the string, that an earlier string of the list has too.

    The strings share the gram at ``before`` (each its own); windows start at 0 to ``more``.
    """
    right_place, right = _ranked([s[b:] for s, b in zip(strings, before.tolist(), strict=True)])
    left_place, left = _ranked([s[:b][::-1] for s, b in zip(strings, before.tolist(), strict=True)])
    out = []
    if len(strings) <= 6:

        def shared(place, common, i, j):
            a, b = sorted((place[i], place[j]))
            return int(common[a + 1 : b + 1].min())

        for i in range(1, len(strings)):
            for j in range(i):
                # A window r bytes before the gram needs r bytes in common to the left, 100 - r to the right.
                most = min(shared(left_place, left, i, j), int(before[i]))
                least = max(LENGTH - shared(right_place, right, i, j), int(before[i] - more[i]))
                if least <= most:
                    out.append((i, int(before[i]) - most, int(before[i]) - least))
        return out
    number = np.arange(len(strings))
    for r in range(int((before - more).min()), int(before.max()) + 1):
        own = np.flatnonzero((before - more <= r) & (r <= before))
        classes = np.cumsum(left < r)[left_place[own]] * (len(strings) + 1) + np.cumsum(right < LENGTH - r)[right_place[own]]
        _, inverse = np.unique(classes, return_inverse=True)
        first = np.full(len(own), len(strings))
        np.minimum.at(first, inverse, number[own])
        for i in own[first[inverse] < number[own]].tolist():
            out.append((i, int(before[i]) - r, int(before[i]) - r))
    return out


# --- The operator ----------------------------------------------------------------------------------------------


def _strings(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The bytes of all windows of each wanted anchor."""

    def hashed(batch):
        row, window = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        return pa.record_batch([pa.array(place_hash(row, window).astype(np.int64))], ["hash"])

    filled = bloom(map_arrow(wanted.select("row", "window"), hashed, "hash bigint"))
    shared = docs.sparkSession.sparkContext.broadcast(filled)

    def work(batch):
        out = []
        for first, texts in chunks(as_bytes(batch.column(2))):
            t, _, _, place, before, more = anchors(texts)
            window = packed_window(place, before, more)
            rows = batch.column(1).to_numpy()[t + first]
            keep = np.flatnonzero(has(shared.value, place_hash(rows, window)))
            start = (place - before)[keep].tolist()
            stop = (place - before + more + LENGTH)[keep].tolist()
            strings = [texts[k][a:b] for k, a, b in zip(t[keep].tolist(), start, stop, strict=True)]
            out.append(pa.record_batch(
                [batch.column(0).take(pa.array(t[keep] + first)), pa.array(rows[keep]), pa.array(window[keep]), pa.array(strings, pa.binary())],
                ["doc_id", "row", "window", "string"],
            ))
        return pa.Table.from_batches(out)

    kind = docs.schema["doc_id"].dataType.simpleString()
    cut = map_arrow(docs.select("doc_id", "row", "text"), work, f"doc_id {kind}, row bigint, window bigint, string binary")
    met = cut.join(wanted.select("row", "window", "gram", (F.col("classes") > HOT).alias("hot")), ["row", "window"])
    return met.select(
        "gram", "hot", "doc_id", "row", F.shiftright("window", 14).cast("int").alias("place"),
        F.shiftright("window", 7).bitwiseAND(127).cast("int").alias("before"), F.col("window").bitwiseAND(127).cast("int").alias("more"), "string",
    )


def _compared(strings: DataFrame) -> DataFrame:
    """(row, start, stop): what repeats between firsts of classes, one anchor at a time."""

    def run(batches):
        row, start, stop = [], [], []
        for t in by_key(batches, ["gram"]):
            if t.num_rows < 2:
                continue
            own, place = t.column("row").to_pylist(), t.column("place").to_pylist()
            before, more = (t.column(c).to_numpy().astype(np.int64) for c in ("before", "more"))
            for i, a, b in repeated_windows(t.column("string").to_pylist(), before, more):
                at = place[i] - int(before[i])
                row.append(own[i])
                start.append(at + a)
                stop.append(at + b + LENGTH)
            if len(row) > 50_000:
                yield pa.record_batch([pa.array(row), pa.array(start, pa.int32()), pa.array(stop, pa.int32())], ["row", "start", "stop"])
                row, start, stop = [], [], []
        if row:
            yield pa.record_batch([pa.array(row), pa.array(start, pa.int32()), pa.array(stop, pa.int32())], ["row", "start", "stop"])
        release()

    placed = strings.repartition("gram").sortWithinPartitions("gram", "doc_id", "row", "place")
    return placed.select("gram", "row", "place", "before", "more", "string").mapInArrow(run, "row bigint, start int, stop int")


def _by_window(strings: DataFrame) -> DataFrame:
    """The same for anchors with very many classes: every window is grouped by its digest."""
    at = F.explode(F.sequence(F.lit(0), "more")).alias("at")
    each = strings.select("doc_id", "row", (F.col("place") - F.col("before")).alias("base"), "string", at)
    window = F.expr(f"substring(string, at + 1, {LENGTH})")
    each = each.select(F.md5(window).alias("window"), "doc_id", "row", (F.col("base") + F.col("at")).alias("start"))
    first = each.groupBy("window").agg(F.min(F.struct("doc_id", "row", "start")).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    later = each.join(first, "window").filter((F.col("row") != F.col("first.row")) | (F.col("start") != F.col("first.start")))
    return later.select("row", "start", (F.col("start") + LENGTH).alias("stop"))


def repeated_ranges(docs: DataFrame) -> DataFrame:
    """(row, start, stop): byte ranges to be removed, for docs(doc_id, row, text); they may overlap."""
    found = materialize(settled(occurrences(docs)), "settled")
    start = F.shiftright("window", 14) - F.shiftright("window", 7).bitwiseAND(127)
    stop = start + F.col("window").bitwiseAND(127) + LENGTH
    removed = found.filter(F.col("gram").isNull()).select("row", start.cast("int").alias("start"), stop.cast("int").alias("stop"))
    strings = materialize(_strings(docs, found.filter(F.col("gram").isNotNull())), "strings")
    compared = _compared(strings.filter(~F.col("hot")))
    return removed.unionByName(compared).unionByName(_by_window(strings.filter("hot")))


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans (start, stop) for every row."""
    rows = numbered(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), "row")
    ranges = repeated_ranges(rows)
    per_row = ranges.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "stop"))).alias("ranges"))

    def squeeze(batch):  # the texts cross the network once, well packed
        texts = [t.as_py() or b"" for t in as_bytes(batch.column(2))]
        squeezed = [pa.compress(t, codec="zstd", asbytes=True) for t in texts]
        return pa.record_batch(
            [*batch.columns[:2], pa.array(map(len, texts), pa.int64()), pa.array(squeezed, pa.binary())], ["row", "doc_id", "size", "text"]
        )

    kind = rows.schema["doc_id"].dataType.simpleString()
    texts = map_arrow(rows.select("row", "doc_id", "text"), squeeze, f"row bigint, doc_id {kind}, size bigint, text binary")
    met = texts.join(per_row, "row", "left").select("doc_id", "size", "text", "ranges")

    def work(batch):
        sizes, removed, counts, shas, spans = [], [], [], [], []
        for size, text, found in zip(*batch.columns[1:], strict=True):
            text, merged = pa.decompress(text.as_py(), size.as_py(), codec="zstd", asbytes=True), []
            for r in found.as_py() or ():
                if merged and r["start"] <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], r["stop"])
                else:
                    merged.append([r["start"], r["stop"]])
            sha, at = hashlib.sha256(), 0
            for a, b in merged:
                sha.update(text[at:a])
                at = b
            sha.update(text[at:])
            sizes.append(len(text))
            removed.append(sum(b - a for a, b in merged))
            counts.append(len(merged))
            shas.append(sha.hexdigest())
            spans.append([{"start": a, "stop": b} for a, b in merged])
        span = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))
        columns = [batch.column(0), *(pa.array(c, pa.int64()) for c in (sizes, removed, counts)), pa.array(shas, pa.string()), pa.array(spans, span)]
        return pa.record_batch(columns, ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"])

    schema = f"doc_id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, spans array<struct<start:int,stop:int>>"
    return map_arrow(met, work, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(table(spark, sf_dir, "documents")).drop("spans")
