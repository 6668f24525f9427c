"""Benchmark decontamination with a positional inverted index.

1. Every ten consecutive words of a benchmark item are a window; an item of fewer words, but not none, is one window.
2. One pass counts, in all documents, the words that occur in windows; counts are summed per batch before the shuffle.
3. A second pass stores the index: for every document the postings, term by term with ascending positions, of all words that
   windows have. The index is a written table, split by documents, so the lists of a term that half of all documents
   have lie in as many tasks as the documents do.
4. **Exact phrases.** A window's lists are intersected from the rarest term on: the postings of the rarest one, moved by its offset,
   are the possible starts; each further list keeps those it has a posting for at the start plus its own offset.
5. **Proximity.** A run of ``REACH`` consecutive document words matches a window of n words if it holds ``NEAR`` of them, each as often as
   counted, in any order. So at most n - NEAR * n may be missing, and one of the rarest words that together are more than that must
   be there; words that no document has count among them. Their postings are the candidates; list by list, from the rarest
   on, a candidate is dropped once the postings within reach can no longer add up. What is left is compared run by run.

What is broadcast and fetched is bounded: the words, counts and owners of about ``BLOCK`` windows. Larger benchmarks go through in
blocks, an index each. Candidates are worked off in slices of ``SLICE``, so memory does not follow the length of lists.

Words are lower-cased (A-Z) runs of ASCII letters, digits and all characters from U+0080 on. Null and empty texts have
no words. Repeated document rows are judged each; a repeated item counts once by its id as text, a null item id as the
empty text. An item that occurs exactly is among the near items too; being near alone does not make a document contaminated.
Empty tables give no rows (documents) or no hits (benchmark). Other columns are left aside. A text may have 2**28 words.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from dataclasses import dataclass
from functools import reduce
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlink.llm.common import as_bytes, map_arrow, numbered, table, words_of
from spendlink.sources.shared import materialize

WINDOW = 10
#: Windows looked up in one index.
BLOCK = 200_000
#: Share of a window's words that a proximity match needs, and the run of document words that must hold them.
NEAR = (4, 5)
REACH = 2 * WINDOW - 1
SLICE = 1 << 19
POSTINGS, ROWS = 1 << 19, 1 << 12
TERM_BITS, POS_BITS = 22, 28


def windows(items: DataFrame, id_col: str, text_col: str, size: int = WINDOW) -> DataFrame:
    """(item, window): the distinct windows of each item."""

    def work(batch):
        out = set()
        for item, text in zip(batch.column(0).to_pylist(), as_bytes(batch.column(1)), strict=True):
            words = words_of(text.as_py())
            if words:
                for at in range(max(1, len(words) - size + 1)):
                    out.add((item, b" ".join(words[at : at + size]).decode()))
        rows = sorted(out)
        return pa.record_batch([pa.array([r[i] for r in rows], pa.string()) for i in (0, 1)], ["item", "window"])

    narrow = items.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"), F.col(text_col).alias("text"))
    return map_arrow(narrow, work, "item string, window string").distinct()


def word_counts(docs: DataFrame, words: frozenset[bytes]) -> DataFrame:
    """(word, n): how often the documents have each of ``words``; only words that occur."""
    shared = docs.sparkSession.sparkContext.broadcast(words)

    def work(batch):
        known, counts = shared.value.__contains__, Counter()
        for text in as_bytes(batch.column(0)):
            counts.update(filter(known, words_of(text.as_py())))
        return pa.record_batch(
            [pa.array([w.decode() for w in counts], pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"]
        )

    return map_arrow(docs.select("text"), work, "word string, n bigint", whole=True).groupBy("word").agg(F.sum("n").alias("n"))


def positional_index(docs: DataFrame, terms: dict[bytes, int]) -> DataFrame:
    """(row, doc_id, n_words, terms, counts, positions): the postings of ``terms``, numbered, in every document; packed numbers."""
    shared = docs.sparkSession.sparkContext.broadcast(terms)

    def work(batch):
        get, sizes, lists = shared.value.get, [], ([], [], [])
        for text in as_bytes(batch.column(2)):
            words = words_of(text.as_py())
            number = np.fromiter(map(get, words, repeat(-1)), np.int32, len(words))
            at = np.flatnonzero(number >= 0)
            at = at[np.argsort(number[at], kind="stable")]
            term, count = np.unique(number[at], return_counts=True)
            sizes.append(len(words))
            for out, values in zip(lists, (term, count, at), strict=True):
                out.append(values.astype("<i4").tobytes())
        return pa.record_batch(
            [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), *(pa.array(x, pa.binary()) for x in lists)],
            ["row", "doc_id", "n_words", "terms", "counts", "positions"],
        )

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"row bigint, doc_id {kind}, n_words bigint, terms binary, counts binary, positions binary"
    return map_arrow(docs.select("row", "doc_id", "text"), work, schema)


class Lists:
    """Windows by the terms they are probed with: those of term t are ``window[start[t] : start[t + 1]]``."""

    def __init__(self, term: np.ndarray, window: np.ndarray, terms: int):
        self.window = window[np.argsort(term, kind="stable")]
        self.start = np.searchsorted(np.sort(term), np.arange(terms + 1))


@dataclass
class Wanted:
    """The windows of a block, their words rarest first.

    ``term`` and ``offset`` have every word of a window; ``distinct`` and ``times`` each distinct one with its count; -1 and 0 fill up.
    """

    owners: list[list[str]]
    length: np.ndarray
    term: np.ndarray
    offset: np.ndarray
    distinct: np.ndarray
    times: np.ndarray
    exact: Lists
    near: Lists

    @property
    def need(self) -> np.ndarray:
        return -(-self.length * NEAR[0] // NEAR[1])


def wanted(rows: list[tuple[str, str]], terms: dict[bytes, int], counts: dict[bytes, int], size: int) -> Wanted:
    """For (item, window) pairs; ``counts`` of words that no document has are missing."""
    by_window = defaultdict(list)
    for item, window in rows:
        by_window[window].append(item)
    shape = (len(by_window), size)
    term, offset, distinct, times = np.full(shape, -1), np.zeros(shape, int), np.full(shape, -1), np.zeros(shape, int)
    length = np.zeros(len(by_window), int)
    exact, near = ([], []), ([], [])
    for k, window in enumerate(by_window):
        words = [w.encode() for w in window.split(" ")]
        order = sorted((counts.get(w, 0), terms[w], at) for at, w in enumerate(words))
        length[k] = len(words)
        term[k, : len(words)] = [t for _, t, _ in order]
        offset[k, : len(words)] = [at for *_, at in order]
        each = Counter(t for _, t, _ in order)  # in order of rarity
        distinct[k, : len(each)], times[k, : len(each)] = list(each), list(each.values())
        if order[0][0]:  # a window with a word that no document has cannot occur
            exact[0].append(term[k, 0])
            exact[1].append(k)
        spare = len(words) * (NEAR[1] - NEAR[0]) // NEAR[1]
        for t, n in each.items():
            near[0].append(t)
            near[1].append(k)
            spare -= n
            if spare < 0:
                break
    lists = [Lists(np.array(t, int), np.array(k, int), len(terms)) for t, k in (exact, near)]
    return Wanted(list(by_window.values()), length, term, offset, distinct, times, *lists)


class Documents:
    """Postings of some documents as sorted keys (document, term, position)."""

    def __init__(self, batch: pa.RecordBatch):
        lists = [np.frombuffer(b"".join(batch.column(n).to_pylist()), "<i4").astype(np.int64) for n in ("terms", "counts", "positions")]
        self.words = batch.column("n_words").to_numpy()
        per_doc = np.array([b.as_buffer().size // 4 for b in batch.column("terms")], np.int64)
        self.term, self.count, position = lists
        self.doc = np.repeat(np.arange(batch.num_rows), per_doc)
        self.first = np.cumsum(self.count) - self.count
        self.keys = np.repeat(self.key(self.doc, self.term, 0), self.count) + position

    @staticmethod
    def key(doc, term, position):
        return (doc << (TERM_BITS + POS_BITS)) + (term << POS_BITS) + position

    def has(self, doc, term, position) -> np.ndarray:
        key = self.key(doc, term, position)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return self.keys[at] == key

    def between(self, doc, term, low, high) -> tuple[np.ndarray, np.ndarray]:
        """First and last + 1 of the postings with positions from ``low`` to ``high``."""
        ends = np.maximum(low, 0), np.minimum(high, (1 << POS_BITS) - 1)
        return np.searchsorted(self.keys, self.key(doc, term, ends[0])), np.searchsorted(self.keys, self.key(doc, term, ends[1]), "right")

    def probes(self, lists: Lists):
        """(document, window, position) of every posting with every window that is probed with its term, in slices."""
        many = (lists.start[self.term + 1] - lists.start[self.term]) if len(self.term) else np.empty(0, np.int64)
        ends = np.cumsum(many * self.count)
        for at in range(0, int(ends[-1]) if len(ends) else 0, SLICE):
            flat = np.arange(at, min(at + SLICE, int(ends[-1])))
            group = np.searchsorted(ends, flat, "right")
            inner = flat - (ends - many * self.count)[group]
            posting = self.first[group] + inner // many[group]
            window = lists.window[lists.start[self.term[group]] + inner % many[group]]
            yield self.doc[group], window, self.keys[posting] & ((1 << POS_BITS) - 1)


def phrases(docs: Documents, search: Wanted):
    """(document, window, start) of every occurrence."""
    for doc, window, position in docs.probes(search.exact):
        start = position - search.offset[window, 0]
        keep = (start >= 0) & (start + search.length[window] <= docs.words[doc])
        doc, window, start = doc[keep], window[keep], start[keep]
        for k in range(1, search.term.shape[1]):
            keep = search.length[window] <= k
            rest = np.flatnonzero(~keep)
            d, w = doc[rest], window[rest]
            keep[rest] = docs.has(d, search.term[w, k], start[rest] + search.offset[w, k])
            doc, window, start = doc[keep], window[keep], start[keep]
        yield doc, window, start


def holds(found: list[tuple[int, int]], times: dict[int, int], need: int) -> bool:
    """Whether ``REACH`` consecutive words hold enough of the words at the sorted (position, term) of ``found``."""
    for k, (first, _) in enumerate(found):
        seen = Counter(t for p, t in found[k : k + REACH] if p < first + REACH)
        if sum(min(n, times[t]) for t, n in seen.items()) >= need:
            return True
    return False


def close(docs: Documents, search: Wanted, known: set[tuple[int, int]]):
    """(document, window) of proximity matches; those in ``known`` are left out."""
    need = search.need
    for doc, window, position in docs.probes(search.near):
        matched = np.zeros(len(doc), np.int64)
        missing = search.length[window].copy()
        for k in range(search.distinct.shape[1]):
            term, times = search.distinct[window, k], search.times[window, k]
            low, high = docs.between(doc, np.maximum(term, 0), position - REACH + 1, position + REACH - 1)
            matched += np.where(term < 0, 0, np.minimum(high - low, times))
            missing -= times
            keep = matched + missing >= need[window]
            doc, window, position, matched, missing = (x[keep] for x in (doc, window, position, matched, missing))
        for d, w, p in zip(doc.tolist(), window.tolist(), position.tolist(), strict=True):
            if (d, w) in known:
                continue
            found, times = [], {}
            for t, n in zip(search.distinct[w].tolist(), search.times[w].tolist(), strict=True):
                if n:
                    low, high = docs.between(d, t, p - REACH + 1, p + REACH - 1)
                    found += [(int(x) & ((1 << POS_BITS) - 1), t) for x in docs.keys[low:high]]
                    times[t] = n
            if holds(sorted(found), times, int(need[w])):
                known.add((d, w))
                yield d, w


def parts(batch: pa.RecordBatch):
    """Slices of a batch of the index with about ``POSTINGS`` postings, ``ROWS`` documents at most."""
    first = held = 0
    for row, packed in enumerate(batch.column("positions")):
        held += packed.as_buffer().size // 4
        if held >= POSTINGS or row + 1 - first >= ROWS:
            yield batch.slice(first, row + 1 - first)
            first, held = row + 1, 0
    if first < batch.num_rows:
        yield batch.slice(first)


SPANS = "array<struct<s:bigint,e:bigint>>"


def matches(index: DataFrame, search: Wanted) -> DataFrame:
    """(row, doc_id, n_words, spans, items, near) for every document of the index; spans do not overlap."""
    shared = index.sparkSession.sparkContext.broadcast(search)
    span = pa.struct([("s", pa.int64()), ("e", pa.int64())])

    def work(batch):
        made = []
        for part in parts(batch):
            docs, wanted = Documents(part), shared.value
            spans, items, near = ([[] for _ in range(part.num_rows)], *([set() for _ in range(part.num_rows)] for _ in range(2)))
            known = set()
            for found in phrases(docs, wanted) if len(docs.keys) else ():
                for d, w, s in zip(*(x.tolist() for x in found), strict=True):
                    spans[d].append((s, s + int(wanted.length[w])))
                    items[d].update(wanted.owners[w])
                    known.add((d, w))
            for d, own in enumerate(items):
                near[d] |= own
            for d, w in close(docs, wanted, known) if len(docs.keys) else ():
                near[d].update(wanted.owners[w])
            merged = []
            for own in spans:
                merged.append([])
                for s, e in sorted(own):
                    if merged[-1] and s <= merged[-1][-1]["e"]:
                        merged[-1][-1]["e"] = max(e, merged[-1][-1]["e"])
                    else:
                        merged[-1].append({"s": s, "e": e})
            lists = [pa.array(list(map(sorted, x)), pa.list_(pa.string())) for x in (items, near)]
            made.append(pa.record_batch([*part.columns[:3], pa.array(merged, pa.list_(span)), *lists], ["row", "doc_id", "n_words", "spans", "items", "near"]))
        return pa.Table.from_batches(made)

    kind = index.schema["doc_id"].dataType.simpleString()
    return map_arrow(index, work, f"row bigint, doc_id {kind}, n_words bigint, spans {SPANS}, items array<string>, near array<string>")


def _search(docs: DataFrame, block: DataFrame, size: int) -> DataFrame:
    """``matches`` of one block of windows, by an index over ``docs``."""
    rows = [tuple(r) for r in block.select("item", "window").collect()]
    words = sorted({w.encode() for _, window in rows for w in window.split(" ")})
    if len(words) >= 1 << TERM_BITS:
        raise ValueError("too many terms: lower the block")
    terms = {w: k for k, w in enumerate(words)}
    counts = {r.word.encode(): r.n for r in word_counts(docs, frozenset(words)).collect()}  # at most the block's words
    index = materialize(positional_index(docs, terms), "index")
    return matches(index, wanted(rows, terms, counts, size))


def contamination(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text: str = "text", size: int = WINDOW, block: int = BLOCK, row_col: str | None = None,
) -> DataFrame:
    """row (``row_col``, or else its monotonically increasing id) and ``COLUMNS`` for every document row."""
    narrow = docs.select(*([F.col(row_col).alias("row")] if row_col else []), F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    found = materialize(windows(items, item_col, item_text, size), "items")
    blocks = max(1, math.ceil(found.count() / block))
    if not row_col:  # one block numbers its rows in its index; several indexes need the same numbers
        narrow = numbered(narrow, "row") if blocks > 1 else narrow.withColumn("row", F.monotonically_increasing_id())
    # Dealt by item and window, so that a window with very many owners is spread over the blocks.
    each = [_search(narrow, found.filter(F.pmod(F.xxhash64("item", "window"), F.lit(blocks)) == b), size) for b in range(blocks)]
    if blocks == 1:
        judged = each[0]
    else:
        lists = [F.flatten(F.collect_list(c)) for c in ("spans", "items", "near")]
        judged = reduce(DataFrame.unionByName, each).groupBy("row", "doc_id", "n_words").agg(
            F.array_sort(lists[0]).alias("spans"), *(F.array_sort(F.array_distinct(x)).alias(n) for x, n in zip(lists[1:], ("items", "near"), strict=True))
        )
    covered = F.aggregate(
        "spans",
        F.struct(F.lit(0).cast("bigint").alias("end"), F.lit(0).cast("bigint").alias("n")),
        lambda a, x: F.struct(
            F.greatest(a["end"], x["e"]).alias("end"),
            (a["n"] + F.greatest(F.lit(0), x["e"] - F.greatest(a["end"], x["s"]))).cast("bigint").alias("n"),
        ),
        lambda a: a["n"],
    )
    return judged.select(
        "row", "doc_id", "n_words",
        covered.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
        F.size("near").cast("bigint").alias("n_near_items"),
        F.array_join("near", ",").alias("near_items"),
    )


COLUMNS = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "n_near_items", "near_items"]


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).select(*COLUMNS)


_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),"
    " '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
)
SQL = f"""
WITH item AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
windows AS MATERIALIZED (
  SELECT DISTINCT coalesce(CAST(item_id AS VARCHAR), '') AS item, least(len(w), {WINDOW}) AS n, array_to_string(list_slice(w, s, s + {WINDOW - 1}), ' ') AS gram
  FROM (SELECT item_id, w, unnest(range(1, greatest(2, len(w) - {WINDOW - 2}))) AS s FROM item WHERE len(w) > 0)),
doc AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
gram AS (
  SELECT r, n, s, array_to_string(list_slice(w, s, s + n - 1), ' ') AS gram
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM doc CROSS JOIN (SELECT DISTINCT n FROM windows) WHERE len(w) >= n)),
hit AS (SELECT r, s, n, item FROM gram JOIN windows USING (n, gram)),
hit_words AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(s, s + n)) AS p FROM hit) GROUP BY r),
hit_items AS (SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM hit GROUP BY r),
term AS MATERIALIZED (
  SELECT gram, word, count(*) AS times, any_value(n) - any_value(n) * {NEAR[1] - NEAR[0]} // {NEAR[1]} AS need
  FROM (SELECT gram, n, unnest(string_split(gram, ' ')) AS word FROM (SELECT DISTINCT gram, n FROM windows)) GROUP BY gram, word),
posting AS MATERIALIZED (
  SELECT r, p, word FROM (SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM doc) SEMI JOIN term USING (word)),
present AS (SELECT r, word, count(*) AS k FROM posting GROUP BY r, word),
possible AS MATERIALIZED (
  SELECT r, gram FROM present JOIN term USING (word) GROUP BY r, gram HAVING sum(least(k, times)) >= any_value(need)),
met AS MATERIALIZED (SELECT r, gram, p, word, times, need FROM possible JOIN term USING (gram) JOIN posting USING (r, word)),
run AS (
  SELECT a.r, a.gram, a.p, b.word, least(count(*), any_value(b.times)) AS k, any_value(b.need) AS need
  FROM met a JOIN met b ON a.r = b.r AND a.gram = b.gram AND b.p BETWEEN a.p AND a.p + {REACH - 1} GROUP BY a.r, a.gram, a.p, b.word),
near AS (SELECT DISTINCT r, gram FROM (SELECT r, gram, p FROM run GROUP BY r, gram, p HAVING sum(k) >= any_value(need))),
near_items AS (SELECT r, count(DISTINCT item) AS n_near, string_agg(DISTINCT item, ',' ORDER BY item) AS near_items FROM near JOIN windows USING (gram) GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated,
  coalesce(n_near, 0) AS n_near_items, coalesce(near_items, '') AS near_items
FROM doc LEFT JOIN hit_words USING (r) LEFT JOIN hit_items USING (r) LEFT JOIN near_items USING (r)
"""
