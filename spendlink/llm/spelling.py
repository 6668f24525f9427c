"""Grouping of spelling variants: all words at one inserted, deleted or replaced code point, by a trie that is a table of edges.

1. Words are counted per batch before anything is shuffled.
2. **Trie.** Beginnings of a word, and of the word reversed, are nodes, named by a 64-bit hash that is rolled along the word. A second
   hash finds out if two nodes share a name; then all are named anew with another seed. Nodes where words end or part are kept;
   an edge leads from one kept node to the next and carries the letters between, so a word has as many edges as there are partings on
   its way, however long it is. Edges are a table of (node, label, child) with the letters that follow the child.
3. **Frontier.** A state is (word, position, node, edits). A word without an edit parts from its own way at every kept node on it: a letter is
   put in, or replaced by a greater one, and the rest of the label must agree. (Left-out and smaller letters are the same pairs
   seen from the other word.) With one edit the word follows the one edge that agrees. The frontier joins the edges level by level,
   each level a written table, until no state is left; states go on only where the next letter does. States at the end of their word,
   at a node where a word ends, are neighbours.
4. An edit leaves one half of the word as it is: the forward trie looks for neighbours that share the first half, the reversed one
   for those that don't and so share the second. So nobody meets the dense top of a trie, and words stand in it from about their
   half on only.
5. A word's form is its most frequent neighbour, if that is ``RATIO`` times as frequent; roots follow forms by pointer doubling.

A node that many words pass has its edges copied to several salts and its words dealt among them; a node has at most one edge per
letter. Nothing is collected or broadcast.

A null or empty text has no words. A null id counts as the empty text in the hash. Repeated rows are counted each; rows of equal id
change the same words. Words of any length are compared whole. An empty table gives an empty result; other columns are left aside.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlink.llm.common import as_bytes, map_arrow, table
from spendlink.sources.shared import materialize

LEAST_LENGTH, LEAST_COUNT, RATIO, EVERY = 7, 2, 10, 31
#: Words per salt of a node's edges.
SPLIT = 4096
SEEDS = 8
HALF = 45
_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
#: Lower-cased runs of ASCII letters and U+00C0 to U+00FF, in UTF-8.
_RUN = re.compile(rb"(?:[a-z]++|\xC3[\x80-\xBF])++")


def count_words(doc_id: bytes, text: bytes | None, out: dict[bytes, int]) -> None:
    """Adds the words of one document: runs, some of them with a code point left out as the hash of id and run says."""
    start = zlib.crc32(doc_id + b":")
    for run, n in Counter(_RUN.findall((text or b"").translate(_LOWER))).items():
        size = len(run)
        if size < LEAST_LENGTH:
            continue
        h = zlib.crc32(run, start)
        if h % EVERY == 0:
            word = run.decode()
            at = h % len(word)
            if len(word) <= LEAST_LENGTH:
                continue
            run = (word[:at] + word[at + 1 :]).encode()
        elif size < 2 * LEAST_LENGTH and size - run.count(b"\xc3") < LEAST_LENGTH:
            continue  # letters beyond ASCII have two bytes
        out[run] = out.get(run, 0) + n


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n) of all words of at least ``LEAST_LENGTH`` code points and ``LEAST_COUNT`` occurrences."""

    def work(batch):
        out: dict[bytes, int] = {}
        for doc_id, text in zip(as_bytes(batch.column(0)), as_bytes(batch.column(1)), strict=True):
            count_words(doc_id.as_py() or b"", text.as_py(), out)
        return pa.record_batch([pa.array([w.decode() for w in out], pa.string()), pa.array(list(out.values()), pa.int64())], ["word", "n"])

    narrow = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.col(text_col).alias("text"))
    counted = map_arrow(narrow, work, "word string, n bigint", whole=True).groupBy("word").agg(F.sum("n").alias("n"))
    return counted.filter(F.col("n") >= LEAST_COUNT)


def first_half(length: Column) -> Column:
    return F.floor(length / 2).cast("int")


def scrambled(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def nodes_on_way(words: list[str], side: int, seed: int):
    """For each depth: places of the words that long, and the names and checks of their nodes at that depth (two independent hashes)."""
    texts = [w[::-1] for w in words] if side else words
    sizes = np.array([len(t) for t in texts])
    points = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32).astype(np.uint64)
    starts = np.cumsum(sizes) - sizes
    order = np.argsort(-sizes, kind="stable")  # those that go on are a prefix
    name = np.full(len(texts), 2 * seed + side + 1, np.uint64)
    check = ~name
    for depth in range(1, int(sizes.max(initial=0)) + 1):
        own = order[: np.searchsorted(-sizes[order], -depth, "right")]
        letter = points[starts[own] + depth - 1]
        name[own] = scrambled(name[own] * np.uint64(0x9E3779B97F4A7C15) + letter)
        check[own] = scrambled(check[own] * np.uint64(0xC2B2AE3D27D4EB4F) + letter)
        yield depth, own, name[own], check[own]


def named(words: DataFrame, seed: int) -> DataFrame:
    """``words`` with a number and the names of their last nodes, forward and reversed."""

    def work(batch):
        texts = batch.column(0).to_pylist()
        ends = np.empty((2, len(texts)), np.uint64)
        sizes = np.array([len(t) for t in texts])
        for side in (0, 1):
            for depth, own, name, _ in nodes_on_way(texts, side, seed):
                done = sizes[own] == depth
                ends[side, own[done]] = name[done]
        return pa.record_batch([*batch.columns, *(pa.array(e.astype(np.int64)) for e in ends)], ["word", "n", "id", "forward", "reversed"])

    numbered = words.select("word", "n", F.monotonically_increasing_id().alias("id"))
    return map_arrow(numbered, work, "word string, n bigint, id bigint, forward bigint, reversed bigint")


def letter_masks(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sets of one letter each, as two numbers of ``HALF`` bits; bit ``HALF`` of the first stands for the end (0)."""
    place = np.where(points < 128, points - 97, points - 0xC0 + 26)
    low = np.where(points == 0, 1 << HALF, np.where(place < HALF, 1 << np.clip(place, 0, HALF), 0))
    return low, np.where((points > 0) & (place >= HALF), 1 << np.clip(place - HALF, 0, HALF), 0)


def has_letter(low: str, high: str, letter: str) -> str:
    """SQL: whether a set has the first letter of ``letter``."""
    place = f"if(ascii({letter}) < 128, ascii({letter}) - 97, ascii({letter}) - {0xC0 - 26})"
    return f"(if({place} < {HALF}, shiftright({low}, {place}), shiftright({high}, {place} - {HALF})) & 1) = 1"


def prefixes(words: DataFrame, seed: int) -> DataFrame:
    """(id, size, place, node, check, low, high): the nodes on every word's way from where a neighbour of its length, or one less, may
    start; ``place`` is twice the depth plus the side, ``low`` and ``high`` the set of the next letter."""

    def work(batch):
        texts, ids = batch.column(0).to_pylist(), batch.column(1).to_numpy()
        sizes = np.array([len(t) for t in texts])
        starts = np.cumsum(sizes + 1) - sizes - 1
        made = []
        for side in (0, 1):
            turned = "\0".join(t[::-1] for t in texts) if side else "\0".join(texts)
            points = np.frombuffer((turned + "\0").encode("utf-32-le"), np.uint32).astype(np.int64)
            least = (sizes - 1 + side) // 2
            for depth, own, name, check in nodes_on_way(texts, side, seed):
                use = least[own] <= depth
                own, name, check = own[use], name[use], check[use]
                masks = letter_masks(points[starts[own] + depth])
                columns = [
                    ids[own], sizes[own].astype(np.int32), np.full(len(own), 2 * depth + side, np.int32), name.astype(np.int64),
                    (check >> np.uint64(33)).astype(np.int32), *masks,
                ]
                made.append(pa.record_batch([pa.array(c) for c in columns], ["id", "size", "place", "node", "check", "low", "high"]))
        return pa.Table.from_batches(made).combine_chunks() if made else None

    return map_arrow(words.select("word", "id"), work, "id bigint, size int, place int, node bigint, check int, low bigint, high bigint")


def ways(words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``words`` with numbers and names, and (id, side, letters, way): the kept nodes on the way of every word and reversed word.

    ``low`` and ``high`` hold the first letters of a node's edges; ``first`` says whether the word is the least of those that pass it, shorter
    words first, as they stand in the trie from higher up.
    """
    for seed in range(SEEDS):
        known = materialize(named(words, seed), "words")
        passed = prefixes(known, seed)
        nodes = passed.groupBy("node").agg(
            F.bit_or("low").alias("low"), F.bit_or("high").alias("high"), F.min(F.struct("size", "id")).alias("least"),
            F.count(F.lit(1)).alias("passing"), F.expr("min(check) <> max(check)").alias("clash"),
        )
        ends = F.expr(f"shiftright(low, {HALF}) = 1")
        kept = nodes.filter((F.expr("bit_count(low) + bit_count(high)") > 1) | ends | F.col("clash")).select(
            "node", "low", "high", ends.alias("ends"), F.col("least.id").alias("least"), F.ceil(F.col("passing") / SPLIT).cast("int").alias("salts"), "clash"
        )
        step = F.struct("place", "node", "low", "high", "ends", "salts", F.expr("id = least").alias("first"))
        way = passed.select("id", "place", "node").join(kept, "node").groupBy("id", F.expr("place % 2").alias("side")).agg(
            F.sort_array(F.collect_list(step)).alias("way"), F.bool_or("clash").alias("clash")
        )
        letters = F.when(F.col("side") == 0, F.col("word")).otherwise(F.reverse("word")).alias("letters")
        found = materialize(way.join(known.select("id", "word"), "id").select("id", "side", letters, "way", "clash"), "ways")
        if found.filter("clash").isEmpty():
            return known, found.drop("clash")
    raise ValueError("nodes share names under every seed")


def edge_table(all_ways: DataFrame) -> DataFrame:
    """(node, salt, edges): all edges (label, child, low, high, ends, salts) of every node, once per salt; at most one per letter.

    Of all words on an edge, the one that is the first at its lower end reports it.
    """
    each = all_ways.filter("size(way) > 1").select("letters", F.expr(
        "inline(transform(filter(sequence(1, size(way) - 1), i -> way[i].first), i -> struct(way[i - 1].node AS node, way[i - 1].salts AS own,"
        " substring(letters, way[i - 1].place DIV 2 + 1, (way[i].place - way[i - 1].place) DIV 2) AS label, way[i].node AS child,"
        " way[i].low AS low, way[i].high AS high, way[i].ends AS ends, way[i].salts AS salts)))"
    ))
    edge = F.struct("label", "child", "low", "high", "ends", "salts")
    together = each.groupBy("node").agg(F.max("own").alias("own"), F.collect_list(edge).alias("edges"))
    return together.select("node", F.explode(F.expr("sequence(0, own - 1)")).alias("salt"), "edges")


REACHED = "pos = length(letters)"


def parted(all_ways: DataFrame) -> DataFrame:
    """States without an edit: every word at each kept node of its way, from its shared half on, that has an edge for it to part by."""
    length = F.length("letters")
    half = F.when(F.col("side") == 0, first_half(length)).otherwise(length - first_half(length))
    edges = "bit_count(s.low) + bit_count(s.high) - if(s.ends, 1, 0) - if(s.place DIV 2 < length(letters), 1, 0)"
    return all_ways.withColumn("half", half).select("id", "side", "letters", F.expr(
        f"inline(transform(filter(way, s -> s.place DIV 2 >= half AND {edges} > 0), s -> struct(s.place DIV 2 AS pos, s.node AS node, s.salts AS salts)))"
    ))


def _goes_on(pos: str) -> str:
    return f"if({pos} = length(letters), e.ends, {has_letter('e.low', 'e.high', f'substring(letters, {pos} + 1, 1)')})"


def _onward(condition: str, pos: str) -> str:
    """SQL: states behind those of the node's edges that meet ``condition``."""
    return f"transform(filter(edges, e -> {condition}), e -> struct({pos} AS pos, e.child AS node, e.salts AS salts))"


def _meet(states: DataFrame, edges: DataFrame, *outcomes: str) -> DataFrame:
    rest = F.expr("substring(letters, pos + 1)").alias("rest")
    here = states.select("id", "side", "letters", "pos", "node", F.pmod(F.xxhash64("id"), "salts").cast("int").alias("salt"), rest)
    met = here.join(edges, ["node", "salt"])
    for k in (0, 1):  # sets of the next letter and the one after it, or of the end
        letter = f"substring(letters, pos + {k + 1}, 1)"
        place = f"(ascii({letter}) - if(ascii({letter}) < 128, 97, {0xC0 - 26}))"
        met = met.withColumns({
            f"low{k}": F.expr(f"if({letter} = '', {1 << HALF}L, if({place} < {HALF}, shiftleft(1L, {place}), 0L))"),
            f"high{k}": F.expr(f"if({letter} = '' OR {place} < {HALF}, 0L, shiftleft(1L, {place} - {HALF}))"),
        })
    met = met.withColumn("own", F.expr("substring(rest, 1, 1)"))
    return met.select("id", "side", "letters", F.expr(f"inline(concat({', '.join(outcomes)}))"))


def one_edit(states: DataFrame, edges: DataFrame) -> DataFrame:
    """States without an edit part from their words: the label's first letter, which isn't the word's next, is put in, or put in its
    place if it is the greater of the two. (The other way round, the neighbour finds the word.) The rest of the label must agree.
    States stay only where the next letter, or the end, goes on. Most labels are one letter, and need no more than a look at the sets.
    """
    far, near = "(pos + length(e.label))", "(pos + length(e.label) - 1)"
    tail = "substring(e.label, 2) AND NOT startswith(e.label, own)"
    replaced = f"""own <> '' AND e.label > rest AND if(length(e.label) = 1, e.label <> own AND ((e.low & low1) | (e.high & high1)) <> 0,
        substring(rest, 2, length(e.label) - 1) = {tail} AND {_goes_on(far)})"""
    put_in = f"""if(length(e.label) = 1, e.label <> own AND ((e.low & low0) | (e.high & high0)) <> 0,
        own <> '' AND substring(rest, 1, length(e.label) - 1) = {tail} AND {_goes_on(near)})"""
    return _meet(states, edges, _onward(replaced, far), _onward(put_in, near))


def followed(states: DataFrame, edges: DataFrame) -> DataFrame:
    """States with an edit follow the edge that agrees with the word."""
    pos = "(pos + length(e.label))"
    return _meet(states, edges, _onward(f"startswith(rest, e.label) AND {_goes_on(pos)}", pos))


def neighbours(words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """words(word, n) with numbers, and every pair of them at one edit, once: (id, n, word, near_id, near_n, near)."""
    known, all_ways = ways(words)
    edges = materialize(edge_table(all_ways), "edges")
    levels = [materialize(one_edit(parted(all_ways), edges), "states")]
    while not levels[-1].filter(f"NOT {REACHED}").isEmpty():
        levels.append(materialize(followed(levels[-1].filter(f"NOT {REACHED}"), edges), "states"))
    reached = reduce(DataFrame.unionByName, [level.filter(REACHED).select("id", "side", "letters", "node") for level in levels])
    near = [F.col("id").alias("near_id"), F.col("n").alias("near_n"), F.col("word").alias("near")]
    last = known.select(F.col("forward").alias("node"), *near).unionByName(known.select(F.col("reversed").alias("node"), *near))
    pairs = reached.join(last, "node").withColumn("half", first_half(F.length("letters")))
    shares_first = F.expr("substring(reverse(letters), 1, half) = substring(near, 1, half)")
    once = pairs.filter((F.col("side") == 0) | ~shares_first)
    word = F.when(F.col("side") == 0, F.col("letters")).otherwise(F.reverse("letters")).alias("word")
    return known, once.select("id", word, "near_id", "near_n", "near").join(known.select("id", "n"), "id")


def with_roots(formed: DataFrame) -> DataFrame:
    """``formed`` (word, form, ...) with ``root``: forms followed to the last. Each form is ``RATIO`` times as frequent as
    the word before, so a chain is short and a few doublings end it."""
    links = materialize(formed.filter(F.col("form").isNotNull()).select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = links.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = materialize(links.join(onward, "root", "left"), "roots")
        if moved.filter("further IS NOT NULL").isEmpty():
            break
        links = moved.select("word", F.coalesce("further", "root").alias("root"))
    return formed.join(links, "word", "left").withColumn("root", F.coalesce("root", "word"))


COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``COLUMNS`` for every word."""
    words, pairs = neighbours(word_counts(docs, id_col, text_col))
    # Both words of a pair are near the other.
    sides = F.explode(F.array(
        F.struct(F.col("id").alias("id"), F.col("near_n").alias("near_n"), F.col("near").alias("near")),
        F.struct(F.col("near_id").alias("id"), F.col("n").alias("near_n"), F.col("word").alias("near")),
    ))
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")
    near = pairs.select(sides.alias("p")).select("p.*").groupBy("id").agg(F.count(F.lit(1)).alias("n_near"), best)
    frequent = -F.col("best.less") >= RATIO * F.col("n")
    formed = words.join(near, "id", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"), F.when(frequent, F.col("best.near")).alias("form"),
        F.when(frequent, -F.col("best.less")).alias("form_n"),
    )
    return with_roots(materialize(formed, "forms")).select(*COLUMNS)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(table(spark, sf_dir, "documents"))


def _crc_table() -> list[int]:
    out = []
    for value in range(256):
        for _ in range(8):
            value = value >> 1 ^ (0xEDB88320 if value & 1 else 0)
        out.append(value)
    return out


_HEX = "hex(encode(CAST(coalesce(CAST(doc_id AS VARCHAR), '') AS VARCHAR) || ':' || run))"
SQL = f"""
WITH RECURSIVE doc AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\\x{{C0}}-\\x{{FF}}]+') AS runs
  FROM documents),
run AS MATERIALIZED (SELECT doc_id, run, count(*) AS k FROM (SELECT doc_id, unnest(runs) AS run FROM doc) WHERE length(run) >= {LEAST_LENGTH} GROUP BY doc_id, run),
hashed AS MATERIALIZED (
  SELECT run, k, xor(4294967295, list_reduce(
    list_prepend(4294967295, list_transform(range(0, CAST(length(x) // 2 AS BIGINT)), lambda i: CAST('0x' || substr(x, 2 * i + 1, 2) AS BIGINT))),
    lambda c, b: xor(c >> 8, list_extract({_crc_table()}, (xor(c, b) & 255) + 1)))) AS h
  FROM (SELECT run, k, {_HEX} AS x FROM run)),
changed AS (
  SELECT CASE WHEN h % {EVERY} = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, k FROM hashed),
words AS MATERIALIZED (
  SELECT word, CAST(sum(k) AS BIGINT) AS n FROM changed WHERE length(word) >= {LEAST_LENGTH} GROUP BY word HAVING sum(k) >= {LEAST_COUNT}),
shorter AS MATERIALIZED (
  SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words)),
near AS MATERIALIZED (
  SELECT a.word AS word, b.word AS near FROM shorter a JOIN shorter b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT a.word, b.word FROM shorter a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word FROM shorter a JOIN words b ON a.rest = b.word),
best AS (
  SELECT near.word, count(*) AS n_near, min({{'less': -v.n, 'near': near.near}}) AS b FROM near JOIN words v ON v.word = near.near GROUP BY near.word),
formed AS MATERIALIZED (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN -b.less >= {RATIO} * n THEN b.near END AS form, CASE WHEN -b.less >= {RATIO} * n THEN -b.less END AS form_n
  FROM words LEFT JOIN best USING (word)),
chain AS (
  SELECT word, word AS at, form AS following FROM formed
  UNION ALL SELECT chain.word, f.word, f.form FROM chain JOIN formed f ON f.word = chain.following)
SELECT formed.word, form, chain.at AS root, n, n_near, form_n FROM formed JOIN chain ON chain.word = formed.word AND chain.following IS NULL
"""
