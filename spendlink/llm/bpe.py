"""Byte-level BPE encoding and decoding by a segment tree over adjacent pair ranks.

A piece of text (pre-token) starts as its bytes. The leaves of a segment tree hold, for each symbol, the rank of the
merge with its right neighbour and its position; every inner node holds the smaller child. The root therefore is the
leftmost merge of lowest rank. A merge changes three leaves, whose paths are recomputed; the piece is done when the
root holds no merge. Pieces of up to ``WIDE`` bytes are worked on side by side, one tree per row of a matrix; longer ones
have a tree each.

Texts are worked on in slices of ``SLICE`` characters' worth of rows; a worker keeps the encoded pieces it has met, at
most ``KEPT`` of them. The vocabulary file is a parameter; it is read on the driver and broadcast (a few MB).

Null texts count as empty, empty texts have no tokens, special tokens inside a text are recognised as the file says,
repeated rows are encoded each, an empty table gives an empty result, other columns are left aside.
"""

from __future__ import annotations

import hashlib
import json

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlink.llm.common import map_arrow, table

WIDE = 64
SLICE = 1 << 20
KEPT = 300_000
NONE = np.int64(1) << 62

# Fixed value: the split pattern of byte-level pre-tokenizers, with white space as Unicode defines it.
PIECES = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)


def byte_letters() -> list[str]:
    """The letter that stands for each byte in vocabulary files: printable ones for themselves, others from U+0100 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b if b in printable else next(others)) for b in range(256)]


class Vocabulary:
    """What a tokenizer file says, as arrays. Picklable; one per worker after the broadcast."""

    def __init__(self, content: str):
        spec = json.loads(content)
        ids, letters = spec["model"]["vocab"], byte_letters()
        byte_of = {c: b for b, c in enumerate(letters)}
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        self.size = max(ids.values(), default=0) + 1
        self.byte_ids = np.array([ids[c] for c in letters], np.int64)
        key = np.array([ids[a] * self.size + ids[b] for a, b in pairs], np.int64)
        order = np.argsort(key, kind="stable")
        self.keys, self.ranks = key[order], order.astype(np.int64)
        self.merged = np.array([ids[a + b] for a, b in pairs], np.int64)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        top = max([self.size - 1, *self.special.values()])
        self.spelled = [b""] * (top + 1)
        for token, i in ids.items():
            self.spelled[i] = bytes(byte_of[c] for c in token)
        for token, i in self.special.items():
            self.spelled[i] = token.encode()

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of merging each pair; ``NONE`` where the pair does not merge."""
        if not len(self.keys):
            return np.full(len(left), NONE)
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NONE)


def merge_long(piece: bytes, vocab: Vocabulary) -> np.ndarray:
    """Ids of one piece, by one tree."""
    n = len(piece)
    width = 1 << (n - 1).bit_length()
    sym = vocab.byte_ids[np.frombuffer(piece, np.uint8)].tolist()
    start = vocab.rank(np.array(sym[:-1], np.int64), np.array(sym[1:], np.int64))
    leaves = np.where(start < NONE, start * width + np.arange(n - 1), NONE)
    levels = [np.concatenate([leaves, np.full(width - n + 1, NONE)])]
    while len(levels[-1]) > 1:
        levels.append(levels[-1].reshape(-1, 2).min(axis=1))
    tree = np.concatenate([[NONE], *levels[::-1]]).tolist()
    before, after = list(range(-1, n - 1)), list(range(1, n + 1))
    none, keys = int(NONE), {}

    def leaf(i, j):
        if i < 0 or j >= n:
            return none
        pair = sym[i], sym[j]
        if pair not in keys:
            keys[pair] = int(vocab.rank(np.array(pair[:1]), np.array(pair[1:]))[0])
        return none if keys[pair] == none else keys[pair] * width + i

    def put(i, value):
        i += width
        tree[i] = value
        while i > 1:
            i >>= 1
            tree[i] = min(tree[2 * i], tree[2 * i + 1])

    while tree[1] < none:
        rank, i = divmod(tree[1], width)
        j = after[i]
        k = after[j]
        sym[i], sym[j], after[i] = int(vocab.merged[rank]), -1, k
        if k < n:
            before[k] = i
        put(j, none)
        put(i, leaf(i, k))
        if before[i] >= 0:
            put(before[i], leaf(before[i], i))
    return np.array([s for s in sym if s >= 0], np.int64)


def merge_rows(pieces: list[bytes], width: int, vocab: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all pieces (each of 1 to ``width`` bytes, ``width`` a power of two) in a row, and how many each has."""
    n = len(pieces)
    length = np.fromiter(map(len, pieces), np.int64, n)
    sym = np.full((n, width + 1), -1, np.int64)
    at = np.arange(width)
    sym[:, :width][at < length[:, None]] = vocab.byte_ids[np.frombuffer(b"".join(pieces), np.uint8)]
    before = np.broadcast_to(np.arange(-1, width), (n, width + 1)).copy()
    after = np.broadcast_to(np.arange(1, width + 2), (n, width + 1)).copy()
    tree = np.full((n, 2 * width), NONE)

    def leaf(rows, i, j):
        """Leaf value of position i merging with j; positions outside the piece (symbol -1) do not merge."""
        out = np.full(len(rows), NONE)
        left, right = sym[rows, i], sym[rows, np.minimum(j, width)]
        ok = np.flatnonzero((i >= 0) & (left >= 0) & (right >= 0))
        rank = vocab.rank(left[ok], right[ok])
        out[ok] = np.where(rank < NONE, rank * width + i[ok], NONE)
        return out

    r, i = np.nonzero(at[: width - 1] < length[:, None] - 1) if width > 1 else (np.empty(0, np.int64),) * 2
    tree[r, width + i] = leaf(r, i, i + 1)
    size = width
    while size > 1:
        size //= 2
        tree[:, size : 2 * size] = tree[:, 2 * size : 4 * size].reshape(n, size, 2).min(axis=2)
    rows = np.arange(n)
    while True:
        root = tree[rows, 1]
        live = root < NONE
        rows, root = rows[live], root[live]
        if not len(rows):
            break
        rank, i = np.divmod(root, width)
        j = after[rows, i]
        k = after[rows, j]
        p = before[rows, i]
        sym[rows, i] = vocab.merged[rank]
        sym[rows, j] = -1
        after[rows, i] = k
        before[rows, np.minimum(k, width)] = i
        tree[rows, width + j] = NONE
        tree[rows, width + i] = leaf(rows, i, k)
        has = p >= 0
        tree[rows[has], width + p[has]] = leaf(rows[has], p[has], i[has])
        nodes = [width + i, width + j, width + np.where(has, p, i)]
        while nodes[0][0] > 1:
            nodes = [x >> 1 for x in nodes]
            for x in nodes:
                tree[rows, x] = np.minimum(tree[rows, 2 * x], tree[rows, 2 * x + 1])
    kept = sym[:, :width] >= 0
    return sym[:, :width][kept], kept.sum(axis=1)


def encode_pieces(pieces: list[str], vocab: Vocabulary) -> dict[str, bytes]:
    """The ids of each piece, as little-endian unsigned 32-bit integers."""
    out, by_width = {}, {}
    for piece in pieces:
        raw = piece.encode()
        if len(raw) > WIDE:
            out[piece] = merge_long(raw, vocab).astype("<u4").tobytes()
        else:
            by_width.setdefault(1 << (len(raw) - 1).bit_length(), []).append((piece, raw))
    for width, group in by_width.items():
        for first in range(0, len(group), 1 << 15):
            part = group[first : first + (1 << 15)]
            ids, counts = merge_rows([raw for _, raw in part], width, vocab)
            packed, ends = ids.astype("<u4").tobytes(), (4 * np.cumsum(counts)).tolist()
            for (piece, _), start, end in zip(part, [0, *ends], ends, strict=False):
                out[piece] = packed[start:end]
    return out


class Codec:
    """Encodes and decodes with one vocabulary, keeping the pieces met."""

    def __init__(self, vocab: Vocabulary):
        import regex

        self.vocab, self.kept = vocab, {}
        self.pieces = regex.compile(PIECES).findall
        names = sorted(vocab.special, key=len, reverse=True)
        self.split = regex.compile("(" + "|".join(map(regex.escape, names)) + ")").split if names else None
        self.special = {name: np.array([i], "<u4").tobytes() for name, i in vocab.special.items()}

    def _pieces(self, text: str) -> list[str]:
        if self.split is None or not any(name in text for name in self.special):
            return self.pieces(text)
        out = []
        for part in self.split(text):
            out += [part] if part in self.special else self.pieces(part)
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        lists = [self._pieces(t) for t in texts]
        if len(self.kept) > KEPT:
            self.kept = {}
        if not self.kept:
            self.kept.update(self.special)
        new = set().union(*lists).difference(self.kept)
        self.kept.update(encode_pieces(list(new), self.vocab))
        look_up = self.kept.__getitem__
        return [b"".join(map(look_up, pieces)) for pieces in lists]

    def decode(self, ids: bytes) -> str:
        spelled = self.vocab.spelled.__getitem__
        return b"".join(map(spelled, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


_CODECS: dict[str, Codec] = {}


def _codec(vocab: Vocabulary, name: str) -> Codec:
    """One per worker and vocabulary, kept between batches."""
    if name not in _CODECS:
        _CODECS[name] = Codec(vocab)
    return _CODECS[name]


def sliced(texts: list[str]):
    """(first, last) of consecutive runs of rows with about ``SLICE`` characters."""
    first, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= SLICE:
            yield first, i + 1
            first, size = i + 1, 0
    if first < len(texts):
        yield first, len(texts)


def read_vocabulary(path: str) -> tuple[Vocabulary, str]:
    with open(path, encoding="utf-8") as file:
        content = file.read()
    return Vocabulary(content), hashlib.sha256(content.encode()).hexdigest()


def encoded(docs: DataFrame, path: str, text_col: str = "text", out: str = "ids") -> DataFrame:
    """``docs`` with the token ids of a text as array<int> in ``out``."""
    return _with_ids(docs, path, text_col, [(out, "array<int>", lambda ids, codec: np.frombuffer(ids, "<u4").astype(np.int32))])


def _with_ids(docs, path, text_col, makers, drop=()):
    vocab, name = read_vocabulary(path)
    shared = docs.sparkSession.sparkContext.broadcast(vocab)
    at = docs.columns.index(text_col)
    kept = [f for f in docs.schema.fields if f.name not in drop]
    places = [docs.columns.index(f.name) for f in kept]

    def work(batch):
        codec = _codec(shared.value, name)
        column = batch.column(at)
        made = [[] for _ in makers]
        sizes = column.fill_null("").to_pylist() if column.null_count else column.to_pylist()
        for first, last in sliced(sizes):
            for ids in codec.encode(sizes[first:last]):
                for values, (_, _, make) in zip(made, makers, strict=True):
                    values.append(make(ids, codec))
        kinds = {"array<int>": pa.list_(pa.int32()), "bigint": pa.int64(), "string": pa.string()}
        columns = [pa.array(v, kinds[k]) for v, (_, k, _) in zip(made, makers, strict=True)]
        return pa.record_batch([*(batch.column(i) for i in places), *columns], [*(f.name for f in kept), *(m[0] for m in makers)])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + [f"`{n}` {k}" for n, k, _ in makers]
    return map_arrow(docs, work, ", ".join(fields))


def round_trip(docs: DataFrame, path: str, text_col: str = "text") -> DataFrame:
    """``docs`` with ``n_tokens``, ``ids`` and ``decodes``: whether the ids decode to the text (null counts as empty)."""
    kept = docs.drop("n_tokens", "ids", "decodes", "__sha")
    checked = _with_ids(
        kept.withColumn("__sha", F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256)),
        path,
        text_col,
        [DIGEST[0], ("ids", "array<int>", lambda ids, codec: np.frombuffer(ids, "<u4").astype(np.int32)), ("__back", *DIGEST[2][1:])],
    )
    return checked.withColumn("decodes", F.col("__sha") == F.col("__back")).drop("__sha", "__back")


def decoded(docs: DataFrame, path: str, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """``docs`` with the text of the token ids in ``ids_col``; null ids give null."""
    vocab, name = read_vocabulary(path)
    shared = docs.sparkSession.sparkContext.broadcast(vocab)
    at = docs.columns.index(ids_col)

    def work(batch):
        codec = _codec(shared.value, name)
        texts = [None if x is None else codec.decode(np.array(x, "<u4").tobytes()) for x in batch.column(at).to_pylist()]
        return pa.record_batch([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, out])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields]
    return map_arrow(docs, work, ", ".join([*fields, f"`{out}` string"]))


DIGEST = [
    ("n_tokens", "bigint", lambda ids, codec: len(ids) // 4),
    ("ids_sha256", "string", lambda ids, codec: hashlib.sha256(ids).hexdigest()),
    ("decoded_sha256", "string", lambda ids, codec: hashlib.sha256(codec.decode(ids).encode()).hexdigest()),
]


def digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 for every row."""
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("__text"))
    return _with_ids(narrow, path, "__text", DIGEST, drop=("__text",))


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"), default_path())
