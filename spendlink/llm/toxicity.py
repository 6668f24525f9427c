"""Toxicity score of a factorization machine over hashed terms.

Terms of a text are its distinct words and their beginnings of 4, 5 and 6 bytes, hashed into ``2**BITS`` buckets. The
machine scores ``w0 + sum w_i + sum over pairs <v_i, v_j>`` of the buckets present, so it learns single terms and pairs
of terms that only together point to an insult.

Learning takes a bounded sample of the labelled rows: up to ``PER_CLASS`` of each class, those with the smallest hash of
their id. Every bucket that at least ``LEAST_TEXTS`` of them have gets a weight and factors, whatever the label says about it alone, so
terms that only tell in pairs are learned too. Weights take steps of the follow-the-regularised-leader kind: a term keeps weight 0 until
its gradients, given all other terms, add up to ``LEAST_PULL`` an epoch. Factors start small and, after the first epochs, follow plain gradient
steps with decay, so they grow where errors are left that weights cannot mend. The cut between the classes is put where the sample's
error is least, with the classes weighted by their shares among all training labels. The sample's size bounds the training task
and the number of buckets; those that training left alone are dropped, and the model is broadcast (2**20 buckets at most).

Null and empty texts have no terms and get the score of the intercept. Repeated rows are scored each; of repeated
training ids one row counts; a label that is given twice is the larger one. Without labels of both classes the score is
their plain share (0 without any). An empty table gives an empty result. Other columns are left aside.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlink.llm.common import as_bytes, fold, map_arrow, table, words_of

BITS = 20
FOLDS = 5
PER_CLASS = 6_000
#: Sampled texts that must have a bucket; one text's own terms teach nothing about others.
LEAST_TEXTS = 2
FACTORS = 8
EPOCHS, WEIGHTS_FIRST, BATCH = 10, 3, 256
#: Weights: rate of their steps, and the sum of an epoch's gradients from which on a term gets one at all, for each square root of
#: the texts of the smaller class: as much as chance makes of a few of them.
RATE, LEAST_PULL = 1.0, 0.04
#: Factors: size at the beginning, rate and decay, largest step of a batch, terms of a text that counts fully.
START, FACTOR_RATE, DECAY, LARGEST_STEP, SHORT = 0.003, 2.0, 1e-4, 0.05, 64
KEPT = 200_000


class Terms:
    """Buckets of a text's terms; remembers the buckets of words it has met."""

    def __init__(self):
        self.kept: dict[bytes, tuple[int, ...]] = {}

    def of_word(self, word: bytes) -> tuple[int, ...]:
        if len(self.kept) > KEPT:
            self.kept = {}
        found = self.kept.get(word)
        if found is None:
            starts = [b"^" + word[:n] for n in (4, 5, 6) if len(word) > n]
            found = self.kept[word] = tuple(xxhash.xxh32_intdigest(t) & ((1 << BITS) - 1) for t in (word, *starts))
        return found

    def of_text(self, text: bytes | None) -> set[int]:
        out: set[int] = set()
        for word in set(words_of(text)):
            out.update(self.of_word(word))
        return out


@dataclass
class Machine:
    """``bucket`` is sorted; ``weight`` and ``factors`` belong to its entries."""

    bias: float
    bucket: np.ndarray
    weight: np.ndarray
    factors: np.ndarray

    def __post_init__(self):
        self.place = dict(zip(self.bucket.tolist(), range(len(self.bucket)), strict=True))

    def logit(self, present: list[int]) -> float:
        if not present:
            return self.bias
        v = self.factors[present]
        total = v.sum(axis=0)
        return float(self.bias + self.weight[present].sum() + 0.5 * (total @ total - (v * v).sum()))

    def score(self, buckets: set[int]) -> float:
        present = sorted(self.place[b] for b in buckets if b in self.place)
        return float(1 / (1 + np.exp(-np.clip(self.logit(present), -30, 30))))


def constant(share: float) -> Machine:
    share = min(max(share, 1e-9), 1 - 1e-9)
    return Machine(float(np.log(share / (1 - share))), np.empty(0, np.int64), np.empty(0), np.empty((0, FACTORS)))


def fit(rows: list[np.ndarray], labels: np.ndarray, share: float) -> Machine:
    """``rows``: buckets of each sampled text; ``share``: the positive share among all training labels.

    Fixed batches of texts in a fixed random order; a step touches the buckets of its batch.
    """
    n, positive = len(labels), int(labels.sum())
    if positive in (0, n):
        return constant(share)
    flat = np.concatenate(rows) if sum(map(len, rows)) else np.empty(0, np.int64)
    bucket = np.flatnonzero(np.bincount(flat, minlength=1 << BITS) >= LEAST_TEXTS)
    if not len(bucket):
        return constant(share)
    rng = np.random.Generator(np.random.PCG64(7))
    order = rng.permutation(n)
    theta = np.concatenate([np.zeros((len(bucket), 1)), rng.normal(0, START, (len(bucket), FACTORS))], axis=1)
    pulled, squares, speed, bias = np.zeros(len(bucket)), np.zeros(len(bucket)), np.zeros((len(bucket), FACTORS)), float(np.log(positive / (n - positive)))
    least_pull = LEAST_PULL * np.sqrt(min(positive, n - positive))
    batches = []
    for first in range(0, n, BATCH):
        own = order[first : first + BATCH]
        kept = [_kept(rows[i], bucket) for i in own]
        touched, col = np.unique(np.concatenate(kept), return_inverse=True)
        batches.append((own, np.array([len(r) for r in kept]), touched, col.astype(np.int32)))
    for epoch in range(EPOCHS):
        for own, sizes, touched, col in batches:
            error, grad = gradient(bias, theta[touched], labels[own], sizes, col)
            g, old = grad[:, 0], squares[touched]
            now = old + g * g
            total = pulled[touched] + g - (np.sqrt(now) - np.sqrt(old)) / RATE * theta[touched, 0]
            pulled[touched], squares[touched] = total, now
            theta[touched, 0] = -np.sign(total) * np.maximum(np.abs(total) - least_pull * (epoch + 1), 0) / ((1 + np.sqrt(now)) / RATE)
            if epoch >= WEIGHTS_FIRST:
                g = grad[:, 1:] / len(own)
                g *= min(1.0, LARGEST_STEP / max(1e-12, np.sqrt((g * g).sum())))
                speed[touched] = 0.9 * speed[touched] - FACTOR_RATE * (g + DECAY * theta[touched, 1:])
                theta[touched, 1:] += speed[touched]
            bias -= error.mean()
    logits = np.empty(n)
    for own, sizes, touched, col in batches:
        logits[own] = bias + raw_logits(theta[touched], sizes, col)[0]
    # What training left alone says nothing: no weight, and factors of the size they began with.
    used = (theta[:, 0] != 0) | (np.abs(theta[:, 1:]).max(axis=1) > 10 * START)
    return Machine(float(bias - cut(logits, labels, share)), bucket[used], theta[used, 0].copy(), theta[used, 1:].copy())


def cut(logits: np.ndarray, labels: np.ndarray, share: float) -> float:
    """Where positive and negative texts part with the least error, classes weighted by their shares among all labels: the
    middle of the widest gap of that error."""
    order = np.argsort(logits, kind="stable")
    x, y = logits[order], labels[order]
    positive = y.sum()
    below = np.concatenate(([0.0], np.cumsum(y))) / positive * share  # positives under the cut
    above = np.concatenate((np.cumsum((1 - y)[::-1])[::-1], [0.0])) / (len(y) - positive) * (1 - share)
    ends = np.concatenate(([x[0] - 1], x, [x[-1] + 1]))
    gap = np.diff(ends)
    error = np.where(gap > 0, below + above, np.inf)
    best = np.flatnonzero(error <= error.min() + 1e-12)
    k = best[np.argmax(gap[best])]
    return float((ends[k] + ends[k + 1]) / 2)


def _kept(row: np.ndarray, bucket: np.ndarray) -> np.ndarray:
    """Places in ``bucket`` of a text's buckets, as far as they are there."""
    at = np.minimum(np.searchsorted(bucket, row), len(bucket) - 1)
    return at[bucket[at] == row]


def raw_logits(theta: np.ndarray, sizes: np.ndarray, col: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Logit without bias of each text of a batch, and the sums of its terms' rows of ``theta`` (a weight and the factors).

    The texts' terms are rows ``col`` of ``theta``, ``sizes`` of them for each text in turn.
    """
    some = np.flatnonzero(sizes)
    total, squares = np.zeros((len(sizes), theta.shape[1])), np.zeros(len(sizes))
    if len(some):
        starts = (np.cumsum(sizes) - sizes)[some]
        terms = theta[col]
        total[some] = np.add.reduceat(terms, starts, axis=0)
        squares[some] = np.add.reduceat((terms[:, 1:] ** 2).sum(axis=1), starts)
    return total[:, 0] + 0.5 * ((total[:, 1:] ** 2).sum(axis=1) - squares), total


def gradient(bias: float, theta: np.ndarray, truth: np.ndarray, sizes: np.ndarray, col: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Error of each text of a batch, and the gradient of the logistic loss by ``theta``.

    For the factors, a text of more than ``SHORT`` terms counts less by its number of terms: it holds so many pairs.
    """
    logit, total = raw_logits(theta, sizes, col)
    error = 1 / (1 + np.exp(-np.clip(bias + logit, -30, 30))) - truth
    part = error * np.minimum(1, SHORT / np.maximum(sizes, 1))
    own = np.repeat(np.arange(len(sizes)), sizes)
    pulls = np.concatenate([error[:, None], total[:, 1:] * part[:, None]], axis=1)
    count = len(theta)
    grad = np.stack([np.bincount(col, pulls[own, f], count) for f in range(theta.shape[1])], axis=1)
    grad[:, 1:] -= np.bincount(col, part[own], count)[:, None] * theta[:, 1:]
    return error, grad


def train(docs: DataFrame, labels: DataFrame, is_training: Column, label_col: str = "toxic", per_class: int = PER_CLASS) -> Machine:
    """docs(doc_id, text), labels(doc_id, ``label_col``); ``is_training`` on doc_id says which labels count."""
    known = labels.select("doc_id", F.col(label_col).cast("int").alias("label")).filter(
        F.col("doc_id").isNotNull() & F.col("label").isNotNull() & is_training
    )
    known = known.groupBy("doc_id").agg((F.max("label") > 0).cast("int").alias("label"))
    counts = known.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("label"), F.lit(0)).alias("k")).first()
    share = counts.k / counts.n if counts.n else 0.0
    if counts.k in (0, counts.n):
        return constant(share)
    picked = [known.filter(F.col("label") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for k in (0, 1)]
    # At most 2 * per_class ids: a bounded broadcast, and no text is shuffled to meet them.
    sample = docs.select("doc_id", "text").join(F.broadcast(picked[0].unionByName(picked[1])), "doc_id")

    def featurise(batch):
        terms = Terms()
        packed = [np.array(sorted(terms.of_text(t.as_py())), "<i4").tobytes() for t in as_bytes(batch.column(1))]
        return pa.record_batch([batch.column(0), pa.array(packed, pa.binary()), batch.column(2)], ["doc_id", "buckets", "label"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    featured = map_arrow(sample, featurise, f"doc_id {kind}, buckets binary, label int")
    # One row per id, so the task below gets the sample's size at most.
    rows = featured.groupBy("doc_id").agg(F.min(F.struct("buckets", "label")).alias("r")).select("doc_id", "r.*")

    def learn(batches):
        gathered = []
        for batch in batches:
            gathered += zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True)
        gathered.sort()
        buckets = [np.frombuffer(b, "<i4") for _, b, _ in gathered]
        machine = fit(buckets, np.array([k for *_, k in gathered], float), share)
        arrays = [machine.bucket.astype("<i8"), machine.weight.astype("<f8"), machine.factors.astype("<f8")]
        yield pa.record_batch(
            [pa.array([machine.bias]), *(pa.array([a.tobytes()], pa.binary()) for a in arrays)], ["bias", "bucket", "weight", "factors"]
        )

    one = rows.repartition(1).mapInArrow(learn, "bias double, bucket binary, weight binary, factors binary").first()
    return Machine(
        one.bias, np.frombuffer(one.bucket, "<i8"), np.frombuffer(one.weight, "<f8"),
        np.frombuffer(one.factors, "<f8").reshape(-1, FACTORS),
    )


def with_score(docs: DataFrame, machine: Machine, text_col: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with the score of ``text_col`` in ``out``, in place of any column of that name."""
    shared = docs.sparkSession.sparkContext.broadcast(machine)
    docs = docs.drop(out)
    at = docs.columns.index(text_col)
    terms = Terms()

    def work(batch):
        scores = [shared.value.score(terms.of_text(t.as_py())) for t in as_bytes(batch.column(at))]
        return pa.record_batch([*batch.columns, pa.array(scores, pa.float64())], [*batch.schema.names, out])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields]
    return map_arrow(docs, work, ", ".join([*fields, f"`{out}` double"]))


def held_out(doc_id: str = "doc_id") -> Column:
    return fold(doc_id, FOLDS) == 0


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of docs(doc_id, text)."""
    machine = train(docs, labels, ~held_out())
    scored = with_score(docs.select("doc_id", "text"), machine)
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
