"""The factorization machine: held-out accuracy, pairwise terms, odd rows."""

import math
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from spendlink.llm import toxicity
from spendlink.llm.common import table


def test_learns_pairs():
    """Label = both terms together; neither alone."""
    rng = np.random.default_rng(1)
    rows, labels = [], []
    for _ in range(3000):
        a, b = rng.integers(0, 2, 2)
        rows.append(np.array(sorted({100 + int(x) for x in rng.integers(0, 500, 20)} | ({1} if a else set()) | ({2} if b else set()))))
        labels.append(float(a and b))
    m = toxicity.fit(rows, np.array(labels), float(np.mean(labels)))
    assert m.score({1, 2}) > 0.9 and max(m.score({1}), m.score({2}), m.score(set())) < 0.2


def auc(score, truth):
    order, k = score.argsort(kind="stable").argsort(kind="stable"), truth.sum()
    return (order[truth == 1].sum() - k * (k - 1) / 2) / (k * (len(truth) - k))


def test_learns_what_no_term_tells_alone():
    """Label = exclusive-or of two groups of neutral terms, among noise."""
    rng = np.random.default_rng(5)

    def texts(n):
        rows, labels = [], []
        for _ in range(n):
            a, b = rng.integers(0, 2, 2)
            pair = {1000 + int(a) * 10 + int(rng.integers(5)), 2000 + int(b) * 10 + int(rng.integers(5))}
            rows.append(np.array(sorted(set(rng.integers(10_000, 14_000, 30).tolist()) | pair)))
            labels.append(float(a ^ b))
        return rows, np.array(labels)

    machine = toxicity.fit(*texts(12_000), 0.5)
    rows, labels = texts(2000)
    assert auc(np.array([machine.score(set(r.tolist())) for r in rows]), labels) > 0.95


def plain_fit(rows, labels, share):
    """The same machine, term by term."""
    n, f = len(labels), toxicity.FACTORS
    seen = Counter(b for r in rows for b in r.tolist())
    bucket = sorted(b for b, k in seen.items() if k >= toxicity.LEAST_TEXTS)
    rng = np.random.Generator(np.random.PCG64(7))
    order = rng.permutation(n).tolist()
    w = dict.fromkeys(bucket, 0.0)
    v = dict(zip(bucket, rng.normal(0, toxicity.START, (len(bucket), f)).tolist(), strict=True))
    z, q, speed = dict.fromkeys(bucket, 0.0), dict.fromkeys(bucket, 0.0), {b: [0.0] * f for b in bucket}
    bias = math.log(labels.sum() / (n - labels.sum()))
    least = toxicity.LEAST_PULL * math.sqrt(min(labels.sum(), n - labels.sum()))

    def logit(terms):
        pairs = sum(sum(x * y for x, y in zip(v[a], v[b], strict=True)) for i, a in enumerate(terms) for b in terms[:i])
        return sum(w[b] for b in terms) + pairs

    for epoch in range(toxicity.EPOCHS):
        for first in range(0, n, toxicity.BATCH):
            own = order[first : first + toxicity.BATCH]
            gw, gv, errors = Counter(), {}, []
            for i in own:
                terms = [b for b in rows[i].tolist() if b in w]
                e = 1 / (1 + math.exp(-min(30, max(-30, bias + logit(terms))))) - labels[i]
                errors.append(e)
                part = e * min(1, toxicity.SHORT / max(1, len(terms)))
                for b in terms:
                    gw[b] += e
                    g = gv.setdefault(b, [0.0] * f)
                    for k in range(f):
                        g[k] += part * (sum(v[a][k] for a in terms) - v[b][k])
            size = math.sqrt(sum((x / len(own)) ** 2 for g in gv.values() for x in g))
            clip = min(1.0, toxicity.LARGEST_STEP / max(1e-12, size))
            for b, g in gv.items():
                total = z[b] + gw[b] - (math.sqrt(q[b] + gw[b] ** 2) - math.sqrt(q[b])) / toxicity.RATE * w[b]
                z[b], q[b] = total, q[b] + gw[b] ** 2
                w[b] = -math.copysign(max(abs(total) - least * (epoch + 1), 0), total) / ((1 + math.sqrt(q[b])) / toxicity.RATE)
                if epoch >= toxicity.WEIGHTS_FIRST:
                    for k in range(f):
                        speed[b][k] = 0.9 * speed[b][k] - toxicity.FACTOR_RATE * (g[k] / len(own) * clip + toxicity.DECAY * v[b][k])
                    v[b] = [x + s for x, s in zip(v[b], speed[b], strict=True)]
            bias -= sum(errors) / len(own)
    logits = np.array([bias + logit([b for b in r.tolist() if b in w]) for r in rows])
    places = sorted(set(logits.tolist()))
    ends = [places[0] - 1, *places, places[-1] + 1]

    def wrong(at):
        missed = sum(x < at and y for x, y in zip(logits, labels, strict=True)) / labels.sum() * share
        return missed + sum(x > at and not y for x, y in zip(logits, labels, strict=True)) / (n - labels.sum()) * (1 - share)

    middles = [((a + b) / 2, b - a) for a, b in zip(ends, ends[1:], strict=False)]
    best = min(wrong(m) for m, _ in middles)
    middle = max((g, m) for m, g in middles if wrong(m) <= best + 1e-12)[1]
    return lambda terms: bias + logit(terms) - middle


def test_equals_a_plain_machine(monkeypatch):
    monkeypatch.setattr(toxicity, "LEAST_PULL", 0.02)
    monkeypatch.setattr(toxicity, "BATCH", 16)
    rng = np.random.default_rng(3)
    rows = [np.array(sorted(set(rng.integers(0, 12, rng.integers(1, 7)).tolist()))) for _ in range(60)]
    labels = np.array([float((1 in r) != (2 in r)) for r in rows])
    machine, plain = toxicity.fit(rows, labels, 0.3), plain_fit(rows, labels, 0.3)
    assert len(machine.bucket) == 12
    for r in rows:
        assert abs(machine.logit([machine.place[b] for b in r.tolist()]) - plain(r.tolist())) < 1e-6


def test_odd_rows(spark):
    docs = [(i, "you idiot scum" if i % 4 == 0 else f"calm words {i % 7} here", "x", 5.0) for i in range(400)]
    docs += [(None, None, None, None), (1000, "", "x", 1.0), (1001, None, "x", 1.0), (3, "calm words 3 here", "x", 1.0), (1002, "idiot " * 50000, "", 0.0)]
    d = spark.createDataFrame(docs, "doc_id bigint, text string, label string, score double")
    lab = spark.createDataFrame(
        [(i, int(i % 4 == 0), "x") for i in range(400)] + [(5, None, "x"), (8, 0, "x"), (None, 1, "x")], "doc_id bigint, toxic int, text string"
    )
    out = toxicity.toxicity(d, lab).collect()
    assert len(out) == len(docs)
    by = {r.doc_id: r for r in out}
    assert all(by[i].predicted == int(i % 4 == 0) for i in range(400)) and by[1002].predicted == 1
    assert 0 <= by[None].score < 0.5 and by[1000].score == by[1001].score == by[None].score
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in out if r.doc_id is not None)
    none = toxicity.toxicity(d, lab.limit(0)).collect()
    assert len(none) == len(docs) and {r.predicted for r in none} == {0}
    assert toxicity.toxicity(d.limit(0), lab).collect() == []


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    got = toxicity.query(spark, sf).filter("held_out").join(table(spark, sf, "labels"), "doc_id")
    rows = got.select("score", "predicted", "toxic").collect()
    score, truth = np.array([r.score for r in rows]), np.array([r.toxic for r in rows])
    order = score.argsort(kind="stable").argsort()
    k = truth.sum()
    auc = (order[truth == 1].sum() - k * (k - 1) / 2) / (k * (len(truth) - k))
    assert auc > 0.95, auc
    wrong = np.mean([r.predicted != r.toxic for r in rows])
    assert wrong < 0.03, wrong


def test_learning_ignores_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    flipped = labels.withColumn("toxic", F.when(toxicity.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (sorted(map(tuple, toxicity.toxicity(docs, x).collect())) for x in (labels, flipped))
    assert a == b
