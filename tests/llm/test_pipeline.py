"""The pipeline against brute force, stage by stage."""

import numpy as np

import corpus_pipeline
from spendlink.llm import bpe, toxicity
from spendlink.llm.common import table
from tests.llm import test_bpe, test_decontaminate, test_jaccard, test_secrets

SF = "/root/testdata/sf0.001"


def write(spark, tmp_path, **tables):
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def after(spark, tmp_path, docs, name, stage, sf_dir):
    out = stage(spark, docs, sf_dir)
    assert out.columns == docs.columns
    path = f"{tmp_path}/{name}"
    out.write.parquet(path)
    return spark.read.parquet(path)


def listed(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=str)


def test_stages(spark, tmp_path):
    docs = table(spark, SF, "documents")
    stages = dict(corpus_pipeline.STAGES)

    machine = toxicity.train(docs, table(spark, SF, "labels"), ~toxicity.held_out())
    terms = toxicity.Terms()
    want = [(i, t) for i, t in listed(docs) if machine.score(terms.of_text((t or "").encode())) < 0.5]
    docs = after(spark, tmp_path, docs, "a", stages["toxicity"], SF)
    assert listed(docs) == sorted(want, key=str)

    classes = {i: c for i, c, _ in test_jaccard.expected(want)}
    want = [(i, t) for i, t in want if classes[i] == i]
    docs = after(spark, tmp_path, docs, "b", stages["near_duplicates"], SF)
    assert listed(docs) == sorted(want, key=str)

    items = [tuple(r) for r in table(spark, SF, "benchmark").select("item_id", "text").collect()]
    hit = {r[0] for r in test_decontaminate.expected(want, items) if r[5]}
    want = [(i, t) for i, t in want if i not in hit]
    docs = after(spark, tmp_path, docs, "c", stages["decontamination"], SF)
    assert listed(docs) == sorted(want, key=str) and hit

    masked = after(spark, tmp_path, docs, "d", stages["secrets"], SF)
    before = dict(want)
    for i, t in listed(masked):
        assert (t == before[i]) == (not test_secrets.base(before[i]))

    codec = bpe.Codec(bpe.read_vocabulary(bpe.default_path())[0])
    out = stages["tokens"](spark, masked, SF).collect()
    texts = dict(listed(masked))
    assert len(out) == len(texts)
    for r in out:
        assert r.decodes and r.n_tokens == len(r.ids)
        assert codec.decode(np.array(r.ids, "<u4").tobytes()) == texts[r.doc_id]


def test_run(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    assert rows and len({r.doc_id for r in rows}) == len(rows) and all(r.decodes for r in rows)


def test_odd_rows_and_empty(spark, tmp_path):
    words = " ".join(f"w{i}" for i in range(60))
    rows = [
        (None, None, None, 1, "x"), (1, "", "en", 2, "x"), (2, words, "en", 3, "x"), (2, words, "en", 3, "x"), (3, words.upper(), None, 4, None),
        (4, "token=abcdefgh", "en", 5, "y"), (5, "bench " + " ".join(f"b{i}" for i in range(12)), "en", 6, "y"), (6, "z " * 40000, "de", 7, ""),
    ]
    schema = "doc_id bigint, text string, lang string, row int, source string"
    sf = write(
        spark, tmp_path, documents=(rows, schema), labels=([], "doc_id bigint, quality int, toxic int"),
        benchmark=([(1, " ".join(f"b{i}" for i in range(12)))], "item_id bigint, text string"),
    )
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, sf).collect()}
    assert set(got) == {None, 1, 2, 4, 6} and all(r.decodes for r in got.values())
    assert len(corpus_pipeline.run(spark, sf).collect()) == 5
    none = write(spark, tmp_path / "none", documents=([], schema), labels=([], "doc_id bigint, toxic int"), benchmark=([], "item_id bigint, text string"))
    assert corpus_pipeline.run(spark, none).collect() == []
