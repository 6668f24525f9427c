"""Files are split otherwise at each read, as on a cluster whose cores come and go."""

import pytest

import corpus_pipeline
from spendlink.llm import common, decontaminate, jaccard, secrets, suffixes
from spendlink.sources import shared
from tests.llm import test_decontaminate, test_secrets, test_suffixes

KEYS = ("spark.sql.files.minPartitionNum", "spark.sql.files.openCostInBytes")


@pytest.fixture
def resplit(spark, monkeypatch, tmp_path):
    """A function that writes rows to files; each intermediate table written later changes how they are split."""
    written = []

    def materialize(df, name):
        out = shared.materialize(df, name)
        written.append(name)
        spark.conf.set(KEYS[0], str(1 + 6 * (len(written) % 2)))
        return out

    for module in (common, decontaminate, jaccard, secrets, suffixes, corpus_pipeline):
        monkeypatch.setattr(module, "materialize", materialize, raising=False)
    spark.conf.set(KEYS[0], "1")
    spark.conf.set(KEYS[1], "1")

    def write(rows, schema, name="documents"):
        spark.createDataFrame(rows, schema).repartition(5).write.parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path), spark.read.parquet(f"{tmp_path}/{name}.parquet")

    yield write
    for key in KEYS:
        spark.conf.unset(key)


def test_suffixes_of_rows(resplit):
    rows = [(i, f"{i} only here " + "one passage of all, " * 8 + f"end {i}") for i in range(12)]
    _, docs = resplit(rows, "doc_id bigint, text string")
    got = sorted((tuple(r)[:5] for r in suffixes.without_repeats(docs).collect()), key=str)
    assert got == test_suffixes.expected(rows)


def test_masked(resplit):
    rows = [(i, f"key {test_secrets.OPAQUE[i:]}{'xY3' * 4} {i}" if i % 3 else f"plain {i}", f"s{i}") for i in range(12)]
    _, docs = resplit(rows, "doc_id bigint, text string, source string")
    want = {i: f"key <secret:opaque> {i}" if i % 3 and len(t) > 40 else t for i, t, _ in rows}
    got = {r.doc_id: r.text for r in secrets.masked(docs).collect()}
    assert len(got) == len(rows) and sum("<secret:opaque>" in t for t in got.values()) == sum("<secret" in t for t in want.values())


def test_pipeline_stages(spark, resplit):
    same = " ".join(f"w{i}" for i in range(60))
    rows = [(i, same if i in (2, 5, 7) else f"bench {test_decontaminate.A}" if i in (3, 8) else " ".join(f"d{i}x{k}" for k in range(40))) for i in range(12)]
    resplit([(1, test_decontaminate.A)], "item_id bigint, text string", "benchmark")
    sf, docs = resplit(rows, "doc_id bigint, text string")
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, sf).collect()
    assert {r.doc_id for r in kept} == set(range(12)) - {5, 7, 8}
    kept = corpus_pipeline.drop_contaminated(spark, docs, sf).collect()
    assert {r.doc_id for r in kept} == set(range(12)) - {3, 8}


def test_blocks(spark, resplit):
    _, docs = resplit(test_decontaminate.DOCS, "doc_id bigint, text string")
    _, items = resplit(test_decontaminate.ITEMS, "item_id bigint, text string", "benchmark")
    out = decontaminate.contamination(docs, items, block=3).select(*decontaminate.COLUMNS)
    assert sorted(map(tuple, out.collect()), key=str) == test_decontaminate.expected(test_decontaminate.DOCS, test_decontaminate.ITEMS)
