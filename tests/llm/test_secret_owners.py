"""Opaque values of few owners, in the registered query and the pipeline's stage."""

import corpus_pipeline
from spendlink.llm.queries import QUERIES
from tests.llm.test_secrets import OPAQUE, SHARED

COPIED = "Qw8Er7Ty6Ui5Op4As3Df2Gh1Jk0Lz9Xc8Vb7"
ROWS = [
    (1, f"first {OPAQUE}", "a"), (2, f"second {OPAQUE}", "b"),  # two owners: no example
    *((10 + i, f"{SHARED} in text {i}", f"s{i}") for i in range(3)),  # three owners: an example
    *((20 + i, f"copied {COPIED}", f"s{i}") for i in range(4)),  # one text, copied into four sources
    *((30 + i, f"token=onetext{COPIED[::-1]}", f"s{i}") for i in range(4)),
]


def test_few_owners(spark, tmp_path):
    docs = spark.createDataFrame(ROWS, "doc_id bigint, text string, source string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    out = {r.doc_id: r for r in QUERIES["op9_secret_scan"](spark, str(tmp_path)).collect()}
    assert {i for i, r in out.items() if r.n_opaque} == {1, 2, 20, 21, 22, 23}
    assert all(r.n_example == 0 for r in out.values())
    texts = {r.doc_id: r.text for r in corpus_pipeline.mask_secrets(spark, spark.read.parquet(f"{tmp_path}/documents.parquet"), "").collect()}
    assert texts[1] == "first <secret:opaque>" and texts[2] == "second <secret:opaque>" and texts[20] == "copied <secret:opaque>"
    assert texts[10] == f"{SHARED} in text 0"
