"""Every registered query against its SQL counterpart in DuckDB, on the smallest tables."""

import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection


def plain(value):
    if isinstance(value, float) and value.is_integer():
        return str(int(value))
    return repr(value) if isinstance(value, float) else str(value)


def listed(rows):
    return sorted(tuple(plain(v) for v in row) for row in rows)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, duck, name):
    df = queries()[name](spark, SF_DIR)
    columns = sorted(df.columns)
    got = listed(df.select(*(f"`{c}`" for c in columns)).collect())
    if name not in oracle_sql():
        assert got
        return
    cursor = duck.execute(oracle_sql()[name])
    order = [d[0] for d in cursor.description]
    assert sorted(order) == columns
    at = [order.index(c) for c in columns]
    assert got == listed([row[i] for i in at] for row in cursor.fetchall())


def test_entry(spark):
    df = entry(spark)
    assert df.count() > 0 and "accuracy" in df.columns


def test_long_texts_against_brute_force(spark):
    """The query without a SQL counterpart, on its own small tables."""
    from tests import model

    rows = queries()["m03_lcs_ratio_long_texts"](spark, SF_DIR).collect()
    passages = spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()
    turns = spark.read.parquet(f"{SF_DIR}/conversations.parquet").collect()
    candidates = [(0, p.item_id, model.fuzzy_form(p.text)) for p in passages]
    # Dynamic programming is slow: only lengths that can reach the cutoff are scored.
    expected = set()
    for text in {model.fuzzy_form(t.text) for t in turns}:
        near = [c for c in candidates if 200 * min(len(text), len(c[2])) / max(1, len(text) + len(c[2])) >= 59]
        expected |= {(text, i, s) for _, _, i, s, _ in model.best({(0, text)}, near, 60, 1, 0)}
    assert {(r.text, r.cand_id, r.score) for r in rows} == expected
