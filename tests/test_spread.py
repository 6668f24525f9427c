import pytest
from pyspark.sql import functions as F

from spendlink.operators import lookup, spread
from spendlink.plans import enrich

KEYS = "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 7 = 0 THEN NULL ELSE concat('k', id % 500) END AS k"


@pytest.fixture
def plain_shuffles(spark):
    """Neither broadcasts by size nor adaptive skew splitting."""
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v)


def sides(spark, n=30_000):
    left = spark.range(n).selectExpr("id", KEYS, "id % 5 AS __salt")
    right = spark.range(0, 600, 2).selectExpr("concat('k', id) AS k", "id AS `a b`").union(spark.sql("SELECT 'hot', -1L UNION ALL SELECT NULL, -2L"))
    return left, right


def as_rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("null_safe", [False, True])
def test_same_rows_as_the_plain_join(plain_shuffles, how, null_safe):
    left, right = sides(plain_shuffles)
    got = spread.spread_join(left, right, ["k"], how, null_safe=null_safe)
    assert got.columns == ["id", "k", "__salt", "a b"]
    other = right.withColumnRenamed("k", "k2")
    same = F.col("k").eqNullSafe(F.col("k2")) if null_safe else F.col("k") == F.col("k2")
    assert as_rows(got) == as_rows(left.join(other, same, how).drop("k2"))


def largest_share(joined):
    parts = [r["count"] for r in joined.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    return max(parts) / sum(parts)


def test_a_third_of_the_rows_is_spread(plain_shuffles):
    left, right = sides(plain_shuffles)
    fans = spread.frequent_keys(left, ["k"])
    sizes = {r.h: r.n for r in left.groupBy(F.xxhash64("k").alias("h")).agg(F.count(F.lit(1)).alias("n")).collect()}
    assert set(fans) == {h for h, n in sizes.items() if n > 30_000 / 8}
    hot = F.col("k") == "hot"
    assert largest_share(left.join(right, "k", "left").filter(hot)) == 1
    joined = spread.spread_join(left, right, ["k"], by=["id"])
    assert largest_share(joined.filter(hot)) < 0.4
    assert largest_share(joined) < 0.33


def test_null_keys_are_spread(plain_shuffles):
    left = plain_shuffles.range(10_000).selectExpr("id", "IF(id % 2 = 0, NULL, concat('k', id)) AS k")
    right = plain_shuffles.createDataFrame([("k1", 1), (None, 2)], "k string, v int")
    got = spread.spread_join(left, right, ["k"])
    assert got.count() == 10_000 and as_rows(got.filter("v IS NOT NULL")) == [(1, "k1", 1)]
    assert largest_share(got) < 0.3


def test_no_frequent_key_is_the_plain_join(plain_shuffles):
    left = plain_shuffles.range(5000).selectExpr("id", "id % 1000 AS k")
    assert spread.frequent_keys(left, ["k"]) == {}
    got = spread.spread_join(left, left.selectExpr("k", "1 AS v").distinct(), ["k"], "inner")
    assert got.count() == 5000 and "salt" not in got._jdf.queryExecution().executedPlan().toString()


def test_repeated_keys_and_rows(plain_shuffles):
    left = plain_shuffles.createDataFrame([("a",)] * 50 + [("b",)], "k string")
    right = plain_shuffles.createDataFrame([("a", 1), ("a", 2), ("c", 3)], "k string, v int")
    assert as_rows(spread.spread_join(left, right, ["k"])) == [("a", 1)] * 50 + [("a", 2)] * 50 + [("b", None)]


def test_empty_sides(spark):
    left, right = sides(spark, 10)
    none = left.limit(0)
    assert spread.frequent_keys(none, ["k"]) == {}
    assert spread.spread_join(none, right, ["k"]).collect() == []
    assert spread.spread_join(left, right.limit(0), ["k"]).count() == 10


def test_refused_arguments(spark):
    left, right = sides(spark, 10)
    with pytest.raises(ValueError, match="not left or inner"):
        spread.spread_join(left, right, ["k"], "outer")
    with pytest.raises(ValueError, match="different types"):
        spread.spread_join(left, right.withColumn("k", F.lit(1)), ["k"])
    with pytest.raises(ValueError, match="floating"):
        spread.frequent_keys(left.withColumn("k", F.lit(1.0)), ["k"])


def test_lookups_with_fans(plain_shuffles):
    spark = plain_shuffles
    items = spark.range(9000).selectExpr(
        "id AS row_id", "'' AS item_description", "'1' AS item_number", "IF(id % 3 > 0, 'Acme Inc', concat('m', id % 900)) AS manufacturer"
    )
    cleaned = enrich.clean_items(items)
    fans = spread.frequent_keys(cleaned, ["clean_manufacturer"])
    aliases = cleaned.filter("row_id < 600").selectExpr("clean_manufacturer AS alias", "upper(clean_manufacturer) AS canonical").distinct()
    wide = lookup.canonical_manufacturer(cleaned, aliases, fans)
    assert fans and largest_share(wide) < 0.3
    plain = lookup.canonical_manufacturer(cleaned, aliases)
    assert set(wide.columns) == set(plain.columns)
    assert as_rows(wide.select(*plain.columns)) == as_rows(plain)
    codes = spark.createDataFrame([(0, "1"), (1, "2")], "pim_key int, first string")
    numbered = spark.range(4000).selectExpr("id", "int(id % 3) AS pim")
    for how in ("inner", "left"):
        wide = lookup.attach_class_code(numbered, codes, how, spread.frequent_keys(numbered, ["pim"]))
        plain = lookup.attach_class_code(numbered, codes, how)
        assert as_rows(wide.select(*plain.columns)) == as_rows(plain)
