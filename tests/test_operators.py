import hashlib
import random

import pytest
from pyspark.sql import functions as F

from spendlink.operators import dedup, keywords, lookup, priority, products, record
from spendlink.plans import price
from spendlink.plans.price import Settings
from tests import model


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_duplicates_and_ids(spark):
    data = [(i, f"k{i % 3}") for i in range(10)]
    df = spark.createDataFrame(data, "row_id long, key string")
    marked = dedup.mark_duplicates(df)
    assert rows(marked, "row_id", "is_duplicate") == [(i, i >= 3) for i in range(10)]
    assert rows(dedup.surrogate_ids(df), "key", "pim") == [("k0", 0), ("k1", 1), ("k2", 2)]


def test_ids_are_consecutive_in_key_order(spark):
    keys = [f"{random.Random(i).random():.6f}" for i in range(3000)]
    df = spark.createDataFrame([(k,) for k in keys], "key string").repartition(5)
    got = dict(rows(dedup.surrogate_ids(df), "key", "pim"))
    assert got == {k: i for i, k in enumerate(sorted(set(keys)))}


def test_marking_does_not_window_over_the_key(spark):
    df = spark.createDataFrame([(1, "a")], "row_id long, key string")
    assert "Window" not in dedup.mark_duplicates(df)._jdf.queryExecution().executedPlan().toString()


def test_lookup(spark):
    items = spark.createDataFrame([("a",), ("b",), (None,)], "clean_manufacturer string")
    aliases = spark.createDataFrame([("a", "A"), ("c", "C")], "alias string, canonical string")
    got = lookup.canonical_manufacturer(items, aliases)
    assert {r.canonical_manufacturer for r in got.collect()} == {"A", "UNKNOWN"}
    doubled = lookup.enrich_distinct(items, ["clean_manufacturer"], lambda d: d.withColumn("n", F.expr("coalesce(clean_manufacturer, 'none')")))
    assert {r.n for r in doubled.collect()} == {"a", "b", "none"}


def test_class_code_join(spark):
    items = spark.createDataFrame([(0, "x"), (1, "y")], "pim long, item string")
    predictions = spark.createDataFrame([(0, "42")], "pim_key long, first string")
    assert rows(lookup.attach_class_code(items, predictions), "item", "class_code") == [("x", "42")]
    assert lookup.attach_class_code(items, predictions, how="left").count() == 2


def test_keywords(spark):
    df = spark.createDataFrame([("cap of tab cap",), ("nothing",), ("",)], "clean_description string")
    words = spark.createDataFrame([("cap", "capsule"), ("tab", "tablet"), ("of", "capsule")], "keyword string, full_name string")
    got = {r.clean_description: r for r in keywords.tag_keywords(df, words).collect()}
    hit = got["cap of tab cap"]
    assert (hit.dosage, hit.dosage_fullname, hit.tag, hit.keywords) == ("cap", "capsule", "Drug", ["capsule", "tablet"])
    assert (got[""].dosage, got[""].tag, got[""].keywords) == ("", "", [])


@pytest.mark.parametrize("alphabet", ["ab", "abcdefgh é%_'"])
def test_contains_join(spark, alphabet):
    rnd = random.Random(3)
    def text(longest):
        return "".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, longest)))
    needles, names = [text(5) for _ in range(40)], [text(12) for _ in range(80)]
    got = products.contains_join(
        spark.createDataFrame([(n,) for n in needles], "needle string"),
        spark.createDataFrame([(n,) for n in names], "name string"),
    )
    expected = sorted({(a, b) for a in needles for b in names if a and a in b})
    assert rows(got, "needle", "name") == expected


@pytest.mark.parametrize("name_tile, needle_tile", [(1 << 20, 1 << 16), (100, 1 << 16), (100, 10)])
def test_contained_in_tiles(spark, name_tile, needle_tile):
    """Long words and needles, needles of several words and of none, copies, nulls; whatever the tiles."""
    rnd = random.Random(5)
    alphabets = ["ab", "ab é", "a.- ", "語b"]
    def text(longest):
        return "".join(rnd.choice(rnd.choice(alphabets)) for _ in range(rnd.randint(0, longest)))
    names = [text(60) for _ in range(60)] + ["abba" * 40, None, None]
    needles = [text(4) for _ in range(60)] + [n[5:30] for n in names[:30]] + ["abba" * 5, "abba" * 6 + "b", "--", " ", None]
    got = products.contained_in(
        spark.createDataFrame([(n,) for n in needles * 2], "needle string"),
        spark.createDataFrame([(n,) for n in names * 2], "name string"), name_tile, needle_tile,
    ).collect()
    expected = {
        hashlib.md5(b.encode()).digest(): sorted({a for a in needles if a and a in b}) for b in names if b
    }
    assert len(got) == len({bytes(r.digest) for r in got})
    assert {bytes(r.digest): sorted(r.needles) for r in got} == {d: found for d, found in expected.items() if found}


def test_contained_in_makes_no_row_per_gram(spark):
    texts = spark.createDataFrame([("word " * 50 + str(n),) for n in range(50)], "name string")
    needles = spark.createDataFrame([("word",), ("4",)], "needle string")
    found = products.contained_in(needles, texts)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate explode(concat" not in plan and "array_distinct" not in plan
    assert found.selectExpr("sum(size(needles))").first()[0] == 50 + 14


PRODUCTS = "id long, proprietaryname string, dosageformname string, packagedescription string, productndc string, nonproprietaryname string, labelername string"
ANIMAL = "id long, proprietaryname string, ndc string, nonproprietaryname string, labelername string"


def test_product_cascade(spark):
    human = spark.createDataFrame(
        [(1, "Aspirin Plus", "TABLET", "10", "n1", "acid", "L1"), (2, "Other", None, "20", "n2", "aspirin", "L2")], PRODUCTS
    )
    animal = spark.createDataFrame(
        [(1, "Vet A", "a1", "dogol base", "V"), (2, "Dogol", "a2", "x", "V"), (3, "Aspirin Vet", "a3", "x", "V")], ANIMAL
    )
    items = spark.createDataFrame(
        [(1, "Aspirin other 20", "aspirin", "Drug"), (2, "dogol 5", "dogol", "Drug"), (3, "none", "none", "Drug"),
         (4, "aspirin", "aspirin", ""), (5, ". x", "", "Drug"), (6, "it's | a # b ! c", "base", "Drug")],
        "row_id long, item_description string, drug_name string, tag string",
    )
    got = {r.row_id: r for r in products.attach_products(items, human, animal).collect()}
    texts = {1: "Aspirin Plus|TABLET|10|n1|acid|L1", 2: "Other|None|20|n2|aspirin|L2"}
    best = max(texts, key=lambda i: model.score(model.fuzzy_form("Aspirin other 20"), model.fuzzy_form(texts[i]), 0))
    assert got[1].ndc == f"n{best}"
    assert got[1].ndc_accuracy == model.score(model.fuzzy_form("Aspirin other 20"), model.fuzzy_form(texts[best]), 0)
    assert (got[2].proprietary_name, got[2].ndc, got[2].ndc_accuracy) == ("Dogol", "a2", None)
    assert (got[6].proprietary_name, got[6].ndc) == ("Vet A", "a1")
    assert [got[i].ndc for i in (3, 4, 5)] == [None] * 3
    without_id = products.attach_products(items, human.drop("id"), animal.drop("id"))
    assert {r.row_id: r.ndc for r in without_id.collect()} == {i: r.ndc for i, r in got.items()}


PRIORITY = "item_description string, clean_description string, processed_clean_desc string, row_no long"


def test_priority(spark):
    listed = spark.createDataFrame(
        [("First A", "alpha beta", "alpha beta", 1), ("Second A", "alpha beta", "alpha beta", 2), ("G", "gamma", "gamma", 3)], PRIORITY
    )
    items = spark.createDataFrame([(1, "Beta, Alpha!", ""), (2, "unrelated", ""), (3, "gamma", "x")], "row_id long, item_description string, tag string")
    for scorer in ("FUZZY", "FAST_FUZZY"):
        got = rows(priority.match_priority(items, listed, scorer=scorer, cutoff=80), "row_id", "tag", "priority_flag", "priority_desc")
        assert got == [(1, "Drug", True, "First A"), (2, "", False, None), (3, "x", True, "G")]


STATS = ["totalnumberofunitspurchased", "minprice", "maxprice", "avgprice", "stdevprice", "percentile25thprice",
         "percentile50thprice", "percentile75thprice", "percentile99thprice"]


def price_frame(spark, data):
    columns = [f"{c}{side} double" for side in ("po", "invoice") for c in STATS]
    schema = "id long, proddesc string, uom string, totalnumberoforders long, " + ", ".join(columns)
    return spark.createDataFrame([(i, d, "EA", 1, *po, *invoice) for i, d, po, invoice in data], schema)


def test_invoice_before_order(spark):
    po, none = tuple(float(n) for n in range(9)), (None,) * 9
    got = {r.id: r for r in record.effective_prices(price_frame(spark, [(1, "a", po, none), (2, "b", po, (9.0,) * 9)])).collect()}
    assert (got[1].min_price, got[1].p99_price, got[1].stddev_price) == (1.0, 8.0, 0.0)
    assert (got[2].min_price, got[2].stddev_price) == (9.0, 9.0)


def test_top_five_counts_copies_once(spark):
    """Five slots are filled before copies of a description are merged; texts with delimiters survive."""
    items = spark.createDataFrame([("a|b#c!d", "7")], "item_description string, class_code string")
    data = [(i, "A b c d" if i < 4 else f"a|b#c!d {i}") for i in range(1, 8)]
    catalogue = spark.createDataFrame([(i, 7, d, d) for i, d in data], "id long, unspscclasscode int, proddesc string, prodcleandesc string")
    prices = price_frame(spark, [(i, d, (1.0,) * 9, (None,) * 9) for i, d in data])
    got = price.match_by_class_code(items, catalogue, prices, Settings(50, only_top=False))
    assert rows(got, "matched_item", "rank") == [("A b c d", 1), ("a|b#c!d 4", 4), ("a|b#c!d 5", 5)]
    fast = price.match_by_class_code(items, catalogue, prices, Settings(0, "FAST_FUZZY", only_top=False))
    assert fast.count() == 5


def test_unmatched_items_and_missing_records_stay(spark):
    items = spark.createDataFrame([("x y", "7"), ("x y", "8"), ("x y", None), ("x y", "junk")], "item_description string, class_code string")
    catalogue = spark.createDataFrame([(1, 7, "y x", "x y")], "id long, unspscclasscode int, proddesc string, prodcleandesc string")
    got = price.match_by_class_code(items, catalogue, price_frame(spark, [(99, "other", (1.0,) * 9, (1.0,) * 9)]), Settings(50))
    found = {r.class_code: (r.accuracy, r.matched_item) for r in got.collect()}
    assert found == {"7": (100.0, None), "8": (None, None), None: (None, None), "junk": (None, None)}


def test_exact_case_option(spark):
    items = spark.createDataFrame([("x", "Acme")], "item_description string, canonical_manufacturer string")
    catalogue = spark.createDataFrame([(1, "ACME", "x", "x")], "id long, mfrcanonicalname string, proddesc string, prodcleandesc string")
    prices = price_frame(spark, [(1, "x", (1.0,) * 9, (1.0,) * 9)])
    assert price.price_by_manufacturer(items, catalogue, prices, Settings(50)).head().accuracy == 100.0
    assert price.price_by_manufacturer(items, catalogue, prices, Settings(50), exact_case=True).head().accuracy is None


def test_unknown_manufacturer_matches_nothing(spark):
    items = spark.createDataFrame([("x", "UNKNOWN")], "item_description string, canonical_manufacturer string")
    catalogue = spark.createDataFrame([(1, "Unknown", "x", "x")], "id long, mfrcanonicalname string, proddesc string, prodcleandesc string")
    prices = price_frame(spark, [(1, "x", (1.0,) * 9, (1.0,) * 9)])
    assert price.price_by_manufacturer(items, catalogue, prices, Settings(0)).head().accuracy is None


def test_a_hot_key_is_split_by_the_engine(spark):
    """A third of the rows share one key: the join back is a skew join, not one long task."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "64",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        many = spark.range(0, 60000, 1, 8).selectExpr("if(id % 3 = 0, 'hot', CAST(id AS STRING)) AS k", "sha2(CAST(id AS STRING), 256) AS pad")
        extra = many.select("k").distinct().withColumn("n", F.length("k"))
        joined = lookup.left_attach(many, extra, ["k"])
        assert len(joined.collect()) == 60000
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_settings_reach_the_match(spark):
    """Both forms normalised on request, exact manufacturer names in routed modes, one record per id."""
    spend = spark.createDataFrame(
        [(1, "beta, ALPHA", "Acme", 2.0, "A", 5.0, 10.0, "EA"), (1, "beta, ALPHA", "Acme", 3.0, "B", 6.0, 18.0, "BX")],
        "id long, itemdesc string, mfrcanonicalname string, quantity double, manufacturer string, pricepaid double, totalspend double, uom string",
    )
    items = spark.createDataFrame([("alpha beta", "", "Acme")], "item_description string, drug_name string, canonical_manufacturer string")
    plain = price.match_new_spend(items, spend, Settings(1, "FAST_FUZZY")).collect()
    both = price.match_new_spend(items, spend, Settings(1, "FAST_FUZZY", both_forms=True)).collect()
    assert len(plain) == len(both) == 1 and plain[0].accuracy < 100 == both[0].accuracy and both[0].quantity == 2.0
    assert price.match_new_spend(items, spend, Settings(1, exact_case=True)).head().accuracy is None


def test_unclassified_items_stay_on_request(spark):
    items = spark.createDataFrame([(1, "a"), (2, "b")], "pim long, item_description string")
    predictions = spark.createDataFrame([(1, "7")], "pim_key long, first string")
    assert [tuple(r) for r in lookup.attach_class_code(items, predictions).collect()] == [(1, "a", "7")]
    assert sorted(tuple(r) for r in lookup.attach_class_code(items, predictions, "left").collect()) == [(1, "a", "7"), (2, "b", None)]
