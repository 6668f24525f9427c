import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from spendlink.functions import clean, concepts, normalize, similarity, tags
from spendlink.functions.similarity import Texts, lcs_bound, lcs_lengths
from spendlink.operators.lookup import concept_answers
from tests import model

letters = st.text(alphabet="abcdé語 _-\U0001f600", max_size=90)


def apply(spark, values, function):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, c string")
    return [r[0] for r in df.select(function(F.col("c")).alias("o"), "i").orderBy("i").collect()]


@pytest.mark.parametrize(
    "raw, expected",
    [
        ("acme inc llc", "acme"),
        ("acme llc inc", "acme llc"),
        ("acme co incorporated", "acme co"),
        ("Acme,  Inc.", "acme"),
        ("inc", "inc"),
        ("acme t/t", "acme"),
        ("acme corp usa", "acme"),
        ("acme i", "acme"),
        ("@Acme.Co", "acmeco"),
    ],
)
def test_manufacturer(spark, raw, expected):
    assert apply(spark, [raw], clean.clean_manufacturer) == [expected]


def test_clean_scalars(spark):
    assert apply(spark, [" A@b C ", "", None], clean.clean_description) == ["ab c", "", None]
    assert apply(spark, ["000", "", " 007 ", "a0", "0x", "00a"], clean.clean_item_number) == ["0", "", "7", "a0", "x", "a"]
    assert apply(spark, ["aspirin, 50 mg", ".x", "a\tb c", "", " b"], clean.first_token) == ["aspirin", "x", "a", "", ""]
    assert apply(spark, ["aspirin, 50 mg", "one", "a\tb c"], clean.after_first_token) == ["50 mg", None, "b c"]


def test_composite_key_keeps_missing_parts(spark):
    df = spark.createDataFrame([("1", None, "a  b\tc")], "n string, m string, d string")
    assert df.select(clean.composite_key(F.col("n"), F.col("m"), F.col("d"))).head()[0] == "1##a_b_c"


HOSTILE = [
    "b_a B|a#c!d", "Zeta álpha  Éa", "tab\tsep a", "日本 語 a_b", "don’t — stop", "", "  ", "x'%y", "a.b,c", "ßtraße œuvre",
    " a b", "naïve_x  1½ ²",
]


def test_text_forms_equal_the_model(spark):
    assert apply(spark, HOSTILE, normalize.fast_form) == [model.fast_form(t) for t in HOSTILE]
    assert apply(spark, HOSTILE, normalize.fuzzy_form) == [model.fuzzy_form(t) for t in HOSTILE]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(letters, letters), min_size=1, max_size=12))
def test_kernel_equals_dynamic_programming(pairs):
    a, b = (Texts(pa.array(side, pa.string())) for side in zip(*pairs))
    i = np.arange(len(pairs))
    true = np.array([model.lcs(x, y) for x, y in pairs])
    assert (lcs_lengths(a, b, i, i) == true).all()
    assert (lcs_lengths(b, a, i, i) == true).all()
    assert (lcs_bound(a, b, i, i) >= true).all()


@pytest.mark.parametrize("size", [0, 1, 63, 64, 65, 127, 128, 129, 700])
def test_kernel_at_word_borders(size):
    a, b = "ab" * size, "ba" * size + "c"
    ta, tb = Texts(pa.array([a[:size]])), Texts(pa.array([b[:size]]))
    one = np.zeros(1, dtype=int)
    assert lcs_lengths(ta, tb, one, one)[0] == model.lcs(a[:size], b[:size])


def test_scores(spark):
    rows = [("a b", "b a", 100.0), ("", "", 100.0), ("", "x", 0.0), (None, "x", None), ("abcd", "abxd", 75.0)]
    # 40 + 40 characters with 23 in common: 57.5 in the reals, just below it in doubles.
    rows.append(("a" * 23 + "b" * 17, "a" * 23 + "c" * 17, 57.0))
    df = spark.createDataFrame([(i, a, b) for i, (a, b, _) in enumerate(rows)], "i int, a string, b string")
    got = df.select("i", similarity.fuzzy_score(F.col("a"), F.col("b")).alias("s")).orderBy("i").collect()
    assert [r.s for r in got] == [s for _, _, s in rows]
    fast = spark.createDataFrame([("B, a", "a b"), ("B a", "B a")], "a string, b string")
    got = fast.select(similarity.fast_score(F.col("a"), F.col("b")).alias("s")).collect()
    assert [r.s for r in got] == [100.0, model.score("a b", "B a", 2)]


def test_tags(spark):
    df = spark.createDataFrame([("", True), ("", False), ("x", True)], "tag string, hit boolean")
    assert [r[0] for r in df.select(tags.promote_if(F.col("tag"), F.col("hit"))).collect()] == ["Drug", "", "x"]
    df = spark.createDataFrame([("", ["b", "a"]), ("t", []), ("t", ["a"]), ("", [])], "tag string, new array<string>")
    assert [r[0] for r in df.select(tags.merge_tags(F.col("tag"), F.col("new"))).collect()] == ["a,b", "t", "t,a", ""]


XML = """<?xml version="1.0"?><r><allRelatedGroup>
<conceptGroup><tty>BN</tty><conceptProperties><name> Brand </name></conceptProperties>
<conceptProperties><name>Second</name></conceptProperties></conceptGroup>
<conceptGroup><tty>IN</tty><conceptProperties><name>Ingredient</name><inferedhuman>US</inferedhuman>
<inferedvet>XX</inferedvet></conceptProperties></conceptGroup>
<conceptGroup><tty>SCD</tty><conceptProperties><name>No</name><inferedvet>US</inferedvet></conceptProperties></conceptGroup>
</allRelatedGroup></r>"""


def test_concept_answers(spark):
    assert apply(spark, ['[{"code":"1"},{"code":"2"}]', "[]", "[{}]", "junk", None], concepts.first_code) == ["1", "", "", "", ""]
    info = apply(spark, [XML, XML[:-5], "", "<r/>", None], concepts.concept_info)
    assert info[0] == ([" Brand ", "Second"], ["Ingredient"], ["Human_Drug"])
    assert all(i == ([], [], []) for i in info[1:])


def test_an_answer_is_parsed_once_by_one_of_many_tasks(spark):
    answers = spark.createDataFrame([(f"C{n}", XML) for n in range(64)], "concept_code string, response string").coalesce(1)
    infos = concept_answers(answers)
    fields = infos.select("concept_code", "info.*", F.spark_partition_id().alias("task"))
    assert fields._jdf.queryExecution().executedPlan().toString().count("from_xml") == 1
    rows = fields.collect()
    assert len({r.concept_code for r in rows}) == 64 and len({r.task for r in rows}) == 8
    assert all(r.brand_names == [" Brand ", "Second"] and r.species_tags == ["Human_Drug"] for r in rows)
