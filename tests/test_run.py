import contextlib
import csv
import shutil

import pytest

from catalog.fixtures import Inputs
from spendlink import Job, Tables, run
from spendlink.plans.run import AnswerMissing, AnswerStale, enriched_items
from spendlink.sources import manifest, readers, sinks
from spendlink.sources.manifest import CheckpointUnverified
from spendlink.sources.shared import materialize

SMALL = "/root/testdata/sf0.001"


def write_csv(path, rows):
    path.parent.mkdir(parents=True, exist_ok=True)
    with open(path, "w", newline="") as f:
        csv.writer(f).writerows(rows)


@pytest.mark.parametrize(
    "args", [["70", "UNSPSC_CODE", "P", "FULL"], ["70", "X", "P", "FULL", "FUZZY"], ["70", "MANUFACTURER", "P", "HALF", "FUZZY"],
             ["70", "MANUFACTURER", "P", "FULL", "SLOW"], ["a", "MANUFACTURER", "P", "FULL", "FUZZY"]],
)
def test_bad_arguments(args):
    with pytest.raises(ValueError):
        Job.parse(args)


def test_arguments():
    assert Job.parse("60 manufacturer P partial fast_fuzzy".split()) == Job(60, "MANUFACTURER", "P", "PARTIAL", "FAST_FUZZY")
    assert not Job.parse("60 MANUFACTURER P PARTIAL FUZZY false".split()).only_top
    options = Job.parse("60 MANUFACTURER P PARTIAL FUZZY".split(), exact_case=True, both_forms=True)
    assert options.settings.exact_case and options.settings.both_forms and not options.keep_unclassified


def test_result_paths():
    assert sinks.result_path("/o/", "P", 70, "MANUFACTURER") == "/o/P/70_MANUFACTURER_PriceInfo"
    assert sinks.result_path("/o", "P", 50, "NEW_SPEND_INFO") == "/o/P/50_NewPriceInfo"


def test_item_scan(spark, tmp_path):
    header = ["desc", "no", "maker"]
    write_csv(tmp_path / "items" / "a.csv", [header, [" Spaced, \"q\" ", "007", "A"], ["", "", ""]])
    write_csv(tmp_path / "items" / "b.csv", [["other", "names", "here"], ["line\nbreak", "1", "B"]])
    got = readers.read_items(spark, str(tmp_path / "items"))
    assert sorted((r.item_description, r.item_number, r.manufacturer) for r in got.collect()) == [
        ("", "", ""), (' Spaced, "q" ', "007", "A"), ("line\nbreak", "1", "B")]
    assert got.select("row_id").distinct().count() == 3
    assert {r[0].rsplit("/", 1)[1] for r in got.select("source_file").distinct().collect()} == {"a.csv", "b.csv"}


def test_sheets(spark, tmp_path):
    write_csv(tmp_path / "alias.csv", [["c", "n", "1", "2", "3"], ["A", 2, "a", "aa", "x"], ["B", 1, "a", "", ""], ["C", 0, "c", "", ""]])
    assert sorted(map(tuple, readers.read_alias_map(spark, str(tmp_path / "alias.csv")).collect())) == [("a", "B"), ("aa", "A")]
    write_csv(tmp_path / "kw.csv", [["TAB", "Tablet"], ["cap", "Capsule"], ["tab", "Second"]])
    assert sorted(map(tuple, readers.read_keyword_map(spark, str(tmp_path / "kw.csv")).collect())) == [("cap", "capsule"), ("tab", "second")]
    header = ["Item Description", "Clean Description", "processed clean desc", *"defghi", "tenth"]
    write_csv(tmp_path / "p.csv", [header, ["I", "C", "P", *"123456", "no"]])
    got = readers.read_priority_list(spark, str(tmp_path / "p.csv")).collect()
    assert [(r.item_description, r.clean_description, r.processed_clean_desc) for r in got] == [("I", "C", "P")]


def test_last_file_wins(spark, tmp_path):
    """Files count in the order of their names, also where a later one is larger and read first."""
    more = [[f"w{i}", f"word {i}"] for i in range(3000)]
    write_csv(tmp_path / "kw" / "a.csv", [["tab", "first"]])
    write_csv(tmp_path / "kw" / "b.csv", [["tab", "second"], *more])
    pairs = dict(map(tuple, readers.read_keyword_map(spark, str(tmp_path / "kw")).collect()))
    assert pairs["tab"] == "second" and len(pairs) == 3001
    header = ["canonical", "n", "alias"]
    write_csv(tmp_path / "alias" / "a.csv", [header, ["A", 1, "x"]])
    write_csv(tmp_path / "alias" / "b.csv", [header, ["B", 1, "x"], *([f"C{i}", 1, f"y{i}"] for i in range(3000))])
    assert dict(map(tuple, readers.read_alias_map(spark, str(tmp_path / "alias")).collect()))["x"] == "B"


def test_jdbc_options_reach_the_reader(spark):
    with pytest.raises(Exception, match="(?i)driver|jdbc"):
        readers.read_table(spark, "t", fmt="jdbc", url="jdbc:none:x", driver="no.such.Driver")


@pytest.fixture(scope="module")
def data(spark, tmp_path_factory):
    """A data folder in the layout of a real run, from the small given tables."""
    root = tmp_path_factory.mktemp("data")
    t = Inputs(spark, SMALL)
    sinks.write(t.items.select("item_description", "item_number", "manufacturer"), str(root / "items"), "csv")
    sinks.write(t.alias_sheet.coalesce(1), str(root / "alias_map.csv"), "csv")
    t.keyword_sheet.coalesce(1).write.csv(str(root / "keyword_map.csv"))
    sinks.write(t.priority_sheet.drop("p_partkey").coalesce(1), str(root / "priority_list.csv"), "csv")
    for name, df in {
        "product_package": t.human, "animal_product": t.animal, "unique_products_unspsc": t.class_products,
        "unique_products": t.maker_products, "price_info": t.prices, "price_info_new": t.new_spend,
    }.items():
        df.write.parquet(str(root / f"{name}.parquet"))
    return str(root)


PREDICTED = (
    "PIM_KEY AS pim_key", "COMPANY_NAME AS company_name", "PART_NUMBER AS part_number", "PRODUCT_DESCRIPTION AS description",
    """'a, "b" c' AS data_set""", "CAST(1 + PIM_KEY % 50 AS STRING) AS first", "'' AS secondCategory", "'' AS thirdCategory",
    "0.5 AS `1stProb`", "0.2 AS `2ndProb`", "0.1 AS `3rdProb`",
)


def answer(spark, request, data, columns=PREDICTED):
    """The external classifier: reads the request, writes its answer beside the inputs."""
    asked = spark.read.options(header=True, multiLine=True, escape='"').csv(request)
    sinks.write(asked.selectExpr(*columns), f"{data}/predictions.csv", "csv")


def test_request_then_answer(spark, data, tmp_path):
    job, tables, output = Job(70, "UNSPSC_CODE", "P", "FULL", "FUZZY"), Tables(spark, data), str(tmp_path / "out")
    request = f"{output}/P/classifier_request"
    with pytest.raises(AnswerMissing):
        run(spark, job, tables, output)
    answer(spark, request, data, [c.replace("PART_NUMBER", "concat(PART_NUMBER, 'x')") for c in PREDICTED])
    with pytest.raises(AnswerStale):
        run(spark, job, tables, output)
    answer(spark, request, data)
    assert spark.read.parquet(run(spark, job, tables, output)).count() == Inputs(spark, SMALL).items.count()


def test_hostile_sheets(spark, tmp_path):
    write_csv(tmp_path / "alias.csv", [["canonical", "n", "alias"], ["A", "3", "a", "a \"q\", b", "line\nbreak"], ["B", "1", "b", "no"]])
    got = sorted(map(tuple, readers.read_alias_map(spark, str(tmp_path / "alias.csv")).collect()))
    assert got == [("a", "A"), ('a "q", b', "A"), ("b", "B"), ("line\nbreak", "A")]
    write_csv(tmp_path / "kw.csv", [["tab", 'say "x", y\nz']])
    assert readers.read_keyword_map(spark, str(tmp_path / "kw.csv")).first().full_name == 'say "x", y\nz'
    row = ["7", "co", "p", 'tube 5", large\nsize', "d", "42142500", "", "", "0.9", "0.1", "0"]
    write_csv(tmp_path / "p.csv", [["h"] * 11, row])
    read = readers.read_predictions(spark, str(tmp_path / "p.csv")).first()
    assert (read.pim_key, read.description, read.first) == (7, 'tube 5", large\nsize', "42142500")


def test_full_then_partial(spark, data, tmp_path):
    tables, output = Tables(spark, data), str(tmp_path / "out")
    full = run(spark, Job(70, "UNSPSC_CODE", "P", "FULL", "FUZZY"), tables, output)
    assert full.endswith("/out/P/70_UNSPSC_CODE_PriceInfo")
    rows = spark.read.parquet(full)
    assert rows.count() == Inputs(spark, SMALL).items.count()
    assert rows.filter("accuracy >= 70").count() > 0 and rows.filter("accuracy < 70").count() == 0
    partial = run(spark, Job(60, "MANUFACTURER", "P", "PARTIAL", "FAST_FUZZY", False), tables, output, "csv")
    assert spark.read.option("header", True).csv(partial).count() >= rows.count()
    new = run(spark, Job(50, "NEW_SPEND_INFO", "P", "PARTIAL", "FUZZY"), tables, output)
    assert new.endswith("/out/P/50_NewPriceInfo")
    assert spark.read.parquet(new).filter("accuracy is not null").count() > 0


def test_checkpoint_round_trip(spark, data, tmp_path):
    job = Job(70, "UNSPSC_CODE", "P", "FULL", "FUZZY")
    items = enriched_items(spark, job, Tables(spark, data), str(tmp_path / "cleaned"))
    columnar = sorted(map(tuple, items.collect()), key=str)
    sinks.write_checkpoint(items, str(tmp_path / "csv"), "csv")
    assert sorted(map(tuple, readers.read_checkpoint(spark, str(tmp_path / "csv"), "csv").collect()), key=str) == columnar


def test_partial_needs_a_whole_checkpoint(spark, data, tmp_path):
    """No checkpoint, a foreign one, an incomplete one, and one made from other inputs fail; the right one passes."""
    inputs, output = tmp_path / "data", str(tmp_path / "out")
    shutil.copytree(data, inputs)
    tables, checkpoint = Tables(spark, str(inputs)), f"{output}/P/cleaned"
    partial = Job(70, "UNSPSC_CODE", "P", "PARTIAL", "FUZZY")
    with pytest.raises(CheckpointUnverified, match="no checkpoint"):
        enriched_items(spark, partial, tables, checkpoint)
    request = f"{output}/P/classifier_request"
    with contextlib.suppress(AnswerMissing, AnswerStale):
        enriched_items(spark, Job(70, "UNSPSC_CODE", "P", "FULL", "FUZZY"), tables, checkpoint)
    answer(spark, request, str(inputs))
    full = enriched_items(spark, Job(70, "UNSPSC_CODE", "P", "FULL", "FUZZY"), tables, checkpoint)
    assert enriched_items(spark, partial, tables, checkpoint).count() == full.count() > 0
    rows = materialize(full.limit(5), "foreign")
    foreign = f"{output}/Q/cleaned"
    sinks.write_checkpoint(rows, foreign)
    with pytest.raises(CheckpointUnverified, match="no manifest"):
        enriched_items(spark, partial, tables, foreign)
    manifest.begin(spark, foreign)
    with pytest.raises(CheckpointUnverified, match="to its end"):
        enriched_items(spark, partial, tables, foreign)
    manifest.complete(spark, foreign, full, {})
    with pytest.raises(CheckpointUnverified, match="not the one"):
        enriched_items(spark, partial, tables, foreign)
    write_csv(inputs / "alias_map.csv" / "later.csv", [["c", "n", "1"], ["New", 1, "new"]])
    with pytest.raises(CheckpointUnverified, match="alias_map"):
        enriched_items(spark, partial, tables, checkpoint)
