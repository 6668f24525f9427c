"""Split CSV files against Spark's one-task reader, with line breaks, quotes and commas in every odd place."""

import random

import pytest

from spendlink.sources import readers, records

HOSTILE = [
    'a,b,c', '"a","b","c"', '"line\nbreak",x,"and\n\n""again"""', 'tube 5", large,3" x 4",y', '"",,""', '"a""b","""","c"', '"quoted" tail,"x"y,z',
    'é\U0001f600,"ü\n\U0001f600",ß', '"comma, and ""quote"", and\r\nbreak",1,2', ",,", '"\n",b,"\n\n"', '" spaced ", x ,y', '"a\n,""b"",\nc",d,"e\n"',
]


def write(path, rows, end="\n", last=True):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes((end.join(rows) + (end if last else "")).encode())


def expected(spark, path, header):
    """Spark's reader of whole files, by file and place."""
    raw = spark.read.schema("c0 string, c1 string, c2 string").options(header=header, multiLine=True, escape='"').csv(path)
    rows = raw.selectExpr("_metadata.file_path AS file", "monotonically_increasing_id() AS n", "*").collect()
    return [tuple(r)[2:] for r in sorted(rows, key=lambda r: (r.file, r.n))]


def found(spark, path, header):
    df = records.read_records(spark, path, header)
    rows = df.select("place", records.parsed(df.record, ["c0", "c1", "c2"]).alias("r")).orderBy("place").collect()
    assert [r.place for r in rows] == list(range(len(rows)))
    return [tuple(r.r) for r in rows]


@pytest.fixture
def small_splits(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "97", "spark.sql.files.openCostInBytes": "1"}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k in keys:
        spark.conf.unset(k)


@pytest.mark.parametrize("end, last, header", [("\n", True, True), ("\n", False, False), ("\r\n", True, True)])
def test_hostile_files(spark, tmp_path, small_splits, end, last, header):
    rnd = random.Random(1)
    rows = [r for r in HOSTILE if "\r" not in r] if end == "\r\n" else HOSTILE
    for name, n in (("b", 120), ("a", 40), ("c", 1)):
        write(tmp_path / "in" / f"{name}.csv", ["h0,h1,h2", *rnd.choices(rows, k=n)], end, last)
    path = str(tmp_path / "in")
    want = expected(spark, path, header)
    assert found(spark, path, header) == want and len(want) > 100
    lines = records._lines(spark, path)
    assert records.splits(lines).count() > 20 and lines.rdd.getNumPartitions() > 20


def test_record_over_many_splits(spark, tmp_path, small_splits):
    """Fields of many lines cover whole splits; one file ends inside a quoted field."""
    field = "\n".join(f"line {i}, with ""quotes"" and commas" for i in range(60)).replace('"', '""')
    write(tmp_path / "in" / "a.csv", ["h,h,h", f'1,"{field}",x', "2,b,c", f'3,"{field}","{field}"', "4,,"])
    path = str(tmp_path / "in")
    want = expected(spark, path, True)
    assert found(spark, path, True) == want and [w[0] for w in want] == ["1", "2", "3", "4"]
    write(tmp_path / "head" / "a.csv", [f'"{field}",h,h', "1,b,c", "2,b,c"])
    assert [r[0] for r in found(spark, str(tmp_path / "head"), True)] == ["1", "2"]
    write(tmp_path / "open" / "a.csv", ["h,h,h", "1,b,c", '2,"never', "closed", "here"])
    assert [r[0] for r in found(spark, str(tmp_path / "open"), True)] == ["1", "2"]


def test_numbers_do_not_depend_on_splits(spark, tmp_path):
    write(tmp_path / "in" / "b.csv", ["h,h,h", *(f'{i},"x\n{i}",' for i in range(300))])
    write(tmp_path / "in" / "a.csv", ["h,h,h", *(f"a{i},," for i in range(50))])
    got = []
    for size in ("64", "1000", "100000"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        got.append(sorted((r.row_id, r.item_description) for r in readers.read_items(spark, str(tmp_path / "in")).collect()))
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got[0] == got[1] == got[2] and [d for _, d in got[0]] == [f"a{i}" for i in range(50)] + [str(i) for i in range(300)]


def test_changed_splits_fail(spark, tmp_path):
    write(tmp_path / "a.csv", ["h", *("x" * 20 for _ in range(30))])
    lines = records._lines(spark, str(tmp_path / "a.csv"))
    with pytest.raises(Exception, match="split otherwise"):
        records.pieces(lines, {}).collect()


def test_empty(spark, tmp_path):
    write(tmp_path / "in" / "a.csv", ["h,h,h"])
    write(tmp_path / "in" / "b.csv", [], last=False)
    assert found(spark, str(tmp_path / "in"), True) == []
    assert readers.read_items(spark, str(tmp_path / "in")).count() == 0
