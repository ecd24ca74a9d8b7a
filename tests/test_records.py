"""CSV records with line breaks in quoted cells, over several splits of a file."""

import csv
import datetime as dt
import io

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyspark.sources import feeds, landing
from tallyspark.sources.contracts import ColumnRule, FeedContract
from tallyspark.sources.records import ends_inside, stays_inside
from tallyspark.sources.store import TableStore
from tests.conftest import rows

CONTRACT = FeedContract("notes", "REF", "*.csv", "raw_notes", ("id",), (ColumnRule("id", "integer"), ColumnRule("note", "string", nullable=True), ColumnRule("tail", "string", nullable=True)))


def walked(line, inside):
    """Where a line ends, one character at a time."""
    fresh, i = not inside, 0
    while i < len(line):
        c = line[i]
        if inside and c == '"':
            if line[i + 1 : i + 2] == '"':
                i += 1
            else:
                inside = False
        elif not inside and c == '"' and fresh:
            inside = True
        fresh = not inside and c == ","
        i += 1
    return inside


def test_line_functions(spark):
    lines = ["", "a,b", '"a",b', 'a,"b', 'b",c', '5" disk,x', '"a ""q"" b",c', '"",""', 'x,"', '"x', '","', '",",', '"a"b,"c', 'x""y', 'a","b', '""', '"""', ',"""']
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    got = {r.value: (r.o, r.i) for r in df.select("value", ends_inside(F.col("value")).alias("o"), stays_inside(F.col("value")).alias("i")).collect()}
    assert got == {x: (walked(x, False), walked(x, True)) for x in lines}


@pytest.fixture
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def write(folder, name, table, end="\n"):
    out = io.StringIO()
    csv.writer(out, lineterminator=end).writerows([["id", "note", "tail"], *table])
    folder.mkdir(exist_ok=True)
    (folder / name).write_bytes(out.getvalue().encode())


def cells(i):
    return [str(i), ["plain", 'two\nlines, and "quotes"', "\n", "a\n\n\nb" * (i % 5), '5" disk', "ü,\n日"][i % 6], ["end", "", "x\ny"][i % 3]]


def test_a_file_over_many_splits(spark, tmp_path, small_splits):
    table = [cells(i) for i in range(200)]
    write(tmp_path / "drop", "notes.csv", table)
    store = TableStore(spark, str(tmp_path / "w"))
    assert spark.read.text(str(tmp_path / "drop")).rdd.getNumPartitions() > 10
    run = landing.land_folder(spark, store, str(tmp_path / "drop"), [CONTRACT], dt.datetime(2002, 1, 1))
    assert [(f.action, f.rows) for f in run.files] == [("append", 200)]
    assert rows(store.read("raw.raw_notes").select("id", "note", "tail")) == sorted((tuple(r) for r in table), key=repr)


def test_unclosed_and_endless_cells_reject_a_file(spark, tmp_path, monkeypatch):
    folder = tmp_path / "drop"
    write(folder, "good.csv", [cells(i) for i in range(12)])
    (folder / "open.csv").write_text('id,note,tail\n1,"never closed,x\n2,b,c\n')
    (folder / "head.csv").write_text('id,note,"ta\nil"\n1,a,b\n')
    (folder / "copy.csv").write_text('id,note,tail\n1,"never closed,x\n2,b,c\n')
    write(folder, "long.csv", [["1", "x\n" * 60, "t"]])
    wave = sorted(feeds.discover(spark, str(folder), CONTRACT).collect(), key=lambda f: f.path)
    monkeypatch.setattr("tallyspark.sources.records.RECORD_LINES", 50)
    monkeypatch.setattr(landing.open_files, "__defaults__", (50,))
    found = landing.land_wave(spark, TableStore(spark, str(tmp_path / "w")), wave, CONTRACT, dt.datetime(2002, 1, 1), dry_run=False)
    assert {f.file: (f.action, f.reason) for f in found} == {
        "good.csv": ("append", None), "open.csv": ("reject", "open_quote"), "copy.csv": ("reject", "open_quote"),
        "head.csv": ("reject", "open_quote"), "long.csv": ("reject", "open_quote"),
    }


def test_surplus_cells_are_still_found(spark, tmp_path):
    (tmp_path / "drop").mkdir()
    (tmp_path / "drop" / "bad.csv").write_text('id,note,tail\n1,"a\nb",c\n2,x,y,z\n')
    run = landing.land_folder(spark, TableStore(spark, str(tmp_path / "w")), str(tmp_path / "drop"), [CONTRACT], dt.datetime(2002, 1, 1))
    assert [f.action for f in run.files] == ["reject"]


TEXTS = st.text(st.sampled_from(list('ab",\n ü')), max_size=8)


@settings(max_examples=12, deadline=None)
@given(st.lists(st.tuples(TEXTS, TEXTS), min_size=1, max_size=25))
def test_any_cells(spark, tmp_path_factory, small_splits_once, pairs):
    folder = tmp_path_factory.mktemp("cells")
    table = [[str(i), a, b] for i, (a, b) in enumerate(pairs)]
    write(folder, "notes.csv", table)
    path = feeds.discover(spark, str(folder), CONTRACT).collect()
    broken = feeds.manifest(spark, path).first().broken
    got = feeds.read_text_columns(spark, [path[0].path], ["id", "note", "tail"], broken)
    assert rows(got.select("id", "note", "tail")) == sorted((tuple(r) for r in table), key=repr)


@pytest.fixture(scope="module")
def small_splits_once(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "60")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")
