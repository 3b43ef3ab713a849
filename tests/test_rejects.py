"""Records that do not fit a schema."""

import os

import pytest

from tallyframe.results import Names
from tallyframe.sources import split_csv, split_json
from tests.helpers import results, rows


def write(path, text):
    with open(path, "w") as out:
        out.write(text)
    return str(path)


CSV = """id,n,placed,note
1,2.50,2024-01-02,plain
2,,,
3,two,2024-01-02,a word for a number
4,1.00,2024-02-30,no such day
5,1.00,2024-01-02
6,1.00,2024-01-02,x,y
x,,,
7,1.005,2024-01-02,"with, comma"
9999999999,1.00,2024-01-02,too large
"""


def test_csv_records(spark, tmp_path):
    path = write(tmp_path / "some.csv", CSV)
    read = split_csv(spark, path, "id int, n decimal(6,2), placed date, note string")
    lines = CSV.splitlines()[1:]
    assert [r["id"] for r in read.rows.orderBy("id").collect()] == [1, 2, 7]
    assert rows(read.rows.filter("id = 7"), "note") == [("with, comma",)]
    assert rows(read.rows.filter("id = 2"), "n", "placed", "note") == [(None, None, None)]
    assert sorted(r["record"] for r in read.rejects.collect()) == sorted(lines[i] for i in (2, 3, 4, 5, 6, 8))
    assert {os.path.basename(r["file"]) for r in read.rejects.collect()} == {"some.csv"}
    assert (read.records, read.rejected) == (9, 6)
    assert results(read.reconciled(Names("files", "rows"))) == {(1, "*"): (9, 3, 6, "fail")}


def test_columns_asked_for_do_not_matter(spark, tmp_path):
    """A reader that is asked for one column alone does not look at the others."""
    path = write(tmp_path / "some.csv", CSV)
    read = split_csv(spark, path, "id int, n decimal(6,2), placed date, note string")
    assert read.rows.select("id").count() == read.rows.count() == 3
    path = write(tmp_path / "some.json", '{"a":1,"b":2}\n{"a":1,"b":"x"}\n')
    read = split_json(spark, path, "a int, b int")
    assert read.rows.select("a").count() == 1 and read.rejects.select("record").count() == 1


def test_json_records(spark, tmp_path):
    lines = ['{"a":1,"b":{"c":[1,2]}}', '{"a":2}', '{"a":"x","b":null}', '{"a":3,"b":{"c":"no"}}', '{"a":4', "word", '{"b":{}}']
    path = write(tmp_path / "some.json", "\n".join(lines) + "\n\n")
    read = split_json(spark, path, "a int, b struct<c:array<int>>")
    assert sorted(r["a"] or 0 for r in read.rows.collect()) == [0, 1, 2]
    assert sorted(r["record"] for r in read.rejects.collect()) == sorted(lines[2:6])
    assert (read.records, read.rejected) == (7, 4)


def test_multiline_files_are_rejected_whole(spark, tmp_path):
    write(tmp_path / "good.json", '[{"a": 1},\n {"a": 2}]')
    write(tmp_path / "bad.json", '{"a":\n')
    read = split_json(spark, str(tmp_path), "a int", multiline=True)
    assert rows(read.rows) == [(1,), (2,)]
    assert [os.path.basename(r["file"]) for r in read.rejects.collect()] == ["bad.json"]


@pytest.mark.parametrize("text", ["", "id\n"])
def test_files_without_records(spark, tmp_path, text):
    read = split_csv(spark, write(tmp_path / "none.csv", text), "id int")
    assert read.rows.count() == read.rejects.count() == read.records == read.rejected == 0
    assert results(read.reconciled()) == {(1, "*"): (0, 0, 0, "pass")}


def test_names_that_clash_and_other_delimiters(spark, tmp_path):
    path = write(tmp_path / "some.csv", "1|2\nx|3\n")
    read = split_csv(spark, path, "__record int, __FILE int", delimiter="|", header=False)
    assert read.rows.columns == ["__record", "__FILE"] and rows(read.rows) == [(1, 2)]
    assert rows(read.rejects, "record") == [("x|3",)]
