"""Nested data as tables, and back."""

from datetime import timedelta

import pytest

from tallyframe.operators import flatten, flatten_tables
from tests.helpers import rows

SCHEMA = (
    "id int, s struct<a:int,b:struct<c:string>>, xs array<int>, "
    "ys array<struct<p:string,q:array<double>,m:map<string,array<int>>>>, m map<int,struct<z:date>>, t array<array<string>>"
)
ROWS = [
    (1, (1, ("x",)), [3, None, 1], [("p", [0.5, 0.25], {"k": [1, 2], "n": None}), (None, [], {})], {1: (None,), 2: None}, [["a"], [], None]),
    (2, None, None, None, None, None),
    (3, (None, None), [], [], {}, []),
    (4, (None, (None,)), [None], [None, (None, None, None)], {7: (None,)}, [[None, "b"]]),
    (4, (5, ("y",)), list(range(30)), [("r", [1.0], {"": []})] * 12, {}, None),
    (None, None, [1], None, None, [[]]),
]


def exactly(df):
    return sorted((repr(r) for r in df.collect()))


@pytest.mark.parametrize("keys", [None, "id, xs"])
def test_tables_rebuild_the_input(spark, keys):
    df = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    tables = flatten_tables(df, keys)
    again = tables.rebuilt()
    assert again.schema.simpleString() == df.schema.simpleString()
    assert exactly(again) == exactly(df)
    for frame in tables.frames.values():
        assert not any(t.startswith(("array", "map", "struct")) for _, t in frame.dtypes)


def test_arrays_beside_one_another_do_not_multiply(spark):
    df = spark.createDataFrame([(1, list(range(50)), list(range(60)))], "id int, a array<int>, b array<int>")
    assert flatten(df).count() == 3000
    tables = flatten_tables(df, "id")
    assert {path: frame.count() for path, frame in tables.frames.items()} == {"": 1, "a": 50, "b": 60}
    assert rows(tables["a"].filter("_place = 7")) == [('{"id":1}/7', '{"id":1}', 7, 7)]


def test_keys_stay_from_run_to_run(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    one, two = (flatten_tables(df.repartition(n), "id, xs") for n in (1, 5))
    assert rows(one["ys/value.q"]) == rows(two["ys/value.q"])
    assert one["ys/value.q"].columns == ["_row", "_parent", "_place", "value"]


def test_flat_and_empty_data(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    flat = df.select("id")
    assert exactly(flatten_tables(flat).rebuilt()) == exactly(flat)
    empty = flatten_tables(df.filter("id = 99"))
    assert empty.rebuilt().count() == 0 and all(f.count() == 0 for f in empty.frames.values())


def test_names_that_repeat_are_an_error(spark):
    df = spark.createDataFrame([(1, (2,))], "`s.a` int, s struct<a:int>")
    with pytest.raises(ValueError, match="repeat"):
        flatten_tables(df)


def test_rebuilding_deals_each_table_once(spark):
    data = [(f"{i}/0", [[f"a b/{i}", None], [], None], {"k": [timedelta(seconds=i), None]}) for i in range(20)]
    df = spark.createDataFrame(data, "id string, xs array<array<string>>, m map<string,array<interval day to second>>")
    tables = flatten_tables(df, "id")
    again = tables.rebuilt()
    plan = again._jdf.queryExecution().executedPlan().toString()
    assert exactly(again) == exactly(df)
    assert plan.count("Exchange ") == len(tables.frames) == 5 and "Join" not in plan


def test_rows_of_one_key_share_their_elements(spark):
    df = spark.createDataFrame([(1, [5, None]), (1, [5, None]), (None, [7])], "id int, xs array<int>").repartition(3)
    assert rows(flatten_tables(df, "id").rebuilt()) == rows(
        spark.createDataFrame([(1, [5, 5, None, None]), (1, [5, 5, None, None]), (None, [7])], df.schema)
    )
