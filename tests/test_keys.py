import pytest

from tallyframe.functions import split_columns
from tallyframe.operators import (
    compare_columns,
    count_validation,
    duplicate_keys,
    duplicate_validation,
    key_checks,
    key_counts,
    only_in_source,
    only_in_source_validation,
    only_in_target,
    only_in_target_validation,
)
from tallyframe.results import Names
from tallyframe.schema import RESULT_SCHEMA
from tests.helpers import results, rows


@pytest.fixture
def pair(spark):
    source = spark.createDataFrame(
        [(1, "a"), (2, "b"), (2, "b"), (3, None), (None, "z"), (5, "e")], "k int, p string"
    )
    target = spark.createDataFrame(
        [(1, "a"), (2, "b"), (3, None), (3, None), (None, "z"), (None, "z"), (6, "f")],
        "k int, p string",
    )
    return source, target


def test_count(pair):
    source, target = pair
    checked = count_validation(source, target, "k", Names("s", "t"))
    assert checked.schema.simpleString() == RESULT_SCHEMA.simpleString()
    assert [tuple(r) for r in checked.collect()] == [
        (1, "Count_validation", "s", "t", 6, 7, 1, "k", "fail")
    ]


def test_count_of_equal_sides_passes(pair):
    source, _ = pair
    assert results(count_validation(source, source, "k")) == {
        (1, "k"): (6, 6, 0, "pass")
    }


def test_repeated_keys_count_groups_and_null_is_a_value(pair):
    _, target = pair
    assert rows(duplicate_keys(target, "k")) == [(3, 2), (None, 2)]
    checked = duplicate_validation(target, "k", Names("s", "t"))
    assert [tuple(r) for r in checked.collect()] == [
        (2, "duplicate_validation", None, "t", None, 7, 2, "k", "fail")
    ]


def test_null_keys_are_only_in_each_side(pair):
    source, target = pair
    assert rows(only_in_source(source, target, "k")) == [(5, 1), (None, 1)]
    assert rows(only_in_target(source, target, "k")) == [(6, 1), (None, 2)]
    assert results(only_in_source_validation(source, target, "k")) == {
        (6, "k"): (6, 7, 2, "fail")
    }
    assert results(only_in_target_validation(source, target, "k")) == {
        (5, "k"): (6, 7, 2, "fail")
    }


def test_composite_key_with_null_parts(pair):
    source, target = pair
    assert rows(only_in_target(source, target, "k, p")) == [
        (3, None, 2),
        (6, "f", 1),
        (None, "z", 2),
    ]
    assert rows(key_counts(source, target, ["k", "p"])) == [
        (1, "a", 1, 1),
        (2, "b", 2, 1),
        (3, None, 1, None),
        (3, None, None, 2),
        (5, "e", 1, None),
        (6, "f", None, 1),
        (None, "z", 1, None),
        (None, "z", None, 2),
    ]


def test_only_in_source_mirrors_only_in_target(pair):
    source, target = pair
    assert rows(only_in_source(source, target, "k")) == rows(
        only_in_target(target, source, "k")
    )


def test_all_key_checks_at_once_equal_each_alone(pair):
    source, target = pair
    together = results(key_checks(source, target, "k"))
    alone = {}
    for check in (
        count_validation(source, target, "k"),
        duplicate_validation(target, "k"),
        only_in_source_validation(source, target, "k"),
        only_in_target_validation(source, target, "k"),
    ):
        alone |= results(check)
    assert together == alone


def test_key_checks_shuffle_the_keys_once(pair):
    source, target = pair
    plan = key_checks(source, target, "k")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert "Join" not in plan and "Cartesian" not in plan


def test_empty_sides(pair, spark):
    source, _ = pair
    empty = spark.createDataFrame([], source.schema)
    assert results(key_checks(empty, empty, "k")) == {
        (1, "k"): (0, 0, 0, "pass"),
        (2, "k"): (None, 0, 0, "pass"),
        (5, "k"): (0, 0, 0, "pass"),
        (6, "k"): (0, 0, 0, "pass"),
    }
    assert results(key_checks(source, empty, "k"))[6, "k"] == (6, 0, 5, "fail")


def test_names_with_dots_and_other_case(spark):
    source = spark.createDataFrame([(1,), (2,)], "`id.no` int")
    target = spark.createDataFrame([(2,), (3,)], "`ID.No` int")
    assert rows(only_in_source(source, target, "id.no")) == [(1, 1)]
    with pytest.raises(ValueError, match="does not exist"):
        only_in_source(source, target, "id")


def test_text_key_meets_number_as_text(spark):
    source = spark.createDataFrame([("1",), ("2",)], "k string")
    target = spark.createDataFrame([(2,), (3,)], "k bigint")
    assert rows(only_in_source(source, target, "k")) == [("1", 1)]


def test_numbers_of_different_width_meet(spark):
    source = spark.createDataFrame([(1,), (2,)], "k int")
    target = spark.createDataFrame([(2,), (3,)], "k bigint")
    assert rows(only_in_source(source, target, "k")) == [(1, 1)]


def test_column_lists_are_stripped():
    assert split_columns("identifier, surname") == ["identifier", "surname"]
    assert split_columns([" a ", "b", ""]) == ["a", "b"]
    assert split_columns(None) == []
    with pytest.raises(ValueError, match="no key column"):
        key_checks(None, None, " ")


def test_names_with_quotes(spark):
    df = spark.createDataFrame([(1, "x")], "`it's \\\\ a key` int, `a'b` string")
    key = df.columns[0]
    checked = count_validation(df, df, key, Names("c:\\x's", "t")).first()
    assert (checked["column"], checked["source_name"]) == (key, "c:\\x's")
    assert rows(compare_columns(df, df, key)) == [("a'b", 1, 1, 0, 0.0)]
