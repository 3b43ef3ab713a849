"""The tree of checksums against the plain comparison."""

import random

import pytest
from pyspark.sql import functions as F

from tallyframe.operators import CompareOptions, TreeComparison, data_compare, data_compare_tree
from tests.helpers import rows

SCHEMA = "k long, r string, a string, n long, d date"


def side(spark, count, change=lambda i, row: row):
    made = [(i, f"r{i % 3}", f"text {i}", None if i % 5000 == 7 else i, None) for i in range(count)]
    made = [change(i, row) for i, row in enumerate(made)]
    return spark.createDataFrame([r for r in made if r is not None], SCHEMA).drop("d")


def moved(i, row):
    if i == 11:
        return (i, "r2", "other", i, None)
    if i == 3000:
        return None
    return (10_000_000, "r0", "new", 1, None) if i == 3001 else row


def dealt_rows(df):
    """Rows that the exchanges of an executed plan wrote."""
    df.collect()
    total, open_ = 0, [df._jdf.queryExecution().executedPlan()]
    while open_:
        node = open_.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            open_.append(node.executedPlan())
            continue
        if name.endswith("QueryStageExec"):
            open_.append(node.plan())
            continue
        if name == "ShuffleExchangeExec":
            total += node.metrics().apply("shuffleRecordsWritten").value()
        children = node.children()
        open_ += [children.apply(i) for i in range(children.size())]
    return total


def test_only_rows_of_differing_ranges_are_dealt(spark, tmp_path):
    for name, change in (("source", lambda i, row: row), ("target", moved)):
        side(spark, 6000, change).write.parquet(f"{tmp_path}/{name}")
    source, target = (spark.read.parquet(f"{tmp_path}/{name}") for name in ("source", "target"))
    found = data_compare_tree(source, target, "k, r")
    assert rows(found) == rows(data_compare(source, target, "k, r"))
    assert {r[0] for r in rows(found)} == {7, 11, 5007, 3000, 3001, 10_000_000}
    assert dealt_rows(data_compare(source, target, "k, r")) >= 11_999
    # Few other rows share one of the some sixteen million parts of ranges with these.
    assert dealt_rows(found) < 40
    comparison = TreeComparison(source, target, "k, r")
    assert comparison._open.columns == ["r", "p"]
    assert comparison._singles().count() < 20


def test_ranges_alone_where_their_parts_are_too_many(spark, never_broadcast):
    source, target = side(spark, 500), side(spark, 500, moved)
    comparison = TreeComparison(source, target, "k, r", ranges=50)
    assert comparison._open.columns == ["r"]
    assert rows(comparison.differences()) == rows(data_compare(source, target, "k, r"))
    assert comparison._singles().count() < 100


def test_equal_sides_have_nothing_left(spark):
    source = side(spark, 400).filter("n is not null")
    comparison = TreeComparison(source, source, "k, r")
    assert comparison._open is None and comparison.differences().count() == 0
    empty = source.filter("k < 0")
    assert data_compare_tree(empty, empty, "k").count() == 0
    assert data_compare_tree(source, empty, "k").count() == 3 * source.count()


@pytest.mark.parametrize(
    ("seed", "ranges", "options"),
    [
        (0, 1, CompareOptions()),
        (1, 4096, CompareOptions(tolerance={"n": 0.5})),
        (2, 3, CompareOptions(columns="n")),
    ],
)
def test_any_data(spark, seed, ranges, options):
    """Repeated keys, null keys, blanks, missing values and a tolerance."""
    rng = random.Random(seed)

    def made(count):
        return spark.createDataFrame(
            [
                (rng.choice([None, "1", " 2", "3", *map(str, range(4, 40))]), rng.choice([None, "x", " x", "y"]), rng.choice([None, 0.0, 0.25, 1.0, 5.0]))
                for _ in range(count)
            ],
            "k string, a string, n double",
        )

    source, target = made(25), made(25)
    found = data_compare_tree(source, target, "k", options=options, ranges=ranges)
    assert rows(found) == rows(data_compare(source, target, "k", options=options))


def test_swapped_values_are_found(spark):
    """The same values and keys in a range, put together otherwise."""
    source = spark.createDataFrame([(1, "a", 5), (2, "b", 6)], "k int, a string, n int")
    target = spark.createDataFrame([(1, "b", 5), (2, "a", 6)], "k int, a string, n int")
    assert rows(data_compare_tree(source, target, "k", ranges=1), "k", "column") == [(1, "a"), (2, "a")]


def test_null_keys_never_meet(spark):
    source = spark.createDataFrame([(None, "a")], "k int, a string")
    assert rows(data_compare_tree(source, source, "k"), "kind") == [("only_in_source",), ("only_in_target",)]


def shuffles_and_joins(job):
    """How many the plan of a frame that has not run has."""
    plan = job._jdf.queryExecution().executedPlan().toString()
    return plan.count("Exchange "), plan.count("Join")


def test_checksums_shuffle_no_rows_where_repeated_keys_are_many(spark, never_broadcast):
    source = side(spark, 300).unionByName(side(spark, 40).withColumn("a", F.lit("twice")))
    target = side(spark, 300, moved).unionByName(side(spark, 30))
    comparison = TreeComparison(source, target, "k, r", ranges=50)
    assert comparison._repeated is not None and not comparison._may_broadcast_repeated()
    assert shuffles_and_joins(comparison._differing(["r"])) == (1, 0)
    assert rows(comparison.differences()) == rows(data_compare(source, target, "k, r"))


def test_no_second_pass_where_missing_values_are_many(spark, monkeypatch):
    source = side(spark, 4000).withColumn("n", F.lit(None).cast("long"))
    made = []
    plain = TreeComparison._differing
    monkeypatch.setattr(TreeComparison, "_differing", lambda self, parts, **other: made.append(parts) or plain(self, parts, **other))
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "100k")
    try:
        found = data_compare_tree(source, source, "k, r")
        assert rows(found) == rows(data_compare(source, source, "k, r")) and found.count() == 4000
    finally:
        spark.conf.set(name, before)
    assert made == [["r"]]
