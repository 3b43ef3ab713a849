import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyframe.operators import null_value_check, uniqueness_check
from tallyframe.operators.quality import _COLUMNS_PER_SCAN, _value_counts, value_digest
from tallyframe.results import Names
from tests.helpers import results


def test_null_like_text(spark):
    texts = [
        "None", "xNULLx", "Nullable", "Nonesuch", "", None, "NaN", " nan ",
        "null", " ", "banana", "12", "nano",
    ]
    df = spark.createDataFrame([(t,) for t in texts], "c string")
    assert results(null_value_check(df, "c")) == {(4, "c"): (None, 13, 8, "fail")}


def test_null_like_by_type(spark):
    df = spark.createDataFrame(
        [
            (1, 1.0, Decimal("1.5"), datetime.date(2020, 1, 1), True, None),
            (None, float("nan"), None, None, None, None),
            (3, None, Decimal("2.5"), None, False, None),
        ],
        "i int, d double, n decimal(9,1), t date, b boolean, s string",
    )
    checked = null_value_check(df, "i, d, n, t, b, s", Names(target="x"))
    assert {k[1]: v[2:] for k, v in results(checked).items()} == {
        "i": (1, "fail"),
        "d": (2, "fail"),
        "n": (1, "fail"),
        "t": (2, "fail"),
        "b": (1, "fail"),
        "s": (3, "fail"),
    }


def test_null_check_reads_once_and_does_not_shuffle_rows(spark, tmp_path):
    spark.range(100).selectExpr("id a", "id b", "id c").write.parquet(f"{tmp_path}/x")
    df = spark.read.parquet(f"{tmp_path}/x")
    plan = null_value_check(df, "a, b")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    assert "hashpartitioning" not in plan
    assert "ReadSchema: struct<a:bigint,b:bigint>" in plan


def test_uniqueness_counts_groups_per_column(spark):
    df = spark.createDataFrame(
        [(1, "x", 0.0), (2, "x", -0.0), (3, None, 1.0), (4, None, None), (5, "y", 2.0)],
        "a int, b string, c double",
    )
    assert results(uniqueness_check(df, "a, b, c")) == {
        (3, "a"): (None, 5, 0, "pass"),
        (3, "b"): (None, 5, 2, "fail"),
        (3, "c"): (None, 5, 1, "fail"),
    }


def test_uniqueness_of_one_column_and_of_nothing(spark):
    df = spark.createDataFrame([(1,), (1,)], "a int")
    assert results(uniqueness_check(df, "a")) == {(3, "a"): (None, 2, 1, "fail")}
    empty = df.filter("a > 5")
    assert results(uniqueness_check(empty, "a")) == {(3, "a"): (None, 0, 0, "pass")}


def test_uniqueness_of_many_columns(spark):
    width = 2 * _COLUMNS_PER_SCAN + 1
    columns = [f"c{i}" for i in range(width)]
    df = spark.range(20).selectExpr(*[f"id % {i + 1} as c{i}" for i in range(width)])
    checked = results(uniqueness_check(df, columns))
    for i, name in enumerate(columns):
        values = [n % (i + 1) for n in range(20)]
        repeated = sum(values.count(v) > 1 for v in set(values))
        assert checked[3, name][1:3] == (20, repeated)


def test_uniqueness_reads_once_and_shuffles_once(spark, tmp_path):
    spark.range(100).selectExpr("id a", "id b", "id c").write.parquet(f"{tmp_path}/x")
    df = spark.read.parquet(f"{tmp_path}/x")
    plan = uniqueness_check(df, "a, b")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    assert plan.count("Exchange hashpartitioning") == 1


LONG = "a string, b binary, c array<double>, d struct<x:int,y:string>, e int"
LONG_ROWS = [
    ("x", b"\x00", [0.0], (1, "p"), 1),
    ("x", b"\x00", [-0.0], (1, None), 1),
    ("xy", b"", [float("nan"), None], (1, None), 2),
    (None, None, [float("nan"), None], None, None),
    (None, b"\x01", [], None, None),
    ("", None, None, (None, None), 3),
    ("X", None, [0.0, 0.0], (2, "p"), 4),
]
LONG_REPEATS = {"a": 2, "b": 2, "c": 2, "d": 2, "e": 2}


@pytest.mark.parametrize(
    "digest",
    [
        value_digest,
        # Digests of few values, so that nearly all rows clash.
        lambda value: F.when(value.isNotNull(), F.length(F.hex(F.xxhash64(value)))),
        lambda value: F.when(value.isNotNull(), F.lit(0)),
        lambda value: F.lit(0),
    ],
)
def test_uniqueness_of_long_values_by_digest(spark, digest):
    df = spark.createDataFrame(LONG_ROWS, LONG).repartition(3)
    checked = results(uniqueness_check(df, "e, a, b, c, d", digest=digest))
    assert {name: figures[1:3] for (_, name), figures in checked.items()} == {
        name: (7, repeated) for name, repeated in LONG_REPEATS.items()
    }
    alone = results(uniqueness_check(df, "c", digest=digest))
    assert alone[3, "c"][1:3] == (7, 2)
    assert results(uniqueness_check(df.filter("e > 9"), "a", digest=digest)) == {(3, "a"): (None, 0, 0, "pass")}


def test_uniqueness_of_a_hot_text_without_broadcast(spark, never_broadcast):
    df = spark.range(3000).selectExpr("if(id % 3 = 0, 'hot', cast(id as string)) as a", "cast(id as string) as b")
    assert results(uniqueness_check(df, "a, b")) == {
        (3, "a"): (None, 3000, 1, "fail"),
        (3, "b"): (None, 3000, 0, "pass"),
    }


def exchanged(df):
    """What the exchanges of a plan get, as texts."""
    plan = df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    parts = [part for part in plan.split("\n\n") if "Exchange\n" in part and "Input" in part]
    assert parts
    return [line for part in parts for line in part.splitlines() if line.startswith("Input")]


def test_uniqueness_deals_out_digests_only(spark, tmp_path):
    spark.range(100).selectExpr("cast(id as string) as a", "if(id < 2, 'again', cast(id as string)) as b").write.parquet(f"{tmp_path}/x")
    df = spark.read.parquet(f"{tmp_path}/x")
    digests = df.select(value_digest(F.col("a")).alias("c0"), value_digest(F.col("b")).alias("c1"))
    plan = _value_counts(digests, ["c0", "c1"])
    assert all("a#" not in line and "b#" not in line for line in exchanged(plan))
    assert [f.dataType.simpleString() for f in plan.schema.fields[:2]] == ["struct<a:bigint,b:bigint>"] * 2
    # Without a repeated digest nothing is read again; with one, only rows that have it go on.
    checked = uniqueness_check(df, "a")
    assert "FileScan" not in checked._jdf.queryExecution().executedPlan().toString()
    assert results(uniqueness_check(df, "b")) == {(3, "b"): (None, 100, 1, "fail")}
    second = uniqueness_check(df, "b")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in second and second.index("HashAggregate") < second.index("BroadcastHashJoin")


@pytest.mark.parametrize("digest", [value_digest, lambda value: F.lit(0)])
@pytest.mark.parametrize("whole_bytes", [1, 2, 32])
def test_uniqueness_of_short_values_as_they_are(spark, digest, whole_bytes):
    df = spark.createDataFrame(LONG_ROWS, LONG).repartition(3)
    checked = results(uniqueness_check(df, "e, a, b, c, d", digest=digest, whole_bytes=whole_bytes))
    assert {name: figures[1:3] for (_, name), figures in checked.items()} == {
        name: (7, repeated) for name, repeated in LONG_REPEATS.items()
    }
    # Repeated values on both sides of the bound, a null, and one value that is its own.
    texts = ["é", "é", "abc", "abc", "abcd", None, None, "", ""]
    df = spark.createDataFrame([(t, None if t is None else t.encode()) for t in texts], "a string, b binary")
    assert results(uniqueness_check(df, "a, b", digest=digest, whole_bytes=whole_bytes)) == {
        (3, "a"): (None, 9, 4, "fail"),
        (3, "b"): (None, 9, 4, "fail"),
    }


def test_short_repeated_values_take_no_second_pass(spark, tmp_path):
    spark.range(100).selectExpr("if(id < 2, 'again', cast(id as string)) as b").write.parquet(f"{tmp_path}/x")
    checked = uniqueness_check(spark.read.parquet(f"{tmp_path}/x"), "b", whole_bytes=8)
    assert "FileScan" not in checked._jdf.queryExecution().executedPlan().toString()
    assert results(checked) == {(3, "b"): (None, 100, 1, "fail")}
