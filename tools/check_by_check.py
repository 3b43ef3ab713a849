"""Time the fused plans against plans with a job per check and a join per column.

Both sides use Spark on the same tables. The plain forms state the checks the
obvious way: every figure by a count of its own.
"""

from __future__ import annotations

import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from pyspark.sql import functions as F  # noqa: E402

from bench import session  # noqa: E402
from tallyframe import validate  # noqa: E402
from tallyframe.functions import null_like  # noqa: E402
from tallyframe.operators import (  # noqa: E402
    compare_columns,
    null_value_check,
    only_in_source_validation,
    trim_columns,
)
from workloads.inputs import order_pair, sql  # noqa: E402
from workloads import inputs  # noqa: E402

NULLS, UNIQUES = ("k", "status", "price"), ("k", "price")


def plain_counts(source, target):
    return source.count(), target.count()


def plain_repeated(target, column):
    return target.groupBy(column).count().filter("count > 1").count(), target.count()


def plain_nulls(target, columns):
    return [
        (
            target.filter(
                null_like(F.col(name), target.schema[name].dataType)
            ).count(),
            target.count(),
        )
        for name in columns
    ]


def plain_lonely(source, target):
    met = (
        source.groupBy("k")
        .agg(F.count("*").alias("here"))
        .join(target.groupBy("k").agg(F.count("*").alias("there")), "k", "full_outer")
    )
    return met.filter("there is null").count(), source.count(), target.count()


def plain_compare(source, target):
    source, target = trim_columns(source), trim_columns(target)
    found = []
    for name in ("status", "price"):
        met = source.select("k", F.col(name).alias("a")).join(
            target.select("k", F.col(name).alias("b")), "k", "full_outer"
        )
        found += [met.filter("a = b").count(), met.filter("not (a <=> b)").count()]
    return found


def plain_all(source, target):
    plain_counts(source, target)
    plain_repeated(target, "k")
    for name in UNIQUES:
        plain_repeated(target, name)
    plain_nulls(target, NULLS)
    plain_lonely(source, target)
    plain_lonely(target, source)
    plain_compare(source, target)


def fused_all(source, target):
    validate(
        source, target, keys="k", null_columns=NULLS, unique_columns=UNIQUES
    ).collect()


def median_seconds(action, runs=5):
    action()
    taken = []
    for _ in range(runs):
        start = time.perf_counter()
        action()
        taken.append(time.perf_counter() - start)
    return statistics.median(taken)


def main(folder: str) -> None:
    spark = session("8")

    def pair():
        return order_pair(spark, folder)

    def marked():
        return sql(spark, folder, inputs.MARKED_TEXT)

    columns = ("k", "note", "price", "placed")
    for label, fused, plain in (
        ("all checks", lambda: fused_all(*pair()), lambda: plain_all(*pair())),
        (
            "compare columns",
            lambda: compare_columns(*pair(), "k").collect(),
            lambda: plain_compare(*pair()),
        ),
        (
            "only in source",
            lambda: only_in_source_validation(*pair(), "k").collect(),
            lambda: plain_lonely(*pair()),
        ),
        (
            "null values",
            lambda: null_value_check(marked(), columns).collect(),
            lambda: plain_nulls(marked(), columns),
        ),
    ):
        print(f"{label}: fused {median_seconds(fused):.2f}s plain {median_seconds(plain):.2f}s")


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1")
