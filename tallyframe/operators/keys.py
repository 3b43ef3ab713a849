"""Checks on key columns: counts, repeated keys and keys found on one side only.

All of them read the same small table, one row per key with the number of rows
on each side. It comes from one union and one grouping: partial sums collapse a
hot key inside every map task, so that a key's rows never travel.
"""

from __future__ import annotations

from collections.abc import Sequence
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.functions.columns import balanced, column_of, ref, require_columns, shared_key
from tallyframe.results import (
    COUNT,
    DATA,
    DUPLICATE,
    ONLY_IN_SOURCE,
    ONLY_IN_TARGET,
    Check,
    Names,
    result_row,
    spread,
)

KEY_CHECKS = (COUNT, DUPLICATE, ONLY_IN_TARGET, ONLY_IN_SOURCE)

_SOURCE_ROWS, _TARGET_ROWS, _LONE = "__source_rows", "__target_rows", "__lone"


def any_null(columns: Sequence[Column]) -> Column:
    """True when one of the columns is null."""
    return balanced(or_, [column.isNull() for column in columns])


def tally(
    source: DataFrame,
    target: DataFrame,
    source_keys: Sequence[Column],
    target_keys: Sequence[Column],
    names: Sequence[str],
) -> DataFrame:
    """Rows per key and side. Keys with a null part stay apart on each side."""

    def side(df: DataFrame, columns: Sequence[Column], from_source: bool) -> DataFrame:
        return df.select(
            *[column.alias(name) for column, name in zip(columns, names)],
            F.when(any_null(columns), F.lit(from_source)).alias(_LONE),
            F.lit(int(from_source)).alias(_SOURCE_ROWS),
            F.lit(int(not from_source)).alias(_TARGET_ROWS),
        )

    both = side(source, source_keys, True).unionByName(
        side(target, target_keys, False)
    )
    return both.groupBy(*[ref(name) for name in names], F.col(_LONE)).agg(
        F.sum(_SOURCE_ROWS).alias(_SOURCE_ROWS),
        F.sum(_TARGET_ROWS).alias(_TARGET_ROWS),
    )


def _tally_of(source: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    pairs = [shared_key(source, target, key) for key in keys]
    return tally(
        source, target, [pair[0] for pair in pairs], [pair[1] for pair in pairs], keys
    )


def key_counts(source: DataFrame, target: DataFrame, keys) -> DataFrame:
    """Per key the rows on each side, null where the key does not occur.

    A key with a null part equals no key of the other side, so it stands in a
    row of its own for each side that holds it.
    """
    keys = require_columns(keys, "key column")
    counted = _tally_of(source, target, keys)
    return counted.select(
        *[ref(key) for key in keys],
        *[
            F.when(F.col(rows) > 0, F.col(rows)).alias(label)
            for rows, label in (
                (_SOURCE_ROWS, "source_count"),
                (_TARGET_ROWS, "target_count"),
            )
        ],
    )


def only_in_target(source: DataFrame, target: DataFrame, keys) -> DataFrame:
    """Distinct keys that the source lacks, with their number of target rows."""
    return (
        key_counts(source, target, keys)
        .filter(F.col("source_count").isNull())
        .drop("source_count")
    )


def only_in_source(source: DataFrame, target: DataFrame, keys) -> DataFrame:
    """Distinct keys that the target lacks, with their number of source rows."""
    return (
        key_counts(source, target, keys)
        .filter(F.col("target_count").isNull())
        .drop("target_count")
    )


def duplicate_keys(df: DataFrame, keys) -> DataFrame:
    """Keys held by more than one row. Null is a value like any other here."""
    keys = require_columns(keys, "key column")
    return (
        df.groupBy(*[column_of(df, key).alias(key) for key in keys])
        .agg(F.count(F.lit(1)).alias("count"))
        .filter(F.col("count") > 1)
    )


def count_rows(source: DataFrame, target: DataFrame) -> DataFrame:
    """One row with both row counts. Reads no columns at all."""
    return (
        source.selectExpr("count(1) as source_records", "bigint(0) as target_records")
        .unionByName(
            target.selectExpr("bigint(0) as source_records", "count(1) as target_records")
        )
        .selectExpr(
            "sum(source_records) as source_records",
            "sum(target_records) as target_records",
        )
    )


def key_rows(checks: Sequence[Check], keys: Sequence[str], names: Names) -> list[str]:
    """Result rows out of one row of figures with the names used below."""
    target = {"target_records": "target_records"}
    both = {"source_records": "source_records", **target}
    figures = {
        COUNT: ("abs(source_records - target_records)", both),
        DUPLICATE: ("repeated", target),
        ONLY_IN_TARGET: ("target_only", both),
        ONLY_IN_SOURCE: ("source_only", both),
        DATA: ("unequal", {**both, "also_fails": "differs"}),
    }
    return [
        result_row(check, names, figures[check][0], ",".join(keys), **figures[check][1])
        for check in checks
    ]


def key_checks(
    source: DataFrame | None,
    target: DataFrame,
    keys,
    checks: Sequence[Check] = KEY_CHECKS,
    names: Names = Names(),
) -> DataFrame:
    """Result rows of the asked key checks, all from one pass over the keys."""
    keys = require_columns(keys, "key column")
    if set(checks) == {COUNT}:
        figures = count_rows(source, target)
    elif set(checks) == {DUPLICATE}:
        figures = (
            target.groupBy(*[column_of(target, key) for key in keys])
            .agg(F.expr("count(1) as rows"))
            .selectExpr(
                "coalesce(sum(rows), 0) as target_records",
                "count_if(rows > 1) as repeated",
            )
        )
    else:
        figures = _tally_of(source, target, keys).selectExpr(
            f"coalesce(sum({_SOURCE_ROWS}), 0) as source_records",
            f"coalesce(sum({_TARGET_ROWS}), 0) as target_records",
            f"count_if({_TARGET_ROWS} > 1) as repeated",
            f"count_if({_SOURCE_ROWS} = 0) as target_only",
            f"count_if({_TARGET_ROWS} = 0) as source_only",
        )
    return spread(figures, key_rows(checks, keys, names))


def count_validation(source, target, keys, names: Names = Names()) -> DataFrame:
    """Passes when both sides hold the same number of rows."""
    return key_checks(source, target, keys, [COUNT], names)


def duplicate_validation(target, keys, names: Names = Names()) -> DataFrame:
    """Passes when no key repeats; fails with the number of repeated keys."""
    return key_checks(None, target, keys, [DUPLICATE], names)


def only_in_target_validation(source, target, keys, names: Names = Names()) -> DataFrame:
    """Passes when every key of the target occurs in the source."""
    return key_checks(source, target, keys, [ONLY_IN_TARGET], names)


def only_in_source_validation(source, target, keys, names: Names = Names()) -> DataFrame:
    """Passes when every key of the source occurs in the target."""
    return key_checks(source, target, keys, [ONLY_IN_SOURCE], names)
