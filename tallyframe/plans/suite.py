"""Running several checks on one pair of datasets."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from tallyframe.functions.columns import require_columns
from tallyframe.operators.compare import CompareOptions, Comparison
from tallyframe.operators.keys import KEY_CHECKS, key_checks, key_rows
from tallyframe.operators.quality import null_value_check, uniqueness_check
from tallyframe.results import (
    COUNT,
    DATA,
    DUPLICATE,
    NULLS,
    ONLY_IN_SOURCE,
    ONLY_IN_TARGET,
    UNIQUE,
    Check,
    Names,
    result_row,
    spread,
    union_all,
)

# The names that a test plan may use.
CHECK_NAMES = {
    "count_validation": COUNT,
    "duplicate": DUPLICATE,
    "Uniquess_check": UNIQUE,
    "uniqueness_check": UNIQUE,
    "Null_value_check": NULLS,
    "records_present_only_in_target": ONLY_IN_TARGET,
    "records_present_only_in_source": ONLY_IN_SOURCE,
    "data_compare": DATA,
}

ALL_CHECKS = (
    "count_validation",
    "duplicate",
    "Uniquess_check",
    "Null_value_check",
    "records_present_only_in_target",
    "records_present_only_in_source",
    "data_compare",
)

# Values up to twice the size of a digest go without one.
_WHOLE_BYTES = 32


def checks_named(names: Iterable[str]) -> list[Check]:
    """The checks of these names, each once, in the order of their numbers."""
    wanted = {name.strip() for name in names}
    unknown = sorted(wanted - CHECK_NAMES.keys())
    if unknown:
        raise ValueError(f"unknown checks {unknown}; known are {sorted(CHECK_NAMES)}")
    return sorted({CHECK_NAMES[name] for name in wanted}, key=lambda c: c.tc_id)


@dataclass(frozen=True)
class Figures:
    """What is known of a dataset before any check: rows, and missing values by column."""

    records: int
    missing: Mapping[str, int] = field(default_factory=dict)

    def nulls(self, df: DataFrame, columns: list[str], names: Names) -> DataFrame:
        """The null check of these columns, without reading anything."""
        return spread(
            df.sparkSession.range(1),
            [
                result_row(NULLS, names, f"{self.missing[c]}L", c, target_records=f"{self.records}L")
                for c in columns
            ],
        )


def validate(
    source: DataFrame,
    target: DataFrame,
    *,
    keys,
    null_columns=None,
    unique_columns=None,
    checks: Iterable[str] = ALL_CHECKS,
    names: Names = Names(),
    count_qa: int | None = None,
    options: CompareOptions = CompareOptions(),
    source_figures: Figures | None = None,
    target_figures: Figures | None = None,
) -> DataFrame:
    """One result table for all asked checks.

    All key checks share one pass over the keys of both sides, which the column
    comparison makes anyway unless its keys are trimmed text. The null check, the
    uniqueness check and the column comparison each read the columns they need
    once, however many columns that is. What the figures of a side answer, if the caller
    has them, is not read at all: numbers of rows, and missing values of its columns.
    """
    asked = checks_named(checks)
    keys = require_columns(keys, "key column")
    on_keys = [check for check in KEY_CHECKS if check in asked]
    parts = []
    if DATA in asked:
        comparison = Comparison(source, target, keys, options)
        shared = on_keys if on_keys and comparison.answers_key_checks else []
        parts.append(comparison.validation(names, count_qa, [*shared, DATA]))
        on_keys = [check for check in on_keys if check not in shared]
    if on_keys == [COUNT] and source_figures and target_figures:
        counts = f"{source_figures.records}L as source_records", f"{target_figures.records}L as target_records"
        parts.append(spread(target.sparkSession.range(1).selectExpr(*counts), key_rows(on_keys, keys, names)))
    elif on_keys:
        parts.append(key_checks(source, target, keys, on_keys, names))
    if UNIQUE in asked:
        parts.append(uniqueness_check(target, unique_columns, names, whole_bytes=_WHOLE_BYTES))
    if NULLS in asked:
        columns = require_columns(null_columns, "column to check for nulls")
        if target_figures and target_figures.missing.keys() >= set(columns):
            parts.append(target_figures.nulls(target, columns, names))
        else:
            parts.append(null_value_check(target, columns, names))
    return union_all(parts)
