"""Building rows of the result table out of one-row aggregates."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.functions.columns import sql_text
from tallyframe.schema import PUBLISHED_HEADINGS, RESULT_SCHEMA


@dataclass(frozen=True)
class Check:
    tc_id: int
    name: str


# Number and published name of every check.
COUNT = Check(1, "Count_validation")
DUPLICATE = Check(2, "duplicate_validation")
UNIQUE = Check(3, "Uniquess_check")
NULLS = Check(4, "Null_value_check")
ONLY_IN_TARGET = Check(5, "records_present_only_in_target")
ONLY_IN_SOURCE = Check(6, "records_present_only_in_source")
DATA = Check(7, "Datavalidation")


@dataclass(frozen=True)
class Names:
    """What the result table calls the two sides."""

    source: str | None = None
    target: str | None = None


def result_row(
    check: Check,
    names: Names,
    failed: str,
    column: str,
    *,
    source_records: str | None = None,
    target_records: str | None = None,
    also_fails: str = "false",
) -> str:
    """One result row as a SQL struct; a side without a count does not apply."""
    values = {
        "tc_id": str(check.tc_id),
        "test_case_name": sql_text(check.name),
        "source_name": sql_text(names.source if source_records else None),
        "target_name": sql_text(names.target if target_records else None),
        "source_records": source_records or "null",
        "target_records": target_records or "null",
        "failed_records": failed,
        "column": sql_text(column),
        "status": f"if({failed} > 0 or {also_fails}, 'fail', 'pass')",
    }
    cells = [
        f"cast({values[field.name]} as {field.dataType.simpleString()}) as {field.name}"
        for field in RESULT_SCHEMA.fields
    ]
    return f"struct({', '.join(cells)})"


def inline_rows(structs: Sequence[str]) -> str:
    """SQL that turns structs into rows."""
    return f"inline(array({', '.join(structs)}))"


def spread(aggregate: DataFrame, rows: Sequence[str]) -> DataFrame:
    """Turn a one-row aggregate into one row per struct."""
    return aggregate.selectExpr(inline_rows(rows))


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of frames with the same columns, repeated rows included."""
    if not frames:
        raise ValueError("nothing to union")
    return reduce(DataFrame.unionByName, frames)


def as_published(results: DataFrame) -> DataFrame:
    """The result table under the headings of the published summary."""
    return results.select(
        *[
            F.col(field.name).alias(heading)
            for field, heading in zip(RESULT_SCHEMA.fields, PUBLISHED_HEADINGS)
        ]
    )


def as_published_short(results: DataFrame) -> DataFrame:
    """The older published summary, which names neither sides nor columns."""
    return as_published(results).drop("Source_name", "target_name", "column")
