"""Checks on single columns of one dataset: missing values and uniqueness."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.functions.columns import (
    column_of,
    find_field,
    ref,
    require_columns,
    sql_text,
)
from tallyframe.functions.rules import null_like
from tallyframe.results import NULLS, UNIQUE, Names, result_row, spread, union_all
from tallyframe.sources.scratch import stored

# Every column adds a row per row and a slot per row to the expanded input, so
# wide lists are split over several scans that each read their own columns.
_COLUMNS_PER_SCAN = 12


def null_value_check(df: DataFrame, columns, names: Names = Names()) -> DataFrame:
    """One result row per column with its number of missing values, in one scan."""
    columns = require_columns(columns, "column to check for nulls")
    counted = df.agg(
        F.count(F.lit(1)).alias("records"),
        *[
            F.count_if(
                null_like(column_of(df, name), find_field(df, name).dataType)
            ).alias(f"missing_{i}")
            for i, name in enumerate(columns)
        ],
    )
    return spread(
        counted,
        [
            result_row(NULLS, names, f"missing_{i}", name, target_records="records")
            for i, name in enumerate(columns)
        ],
    )


def _value_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows per distinct value of each column, all columns in one shuffle."""
    slots = [f"c{i}" for i in range(len(columns))]
    narrow = df.select(
        *[column_of(df, name).alias(slot) for name, slot in zip(columns, slots)]
    )
    if len(slots) == 1:
        return narrow.groupBy(slots[0]).agg(
            F.lit(0).cast("long").alias("which"), F.count(F.lit(1)).alias("rows")
        )
    return narrow.groupingSets([[ref(s)] for s in slots], *[ref(s) for s in slots]).agg(
        F.grouping_id().alias("which"), F.count(F.lit(1)).alias("rows")
    )


def _grouping_number(position: int, width: int) -> int:
    """What ``grouping_id`` gives for the set that holds one column only."""
    if width == 1:
        return 0
    return (2**width - 1) - 2 ** (width - 1 - position)


# Types whose values can be long, so that digests stand for them where rows are dealt.
_LONG_TYPES = (T.StringType, T.BinaryType, T.ArrayType, T.StructType)


def value_digest(value: Column) -> Column:
    """128 bits of a value, null for null."""
    halves = F.struct(F.xxhash64(F.lit(1), value).alias("a"), F.xxhash64(F.lit(2), value).alias("b"))
    return F.when(value.isNotNull(), halves)


def uniqueness_check(
    df: DataFrame,
    columns,
    names: Names = Names(),
    *,
    digest: Callable[[Column], Column] = value_digest,
    whole_bytes: int = 0,
) -> DataFrame:
    """One result row per column with its number of repeated values.

    Values of fixed size are counted as they are. Of long ones (text, bytes, arrays,
    structs) only digests are, and a second pass counts the values whose digest repeats,
    whole, so that digests that clash change nothing; where none repeats there is no
    second pass. The figures of long columns so take a job while the frame is built.
    Texts and bytes of at most ``whole_bytes`` stand for themselves in place of a digest
    and take no second pass.
    """
    columns = require_columns(columns, "column to check for uniqueness")
    long = [c for c in columns if isinstance(find_field(df, c).dataType, _LONG_TYPES)]
    fixed = [c for c in columns if c not in long]
    parts = []
    for start in range(0, len(fixed), _COLUMNS_PER_SCAN):
        chunk = fixed[start : start + _COLUMNS_PER_SCAN]
        parts.append(_repeated_as_given(df, chunk, names))
    for start in range(0, len(long), _COLUMNS_PER_SCAN):
        chunk = long[start : start + _COLUMNS_PER_SCAN]
        parts.append(_repeated_by_digest(df, chunk, names, digest, whole_bytes))
    return union_all(parts)


def _repeated_as_given(df: DataFrame, columns: list[str], names: Names) -> DataFrame:
    numbers = [_grouping_number(i, len(columns)) for i in range(len(columns))]
    totals = _value_counts(df, columns).selectExpr(
        *[
            f"coalesce(sum(if(which = {number}, rows, null)), 0) as records_{i}"
            for i, number in enumerate(numbers)
        ],
        *[
            f"count_if(which = {number} and rows > 1) as repeated_{i}"
            for i, number in enumerate(numbers)
        ],
    )
    return spread(
        totals,
        [
            result_row(UNIQUE, names, f"repeated_{i}", name, target_records=f"records_{i}")
            for i, name in enumerate(columns)
        ],
    )


def _repeated_by_digest(
    df: DataFrame, columns: list[str], names: Names, digest: Callable[[Column], Column], whole_bytes: int
) -> DataFrame:
    slots = [f"c{i}" for i in range(len(columns))]
    # Collated texts of unlike sizes can be equal, so theirs do not tell them apart.
    plain = [find_field(df, c).dataType in (T.StringType(), T.BinaryType()) for c in columns]
    split = [whole_bytes > 0 and p for p in plain]

    def mark(value: Column, is_split: bool) -> Column:
        if not is_split:
            return digest(value)
        fits = F.octet_length(value) <= whole_bytes
        return F.struct(F.when(fits, value).alias("whole"), F.when(~fits, digest(value)).alias("digest"))

    marks = df.select(*[mark(column_of(df, c), s).alias(slot) for c, s, slot in zip(columns, split, slots)])
    numbers = [_grouping_number(i, len(columns)) for i in range(len(columns))]
    by_digest = [
        f"(which = {n} and {slot}.digest is not null)" if s else f"which = {n}"
        for n, s, slot in zip(numbers, split, slots)
    ]
    suspects, found = _suspects(_value_counts(marks, slots), numbers, by_digest)
    records = f"{found['records'] or 0}L"
    parts = []
    for i, (column, slot) in enumerate(zip(columns, slots)):
        counted = df.sparkSession.range(1).selectExpr(f"{found[f'whole_{i}']}L as repeated")
        if found[f"suspects_{i}"]:
            suspected = suspects.filter(by_digest[i])
            values = df.select(column_of(df, column).alias("value"))
            if split[i]:
                suspected = suspected.select(F.col(f"{slot}.digest").alias("suspect"))
                values = values.filter(F.octet_length("value") > whole_bytes)
            else:
                suspected = suspected.select(ref(slot).alias("suspect"))
            counted = (
                values.join(suspected, digest(F.col("value")).eqNullSafe(F.col("suspect")), "left_semi")
                .groupBy("value")
                .agg(F.count(F.lit(1)).alias("rows"))
                .selectExpr(f"count_if(rows > 1) + {found[f'whole_{i}']}L as repeated")
            )
        parts.append(spread(counted, [result_row(UNIQUE, names, "repeated", column, target_records=records)]))
    return union_all(parts)


def _suspects(counts: DataFrame, numbers: list[int], by_digest: list[str]) -> tuple[DataFrame, dict[str, int]]:
    """The stored digests of several rows, and what is counted while they are stored.

    That is ``records``, and by column the digests of several rows (``suspects_``) and the
    values of several rows that stand for themselves (``whole_``). Spark broadcasts the
    digests to the second pass as long as they are small; beyond that the rows meet them
    on a shuffle of the values.
    """
    seen = Observation()
    counted = [F.expr(f"sum(if(which = {numbers[0]}, rows, null))").alias("records")]
    for i, (number, wanted) in enumerate(zip(numbers, by_digest)):
        counted.append(F.expr(f"count_if(rows > 1 and {wanted})").alias(f"suspects_{i}"))
        counted.append(F.expr(f"count_if(rows > 1 and which = {number} and not ({wanted}))").alias(f"whole_{i}"))
    suspects = stored(counts.observe(seen, *counted).filter(f"rows > 1 and ({' or '.join(by_digest)})").drop("rows"))
    return suspects, seen.get


def _telling_text(df: DataFrame, name: str, slot: str) -> str:
    """A value as text that differs whenever values of the column do."""
    kind = find_field(df, name).dataType
    if isinstance(kind, T.BinaryType):
        return f"base64({slot})"
    if isinstance(kind, (T.ArrayType, T.StructType)):
        micros = "yyyy-MM-dd\\'T\\'HH:mm:ss.SSSSSS"
        return (
            f"to_json(struct({slot}), map('ignoreNullFields', 'false', "
            f"'timestampFormat', '{micros}XXX', 'timestampNTZFormat', '{micros}'))"
        )
    return f"cast({slot} as string)"


def value_counts(df: DataFrame, columns) -> DataFrame:
    """``column, value, rows``: the rows per distinct value of each column.

    Values are text here, so that counts of several columns, or of several parts
    of a dataset, come together in one table.
    """
    columns = require_columns(columns, "column to check for uniqueness")
    parts = []
    for start in range(0, len(columns), _COLUMNS_PER_SCAN):
        chunk = columns[start : start + _COLUMNS_PER_SCAN]
        whens = [
            (f"when {_grouping_number(i, len(chunk))} then", name, f"c{i}")
            for i, name in enumerate(chunk)
        ]
        named = " ".join(f"{when} {sql_text(name)}" for when, name, _ in whens)
        texts = " ".join(
            f"{when} {_telling_text(df, name, slot)}" for when, name, slot in whens
        )
        parts.append(
            _value_counts(df, chunk).selectExpr(
                f"case which {named} end as column",
                f"case which {texts} end as value",
                "rows",
            )
        )
    return union_all(parts)


def repeated_values(counts: DataFrame) -> DataFrame:
    """``column, records, repeated`` out of the value counts of all parts."""
    return (
        counts.groupBy("column", "value")
        .agg(F.sum("rows").alias("rows"))
        .groupBy("column")
        .agg(
            F.sum("rows").alias("records"),
            F.count_if(F.col("rows") > 1).alias("repeated"),
        )
    )
