"""Looking at failures: the rows behind failing keys, and a few samples."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.functions.columns import (
    column_of,
    find_field,
    ref,
    require_columns,
    trimmed_text,
)


def drill_down(df: DataFrame, failing: DataFrame, keys) -> DataFrame:
    """All rows of ``df`` whose key is among the failing ones.

    Text keys, and keys of different types, meet as trimmed text, the form in
    which the column comparison reports them. A key with a null part equals
    nothing.
    """
    keys = require_columns(keys, "key column")
    slots = [f"__failing_{i}" for i in range(len(keys))]
    wanted = failing.select(
        *[column_of(failing, key).alias(slot) for key, slot in zip(keys, slots)]
    ).distinct()
    condition = F.lit(True)
    for key, slot in zip(keys, slots):
        mine, type_here = column_of(df, key), find_field(df, key).dataType
        type_there = find_field(wanted, slot).dataType
        if type_here != type_there or isinstance(type_here, T.StringType):
            condition = condition & (trimmed_text(mine) == trimmed_text(ref(slot)))
        else:
            condition = condition & (mine == ref(slot))
    return df.join(wanted, condition, "left_semi")


def sample_failures(failures: DataFrame, order_by=None, count: int = 10) -> DataFrame:
    """The first failing rows in the order given, by default that of all columns."""
    if not order_by:
        return failures.orderBy(*[ref(name) for name in failures.columns]).limit(count)
    order = require_columns(order_by, "column to order by")
    return failures.orderBy(*[column_of(failures, name) for name in order]).limit(count)
