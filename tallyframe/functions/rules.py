"""The rule that says which values count as missing."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Texts that mark a missing value wherever they occur, by case.
NULL_MARKERS = ("None", "NULL", "Null")


def null_like(column: Column, data_type: T.DataType) -> Column:
    """True where a value is null, or stands for null; never null itself.

    Text counts when it holds one of the markers, is empty, or reads as NaN.
    Blanks do not count. Floating point counts NaN; other types only null.
    """
    if isinstance(data_type, (T.StringType, T.CharType, T.VarcharType)):
        marked = reduce(or_, (column.contains(marker) for marker in NULL_MARKERS))
        # The cast fails slowly on ordinary words, so only likely texts reach it.
        not_a_number = F.lower(column).contains("nan") & F.isnan(
            column.try_cast("double")
        )
        present = marked | (column == "") | F.coalesce(not_a_number, F.lit(False))
        return column.isNull() | F.coalesce(present, F.lit(False))
    if isinstance(data_type, (T.FloatType, T.DoubleType)):
        return column.isNull() | F.isnan(column)
    return column.isNull()
