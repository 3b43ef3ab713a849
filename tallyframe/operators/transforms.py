"""Reshaping datasets before they are checked."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.functions.columns import column_of, ref, require_columns, trimmed_text


def trim_columns(df: DataFrame, columns=None) -> DataFrame:
    """The given columns, by default all, as text without blanks around it."""
    # Names taken from the frame are used as they are, blanks around them included.
    names = require_columns(columns, "column") if columns else df.columns
    wanted = {name.lower() for name in names}
    return df.select(
        *[
            trimmed_text(ref(name)).alias(name) if name.lower() in wanted else ref(name)
            for name in df.columns
        ]
    )


def flatten(df: DataFrame) -> DataFrame:
    """Expand structs and arrays until none is left.

    A struct gives way to one column per field, named ``struct_field`` and put
    last. An array gives one row per element, and one row with null when it is
    empty or null; several arrays therefore multiply. Maps stay as they are.
    """
    while True:
        nested = next(
            (
                field
                for field in df.schema.fields
                if isinstance(field.dataType, (T.StructType, T.ArrayType))
            ),
            None,
        )
        if nested is None:
            return df
        if isinstance(nested.dataType, T.ArrayType):
            df = df.select(
                *[
                    F.explode_outer(ref(name)).alias(name)
                    if name == nested.name
                    else ref(name)
                    for name in df.columns
                ]
            )
            continue
        kept = [name for name in df.columns if name != nested.name]
        fields = nested.dataType.names
        clash = {f"{nested.name}_{name}" for name in fields} & set(kept)
        if clash:
            raise ValueError(f"flattening {nested.name!r} repeats columns {clash}")
        df = df.select(
            *[ref(name) for name in kept],
            *[
                ref(nested.name).getField(name).alias(f"{nested.name}_{name}")
                for name in fields
            ],
        )


def unpivot_history(
    df: DataFrame,
    common: Sequence[str],
    versions: Mapping[str, Mapping[str, str]],
    flag: str,
) -> DataFrame:
    """Distinct rows, one per version of the columns that have a history.

    ``versions`` gives per flag value the column to read for each output column.
    All versions come from one read of the data. Columns that meet in one output
    column but differ in type are brought together as text.
    """
    outputs = list(next(iter(versions.values())))
    types = {
        out: {df.select(column_of(df, v[out])).dtypes[0][1] for v in versions.values()}
        for out in outputs
    }

    def value(name: str, out: str):
        column = column_of(df, name)
        return column if len(types[out]) == 1 else column.cast("string")

    rows = [
        F.struct(
            *[value(columns[out], out).alias(out) for out in outputs],
            F.lit(mark).alias(flag),
        )
        for mark, columns in versions.items()
    ]
    return df.select(
        *[column_of(df, name).alias(name) for name in common], F.inline(F.array(*rows))
    ).distinct()
