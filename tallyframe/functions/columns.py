"""Column lists, column references and the value forms used for comparing."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Types whose equality is the same as the equality of their text, so that two
# columns of one such type can be compared without being turned into strings.
_TEXT_FAITHFUL = (
    T.ByteType,
    T.ShortType,
    T.IntegerType,
    T.LongType,
    T.DecimalType,
    T.BooleanType,
    T.DateType,
    T.TimestampNTZType,
)


def split_columns(columns: str | Iterable[str] | None) -> list[str]:
    """``"a, b"`` or ``["a", " b"]`` as ``["a", "b"]``; blanks are dropped."""
    if columns is None:
        return []
    parts = columns.split(",") if isinstance(columns, str) else columns
    return [name for name in (part.strip() for part in parts) if name]


def require_columns(columns: str | Iterable[str] | None, what: str) -> list[str]:
    names = split_columns(columns)
    if not names:
        raise ValueError(f"no {what} given")
    return names


def ref(name: str) -> Column:
    """Reference to a top-level column, whatever characters its name holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def sql_text(value: str | None) -> str:
    """A string as SQL literal."""
    if value is None:
        return "cast(null as string)"
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def find_field(df: DataFrame, name: str) -> T.StructField:
    """The field called ``name``, by exact name first and then ignoring case."""
    for field in df.schema.fields:
        if field.name == name:
            return field
    near = [f for f in df.schema.fields if f.name.lower() == name.lower()]
    if len(near) == 1:
        return near[0]
    reason = "is ambiguous" if near else "does not exist"
    raise ValueError(f"column {name!r} {reason}; columns are {df.columns}")


def column_of(df: DataFrame, name: str) -> Column:
    return ref(find_field(df, name).name)


def same_name(name: str, names: Sequence[str]) -> bool:
    return name.lower() in {other.lower() for other in names}


def balanced(operator, columns: Sequence[Column]) -> Column:
    """Columns joined by an operator as a shallow tree, however many there are."""
    if len(columns) == 1:
        return columns[0]
    half = len(columns) // 2
    return operator(
        balanced(operator, columns[:half]), balanced(operator, columns[half:])
    )


def trimmed_text(column: Column) -> Column:
    return F.trim(column.cast("string"))


def is_native(source: DataFrame, target: DataFrame, name: str) -> bool:
    """Whether a column has one type on both sides that needs no turning into text."""
    left, right = find_field(source, name), find_field(target, name)
    return left.dataType == right.dataType and isinstance(left.dataType, _TEXT_FAITHFUL)


def shared_form(
    source: DataFrame, target: DataFrame, name: str
) -> tuple[Column, Column]:
    """Both sides of a column in one type, equal exactly when the trimmed texts are."""
    left, right = find_field(source, name), find_field(target, name)
    if is_native(source, target, name):
        return ref(left.name), ref(right.name)
    return trimmed_text(ref(left.name)), trimmed_text(ref(right.name))


def shared_key(
    source: DataFrame, target: DataFrame, name: str
) -> tuple[Column, Column]:
    """Both sides of an untrimmed key in types that a union can bring together.

    Equal types and pairs of numeric types stay as they are. Anything else, such
    as text against a number, is compared as text.
    """
    left, right = find_field(source, name), find_field(target, name)
    numeric = isinstance(left.dataType, T.NumericType) and isinstance(
        right.dataType, T.NumericType
    )
    if left.dataType == right.dataType or numeric:
        return ref(left.name), ref(right.name)
    return ref(left.name).cast("string"), ref(right.name).cast("string")
