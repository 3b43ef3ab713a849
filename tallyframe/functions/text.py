"""Scalar text functions of the medallion projections."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def mask_characters(column: Column, characters: str, mark: str = "*") -> Column:
    """Replace every listed character, in this case only, wherever it occurs."""
    return F.translate(column, characters, mark * len(characters))


def drop_characters(column: Column, characters: str) -> Column:
    return F.translate(column, characters, "")


def fill_right(column: Column, width: int, fill: str = "0") -> Column:
    """Exactly ``width`` characters: shorter text is filled, longer text is cut."""
    return F.rpad(column, width, fill)


def whole_number(column: Column, digits: int = 10) -> Column:
    """Rounded ``decimal(digits, 0)``; null where the text does not fit."""
    return column.try_cast(f"decimal({digits},0)")


def substring_of(start: int, length: int):
    """Normalizer that compares only a part of a value."""
    return lambda column: F.substring(column, start, length)
