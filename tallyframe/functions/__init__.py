from tallyframe.functions.columns import (
    column_of,
    find_field,
    ref,
    split_columns,
    trimmed_text,
)
from tallyframe.functions.rules import NULL_MARKERS, null_like
from tallyframe.functions.text import (
    drop_characters,
    fill_right,
    mask_characters,
    substring_of,
    whole_number,
)

__all__ = [
    "NULL_MARKERS",
    "column_of",
    "drop_characters",
    "fill_right",
    "find_field",
    "mask_characters",
    "null_like",
    "ref",
    "split_columns",
    "substring_of",
    "trimmed_text",
    "whole_number",
]
