"""The contact pipeline, raw to bronze to silver, and its validation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.functions.columns import column_of
from tallyframe.functions.text import (
    drop_characters,
    fill_right,
    mask_characters,
    whole_number,
)
from tallyframe.operators.transforms import unpivot_history

# The columns of a contact, in order.
CONTACT_COLUMNS = (
    "Identifier",
    "Surname",
    "given_name",
    "middle_initial",
    "suffix",
    "Primary_street_number",
    "primary_street_name",
    "city",
    "state",
    "zipcode",
    "Primary_street_number_prev",
    "primary_street_name_prev",
    "city_prev",
    "state_prev",
    "zipcode_prev",
    "Email",
    "Phone",
    "birthmonth",
)
CONTACT_KEY = ("Identifier",)
SILVER_KEY = ("Identifier", "Current_ind")

# The address columns, which keep their previous version beside
# them, and the silver columns around them.
ADDRESS_COLUMNS = (
    "Primary_street_number",
    "primary_street_name",
    "city",
    "state",
    "zipcode",
)
SILVER_COLUMNS = (
    "Identifier",
    "Surname",
    "given_name",
    "middle_initial",
    *ADDRESS_COLUMNS,
    "Email",
    "Phone",
    "birthmonth",
    "Current_ind",
)


def raw_to_bronze(
    raw: DataFrame, *, mask_email: str | None = None, numeric_zipcode: bool = False
) -> DataFrame:
    """Typed and tidied contacts.

    ``mask_email`` lists characters to hide in e-mail addresses.
    ``numeric_zipcode`` also casts the current zip code to a number.
    """
    changed = {
        "Identifier": whole_number,
        "Surname": F.upper,
        "given_name": F.upper,
        "middle_initial": F.upper,
        "Phone": lambda column: drop_characters(column, "+-"),
        "birthmonth": lambda column: fill_right(column, 8),
    }
    if mask_email:
        changed["Email"] = lambda column: mask_characters(column, mask_email)
    if numeric_zipcode:
        changed["zipcode"] = whole_number
    return raw.select(
        *[
            changed.get(name, lambda column: column)(column_of(raw, name)).alias(name)
            for name in CONTACT_COLUMNS
        ]
    )


def bronze_to_silver(bronze: DataFrame) -> DataFrame:
    """Current and previous addresses as rows of their own, flagged ``Y`` and ``N``."""
    silver = unpivot_history(
        bronze,
        common=[
            name
            for name in SILVER_COLUMNS
            if name not in ADDRESS_COLUMNS and name != "Current_ind"
        ],
        versions={
            "Y": {name: name for name in ADDRESS_COLUMNS},
            "N": {name: f"{name}_prev" for name in ADDRESS_COLUMNS},
        },
        flag="Current_ind",
    )
    return silver.select(*SILVER_COLUMNS)
