from tallyframe.plans.increment import Changes, read_derived, update_derived
from tallyframe.plans.medallion import bronze_to_silver, raw_to_bronze
from tallyframe.plans.runner import (
    Environment,
    active_cases,
    grouped_cases,
    read_plan,
    run_cases,
    run_plan,
)
from tallyframe.plans.suite import ALL_CHECKS, Figures, validate

__all__ = [
    "ALL_CHECKS",
    "Changes",
    "Environment",
    "Figures",
    "active_cases",
    "bronze_to_silver",
    "grouped_cases",
    "raw_to_bronze",
    "read_derived",
    "read_plan",
    "run_cases",
    "run_plan",
    "update_derived",
    "validate",
]
