"""Source and target data validation on Spark."""

from tallyframe.operators.compare import CompareOptions
from tallyframe.plans.runner import Environment, run_plan
from tallyframe.plans.suite import ALL_CHECKS, validate
from tallyframe.results import Names, as_published, as_published_short
from tallyframe.schema import PLAN_SCHEMA, RESULT_SCHEMA

__all__ = [
    "ALL_CHECKS",
    "CompareOptions",
    "Environment",
    "Names",
    "PLAN_SCHEMA",
    "RESULT_SCHEMA",
    "as_published",
    "as_published_short",
    "run_plan",
    "validate",
]
