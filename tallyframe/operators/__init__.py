from tallyframe.operators.compare import (
    CompareOptions,
    Comparison,
    compare_columns,
    compare_one_column,
    data_compare,
    data_validation,
    failing_keys,
)
from tallyframe.operators.drilldown import drill_down, sample_failures
from tallyframe.operators.keys import (
    count_validation,
    duplicate_keys,
    duplicate_validation,
    key_checks,
    key_counts,
    only_in_source,
    only_in_source_validation,
    only_in_target,
    only_in_target_validation,
)
from tallyframe.operators.quality import null_value_check, uniqueness_check
from tallyframe.operators.shred import Tables, flatten_tables
from tallyframe.operators.transforms import flatten, trim_columns, unpivot_history
from tallyframe.operators.tree import TreeComparison, data_compare_tree
from tallyframe.results import union_all

__all__ = [
    "CompareOptions",
    "Comparison",
    "Tables",
    "TreeComparison",
    "compare_columns",
    "compare_one_column",
    "count_validation",
    "data_compare",
    "data_compare_tree",
    "data_validation",
    "drill_down",
    "duplicate_keys",
    "duplicate_validation",
    "failing_keys",
    "flatten",
    "flatten_tables",
    "key_checks",
    "key_counts",
    "null_value_check",
    "only_in_source",
    "only_in_source_validation",
    "only_in_target",
    "only_in_target_validation",
    "sample_failures",
    "trim_columns",
    "union_all",
    "uniqueness_check",
    "unpivot_history",
]
