"""Running a test plan: a table that names pairs of datasets and their checks."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from tallyframe.functions.columns import column_of, find_field, ref, split_columns
from tallyframe.functions.rules import null_like
from tallyframe.operators.compare import CompareOptions
from tallyframe.plans.suite import Figures, checks_named, validate
from tallyframe.results import NULLS, Names, union_all
from tallyframe.schema import (
    PLAN_ACTIVE_COLUMN,
    PLAN_CHECK_COLUMN,
    PLAN_LOCATION_COLUMNS,
    PLAN_SCHEMA,
)
from tallyframe.sources.readers import read_csv, read_data, read_json
from tallyframe.sources.scratch import stored

# Types whose rows are found again from scratch by every scan, all columns of them.
_WHOLE_ROW_TYPES = ("csv", "json", "table")


def read_plan(spark: SparkSession, format_name: str, path: str) -> DataFrame:
    """A test plan from a CSV, JSON or Parquet file, or from a view or table."""
    kind = format_name.strip().lower()
    if kind == "csv":
        plan = read_csv(spark, path)
    elif kind == "json":
        plan = read_json(spark, path, schema=PLAN_SCHEMA)
    else:
        plan = read_data(spark, kind, path)
    return plan.select(*[ref(name).cast("string") for name in PLAN_SCHEMA.names])


def active_cases(plan: DataFrame) -> DataFrame:
    return plan.filter(ref(PLAN_ACTIVE_COLUMN) == "Y")


def grouped_cases(
    plan: DataFrame,
    by: Sequence[str] = PLAN_LOCATION_COLUMNS,
    check_column: str = PLAN_CHECK_COLUMN,
) -> DataFrame:
    """One row per pair of datasets, with the set of its checks in order.

    Plans of another layout name the columns that tell pairs apart.
    """
    return plan.groupBy(*[ref(name) for name in by]).agg(
        F.sort_array(F.collect_set(ref(check_column))).alias(check_column)
    )


@dataclass(frozen=True)
class Environment:
    """What a plan refers to by name.

    connections  options of each named connection
    data_root    folder that file names are relative to
    query_root   folder that query files are relative to
    readers      reader options of a dataset, such as ``delimiter``, ``multiline`` or
                 ``schema``, under the name by which the plan calls it
    store_rows   keep a stored copy of datasets whose format has to be read whole
                 by every check, so that each is read once, whatever the number of
                 cases; by default for datasets with several checks
    """

    connections: Mapping[str, Mapping[str, Any]] = field(default_factory=dict)
    data_root: str = ""
    query_root: str = ""
    readers: Mapping[str, Mapping[str, Any]] = field(default_factory=dict)
    store_rows: bool | None = None


def _under(root: str, path: str | None) -> str | None:
    if not path or not root or path.startswith("/") or "://" in path:
        return path
    return f"{root.rstrip('/')}/{path}"


def _place_of(case: Row, side: str) -> tuple:
    """What tells the datasets of a plan apart."""
    return (
        case[f"{side}_type"].strip().lower(),
        *(case[f"{side}{rest}"] for rest in ("", "_db_name", "_transformation_query_path")),
    )


class _Datasets:
    """The datasets of a plan's cases, each read once if its format has to be read whole.

    Such a dataset is stored when the first case asks for it, if several checks of all
    cases do, and its rows and missing values are counted while it is written.
    """

    def __init__(self, spark: SparkSession, cases: Sequence[Row], env: Environment):
        self._spark, self._env = spark, env
        self._held: dict[tuple, tuple[DataFrame, Figures | None]] = {}
        self._checks: dict[tuple, int] = {}
        self._null_columns: dict[tuple, list[str]] = {}
        for case in cases:
            checks = checks_named(case[PLAN_CHECK_COLUMN])
            for place in {_place_of(case, side) for side in ("source", "target")}:
                self._checks[place] = self._checks.get(place, 0) + len(checks)
            if NULLS in checks:
                asked = self._null_columns.setdefault(_place_of(case, "target"), [])
                asked += [c for c in split_columns(case["null_col_list"]) if c not in asked]

    def read(self, case: Row, side: str) -> tuple[DataFrame, Figures | None]:
        place = _place_of(case, side)
        if place not in self._held:
            self._held[place] = self._read(place)
        return self._held[place]

    def _read(self, place: tuple) -> tuple[DataFrame, Figures | None]:
        kind, name, database, query_path = place
        df = read_data(
            self._spark,
            kind,
            name if kind in ("table", "view") else _under(self._env.data_root, name),
            connections=self._env.connections,
            database=database,
            query_path=_under(self._env.query_root, query_path),
            **self._env.readers.get(name, {}),
        )
        store = self._env.store_rows
        if store is None:
            store = self._checks[place] > 1
        if not store or kind not in _WHOLE_ROW_TYPES:
            return df, None
        columns = self._null_columns.get(place, [])
        seen = Observation()
        counts = [F.count(F.lit(1)).alias("records")]
        for i, column in enumerate(columns):
            missing = null_like(column_of(df, column), find_field(df, column).dataType)
            counts.append(F.count_if(missing).alias(f"missing_{i}"))
        held = stored(df.observe(seen, *counts))
        found = seen.get
        return held, Figures(found["records"], {c: found[f"missing_{i}"] for i, c in enumerate(columns)})


OptionsOfCase = CompareOptions | Callable[[Row], CompareOptions]


def run_cases(
    plan: DataFrame,
    env: Environment = Environment(),
    options: OptionsOfCase = CompareOptions(),
) -> Iterator[tuple[Row, DataFrame]]:
    """The grouped cases of a plan, each with its result table, one by one.

    ``options`` serve all cases, or are a function that gives those of a case.
    Only the plan's own rows come to the driver. To publish long plans case by
    case, append each result table as it comes.
    """
    spark = plan.sparkSession
    cases = grouped_cases(active_cases(plan)).orderBy(*PLAN_LOCATION_COLUMNS).collect()
    datasets = _Datasets(spark, cases, env)
    for case in cases:
        source, source_figures = datasets.read(case, "source")
        target, target_figures = datasets.read(case, "target")
        yield (
            case,
            validate(
                source,
                target,
                keys=case["key_col_list"],
                null_columns=case["null_col_list"],
                unique_columns=case["unique_col_list"],
                checks=case[PLAN_CHECK_COLUMN],
                names=Names(case["source"], case["target"]),
                options=options(case) if callable(options) else options,
                source_figures=source_figures,
                target_figures=target_figures,
            ),
        )


def run_plan(
    plan: DataFrame,
    env: Environment = Environment(),
    options: OptionsOfCase = CompareOptions(),
) -> DataFrame:
    """One result table for all active cases of a plan."""
    return union_all([results for _, results in run_cases(plan, env, options)])
