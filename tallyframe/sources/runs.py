"""Publishing by run: a run that is repeated replaces its rows, and half a run is not seen.

A run's rows are in a folder of their own, which a repeat overwrites, also where it has
no rows any more. A marker beside them says ``open`` before they are written and
``committed`` with their number after, so readers see whole runs only.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallyframe.sources.readers import Schema

_RUN_NAME = re.compile(r"[A-Za-z0-9][A-Za-z0-9._-]*")
_MARKER = "state string, rows bigint"


def _folders(path: str, run_id: str) -> tuple[str, str]:
    if not _RUN_NAME.fullmatch(run_id):
        raise ValueError(f"run {run_id!r} may have letters, digits, dots, dashes and underscores")
    root = path.rstrip("/")
    return f"{root}/rows/run_id={run_id}", f"{root}/runs/run_id={run_id}"


def _mark(spark: SparkSession, folder: str, state: str, rows: int | None) -> None:
    marker = spark.createDataFrame([(state, rows)], _MARKER).coalesce(1)
    marker.write.mode("overwrite").parquet(folder)


def publish_run(
    df: DataFrame, path: str, run_id: str, *, format_name: str = "parquet", **options
) -> int:
    """Write the rows as those of a run, in place of what it published before.

    Gives the number of rows. A failure at any point leaves the run out of what
    :func:`read_runs` gives until it is published again.
    """
    rows, marker = _folders(path, run_id)
    _mark(df.sparkSession, marker, "open", None)
    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    if format_name == "csv":
        options = {"header": True} | options
    counted.write.mode("overwrite").format(format_name).options(**options).save(rows)
    written = seen.get["rows"]
    _mark(df.sparkSession, marker, "committed", written)
    return written


def runs_of(spark: SparkSession, path: str) -> DataFrame:
    """``run_id, state, rows`` of every run that was begun."""
    root = path.rstrip("/")
    marks = spark.read.schema(f"{_MARKER}, run_id string").option("basePath", f"{root}/runs")
    return marks.parquet(f"{root}/runs/run_id=*").select("run_id", "state", "rows")


def read_runs(
    spark: SparkSession, path: str, schema: Schema, *, format_name: str = "parquet", **options
) -> DataFrame:
    """The rows of all committed runs with their ``run_id``, under a schema."""
    if format_name == "csv":
        options = {"header": True} | options
    root = path.rstrip("/")
    columns = spark.createDataFrame([], schema).schema.add("run_id", "string")
    rows = spark.read.schema(columns).format(format_name).options(**options)
    committed = runs_of(spark, path).filter("state = 'committed'").select("run_id")
    return rows.load(f"{root}/rows").join(committed, "run_id", "left_semi").select(*columns.names)
