"""Checks on a stream, one micro-batch at a time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyframe.functions.columns import column_of, find_field, split_columns
from tallyframe.operators.quality import null_value_check, repeated_values, value_counts
from tallyframe.results import COUNT, UNIQUE, Names, result_row, spread, union_all

_VALUE_COUNTS = "column string, value string, rows bigint"


def _folders(results_path: str) -> tuple[str, str]:
    root = results_path.rstrip("/")
    return f"{root}/checks", f"{root}/values"


def check_stream(
    stream: DataFrame,
    results_path: str,
    checkpoint_path: str,
    *,
    keys=None,
    null_columns=None,
    unique_columns=None,
    names: Names = Names(),
    trigger: dict | None = None,
) -> StreamingQuery:
    """Write the checks of every micro-batch below ``results_path``.

    ``checks/batch_id=n`` holds the number of records, under the name of the key
    columns, and the missing values per column. ``values/batch_id=n`` holds the
    rows per value of the columns that have to be unique, since a value may repeat
    in another batch. A batch that runs again after a failure replaces its own
    folders, so nothing counts twice. :func:`stream_totals` adds it all up.
    """
    keys, null_columns = split_columns(keys), split_columns(null_columns)
    unique_columns = split_columns(unique_columns)
    if not null_columns and not unique_columns:
        raise ValueError("no columns to check")
    checks, values = _folders(results_path)

    def check_batch(batch: DataFrame, batch_id: int) -> None:
        # Read once, whatever the number of checks.
        batch = batch.select(*{find_field(batch, c).name: column_of(batch, c) for c in [*null_columns, *unique_columns]}.values())
        held = batch.persist()
        try:
            counted = result_row(
                COUNT, names, "0", ",".join(keys) or "*", target_records="records"
            )
            parts = [spread(held.selectExpr("count(1) as records"), [counted])]
            if null_columns:
                parts.append(null_value_check(held, null_columns, names))
            union_all(parts).coalesce(1).write.mode("overwrite").parquet(
                f"{checks}/batch_id={batch_id}"
            )
            values_of = (
                value_counts(held, unique_columns)
                if unique_columns
                else held.sparkSession.createDataFrame([], _VALUE_COUNTS)
            )
            values_of.write.mode("overwrite").parquet(f"{values}/batch_id={batch_id}")
        finally:
            held.unpersist()

    return (
        stream.writeStream.foreachBatch(check_batch)
        .option("checkpointLocation", checkpoint_path)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def stream_totals(
    spark: SparkSession, results_path: str, source_records: int | None = None
) -> DataFrame:
    """Records and failures per check and column over all batches so far.

    The result depends on the records alone, not on how they fell into batches.
    With ``source_records`` the count check fails by the difference to it.
    """
    checks, values = _folders(results_path)
    summed = (
        spark.read.parquet(checks)
        .groupBy("tc_id", "test_case_name", "column")
        .agg(
            F.sum("target_records").alias("target_records"),
            F.sum("failed_records").alias("failed_records"),
        )
    )
    if source_records is not None:
        apart = F.abs(F.col("target_records") - F.lit(source_records))
        summed = summed.withColumn(
            "failed_records",
            F.when(F.col("tc_id") == COUNT.tc_id, apart).otherwise(
                F.col("failed_records")
            ),
        )
    unique = repeated_values(
        spark.read.schema(_VALUE_COUNTS).parquet(values)
    ).select(
        F.lit(UNIQUE.tc_id).alias("tc_id"),
        F.lit(UNIQUE.name).alias("test_case_name"),
        "column",
        F.col("records").alias("target_records"),
        F.col("repeated").alias("failed_records"),
    )
    return summed.unionByName(unique)
