"""Schemas of the result table and of the test plan."""

from __future__ import annotations

from pyspark.sql import types as T

RESULT_SCHEMA = T.StructType(
    [
        T.StructField("tc_id", T.IntegerType()),
        T.StructField("test_case_name", T.StringType()),
        T.StructField("source_name", T.StringType()),
        T.StructField("target_name", T.StringType()),
        T.StructField("source_records", T.LongType()),
        T.StructField("target_records", T.LongType()),
        T.StructField("failed_records", T.LongType()),
        T.StructField("column", T.StringType()),
        T.StructField("status", T.StringType()),
    ]
)

# The columns of a test plan, all text.
PLAN_LOCATION_COLUMNS = (
    "source",
    "source_type",
    "source_db_name",
    "source_transformation_query_path",
    "target",
    "target_type",
    "target_db_name",
    "target_transformation_query_path",
    "key_col_list",
    "null_col_list",
    "unique_col_list",
)
PLAN_CHECK_COLUMN = "validation_Type"
PLAN_ACTIVE_COLUMN = "execution_ind"

PLAN_SCHEMA = T.StructType(
    [
        T.StructField(name, T.StringType())
        for name in (*PLAN_LOCATION_COLUMNS, PLAN_CHECK_COLUMN, PLAN_ACTIVE_COLUMN)
    ]
)

# Headings of the published summary, in the order of RESULT_SCHEMA.
PUBLISHED_HEADINGS = (
    "TC_ID",
    "test_Case_Name",
    "Source_name",
    "target_name",
    "Number_of_source_Records",
    "Number_of_target_Records",
    "Number_of_failed_Records",
    "column",
    "Status",
)
