from tallyframe.sources.readers import (
    MissingConnector,
    read_avro,
    read_csv,
    read_data,
    read_format,
    read_json,
    read_kafka_stream,
    read_parquet,
    read_table,
    read_text,
    register_view,
    schema_from_json,
)
from tallyframe.sources.rejects import Split, split_csv, split_json
from tallyframe.sources.runs import publish_run, read_runs, runs_of
from tallyframe.sources.writers import write_csv, write_results, write_table

__all__ = [
    "MissingConnector",
    "Split",
    "publish_run",
    "read_avro",
    "read_csv",
    "read_data",
    "read_format",
    "read_json",
    "read_kafka_stream",
    "read_parquet",
    "read_runs",
    "read_table",
    "read_text",
    "register_view",
    "runs_of",
    "schema_from_json",
    "split_csv",
    "split_json",
    "write_csv",
    "write_results",
    "write_table",
]
