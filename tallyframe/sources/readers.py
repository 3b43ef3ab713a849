"""Reading datasets: files, tables behind JDBC, registered views and streams."""

from __future__ import annotations

import json
from collections.abc import Mapping
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import types as T

Schema = T.StructType | str


class MissingConnector(RuntimeError):
    """The format needs a package that this session was started without."""


def schema_from_json(spark: SparkSession, path: str) -> T.StructType:
    """The schema stored as JSON text at ``path``, any file system Spark reads."""
    return T.StructType.fromJson(json.loads(read_text(spark, path)))


def read_text(spark: SparkSession, path: str) -> str:
    """One small text file, such as a query or a schema; several files are an error."""
    rows = spark.read.text(path, wholetext=True).limit(2).collect()
    if len(rows) != 1:
        raise ValueError(f"{path} has no text" if not rows else f"{path} is more than one file")
    return rows[0]["value"]


def _reader(spark: SparkSession, schema: Schema | None) -> DataFrameReader:
    return spark.read if schema is None else spark.read.schema(schema)


def read_csv(spark, path, *, delimiter=",", schema: Schema | None = None, **options):
    """CSV with a header. Without a schema every column is text."""
    return (
        _reader(spark, schema)
        .options(header=True, delimiter=delimiter, **options)
        .csv(path)
    )


def read_json(
    spark, path, *, multiline=False, schema: Schema | None = None, **options
) -> DataFrame:
    """JSON, one record per line, or with ``multiline`` one value per file.

    Without a schema the data is read twice, as the schema is found first; a
    multi-line file cannot be split, so each is read by one task.
    """
    return _reader(spark, schema).options(multiLine=bool(multiline), **options).json(path)


def read_parquet(spark, path, *, schema: Schema | None = None, **options) -> DataFrame:
    return _reader(spark, schema).options(**options).parquet(path)


def read_format(
    spark, format_name, path, *, schema: Schema | None = None, **options
) -> DataFrame:
    """Any format that the session has a data source for."""
    reader = _reader(spark, schema).format(format_name).options(**options)
    return _or_missing(format_name, lambda: reader.load(path))


def read_avro(spark, path, *, schema: Schema | None = None, **options) -> DataFrame:
    return read_format(spark, "avro", path, schema=schema, **options)


def _or_missing(format_name: str, load):
    try:
        return load()
    except AnalysisException as error:
        if "Failed to find data source" in str(error) or (
            error.getCondition() == "DATA_SOURCE_NOT_FOUND"
        ):
            raise MissingConnector(
                f"no data source for {format_name!r} here; start the session with "
                f"its package"
            ) from error
        raise


# -- tables behind JDBC ------------------------------------------------------

# What a named connection must say.
CONNECTION_KEYS = ("url", "user", "password", "driver")
PARTITION_OPTIONS = ("partitionColumn", "lowerBound", "upperBound", "numPartitions")


def jdbc_options(connection: Mapping[str, Any], query: str) -> dict[str, str]:
    """Reader options for a query that the database runs.

    A connection that also names a partition column and its bounds is read by
    many tasks, for which the query has to stand as a derived table.
    """
    missing = [key for key in CONNECTION_KEYS if connection.get(key) is None]
    if missing:
        raise ValueError(f"connection lacks {missing}")
    options = {key: str(value) for key, value in connection.items() if value is not None}
    text = query.strip().rstrip(";").strip()
    partitioned = [name for name in PARTITION_OPTIONS if name in options]
    if not partitioned:
        return options | {"query": text}
    if len(partitioned) < len(PARTITION_OPTIONS):
        raise ValueError(f"a partitioned read needs all of {PARTITION_OPTIONS}")
    return options | {"dbtable": f"({text}) q"}


def read_table(
    spark: SparkSession,
    connection: Mapping[str, Any],
    *,
    query: str | None = None,
    query_path: str | None = None,
) -> DataFrame:
    """The result of a query, given as text or as the path of a file with it."""
    if (query is None) == (query_path is None):
        raise ValueError("give either query or query_path")
    text = query if query is not None else read_text(spark, query_path)
    return spark.read.format("jdbc").options(**jdbc_options(connection, text)).load()


# -- streams -----------------------------------------------------------------


def kafka_options(servers: str, topic: str, headers: bool = True) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "includeHeaders": str(headers).lower(),
    }


def read_kafka_stream(
    spark: SparkSession, servers: str, topic: str, *, headers: bool = True, **options
) -> DataFrame:
    """An unbounded dataset of the records of one topic, headers included."""
    reader = (
        spark.readStream.format("kafka")
        .options(**kafka_options(servers, topic, headers))
        .options(**options)
    )
    return _or_missing("kafka", reader.load)


# -- by name -----------------------------------------------------------------

_FILE_READERS = {
    "csv": read_csv,
    "json": read_json,
    "parquet": read_parquet,
    "avro": read_avro,
}


def read_data(
    spark: SparkSession,
    format_name: str,
    path: str | None = None,
    *,
    connections: Mapping[str, Mapping[str, Any]] | None = None,
    database: str | None = None,
    query: str | None = None,
    query_path: str | None = None,
    **options,
) -> DataFrame:
    """Read by type name, in any case.

    ``table`` runs a query on a named connection, ``view`` takes a view or table
    that the session knows, and any file type reads ``path``.
    """
    kind = format_name.strip().lower()
    if kind == "table":
        if not connections or database not in connections:
            raise ValueError(f"no connection named {database!r}")
        return read_table(
            spark, connections[database], query=query, query_path=query_path
        )
    if kind == "view":
        return spark.table(path)
    if kind not in _FILE_READERS:
        known = sorted([*_FILE_READERS, "table", "view"])
        raise ValueError(f"unknown type {format_name!r}; known are {known}")
    return _FILE_READERS[kind](spark, path, **options)


def register_view(df: DataFrame, name: str) -> DataFrame:
    """Make a dataset known to SQL under a name, replacing an earlier one."""
    df.createOrReplaceTempView(name)
    return df
