"""Writing datasets and result tables."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame

from tallyframe.sources.readers import CONNECTION_KEYS


def write_csv(df: DataFrame, path: str, *, mode: str = "overwrite", **options) -> None:
    """CSV with a header; ``mode`` is ``append`` or ``overwrite``."""
    df.write.mode(mode).options(header=True, **options).csv(path)


def jdbc_write_options(connection: Mapping[str, Any], table: str) -> dict[str, str]:
    """Writer options. Settings such as ``batchsize`` and ``numPartitions``, which
    bounds the number of open connections, come from the connection."""
    missing = [key for key in CONNECTION_KEYS if connection.get(key) is None]
    if missing:
        raise ValueError(f"connection lacks {missing}")
    return {k: str(v) for k, v in connection.items() if v is not None} | {
        "dbtable": table
    }


def write_table(
    df: DataFrame,
    connection: Mapping[str, Any],
    table: str,
    *,
    mode: str = "overwrite",
) -> None:
    """Write to a table behind JDBC, by default in place of what it holds."""
    options = jdbc_write_options(connection, table)
    df.write.mode(mode).format("jdbc").options(**options).save()


def write_results(results: DataFrame, path: str, *, mode: str = "append") -> None:
    """Publish a result table, which has a row per check, as one CSV file."""
    write_csv(results.repartition(1), path, mode=mode)
