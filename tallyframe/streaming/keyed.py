"""Checks on the keys of streams that need what went by before: kept as Spark's state.

State is held per key and span of event time, and given up once the watermark has
passed the span, so it is bounded by the keys of the time that ``delay`` and the span
cover, not by the length of the stream. All of it is done by Spark's own stateful
operators: partial counts collapse a hot key in the map tasks before they reach the
state store, and the same functions work on a bounded dataset.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyframe.functions.columns import column_of, ref, require_columns, shared_key
from tallyframe.operators.keys import any_null

_TIME, _SPAN, _LONE = "__event_time", "__span", "__lone"


def _timed(df: DataFrame, event_time: str, delay: str, columns) -> DataFrame:
    """The columns and the event time, whose watermark is ``delay`` behind the latest."""
    moment = column_of(df, event_time).cast("timestamp").alias(_TIME)
    return df.select(*columns, moment).withWatermark(_TIME, delay)


def stream_duplicate_keys(
    stream: DataFrame, keys, event_time: str, *, within: str = "1 hour", delay: str = "10 minutes"
) -> DataFrame:
    """``keys, first, last, rows``: stretches of time in which a key stands in several rows.

    Rows of a key belong to one stretch as long as each follows the one before by no more
    than ``within``. A stretch comes out once, when the watermark, ``delay`` behind the
    latest event, has passed its last row by ``within``; its state goes then. Rows that
    come later than that are dropped, and rows without an event time never count. Null
    is a key like any other.
    """
    keys = require_columns(keys, "key column")
    timed = _timed(stream, event_time, delay, [column_of(stream, key).alias(key) for key in keys])
    return (
        timed.groupBy(F.session_window(_TIME, within).alias(_SPAN), *[ref(key) for key in keys])
        .agg(F.min(_TIME).alias("first"), F.max(_TIME).alias("last"), F.count(F.lit(1)).alias("rows"))
        .filter("rows > 1")
        .select(*[ref(key) for key in keys], "first", "last", "rows")
    )


def stream_key_counts(
    source: DataFrame, target: DataFrame, keys, event_time: str, *, window: str = "1 hour", delay: str = "10 minutes"
) -> DataFrame:
    """``window_start, keys, source_count, target_count`` per window of event time and key.

    Both streams are counted per window and key first, so the outer join that follows has
    one row a side for each and never a pair of rows; it holds a side's row until the
    watermark, ``delay`` behind the slower stream, has passed the window. A side without
    the key counts null. A key with a null part equals no key of the other side.
    """
    keys = require_columns(keys, "key column")
    forms = [shared_key(source, target, key) for key in keys]

    def counted(df: DataFrame, side: int, label: str) -> DataFrame:
        named = [form[side].alias(key) for form, key in zip(forms, keys)]
        timed = _timed(df, event_time, delay, named)
        rows = timed.groupBy(F.window(_TIME, window).alias(_SPAN), *[ref(key) for key in keys])
        counts = rows.agg(F.count(F.lit(1)).alias(f"{label}_count"))
        # Joins of streams lose rows with a null on the key, so that a mark parts these.
        counts = counts.withColumn(_LONE, F.when(any_null([ref(key) for key in keys]), F.lit(label)).otherwise(""))
        return counts.withColumnsRenamed({name: f"{label}_{name}" for name in [_SPAN, _LONE, *keys]})

    met = counted(source, 0, "source").join(
        counted(target, 1, "target"),
        [ref(f"source_{name}") == ref(f"target_{name}") for name in (_SPAN, _LONE)]
        + [ref(f"source_{key}").eqNullSafe(ref(f"target_{key}")) for key in keys],
        "full_outer",
    )
    either = {name: F.coalesce(ref(f"source_{name}"), ref(f"target_{name}")) for name in [_SPAN, *keys]}
    return met.select(
        either[_SPAN]["start"].alias("window_start"), *[either[key].alias(key) for key in keys],
        "source_count", "target_count",
    )


def stream_only_in_source(source: DataFrame, target: DataFrame, keys, event_time: str, **spans) -> DataFrame:
    """Keys of a window that the target lacks there, with their number of source rows."""
    counts = stream_key_counts(source, target, keys, event_time, **spans)
    return counts.filter(F.col("target_count").isNull()).drop("target_count")


def stream_only_in_target(source: DataFrame, target: DataFrame, keys, event_time: str, **spans) -> DataFrame:
    """Keys of a window that the source lacks there, with their number of target rows."""
    counts = stream_key_counts(source, target, keys, event_time, **spans)
    return counts.filter(F.col("source_count").isNull()).drop("source_count")


def publish_stream(
    found: DataFrame, results_path: str, checkpoint_path: str, *, trigger: dict | None = None
) -> StreamingQuery:
    """Append what a check on keys finds to a Parquet folder, each row once.

    The folder has a log of its batches, so a batch that runs again after a failure does
    not double its rows. A later run goes on where the checkpoint ends, state included.
    """
    return (
        found.writeStream.outputMode("append")
        .format("parquet")
        .option("path", results_path)
        .option("checkpointLocation", checkpoint_path)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
