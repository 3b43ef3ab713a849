"""Checks on the keys of streams: state, watermarks and eviction."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tallyframe.streaming import (
    publish_stream,
    stream_duplicate_keys,
    stream_key_counts,
    stream_only_in_source,
    stream_only_in_target,
)
from tests.helpers import rows

START = datetime(2024, 5, 1)
SCHEMA = "k string, region int, at timestamp"


def at(minutes):
    return None if minutes is None else START + timedelta(minutes=minutes)


def deliver(spark, path, records):
    made = [(key, region, at(minutes)) for key, region, minutes in records]
    spark.createDataFrame(made, SCHEMA).coalesce(1).write.mode("append").parquet(path)


class Stream:
    """Deliveries into folders, each followed by a run that goes on where the last ended."""

    def __init__(self, spark, tmp_path, found, folders=("in",)):
        self.spark, self.found = spark, found
        self.folders = [f"{tmp_path}/{name}" for name in folders]
        self.results, self.checkpoint = f"{tmp_path}/out", f"{tmp_path}/checkpoint"

    def run(self, *records):
        for folder, held in zip(self.folders, records):
            deliver(self.spark, folder, held)
        streams = [self.spark.readStream.schema(SCHEMA).parquet(f) for f in self.folders]
        query = publish_stream(self.found(*streams), self.results, self.checkpoint)
        query.awaitTermination()
        return query

    def result(self):
        return rows(self.spark.read.parquet(self.results))


def state(query):
    """Rows held at the end, and rows that came too late, of all stateful operators."""
    progress = [p["stateOperators"] for p in query.recentProgress]
    late = sum(o["numRowsDroppedByWatermark"] for p in progress for o in p)
    return sum(o["numRowsTotal"] for o in progress[-1]), late


def repeated(events):
    return stream_duplicate_keys(events, "k, region", "at", within="30 minutes", delay="10 minutes")


def test_repeats_come_out_when_their_time_is_over_and_state_goes(spark, tmp_path):
    stream = Stream(spark, tmp_path, repeated)
    query = stream.run([("a", 1, 0), ("a", 1, 20), ("a", 1, 45), ("b", 1, 5), (None, 2, 5), (None, 2, 6), ("c", 1, 50)])
    # The watermark is at 40 minutes: nothing after 10 minutes is over.
    assert stream.result() == [(None, 2, at(5), at(6), 2)]
    assert state(query) == (2, 0)
    # A row goes on with the state of the run before; another one is too late.
    query = stream.run([("a", 1, 60), ("b", 1, 8), ("c", 1, 81), ("x", None, None)])
    assert state(query)[1] == 1
    query = stream.run([("z", 9, 500)])
    assert stream.result() == [("a", 1, at(0), at(60), 4), (None, 2, at(5), at(6), 2)]
    assert state(query) == (1, 0)


def test_state_does_not_grow_with_the_stream(spark, tmp_path):
    stream = Stream(spark, tmp_path, repeated)
    held = [
        state(stream.run([(f"k{i}", day, day * 1440 + i) for i in range(50)]))[0] for day in range(3)
    ]
    assert held == [40, 40, 40]
    assert stream.result() == []


def test_stretches_of_a_bounded_dataset(spark):
    """The same function without a stream, on a key that holds most rows."""
    made = [("hot", 1, at(i / 10)) for i in range(3000)] + [("lone", 1, at(7)), ("far", 1, at(0)), ("far", 1, at(31))]
    found = repeated(spark.createDataFrame(made, SCHEMA))
    assert rows(found) == [("hot", 1, at(0), at(299.9), 3000)]


SOURCE = [("a", 1, 0), ("a", 1, 1), ("b", 1, 2), (None, 1, 3), ("c", 1, 70)]
TARGET = [("a", 1, 50), ("d", 1, 2), (None, 1, 4), ("b", 1, 65)]


def test_keys_on_one_side_of_two_streams(spark, tmp_path):
    def found(source, target):
        return stream_only_in_source(source, target, "k, region", "at", window="1 hour", delay="5 minutes")

    stream = Stream(spark, tmp_path, found, ("source", "target"))
    query = stream.run(SOURCE, TARGET)
    # The slower stream decides: its watermark is at 60 minutes, the end of the first hour.
    assert stream.result() == [(at(0), "b", 1, 1), (at(0), None, 1, 1)]
    assert state(query)[0] == 2
    query = stream.run([("e", 1, 300)], [("e", 1, 310)])
    assert stream.result() == [(at(0), "b", 1, 1), (at(0), None, 1, 1), (at(60), "c", 1, 1)]
    assert state(query)[0] == 2


@pytest.mark.parametrize("side", ["source", "target", "both"])
def test_sides_of_a_bounded_dataset(spark, side):
    source = spark.createDataFrame([(k, r, at(m)) for k, r, m in SOURCE], SCHEMA)
    target = spark.createDataFrame([(k, r, at(m)) for k, r, m in TARGET], SCHEMA)
    check = {"source": stream_only_in_source, "target": stream_only_in_target, "both": stream_key_counts}[side]
    found = rows(check(source, target, "k", "at", window="1 hour"))
    first, second = at(0), at(60)
    lone = {
        "source": [(first, "b", 1), (first, None, 1), (second, "c", 1)],
        "target": [(first, "d", 1), (first, None, 1), (second, "b", 1)],
    }
    both = [(*r, None) for r in lone["source"]] + [(w, k, None, n) for w, k, n in lone["target"]] + [(first, "a", 2, 1)]
    assert found == sorted(lone.get(side, both), key=repr)


def test_a_hot_key_makes_no_pairs(spark):
    """A million pairs of rows under one key stay two rows in the join."""
    hot = spark.range(1000).select(F.lit("hot").alias("k"), F.lit(1).alias("region"), F.lit(START).alias("at"))
    assert rows(stream_key_counts(hot, hot, "k", "at")) == [(START, "hot", 1000, 1000)]


def test_keys_and_columns_must_exist(spark):
    with pytest.raises(ValueError, match="no key column"):
        stream_duplicate_keys(spark.createDataFrame([], SCHEMA), "", "at")
    with pytest.raises(ValueError, match="does not exist"):
        stream_duplicate_keys(spark.createDataFrame([], SCHEMA), "k", "when")
