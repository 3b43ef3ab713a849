"""Publishing by run."""

import pytest
from pyspark.sql import functions as F

from tallyframe.sources import publish_run, read_runs, runs_of
from tests.helpers import rows

SCHEMA = "id long, name string"


def some(spark, *names):
    return spark.createDataFrame(list(enumerate(names)), SCHEMA)


@pytest.mark.parametrize("format_name", ["parquet", "csv", "json"])
def test_a_run_that_is_repeated_replaces_its_rows(spark, tmp_path, format_name):
    path = f"{tmp_path}/out"

    def publish(run_id, *names):
        return publish_run(some(spark, *names), path, run_id, format_name=format_name)

    assert publish("r1", "a", "b") == 2
    assert publish("r1", "a", "b") == 2
    assert publish("2024-01-01", "c") == 1
    read = read_runs(spark, path, SCHEMA, format_name=format_name)
    assert read.columns == ["id", "name", "run_id"]
    assert rows(read) == [(0, "a", "r1"), (0, "c", "2024-01-01"), (1, "b", "r1")]
    # With fewer rows, and with none.
    publish("r1", "z")
    publish("2024-01-01")
    assert rows(read_runs(spark, path, SCHEMA, format_name=format_name)) == [(0, "z", "r1")]
    assert rows(runs_of(spark, path)) == [("2024-01-01", "committed", 0), ("r1", "committed", 1)]


def test_a_run_that_fails_is_not_seen(spark, tmp_path):
    path = f"{tmp_path}/out"
    publish_run(some(spark, "a"), path, "whole")
    publish_run(some(spark, "b"), path, "broken")
    bad = some(spark, "c", "d").withColumn("name", F.raise_error(F.lit("fails here")).cast("string"))
    with pytest.raises(Exception, match="fails here"):
        publish_run(bad, path, "broken")
    assert rows(read_runs(spark, path, SCHEMA)) == [(0, "a", "whole")]
    assert ("broken", "open", None) in rows(runs_of(spark, path))
    publish_run(some(spark, "e"), path, "broken")
    assert rows(read_runs(spark, path, SCHEMA)) == [(0, "a", "whole"), (0, "e", "broken")]


@pytest.mark.parametrize("run_id", ["", "a/b", "..", "a=b", "x y"])
def test_names_of_runs(spark, tmp_path, run_id):
    with pytest.raises(ValueError, match="letters"):
        publish_run(some(spark, "a"), str(tmp_path), run_id)
