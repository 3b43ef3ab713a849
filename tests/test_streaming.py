import pytest

from tallyframe.streaming import check_stream, stream_totals
from tests.helpers import rows

RECORD = "key binary, value string, topic string, headers array<struct<key:string,value:binary>>"


def test_batches_are_checked_one_by_one(spark, tmp_path):
    """A file stream with the columns of a topic stands in for the topic."""
    source = f"{tmp_path}/topic"
    for values in (["a", "a", ""], ["a", None], ["b"]):
        spark.createDataFrame(
            [(b"k", v, "t", [("h", b"1")]) for v in values], RECORD
        ).coalesce(1).write.mode("append").parquet(source)
    results, checkpoint = f"{tmp_path}/results", f"{tmp_path}/checkpoint"

    def run():
        stream = (
            spark.readStream.schema(RECORD).option("maxFilesPerTrigger", 1).parquet(source)
        )
        check_stream(
            stream, results, checkpoint, null_columns="value", unique_columns="value"
        ).awaitTermination()
        return rows(
            stream_totals(spark, results), "tc_id", "target_records", "failed_records"
        )

    totals = run()
    assert totals == [(1, 6, 0), (3, 6, 1), (4, 6, 2)]
    checks = spark.read.parquet(f"{results}/checks")
    assert checks.select("batch_id").distinct().count() == 3
    assert run() == totals


@pytest.mark.parametrize("files", [1, 2, 5])
def test_values_that_repeat_across_batches(spark, tmp_path, files):
    """The same totals however the records fall into batches."""
    source, schema = f"{tmp_path}/in", "v double, b binary, a array<string>"
    records = [
        (0.0, b"\xff", ["x"]),
        (-0.0, b"\xfe", ["x", None]),
        (float("nan"), b"\xfd", ["x", "null"]),
        (float("nan"), b"\xfd", ["x", None]),
        (None, None, None),
        (None, b"", []),
    ]
    # One record to a file, so that the batch size decides what falls together.
    for record in records:
        spark.createDataFrame([record], schema).coalesce(1).write.mode("append").parquet(source)
    stream = (
        spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(source)
    )
    results = f"{tmp_path}/results"
    check_stream(
        stream, results, f"{tmp_path}/checkpoint", keys="v", unique_columns="v, b, a"
    ).awaitTermination()
    found = rows(
        stream_totals(spark, results, source_records=8),
        "tc_id", "column", "target_records", "failed_records",
    )
    assert found == [(1, "v", 6, 2), (3, "a", 6, 1), (3, "b", 6, 1), (3, "v", 6, 3)]


def test_stream_needs_columns(spark):
    with pytest.raises(ValueError, match="no columns"):
        check_stream(None, "x", "y")
