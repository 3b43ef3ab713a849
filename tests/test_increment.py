"""A derived table kept up from changes, against deriving it whole."""

import os
import random

import pytest
from pyspark.sql import functions as F

from tallyframe.plans import Changes, read_derived, update_derived
from tests.helpers import rows

SCHEMA = "k string, now string, before string"


def history(source):
    """A row for each version; rows of a key come from that key alone."""
    return source.select("k", F.explode(F.array("now", "before")).alias("place")).filter("place is not null").distinct()


def check(spark, path, records, want):
    source = spark.createDataFrame(records, SCHEMA).repartition(3)
    assert update_derived(source, path, "k", history, buckets=8) == want
    derived = read_derived(spark, path)
    assert derived.columns == ["k", "place"]
    assert rows(derived) == rows(history(source))


def files(path):
    return {os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.startswith("part-")}


def test_new_changed_and_gone_keys(spark, tmp_path):
    path = f"{tmp_path}/derived"
    records = [(f"k{i}", f"a{i}", f"b{i}") for i in range(40)] + [(None, "x", None), ("k1", "a1", "b1")]
    check(spark, path, records, Changes(41, 0, 0, 8))
    before = files(f"{path}/rows")
    # The same rows in another order: nothing is written.
    check(spark, path, records[::-1], Changes(0, 0, 0, 0))
    assert files(f"{path}/rows") == before
    # One key changed: the other buckets' files stay.
    check(spark, path, [("k3", "moved", "a3"), *[r for r in records if r[0] != "k3"]], Changes(0, 1, 0, 1))
    assert len(before & files(f"{path}/rows")) == len(before) - 1
    # A repeated row less changes its key; a null key goes.
    check(spark, path, records[:40], Changes(0, 2, 1, 3))
    # Whole buckets empty, and the table too.
    check(spark, path, records[:1], Changes(0, 0, 39, 8))
    check(spark, path, [], Changes(0, 0, 1, 1))
    check(spark, path, records[:2], Changes(2, 0, 0, 2))


def test_an_update_that_broke_off_is_run_again(spark, tmp_path):
    import tallyframe.plans.increment as increment

    path = f"{tmp_path}/derived"
    records = [(f"k{i}", "a", None) for i in range(10)]
    check(spark, path, records, Changes(10, 0, 0, buckets_of(spark, records, "a")))
    new = [(k, "b" if k < "k5" else now, None) for k, now, _ in records]
    replace, calls = increment._replace, []

    def breaks(rows, affected, where):
        calls.append(where)
        if where.endswith("digests"):
            raise RuntimeError("lost")
        replace(rows, affected, where)

    increment._replace = breaks
    try:
        with pytest.raises(RuntimeError, match="lost"):
            update_derived(spark.createDataFrame(new, SCHEMA), path, "k", history)
    finally:
        increment._replace = replace
    assert len(calls) == 2
    check(spark, path, new, Changes(0, 5, 0, buckets_of(spark, new, "b")))


def buckets_of(spark, records, now):
    keys = spark.createDataFrame([r for r in records if r[1] == now], SCHEMA)
    return keys.select(F.pmod(F.xxhash64("k"), F.lit(8))).distinct().count()


def test_random_deliveries(spark, tmp_path):
    rng = random.Random(5)
    path = f"{tmp_path}/derived"
    for _ in range(3):
        records = [(rng.choice([None, *"abcdefghij"]), rng.choice("xyz"), rng.choice([None, "u", "v"])) for _ in range(12)]
        source = spark.createDataFrame(records, SCHEMA)
        update_derived(source, path, "k", history, buckets=3)
        assert rows(read_derived(spark, path)) == rows(history(source))
