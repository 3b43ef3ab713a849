"""A derived table kept up with its source: only changed keys are derived again.

For tables whose rows of a key come from the source rows of that key alone, such as the
history of a contact. The source's rows of each key have a digest that does not depend on
their order. Digests of the new source meet the stored ones on the key, narrow rows that
hold neither source nor derived data. Only keys whose digest is new, changed or gone are
derived again, and only the buckets of keys that hold one are written again.

An update that breaks off can be run again: digests are written last, so its keys are
found changed once more, and deriving them twice gives the same rows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.functions.columns import column_of, ref, require_columns
from tallyframe.sources.scratch import stored

BUCKETS = 64
_BUCKET, _REAL, _STATE = "__bucket", "__real", "__state"
_FIGURES = ("__rows", "__low", "__high")


@dataclass(frozen=True)
class Changes:
    """Numbers of keys, and of buckets that were written again."""

    new: int
    changed: int
    gone: int
    buckets: int


def _digests(source: DataFrame, keys: list[str], buckets: int) -> DataFrame:
    """Per key the number of rows and the summed halves of their hashes."""
    hashed = F.xxhash64(*[column_of(source, name) for name in source.columns])
    key = [column_of(source, name).alias(name) for name in keys]
    return (
        source.select(*key, hashed.alias("__hash"))
        .groupBy(*[ref(name) for name in keys])
        .agg(
            F.count(F.lit(1)).alias(_FIGURES[0]),
            F.expr("sum(__hash & 4294967295)").alias(_FIGURES[1]),
            F.expr("sum(shiftright(__hash, 32))").alias(_FIGURES[2]),
        )
        .withColumn(_BUCKET, _bucket([ref(name) for name in keys], buckets))
    )


def _bucket(keys: list[Column], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _read(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def _replace(rows: DataFrame, affected: DataFrame, path: str) -> None:
    """Write the rows of the affected buckets in place of what these hold.

    Each such bucket gets a row that stands for none, as a bucket without rows would keep
    its old ones.
    """
    empty = affected.select(ref(_BUCKET), F.lit(False).alias(_REAL))
    whole = rows.withColumn(_REAL, F.lit(True)).unionByName(empty, allowMissingColumns=True)
    # Few files a bucket, and several tasks for a bucket that is large.
    dealt = whole.hint("rebalance", _BUCKET)
    dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(_BUCKET).parquet(path)


def _rows_of(stored_rows: DataFrame) -> DataFrame:
    return stored_rows.filter(ref(_REAL)).drop(_REAL)


def update_derived(
    source: DataFrame, path: str, keys, derive: Callable[[DataFrame], DataFrame], *, buckets: int = BUCKETS
) -> Changes:
    """Bring the derived table at ``path`` up to the source as it is now.

    ``derive`` makes the derived rows of source rows; it is given all rows of some keys, and
    its rows have the key columns. The first update writes everything and fixes the number
    of buckets, the parts that are written again as a whole: about a thousand a TB do. A null is a key like any other. Columns of the source without an order,
    such as maps, cannot be part of a digest and are an error.
    """
    spark, keys = source.sparkSession, require_columns(keys, "key column")
    root = path.rstrip("/")
    old_digests, old_rows = _read(spark, f"{root}/digests"), _read(spark, f"{root}/rows")
    known = _read(spark, f"{root}/buckets")
    if known is None:
        spark.range(1).select(F.lit(buckets).alias("n")).coalesce(1).write.parquet(f"{root}/buckets")
    else:
        buckets = known.first()["n"]
    fresh = stored(_digests(source, keys, buckets))
    before = fresh.limit(0) if old_digests is None else _rows_of(old_digests)
    changed = stored(_changed(before, fresh, keys))
    counts = {r[_STATE]: r["count"] for r in changed.groupBy(_STATE).count().collect()}
    if not counts:
        return Changes(0, 0, 0, 0)
    # At most as many numbers as there are buckets.
    affected = stored(changed.select(_BUCKET).distinct().coalesce(1))
    again = _with_keys(source, changed.filter(ref(_STATE) != "gone"), keys, "left_semi")
    derived = derive(again)
    derived = derived.withColumn(_BUCKET, _bucket([column_of(derived, k) for k in keys], buckets))
    if old_rows is not None:
        held = _rows_of(old_rows).join(F.broadcast(affected), _BUCKET, "left_semi")
        derived = derived.unionByName(_with_keys(held, changed, keys, "left_anti"))
    _replace(stored(derived), affected, f"{root}/rows")
    _replace(fresh.join(F.broadcast(affected), _BUCKET, "left_semi"), affected, f"{root}/digests")
    return Changes(*(counts.get(state, 0) for state in ("new", "changed", "gone")), affected.count())


def _changed(before: DataFrame, after: DataFrame, keys: list[str]) -> DataFrame:
    """Keys whose digests differ, with their bucket and what has become of them."""
    old = before.withColumnsRenamed({name: f"old_{name}" for name in before.columns})
    same_key = [ref(name).eqNullSafe(ref(f"old_{name}")) for name in keys]
    met = after.join(old, same_key, "full_outer")
    state = (
        F.when(ref(f"old_{_BUCKET}").isNull(), "new")
        .when(ref(_BUCKET).isNull(), "gone")
        .when(~F.struct(*_FIGURES).eqNullSafe(F.struct(*[f"old_{name}" for name in _FIGURES])), "changed")
    )
    either = [
        F.when(ref(_BUCKET).isNull(), ref(f"old_{name}")).otherwise(ref(name)).alias(name)
        for name in [*keys, _BUCKET]
    ]
    return met.select(*either, state.alias(_STATE)).filter(ref(_STATE).isNotNull())


def _with_keys(df: DataFrame, wanted: DataFrame, keys: list[str], how: str) -> DataFrame:
    named = wanted.select(*[ref(name).alias(f"wanted_{i}") for i, name in enumerate(keys)])
    return df.join(named, [column_of(df, name).eqNullSafe(ref(f"wanted_{i}")) for i, name in enumerate(keys)], how)


def read_derived(spark: SparkSession, path: str) -> DataFrame:
    """The derived table as of the last update."""
    return _rows_of(spark.read.parquet(f"{path.rstrip('/')}/rows")).drop(_BUCKET)
