"""Helpers that the operators share: names, Arrow functions per batch, shared tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.sources.scratch import fresh_path

#: The separators of words and the blanks stripped from lines: space and 09 to 0D.
BLANKS = b" \t\n\x0b\x0c\r"


def column_of(df: DataFrame, name: str) -> Column:
    """A column by its exact name, dots and blanks included."""
    return df["`" + name.replace("`", "``") + "`"]


def free_name(df: DataFrame, wanted: str) -> str:
    """A name like ``wanted`` that no column has, whatever the case."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def others(df: DataFrame, *replaced: str) -> list[Column]:
    """The columns of a frame but those that results of these names replace."""
    gone = {name.lower() for name in replaced}
    return [column_of(df, c) for c in df.columns if c.lower() not in gone]


def text_bytes(df: DataFrame, name: str = "text") -> Column:
    """A text as UTF-8 bytes; null counts as empty."""
    return F.coalesce(column_of(df, name).cast("binary"), F.lit(b""))


def with_results(
    df: DataFrame,
    inputs: Sequence[Column],
    results: Sequence[T.StructField],
    function: Callable[[list[pa.Array]], list[pa.Array]],
) -> DataFrame:
    """The rows with columns that a function makes of each Arrow batch.

    ``function`` gets the arrays of ``inputs`` and gives one array per result. All
    other columns pass by. A column whose name a result has is replaced.
    """
    names = [field.name for field in results]
    kept = others(df, *names)
    width = len(inputs)
    given = df.select(*(c.alias(f"_input_{i}") for i, c in enumerate(inputs)), *kept)
    schema = T.StructType([*given.schema.fields[width:], *results])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                made = function(batch.columns[:width])
                passed = batch.columns[width:]
                names_out = [f.name for f in schema.fields]
                yield pa.RecordBatch.from_arrays([*passed, *made], names=names_out)

    return given.mapInArrow(run, schema)


_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"
_BATCH_BYTES = 8 << 20


def small_batches(spark: SparkSession) -> SparkSession:
    """The session, with Arrow batches of 8 MB unless it names a size of its own.

    Spark's default of 64 MB costs each task several times that beside the heap when
    rows are texts. Queries call this; operators leave the session as it is.
    """
    if spark.conf.get(_BATCH_SETTING, None) is None:
        spark.conf.set(_BATCH_SETTING, str(_BATCH_BYTES))
    return spark


def store(df: DataFrame, label: str) -> DataFrame:
    """The rows, written once to the shared folder and read from there."""
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def is_whole_number(kind: T.DataType) -> bool:
    """Whether values of a type are longs as they stand."""
    return isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))


def with_place(df: DataFrame, id: str) -> DataFrame:
    """The rows with ``place``, a long that is in the order of their ids; null where those are.

    Whole numbers stand for themselves. Ids of any other type that can be sorted (texts
    by their bytes, decimals, dates) are sorted in a distributed way, each once, into a
    stored table of places, which meets the rows by id. Rows without an id take no part
    in that join, and adaptive execution splits the rows of an id that has very many.
    """
    own = column_of(df, id)
    if is_whole_number(df.schema[id].dataType):
        return df.withColumn("place", own.cast("long"))
    known = df.where(own.isNotNull())
    order = known.select(own.alias(id)).distinct().repartitionByRange(F.col(f"`{id}`")).sortWithinPartitions(F.col(f"`{id}`"))
    places = store(order.withColumn("place", F.monotonically_increasing_id()), "places")
    unknown = df.where(own.isNull()).withColumn("place", F.lit(None).cast("long"))
    return known.join(places, id).select(*unknown.columns).unionByName(unknown)


def range_buckets(df: DataFrame, place: str, wanted: int) -> Column:
    """The number of a row's range of ``place``, a long, among about ``wanted`` like ones."""
    shares = [i / wanted for i in range(1, wanted)]
    cuts = sorted(set(df.agg(F.percentile_approx(place, shares, 20 * wanted)).first()[0] or [])) if shares else []
    if len(cuts) <= 256:
        return F.size(F.filter(F.lit(cuts).cast("array<bigint>"), lambda c: c <= F.col(place)))
    # First among every so many cuts, then among those between two of them.
    step = int(len(cuts) ** 0.5)
    coarse = F.size(F.filter(F.lit(cuts[step - 1 :: step]).cast("array<bigint>"), lambda c: c <= F.col(place))) * step
    fine = F.slice(F.lit(cuts).cast("array<bigint>"), coarse + 1, F.lit(step))
    return coarse + F.size(F.filter(fine, lambda c: c <= F.col(place)))


def binary_parts(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a binary array without nulls, and its offsets, both as views."""
    if pa.types.is_large_binary(array.type):
        kind = np.int64
    else:
        kind = np.int32
    _, places, data = array.buffers()
    offsets = np.frombuffer(places, dtype=kind, count=array.offset + len(array) + 1)
    offsets = offsets[array.offset :].astype(np.int64)
    held = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return held[offsets[0] : offsets[-1]], offsets - offsets[0]


def texts(array: pa.Array) -> list[str]:
    """Strings, null as empty."""
    return [x or "" for x in array.to_pylist()]
