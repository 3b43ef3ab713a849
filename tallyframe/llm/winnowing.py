"""Fingerprints of documents by winnowing.

Hashes of all k-grams of code points; of every ``window`` neighbouring grams the one
with the least hash is kept, the rightmost of equals, with its position. Two texts
that share ``k + window - 1`` code points in a row share a kept hash at the same
place in them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.llm.rows import column_of, range_buckets, texts, with_place, with_results

K = 16
WINDOW = 16
_STEP = 0x9E3779B97F4A7C15
_BUCKET_BYTES = 16 << 20
#: Buckets are tasks, and their borders a list on the driver.
_MOST_BUCKETS = 1 << 16


def _gram_hashes(codes: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the grams of ``k`` codes, by doubling lengths; 32 bits each."""
    power = codes.astype(np.uint64) + np.uint64(1)
    made, length, total = None, 1, 0
    while True:
        if k & length:
            if made is None:
                made = power
            else:
                size = len(codes) - total - length + 1
                made = made[:size] * _power(length) + power[total : total + size]
            total += length
        length *= 2
        if length > k:
            break
        half = length // 2
        power = power[:-half] * _power(half) + power[half:]
    made ^= made >> np.uint64(29)
    made *= np.uint64(0xBF58476D1CE4E5B9)
    return made >> np.uint64(32)


def _power(exponent: int) -> np.uint64:
    return np.uint64(pow(_STEP, exponent, 1 << 64))


def winnow(text: str, k: int = K, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Kept hashes (32 bits) and their positions, in order.

    A text of fewer than ``k`` code points is one gram, and fewer grams than
    ``window`` are one window; an empty text keeps none.
    """
    codes = np.frombuffer(text.encode("utf-32-le"), dtype="<u4")
    if not len(codes):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    hashes = _gram_hashes(codes, min(k, len(codes)))
    # Equal hashes: the greater position makes the smaller number.
    keys = hashes << np.uint64(32) | np.uint64(0xFFFFFFFF) - np.arange(len(hashes), dtype=np.uint64)
    span, wanted = 1, min(window, len(keys))
    while span < wanted:
        more = min(span, wanted - span)
        keys = np.minimum(keys[:-more], keys[more:])
        span += more
    keys = keys[np.concatenate([[True], keys[1:] != keys[:-1]])]
    return keys >> np.uint64(32), (np.uint64(0xFFFFFFFF) - (keys & np.uint64(0xFFFFFFFF))).astype(np.int64)


def digest(hashes: np.ndarray, positions: np.ndarray) -> str:
    """32 hex digits that stand for a whole fingerprint, positions included."""
    packed = np.stack([hashes, positions.astype(np.uint64)]).astype("<u8").tobytes()
    return hashlib.blake2b(packed, digest_size=16).hexdigest()


def likeness(one: set[int], other: set[int]) -> float:
    """Shared hashes among all of both; two empty fingerprints are alike."""
    both = len(one & other)
    return both / (len(one) + len(other) - both) if one or other else 1.0


def fingerprints(df: DataFrame, k: int = K, window: int = WINDOW, text: str = "text") -> DataFrame:
    """Each row with ``hashes`` and ``positions``, the kept grams of its whole text.

    Equal texts have equal fingerprints; null and empty texts have empty arrays.
    Repeated rows stay, columns named as the results are replaced, and an empty
    table gives none.
    """
    def run(columns: list[pa.Array]) -> list[pa.Array]:
        found = [winnow(x, k, window) for x in texts(columns[0])]
        return [
            pa.array([h.astype(np.int64) for h, _ in found], pa.list_(pa.int64())),
            pa.array([p.astype(np.int32) for _, p in found], pa.list_(pa.int32())),
        ]

    results = [
        T.StructField("hashes", T.ArrayType(T.LongType())), T.StructField("positions", T.ArrayType(T.IntegerType()))
    ]
    return with_results(df, [column_of(df, text)], results, run)


def edited(text: str, following: str) -> str:
    """A text whose last quarter gives way to as much of the beginning of another."""
    part = len(text) // 4
    return text[: len(text) - part] + following[:part]


def in_order(df: DataFrame, text: str = "text", id: str = "doc_id") -> DataFrame:
    """Rows ``(bucket, tail, doc_id, text)`` for going through documents by id.

    Ranges of ids are buckets, and the rows of a partition are sorted by bucket,
    tail, id and text. The document after a bucket's last one stands in it once more
    as its tail; after the last bucket comes the first. One shuffle of the texts; the
    ranges follow the ids' quantiles, of which there are at most 65,536; each is a task
    of its own, which sorts what does not fit into memory on disk. Ids may be of any
    type that can be sorted; texts go by their bytes. Null ids come first, and equal ids
    are ordered by text.
    """
    spark = df.sparkSession
    given = df.select(
        column_of(df, id).alias("doc_id"), F.coalesce(column_of(df, text), F.lit("")).alias("text")
    )
    given = with_place(given, "doc_id").withColumn("place", F.coalesce("place", F.lit(-(1 << 63))))
    size = given.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    wanted = min(_MOST_BUCKETS, max(3 * spark.sparkContext.defaultParallelism, size // _BUCKET_BYTES))
    bucket = range_buckets(given, "place", wanted)
    given = given.withColumn("bucket", bucket)
    rows = given.groupBy("bucket").agg(F.min("place").alias("first")).orderBy("bucket").collect()
    before = {row["bucket"]: rows[i - 1]["bucket"] for i, row in enumerate(rows)}
    by_bucket = F.lit([before.get(b, 0) for b in range(max(before, default=0) + 1)]).cast("array<int>")
    own = F.struct(F.col("bucket").alias("bucket"), F.lit(False).alias("tail"))
    earlier = F.struct(F.element_at(by_bucket, F.col("bucket") + 1).alias("bucket"), F.lit(True).alias("tail"))
    is_first = F.col("place").isin([row["first"] for row in rows] or [0])
    given = given.select(
        F.explode(F.when(is_first, F.array(own, earlier)).otherwise(F.array(own))).alias("at"), "place", "doc_id", "text"
    ).select("at.*", "place", "doc_id", "text")
    parts = max(before, default=0) + 1
    given = given.repartitionById(parts, "bucket").sortWithinPartitions("bucket", "tail", "place", "text")
    return given.drop("place")


def with_next(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, str, str]]:
    """``(doc_id, text, next text)`` of rows in the order of :func:`in_order`."""
    held = None
    for batch in batches:
        for row in zip(*(column.to_pylist() for column in batch.columns), strict=True):
            if held is not None and held[0] == row[0]:
                yield held[2], held[3], row[3]
            held = None if row[1] else row


def against_next(df: DataFrame, k: int = K, window: int = WINDOW, text: str = "text", id: str = "doc_id") -> DataFrame:
    """Each document's fingerprint beside those of its edited text and of the next one.

    The next document is the one of the following id (:func:`in_order`); the edited
    text ends with the next one's beginning in place of its last quarter of code
    points. ``near_edited`` and ``near_next`` are shares of kept hashes in common;
    two texts without any are alike. Null texts are empty. A single document is its
    own next one, repeated rows follow each other, and an empty table gives none.
    """
    ordered = in_order(df, text, id)
    schema = T.StructType([
        T.StructField(id, df.schema[id].dataType), T.StructField("n_chars", T.LongType()),
        T.StructField("edited_sha256", T.StringType()), T.StructField("fingerprint", T.StringType()),
        T.StructField("edited_fingerprint", T.StringType()), T.StructField("near_edited", T.DoubleType()),
        T.StructField("near_next", T.DoubleType()),
    ])

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        last_text, last = None, None
        for doc, own, following in with_next(batches):
            if own != last_text:
                last = winnow(own, k, window)
            other = edited(own, following)
            changed = winnow(other, k, window)
            after = winnow(following, k, window)
            sets = [set(x[0].tolist()) for x in (last, changed, after)]
            yield (
                doc, len(own), hashlib.sha256(other.encode()).hexdigest(), digest(*last), digest(*changed),
                likeness(sets[0], sets[1]), likeness(sets[0], sets[2]),
            )
            last_text, last = following, after

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow, rows = to_arrow_schema(schema), []
        for row in compared(batches):
            rows.append(row)
            if len(rows) == 10_000:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), arrow, strict=True)], schema=arrow
                )
                rows = []
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), arrow, strict=True)], schema=arrow
            )

    return ordered.mapInArrow(run, schema)
