"""Lines that many documents share, found with two Bloom filters.

1. Every document's distinct line hashes (64 bits) are written once, eight bytes a
   line; their number sets the filters' size.
2. A few tasks fill two filters each: ``once`` with every hash, ``twice`` with those
   that ``once`` held already. Merging ors both and adds to ``twice`` the bits that
   two ``once`` filters share, so a hash of two tasks gets there too. They are merged
   piece by piece in a shuffle; only the merged ``twice`` filter reaches the driver,
   and its size has a bound. Beyond the bound it lets through more, never fewer.
3. Lines whose hash is in ``twice`` are suspects. Only they are shuffled, as text:
   counting confirms them exactly, with partial counts in the map tasks.
4. The numbers of the lines to drop go to their documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.llm.rows import BLANKS, column_of, free_name, others, store, text_bytes, with_results

#: Bits of a filter per hash, functions per hash, and the most bits of a filter.
BITS_PER_HASH = 8
FUNCTIONS = 4
MOST_BITS = 1 << 30
_PIECE = 1 << 19


def line_keys(text: bytes, shortest: int) -> list[tuple[int, bytes]]:
    """Numbers and keys of the lines whose key has at least ``shortest`` code points."""
    found = []
    for number, line in enumerate(text.lower().split(b"\n")):
        key = line.strip(BLANKS)
        if len(key) >= shortest and (len(key) >= 4 * shortest or len(key.decode()) >= shortest):
            found.append((number, key))
    return found


def filter_bits(hashes: int) -> int:
    """The size of a filter: a power of two with room for so many hashes, bounded."""
    return min(MOST_BITS, 1 << max(16, (hashes * BITS_PER_HASH - 1).bit_length()))


def _places(hashes: np.ndarray, bits: int) -> Iterator[np.ndarray]:
    step = (hashes >> np.uint64(32)) | np.uint64(1)
    for i in range(FUNCTIONS):
        mixed = hashes + np.uint64(i) * step
        yield (mixed ^ mixed >> np.uint64(29)) & np.uint64(bits - 1)


def is_in(held: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which hashes a filter, given as bytes, may hold."""
    found = np.ones(len(hashes), bool)
    for place in _places(hashes, len(held) * 8):
        found &= (held[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
    return found


def _put(held: np.ndarray, hashes: np.ndarray) -> None:
    for place in _places(hashes, len(held) * 8):
        bit = np.left_shift(1, (place & np.uint64(7)).astype(np.uint8), dtype=np.uint8)
        np.bitwise_or.at(held, place >> np.uint64(3), bit)


def add(once: np.ndarray, twice: np.ndarray, hashes: np.ndarray) -> None:
    """Put hashes of several documents, each distinct in its document, into both filters."""
    values, counts = np.unique(hashes, return_counts=True)
    _put(twice, values[(counts > 1) | is_in(once, values)])
    _put(once, values)


def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """One pair of filters for the hashes of all pairs."""
    once, twice = parts[0][0].copy(), parts[0][1].copy()
    for more_once, more_twice in parts[1:]:
        twice |= more_twice | (once & more_once)
        once |= more_once
    return once, twice


def _hash_lines(text: bytes, shortest: int) -> bytes:
    from xxhash import xxh64_intdigest

    keys = {key for _, key in line_keys(text, shortest)}
    return np.array([xxh64_intdigest(k) for k in keys], dtype="<u8").tobytes()


def twice_seen(hashes: DataFrame, bits: int, builders: int) -> np.ndarray:
    """The filter of hashes that two rows of ``hashes`` (packed, distinct per row) hold."""
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, twice = np.zeros(bits // 8, np.uint8), np.zeros(bits // 8, np.uint8)
        some = False
        for batch in batches:
            packed = b"".join(batch.column(0).to_pylist())
            some = some or bool(packed)
            add(once, twice, np.frombuffer(packed, dtype="<u8"))
        for piece in range(0, len(once) if some else 0, _PIECE):
            yield pa.RecordBatch.from_pydict(
                {
                    "piece": pa.array([piece // _PIECE], pa.int32()),
                    "once": pa.array([once[piece : piece + _PIECE].tobytes()], pa.binary()),
                    "twice": pa.array([twice[piece : piece + _PIECE].tobytes()], pa.binary()),
                }
            )

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for piece, *parts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                new = tuple(np.frombuffer(p, np.uint8) for p in parts)
                held[piece] = merged([held[piece], new]) if piece in held else new
        pieces = pa.array(list(held), pa.int32())
        yield pa.RecordBatch.from_arrays(
            [pieces, pa.array([t.tobytes() for _, t in held.values()], pa.binary())], names=["piece", "twice"]
        )

    parts = hashes.coalesce(builders).mapInArrow(build, "piece int, once binary, twice binary")
    twice = np.zeros(bits // 8, np.uint8)
    for row in parts.repartition("piece").mapInArrow(merge, "piece int, twice binary").toLocalIterator():
        held = np.frombuffer(row["twice"], np.uint8)
        twice[row["piece"] * _PIECE : row["piece"] * _PIECE + len(held)] = held
    return twice


def drop_shared_lines(
    df: DataFrame, documents: int = 3, shortest: int = 20, text: str = "text", id: str = "doc_id",
    by_id: bool = False,
) -> DataFrame:
    """Each row with the text's remaining lines, ``n_lines`` and ``n_dropped``.

    Texts are split at line feeds. A line's key is the line without blanks (20, 09
    to 0D) at both ends, A-Z lower-cased. Lines whose key has at least ``shortest``
    code points and stands in at least ``documents`` rows are dropped, but for those
    of the rows with the largest id that holds the key. The rest stays as it is,
    joined by line feeds; ``n_lines`` counts lines before dropping.

    A null text stays null and counts as one empty line. A row is a document, so
    repeated rows count each, and all that share the largest id keep their lines.
    Null ids come before all others. Extra columns stay, but those named as the
    results. An empty table gives none.

    With ``by_id`` rows of one id are one document, and a key must stand under
    ``documents`` ids other than null, as ``count(distinct id)`` has it.
    """
    context = df.sparkSession.sparkContext

    def to_hashes(columns: list[pa.Array]) -> list[pa.Array]:
        return [pa.array([_hash_lines(x, shortest) for x in columns[0].to_pylist()], pa.binary())]

    plain = df.select(column_of(df, id).alias("doc_id"), column_of(df, text).alias("text"))
    hashes = with_results(
        plain.select("text"), [text_bytes(plain)], [T.StructField("hashes", T.BinaryType())], to_hashes
    ).select("hashes")
    hashes = store(hashes.where(F.length("hashes") > 0), "line-hashes")
    count = hashes.agg(F.sum(F.length("hashes") / 8)).first()[0] or 0
    builders = max(context.defaultParallelism, 1)
    shared = context.broadcast(twice_seen(hashes, filter_bits(int(count)), builders))

    keyed = plain.withColumn("row", F.xxhash64("doc_id", "text"))

    def to_suspects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from _suspects(batch, shared.value, shortest)

    suspects = keyed.select("row", "doc_id", text_bytes(keyed).alias("text")).mapInArrow(
        to_suspects, T.StructType([*keyed.select("row", "doc_id").schema.fields,
                                   T.StructField("key", T.BinaryType()),
                                   T.StructField("lines", T.ArrayType(T.IntegerType()))])
    )
    suspects = store(suspects, "suspect-lines")
    holders = suspects.select("key", "doc_id")
    if by_id:
        holders = holders.where(F.col("doc_id").isNotNull()).distinct()
    shared_keys = holders.groupBy("key").agg(F.count("*").alias("n"), F.max("doc_id").alias("last"))
    # Stored, so that both sides of the join are shuffled plainly and a hot key is split.
    shared_keys = store(shared_keys.where(F.col("n") >= documents).select("key", "last"), "shared-lines")
    gone = suspects.join(shared_keys, "key").where(~F.col("doc_id").eqNullSafe(F.col("last")))
    gone = gone.groupBy("row", "doc_id").agg(F.flatten(F.collect_list("lines")).alias("lines"))

    row, lines = free_name(df, "row"), free_name(df, "lines")
    gone = gone.select(F.col("row").alias("_row"), F.col("doc_id").alias("_doc_id"), F.col("lines").alias(lines))
    given = df.withColumn(row, F.xxhash64(column_of(df, id), column_of(df, text)))
    met = given.join(
        gone, (given[row] == gone["_row"]) & column_of(given, id).eqNullSafe(gone["_doc_id"]), "left"
    )
    results = [T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())]
    made = with_results(
        met.select(*others(df), lines), [column_of(met, text).cast("binary"), column_of(met, lines)],
        [T.StructField(text, T.StringType()), *results], _cut,
    )
    names = [c for c in df.columns if c.lower() not in ("n_lines", "n_dropped")]
    return made.select(*(column_of(made, c) for c in names), "n_lines", "n_dropped")


def _suspects(batch: pa.RecordBatch, twice: np.ndarray, shortest: int) -> Iterator[pa.RecordBatch]:
    from xxhash import xxh64_intdigest

    rows, keys, lines = [], [], []
    for row, text in enumerate(batch.column(2).to_pylist()):
        found: dict[bytes, list[int]] = {}
        for number, key in line_keys(text, shortest):
            found.setdefault(key, []).append(number)
        rows += [row] * len(found)
        keys += found
        lines += found.values()
    if keys:
        hashes = np.array([xxh64_intdigest(k) for k in keys], dtype=np.uint64)
        hit = np.flatnonzero(is_in(twice, hashes)).tolist()
        at = pa.array([rows[i] for i in hit], pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(at), batch.column(1).take(at), pa.array([keys[i] for i in hit], pa.binary()),
             pa.array([lines[i] for i in hit], pa.list_(pa.int32()))],
            names=["row", "doc_id", "key", "lines"],
        )


def _cut(columns: list[pa.Array]) -> list[pa.Array]:
    texts, counts, dropped = [], [], []
    for text, gone in zip(columns[0].to_pylist(), columns[1].to_pylist(), strict=True):
        parts = (text or b"").split(b"\n")
        counts.append(len(parts))
        if gone:
            out = set(gone)
            kept = [part for i, part in enumerate(parts) if i not in out]
            dropped.append(len(parts) - len(kept))
            text = b"\n".join(kept)
        else:
            dropped.append(0)
        texts.append(None if text is None else text.decode())
    return [pa.array(texts, pa.string()), pa.array(counts, pa.int64()), pa.array(dropped, pa.int64())]
