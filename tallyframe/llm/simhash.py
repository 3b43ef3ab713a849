"""Near copies by SimHash fingerprints, compared bit plane by bit plane.

1. Fingerprints are computed per text in Arrow batches and written once.
2. Equal fingerprints collapse, so copies of any number are one from here on.
3. Two fingerprints within ``radius`` bits agree in at least one of ``radius + 1``
   bands of bits. Fingerprints are dealt by each band's value; a band value shared
   by more than ``tile`` fingerprints is dealt as pairs of smaller tiles, so that no
   task gets all of them. Nothing is dropped.
4. A task keeps the fingerprints of its buckets as vertical bit planes, 64 of them
   per word, and compares one fingerprint with 64 others at a time: the differing
   bits of each plane go into bitwise carry-save counters, and a word is abandoned
   when all its 64 distances exceed the radius. Only links of a spanning forest
   per task leave it.
5. Components of the links give the classes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.llm.components import components
from tallyframe.llm.rows import column_of, store, text_bytes, with_results

_ONE = np.uint64(1)
_PAIRS = 1 << 15
_SEED = 42
_HASHES = 1 << 18


def text_fingerprint(text: bytes, shingle: int) -> int:
    """SimHash of a UTF-8 text: a bit is set if over half of the shingles' hashes set it."""
    from xxhash import xxh64_intdigest

    words = text.lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    if len(words) > shingle:
        starts, ends = starts[: len(words) - shingle + 1], ends[shingle - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    set_in = np.zeros(64, np.int64)
    for first in range(0, len(starts), _HASHES):
        pairs = zip(starts[first : first + _HASHES].tolist(), ends[first : first + _HASHES].tolist(), strict=True)
        hashes = np.array([xxh64_intdigest(line[s:e], _SEED) for s, e in pairs], dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        set_in += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * set_in > len(starts), bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame, shingle: int = 3, text: str = "text") -> DataFrame:
    """Each row with ``fingerprint``, the 64 bits as a signed long.

    A-Z is lower-cased, words are what space and 09 to 0D separate, a shingle is
    ``shingle`` words with single spaces, hashed as UTF-8 by XXH64 with seed 42.
    A shorter text is one shingle; null, empty and blank texts have fingerprint 0.
    """
    def run(columns: list[pa.Array]) -> list[pa.Array]:
        found = [text_fingerprint(x, shingle) for x in columns[0].to_pylist()]
        return [pa.array(np.array(found, dtype=np.uint64).view(np.int64), pa.int64())]

    return with_results(df, [text_bytes(df, text)], [T.StructField("fingerprint", T.LongType())], run)


def _planes(values: np.ndarray) -> np.ndarray:
    """64 rows of words: bit ``i`` of word ``w`` in row ``b`` is bit ``b`` of value 64w+i."""
    filled = np.zeros(-(-len(values) // 64) * 64, dtype="<u8")
    filled[: len(values)] = values
    bits = np.unpackbits(filled.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view("<u8")


def _above(counters: list[np.ndarray], radius: int) -> np.ndarray:
    """Lanes whose counter, given by bit planes from the lowest, exceeds the radius."""
    over = np.zeros_like(counters[0])
    equal = ~over
    for place in reversed(range(len(counters))):
        if radius >> place & 1:
            equal = equal & counters[place]
        else:
            over |= equal & counters[place]
            equal = equal & ~counters[place]
    return over


def close_pairs(
    values: np.ndarray, first: np.ndarray, last: np.ndarray, radius: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions ``(i, j)`` of values at most ``radius`` bits apart.

    Value ``i`` is compared with the values at ``first[i] <= j < last[i]``, a word
    of 64 at a time.
    """
    planes = _planes(values)
    rows = np.flatnonzero(last > first)
    if not len(rows):
        return
    words = (last[rows] - 1) // 64 - first[rows] // 64 + 1
    ends = np.cumsum(words)
    digits = max(1, int(radius).bit_length())
    for begin in range(0, int(ends[-1]), _PAIRS):
        at = np.arange(begin, min(begin + _PAIRS, int(ends[-1])))
        which = np.searchsorted(ends, at, side="right")
        row = rows[which]
        word = first[row] // 64 + at - (ends[which] - words[which])
        low = np.clip(first[row] - word * 64, 0, 64)
        high = np.clip(last[row] - word * 64, 0, 64)
        alive = _ones(high) & ~_ones(low)
        counters = [np.zeros(len(at), np.uint64) for _ in range(digits)]
        for plane in range(64):
            own = -(values[row] >> np.uint64(plane) & _ONE)
            carry = (planes[plane][word] ^ own) & alive
            for counter in counters:
                kept = counter & carry
                counter ^= carry
                carry = kept
            alive &= ~carry
            if plane % 4 == 3 or plane == 63:
                alive &= ~_above(counters, radius)
                left = np.flatnonzero(alive)
                if len(left) < 0.8 * len(alive):
                    row, word, alive = row[left], word[left], alive[left]
                    counters = [c[left] for c in counters]
                if not len(left):
                    break
        if len(alive):
            lanes = np.unpackbits(alive.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            pair, lane = np.nonzero(lanes)
            yield row[pair], word[pair] * 64 + lane


def _ones(count: np.ndarray) -> np.ndarray:
    """Words whose lowest ``count`` bits are set, for counts from 0 to 64."""
    count = count.astype(np.uint64)
    return np.where(count >= 64, ~np.uint64(0), (_ONE << (count & np.uint64(63))) - _ONE)


def _roots(parent: np.ndarray) -> np.ndarray:
    while not np.array_equal(above := parent[parent], parent):
        parent = above
    return parent


def _forest(i: np.ndarray, j: np.ndarray, parent: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """The forest ``parent`` with these links, and those links that join two trees."""
    parent = _roots(parent)
    ends = np.sort(np.stack([parent[i], parent[j]]), axis=0)
    new = np.flatnonzero(ends[0] != ends[1])
    new = new[np.unique(ends[0][new] * len(parent) + ends[1][new], return_index=True)[1]]
    kept = []
    for a, b in zip(i[new].tolist(), j[new].tolist(), strict=True):
        low, high = a, b
        while parent[low] != low:
            low = parent[low]
        while parent[high] != high:
            high = parent[high]
        if low != high:
            parent[max(low, high)] = min(low, high)
            kept.append((a, b))
    return parent, kept


def bucket_links(
    bucket: np.ndarray, side: np.ndarray, values: np.ndarray, radius: int
) -> tuple[np.ndarray, np.ndarray]:
    """Links of values in one bucket; rows are sorted by bucket and side.

    Side 0 is compared with itself and side 1 with side 0, when both are there; a
    bucket of side 1 alone has no pairs of its own.
    """
    size = len(values)
    starts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
    ends = np.concatenate([starts[1:], [size]])
    run = np.repeat(np.arange(len(starts)), ends - starts)
    position = np.arange(size)
    zeros = np.concatenate([[0], np.cumsum(side == 0)])
    middle = starts[run] + (zeros[ends] - zeros[starts])[run]
    twofold = (middle < ends[run])
    first = np.where(twofold, middle, position + 1)
    last = np.where(side == 1, first, ends[run])
    parent, kept = np.arange(size), []
    for i, j in close_pairs(values, first, last, radius):
        parent, found = _forest(i, j, parent)
        kept += found
    if not kept:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    pairs = np.array(kept)
    return values[pairs[:, 0]].view(np.int64), values[pairs[:, 1]].view(np.int64)


def fingerprint_links(values: DataFrame, radius: int = 2, tile: int = 1 << 14) -> DataFrame:
    """Links ``(a, b)`` that connect distinct ``fingerprint`` values as all pairs within
    ``radius`` bits do. ``values`` should be a stored table; equal values collapse."""
    bands = radius + 1
    edges = [64 * i // bands for i in range(bands + 1)]
    masked = [
        F.shiftrightunsigned("fingerprint", edges[i]).bitwiseAND((1 << edges[i + 1] - edges[i]) - 1)
        if bands > 1 else F.col("fingerprint")
        for i in range(bands)
    ]
    distinct = values.select("fingerprint").distinct()
    dealt = distinct.select(
        "fingerprint",
        F.explode(F.array(*(F.struct(F.lit(i).alias("band"), m.alias("value")) for i, m in enumerate(masked)))).alias("at"),
    ).select("fingerprint", "at.*")
    large = dealt.groupBy("band", "value").count().where(F.col("count") > tile)
    large = large.select("band", "value", F.ceil(F.col("count") / tile).cast("int").alias("tiles"))
    dealt = dealt.join(large, ["band", "value"], "left").withColumn("tiles", F.coalesce("tiles", F.lit(1)))
    own = F.pmod(F.xxhash64(F.lit(7), "fingerprint"), F.col("tiles")).cast("int")
    tiles = F.transform(
        F.sequence(F.lit(0), F.col("tiles") - 1),
        lambda k: F.struct(
            F.least(own, k).alias("low"), F.greatest(own, k).alias("high"), (own > k).cast("int").alias("side")
        ),
    )
    dealt = dealt.select("band", "value", F.explode(tiles).alias("t"), "fingerprint")
    # The lowest bit tells pairs of tiles from single ones, whatever else collides.
    cross = (F.col("t.low") != F.col("t.high")).cast("long")
    key = F.xxhash64("band", "value", "t.low", "t.high").bitwiseAND(F.lit(-2)).bitwiseOR(cross)
    dealt = dealt.select(key.alias("bucket"), F.col("t.side").alias("side"), "fingerprint")
    dealt = dealt.repartition("bucket").sortWithinPartitions("bucket", "side")
    limit = max(4 * tile, 1 << 18)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, side, bits in _whole_buckets(batches, limit):
            a, b = bucket_links(bucket, side, bits.view(np.uint64), radius)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return dealt.mapInArrow(run, "a long, b long")


def _whole_buckets(batches: Iterator[pa.RecordBatch], limit: int):
    """Sorted rows in groups of about ``limit`` that never part a bucket."""
    held: list[list[np.ndarray]] = []
    count = 0
    for batch in batches:
        held.append([c.to_numpy(zero_copy_only=False) for c in batch.columns])
        count += batch.num_rows
        if count >= limit:
            joined = [np.concatenate(parts) for parts in zip(*held, strict=True)]
            cut = int(np.searchsorted(joined[0], joined[0][-1]))
            if cut:
                yield [part[:cut] for part in joined]
            held, count = [[part[cut:] for part in joined]], len(joined[0]) - cut
    if count:
        yield [np.concatenate(parts) for parts in zip(*held, strict=True)]


def near_copies(
    df: DataFrame, shingle: int = 3, radius: int = 2, text: str = "text", id: str = "doc_id"
) -> DataFrame:
    """Each row's id with ``fingerprint`` (16 hex digits) and ``component_id``.

    Fingerprints link at ``radius`` or fewer differing bits, and ``component_id`` is
    the smallest id that links reach, a row's own included. Rows without words have
    fingerprint 0 and are linked like any other. Null ids are never the smallest; a
    component of null ids only has a null ``component_id``. Repeated rows stay, each
    with the same result; ties do not arise. An empty table gives none.
    """
    return _classes(df, shingle, radius, text, id).select(
        F.col("doc_id").alias(id), F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id"
    )


def _classes(df: DataFrame, shingle: int, radius: int, text: str, id: str) -> DataFrame:
    """``(doc_id, fingerprint, digest, root, component_id)`` of each row; roots tell components apart."""
    plain = df.select(column_of(df, id).alias("doc_id"), column_of(df, text).alias("text"))
    given = fingerprints(plain, shingle).select("doc_id", "fingerprint", F.xxhash64("text").alias("digest"))
    given = store(given, "fingerprints")
    roots = components(fingerprint_links(given, radius))
    least = given.groupBy("fingerprint").agg(F.min("doc_id").alias("least"))
    least = least.join(roots.withColumnRenamed("node", "fingerprint"), "fingerprint", "left")
    least = least.withColumn("root", F.coalesce("root", "fingerprint"))
    class_of = least.groupBy("root").agg(F.min("least").alias("component_id"))
    least = least.join(class_of, "root").select("fingerprint", "root", "component_id")
    return given.join(least, "fingerprint")


def one_of_each(
    df: DataFrame, shingle: int = 3, radius: int = 2, text: str = "text", id: str = "doc_id"
) -> DataFrame:
    """The rows without near copies: one row of each component.

    It is the one of the smallest id, null ids last; then of the least fingerprint and
    the least hash of the text; of rows alike in id and text that of the least hash of
    all columns but maps. Columns stay as they are.
    """
    classes = store(_classes(df, shingle, radius, text, id), "classes")
    rank = F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "fingerprint", "digest")
    first = classes.groupBy("root").agg(F.min(rank).alias("first"))
    first = first.select("root", F.col("first.doc_id").alias("own"), F.col("first.digest").alias("text"))
    # Rows alike in id and text have one fingerprint, so all of them are in one component.
    rows = classes.groupBy("root", "doc_id", "digest").agg(F.count("*").alias("n")).join(first, "root")
    stands = F.col("doc_id").eqNullSafe(F.col("own")) & (F.col("digest") == F.col("text"))
    keys = rows.where(~stands | (F.col("n") > 1)).select(
        F.col("doc_id").alias("_id"), F.col("digest").alias("_digest"), stands.alias("_stands")
    )
    keys = store(keys, "copies")
    own, digest = column_of(df, id), F.xxhash64(column_of(df, text))
    same = lambda found: own.eqNullSafe(found["_id"]) & (digest == found["_digest"])
    kept = df.join(keys, same(keys), "left_anti")
    repeated = keys.where("_stands")
    if repeated.isEmpty():
        return kept
    hashed = [column_of(df, f.name) for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
    alike = df.join(repeated, same(repeated), "left_semi")
    alike = alike.groupBy(own.alias("_id"), digest.alias("_digest")).agg(
        F.min_by(F.struct(*(column_of(df, c) for c in df.columns)), F.xxhash64(*hashed)).alias("_row")
    )
    return kept.unionByName(alike.select("_row.*"))
