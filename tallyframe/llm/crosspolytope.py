"""Near copies among vectors: cross-polytope hashing, probes beside it, exact checks.

1. Equal vectors collapse into one class, so copies of any number are one from here on.
2. A class's vector is turned by three rounds of random signs and a fast Hadamard
   transform; the hash is the nearest of the 2 d signed axes. A table's bucket is made
   of several such hashes, as many as the number of classes allows without buckets that
   are all but empty. Beside its own bucket a class stands in the ones it came near to:
   of the next axes of every hash, those with the least squared loss. Both sides do so.
3. Classes of a bucket are compared in blocks by products of matrices, in double
   precision. A bucket of more than ``tile`` classes is dealt as pairs of tiles, so that
   no task gets all of it. Nothing is dropped.
4. A pair counts in the first bucket that both share, so links are counted once although
   no pair leaves a task: only sums for each class do, and a spanning forest of links.
5. Components of the forest give the groups.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.llm.components import components
from tallyframe.llm.rows import binary_parts, column_of, store, with_results

_SEED = 11
_ROUNDS = 3
#: Rows of a bucket that are compared with so many others at a time; pairs checked at a time.
_BLOCK, _OTHERS, _PAIRS = 512, 4096, 1 << 16
#: Rows that are hashed at a time.
_ROWS = 2048


def packed_vectors(array: pa.Array, kind: str) -> list[bytes | None]:
    """Vectors as bytes, without zeros at the end; None where one takes no part.

    That is where it is null, zero, empty, or holds null, NaN or infinite components.
    Doubles are divided by a power of two, which leaves their direction as it is.
    """
    values = array.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False)
    lengths = array.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths)
    out: list[bytes | None] = []
    for begin, end in zip((ends - lengths).tolist(), ends.tolist(), strict=True):
        x = values[begin:end]
        places = np.flatnonzero(x)
        if not len(places) or not np.isfinite(x).all():
            out.append(None)
            continue
        x = x[: places[-1] + 1] + x.dtype.type(0)
        if kind == "<f8":
            x = np.ldexp(x, -int(np.frexp(np.abs(x).max())[1]))
        out.append(x.tobytes())
    return out


def matrix_of(array: pa.Array, kind: str, dims: int) -> np.ndarray:
    """Packed vectors as unit rows in double precision, filled up with zeros."""
    data, places = binary_parts(array)
    size = np.dtype(kind).itemsize
    rows = np.zeros((len(array), dims))
    lengths = np.diff(places) // size
    values = np.frombuffer(data.tobytes(), dtype=kind)
    rows[np.arange(dims) < lengths[:, None]] = values
    return rows / np.sqrt(np.einsum("ij,ij->i", rows, rows))[:, None]


def hadamard(rows: np.ndarray) -> np.ndarray:
    """The fast Hadamard transform of every row; their length is a power of two."""
    count, size = rows.shape
    half = 1
    while half < size:
        parts = rows.reshape(count, size // (2 * half), 2, half)
        rows = np.stack([parts[:, :, 0] + parts[:, :, 1], parts[:, :, 0] - parts[:, :, 1]], axis=2).reshape(count, size)
        half *= 2
    return rows


def _padded(dims: int) -> int:
    """The least power of two that is not below so many dimensions, 32 at least."""
    return max(32, 1 << (dims - 1).bit_length())


def codes(unit: np.ndarray, hashes: int, tables: int, probes: int) -> np.ndarray:
    """The buckets of every row: ``probes`` of each of ``tables`` tables, each a long.

    A table's buckets are numbered from ``table * (2 * size) ** hashes`` on, ``size`` being
    the padded number of dimensions. A row's own bucket is the first of each table.
    """
    size = _padded(unit.shape[1])
    signs = np.random.default_rng(_SEED).choice([-1.0, 1.0], size=(tables, hashes, _ROUNDS, size))
    # So many of the axes nearest to each hash can fill all probes.
    offered = probes if hashes <= 2 else max(2, probes // 2)
    combos = np.array(list(product(range(offered), repeat=hashes)))
    made = np.empty((len(unit), tables * probes), dtype=np.int64)
    for low in range(0, len(unit), _ROWS):
        part = unit[low : low + _ROWS]
        rows = np.zeros((len(part), size))
        rows[:, : part.shape[1]] = part
        for table in range(tables):
            loss = np.zeros((len(rows), len(combos)))
            code = np.zeros((len(rows), len(combos)), dtype=np.int64)
            for hash_ in range(hashes):
                turned = rows
                for sign in signs[table, hash_]:
                    turned = hadamard(turned * sign) / np.sqrt(size)
                height = np.concatenate([turned, -turned], axis=1)
                near = np.argpartition(-height, offered - 1, axis=1)[:, :offered]
                height = np.take_along_axis(height, near, axis=1)
                order = np.lexsort((near, -height))
                near, height = np.take_along_axis(near, order, axis=1), np.take_along_axis(height, order, axis=1)
                loss += ((height[:, :1] - height) ** 2)[:, combos[:, hash_]]
                code = code * (2 * size) + near[:, combos[:, hash_]]
            best = np.argsort(loss, axis=1, kind="stable")[:, :probes]
            own = np.take_along_axis(code, best, axis=1) + table * (2 * size) ** hashes
            made[low : low + _ROWS, table * probes : (table + 1) * probes] = own
    return made


def layout(classes: int, dims: int) -> tuple[int, int, int]:
    """Hashes a table, tables and probes for so many classes.

    The buckets of a table are at most as many as the classes. A pair at a cosine of 0.9
    shares a bucket of a table by a chance of 0.99 with one hash, 0.75 with two, 0.7 with
    three and 0.45 with four (measured at 64 dimensions), so the tables together miss less
    than one in a hundred of such pairs, and fewer of closer ones.
    """
    buckets = 2 * _padded(dims)
    hashes = 1
    while buckets ** (hashes + 1) <= classes:
        hashes += 1
    tables = 2 if hashes == 1 else 4 << max(0, hashes - 3)
    return hashes, tables, 4 if hashes <= 2 else 8


def _first_shared(left: np.ndarray, right: np.ndarray, bucket: np.ndarray, probes: int) -> np.ndarray:
    """Pairs of rows of buckets that share none before the given one."""
    first = np.ones(len(left), dtype=bool)
    alive = np.arange(len(left))
    for low in range(0, left.shape[1], probes):
        # Buckets of a table are all below those of the next one.
        alive = alive[left[alive, low : low + probes].min(axis=1) < bucket[alive]]
        if not len(alive):
            break
        a, b = left[alive, low : low + probes, None], right[alive, None, low : low + probes]
        earlier = ((a == b) & (a < bucket[alive, None, None])).any(axis=(1, 2))
        first[alive[earlier]] = False
        alive = alive[~earlier]
    return first


def _united(root: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The least place of each tree when these links join trees; roots lead to themselves."""
    while True:
        a, b = root[i], root[j]
        apart = a != b
        if not apart.any():
            return root
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while not np.array_equal(above := root[root], root):
            root = above


def bucket_links(
    bucket: np.ndarray, tile: np.ndarray, other: np.ndarray, side: np.ndarray, unit: np.ndarray, held: np.ndarray,
    weight: np.ndarray, cosine: float, probes: int,
) -> tuple[np.ndarray, np.ndarray]:
    """For rows sorted by bucket, tiles and side: the weights of the rows that each links
    with, and the root of each in a forest that joins all links found.

    Where ``tile`` and ``other`` differ, side 1 is compared with side 0 only, and else all
    with all. ``held`` has the buckets of each row, and ``bucket`` the one of them it stands here for.
    """
    size = len(bucket)
    links, root = np.zeros(size, dtype=np.int64), np.arange(size)
    cross = tile != other
    new = (bucket[1:] != bucket[:-1]) | (tile[1:] != tile[:-1]) | (other[1:] != other[:-1])
    starts = np.flatnonzero(np.concatenate([[True], new]))
    for start, end in zip(starts.tolist(), [*starts[1:].tolist(), size], strict=True):
        middle = start + int(np.searchsorted(side[start:end], 1)) if cross[start] else end
        for low in range(start, middle, _BLOCK):
            high = min(low + _BLOCK, middle)
            for first in range(middle if cross[start] else low, end, _OTHERS):
                last = min(first + _OTHERS, end)
                near = unit[low:high] @ unit[first:last].T >= cosine
                if not cross[start]:
                    near &= np.arange(first, last) > np.arange(low, high)[:, None]
                i, j = np.nonzero(near)
                for pair in range(0, len(i), _PAIRS):
                    a, b = i[pair : pair + _PAIRS] + low, j[pair : pair + _PAIRS] + first
                    new = _first_shared(held[a], held[b], bucket[a], probes)
                    a, b = a[new], b[new]
                    np.add.at(links, a, weight[b])
                    np.add.at(links, b, weight[a])
                    root = _united(root, a, b)
    return links, root


def _dealt(classes: DataFrame, tile: int) -> DataFrame:
    """A row for each class and bucket, of buckets beyond ``tile`` one for each pair of tiles."""
    placed = classes.select("node", F.explode("codes").alias("bucket"))
    large = placed.groupBy("bucket").count().where(F.col("count") > tile)
    large = store(large.select("bucket", F.ceil(F.col("count") / tile).cast("int").alias("tiles")), "large-buckets")
    dealt = classes.withColumn("bucket", F.explode("codes"))
    # Vectors are dealt once, unless some buckets have to be found among theirs.
    dealt = dealt.withColumn("tiles", F.lit(1)) if large.isEmpty() else dealt.join(large, "bucket", "left")
    dealt = dealt.withColumn("tiles", F.coalesce("tiles", F.lit(1)))
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64(F.lit(5), "node"), F.col("tiles")).cast("int"))
    own = F.col("own")
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("tiles") - 1),
        lambda k: F.struct(F.least(own, k).alias("low"), F.greatest(own, k).alias("high"), (own > k).cast("int").alias("side")),
    )
    dealt = dealt.withColumn("t", F.explode(pairs))
    return dealt.select(
        "bucket", "t.low", "t.high", "t.side", "node", "n", "codes", "v"
    ).repartition("bucket", "low", "high").sortWithinPartitions("bucket", "low", "high", "side")


def _whole_buckets(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.Table]:
    """Sorted rows in tables of about ``limit`` that never part a bucket's tiles."""
    held: list[pa.RecordBatch] = []
    count = 0
    for batch in batches:
        held.append(batch)
        count += batch.num_rows
        if count >= limit:
            table = pa.Table.from_batches(held).combine_chunks()
            key = np.stack([table.column(c).to_numpy() for c in ("bucket", "low", "high")])
            other = np.flatnonzero((key != key[:, -1:]).any(axis=0))
            cut = int(other[-1]) + 1 if len(other) else 0
            if cut:
                yield table.slice(0, cut)
            held, count = table.slice(cut).to_batches(), count - cut
    if count:
        yield pa.Table.from_batches(held).combine_chunks()


def class_links(classes: DataFrame, cosine: float, kind: str, dims: int, probes: int, tile: int = 1 << 14) -> DataFrame:
    """``(a, b, links)``: links of a spanning forest, or with a null ``b`` numbers of links.

    ``classes`` is a stored table of ``(node, n, codes, v)``.
    """
    limit = max(2 * tile, 1 << 15)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_buckets(batches, limit):
            one = lambda name: table.column(name).combine_chunks()
            node = one("node")
            flat = lambda name: one(name).to_numpy(zero_copy_only=False)
            held = one("codes").flatten().to_numpy().reshape(len(node), -1)
            unit = matrix_of(one("v"), kind, dims)
            links, root = bucket_links(
                *(flat(c) for c in ("bucket", "low", "high", "side")), unit, held, flat("n"), cosine, probes
            )
            some = np.flatnonzero(links)
            joined = np.flatnonzero(root != np.arange(len(node)))
            yield pa.RecordBatch.from_arrays([
                pa.concat_arrays([node.take(pa.array(some)), node.take(pa.array(joined))]),
                pa.concat_arrays([pa.nulls(len(some), node.type), node.take(pa.array(root[joined]))]),
                pa.concat_arrays([pa.array(links[some]), pa.nulls(len(joined), pa.int64())]),
            ], names=["a", "b", "links"])

    return _dealt(classes, tile).mapInArrow(run, "a binary, b binary, links long")


def near_vectors(
    df: DataFrame, cosine: float = 0.9, vector: str = "embedding", id: str = "vec_id", tile: int = 1 << 14
) -> DataFrame:
    """Each row's id with ``n_links``, ``component_id`` and ``kept``.

    Rows link when the cosine of their vectors, in double precision, is ``cosine`` or more
    and hashing brings them together (see ``layout``); equal vectors always do. ``n_links``
    counts a row's links to other rows, ``component_id`` is the smallest id that links
    reach, the row's own included, and ``kept`` says whether that is its own.

    Vectors that are null, empty, zero or hold null, NaN or infinite components link with
    nothing. Shorter vectors count as filled up with zeros. Rows are vectors of their own
    even if ids or whole rows repeat, and rows of equal vectors have equal results but for
    ``kept``. Null ids are never the smallest; a component of null ids only has a null
    ``component_id`` and keeps all its rows. An empty table gives none.
    """
    spark = df.sparkSession
    field = df.select(column_of(df, vector)).schema[0].dataType
    kind = "<f4" if isinstance(field.elementType, T.FloatType) else "<f8"
    given = df.select(column_of(df, id).alias("vec_id"), column_of(df, vector).alias("_v"))
    vectors = F.col("_v") if kind == "<f4" else F.col("_v").cast("array<double>")
    given = with_results(
        given, [vectors], [T.StructField("v", T.BinaryType())],
        lambda columns: [pa.array(packed_vectors(columns[0], kind), pa.binary())],
    ).select("vec_id", "v", F.unhex(F.md5("v")).alias("node"))
    given = store(given, "vectors")
    classes = given.where("node is not null").groupBy("v").agg(F.count("*").alias("n"), F.min("vec_id").alias("least"))
    classes = store(classes.withColumn("node", F.unhex(F.md5("v"))), "vector-classes")
    count, longest = classes.agg(F.count("*"), F.max(F.length("v"))).first()
    alone = given.where("node is null").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept")
    )
    if not count:
        return alone.withColumnRenamed("vec_id", id)
    dims = longest // np.dtype(kind).itemsize
    hashes, tables, probes = layout(count, dims)

    def hashed(columns: list[pa.Array]) -> list[pa.Array]:
        made = codes(matrix_of(columns[0], kind, dims), hashes, tables, probes)
        offsets = np.arange(len(made) + 1, dtype=np.int32) * made.shape[1]
        return [pa.ListArray.from_arrays(pa.array(offsets), pa.array(made.ravel()))]

    coded = with_results(classes, [F.col("v")], [T.StructField("codes", T.ArrayType(T.LongType()))], hashed)
    coded = store(coded, "vector-codes")
    found = store(class_links(coded, cosine, kind, dims, probes, tile), "vector-links")
    sums = found.where("b is null").groupBy("a").agg(F.sum("links").alias("links"))
    roots = components(found.where("b is not null").select("a", "b"))
    info = classes.select("node", "n", "least").join(sums.withColumnRenamed("a", "node"), "node", "left")
    info = info.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    # Stored, as a join on what is grouped by its key could not split the classes of one root.
    info = store(info, "vector-roots")
    group = store(info.groupBy("root").agg(F.min("least").alias("component_id")), "vector-groups")
    info = info.join(group, "root").select(
        "node", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id"
    )
    linked = given.where("node is not null").select("vec_id", "node").join(info, "node")
    linked = linked.select("vec_id", "n_links", "component_id", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"))
    return linked.unionByName(alone).withColumnRenamed("vec_id", id)
