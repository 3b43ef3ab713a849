"""Exact top-k search by inner product on a bit-sliced index.

Components are quantised to integers. The index has a row per block of vectors: for
each dimension its least value in the block, and the bits of the differences to it as
bitmaps over the block's rows. A query adds up the bitmaps, each as often as its own
component's bits say, with carry-save adders, so 64 scores grow with every word; the
sum is again a list of bitmaps. The best rows are found from the most significant
bitmap down, and rows level at the boundary are told apart by their exact scores.

Blocks and groups of queries are dealt out, each pair of them to one task, and only
the best k of a block leave it. A block and a group of queries have a fixed size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.llm.rows import column_of, is_whole_number, store, with_place

BLOCK_ROWS = 1 << 15
GROUP_QUERIES = 256
#: Unless asked for whole, quantised components are held to this.
_LARGEST = 1 << 24
_LIMB = 60
_BLOCK = "block long, n int, dims int, planes binary, widths binary, least binary, ids binary"


def quantised(df: DataFrame, scale: int, vector: str, id: str, whole: bool = False) -> DataFrame:
    """``(vec_id, x)`` with x = floor(scale * component) of the rows that take part.

    Those are the rows with an id and a vector without null, NaN or infinite
    components. Integers beyond 2 ** 24 count as that, with their sign, and rows with
    empty vectors are left out. With ``whole`` neither holds: integers stay as they are,
    one beyond a long is an error, and an empty vector's scores are 0.
    """
    given = df.select(column_of(df, id).cast("long").alias("vec_id"), column_of(df, vector).alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    given = given.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull()).where(finite)
    if whole:
        fits = lambda x: F.abs(x.cast("double") * scale) < float(1 << 63)
        error = F.raise_error(F.lit("a quantised component exceeds a long")).cast("long")
        number = lambda x: F.when(fits(x), F.floor(x.cast("double") * scale).cast("long")).otherwise(error)
        return given.select("vec_id", F.transform("v", number).alias("x"))
    given = given.where(F.size("v") > 0)
    whole_number = lambda x: F.floor(
        F.greatest(F.lit(-float(_LARGEST)), F.least(F.lit(float(_LARGEST)), x.cast("double") * scale))
    ).cast("long")
    return given.select("vec_id", F.transform("v", whole_number).alias("x"))


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Lists as rows of a matrix, the short ones filled up with zeros."""
    rows = [np.asarray(x, dtype=np.int64) for x in column.to_pylist()]
    table = np.zeros((len(rows), max(map(len, rows), default=0)), dtype=np.int64)
    for out, row in zip(table, rows, strict=True):
        out[: len(row)] = row
    return table


def slices(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The least value and the number of bitmaps of each dimension, and all bitmaps."""
    least = x.min(axis=0)
    over = (x - least).astype(np.uint64)
    widths = np.array([int(m).bit_length() for m in over.max(axis=0)], dtype=np.int64)
    words = -(-len(x) // 64)
    planes = np.zeros((int(widths.sum()), words * 8), dtype=np.uint8)
    at = 0
    for dim, width in enumerate(widths.tolist()):
        for bit in range(width):
            packed = np.packbits(over[:, dim] >> np.uint64(bit) & np.uint64(1) != 0, bitorder="little")
            planes[at, : len(packed)] = packed
            at += 1
    return least, widths, planes.view("<u8")


def build_index(
    df: DataFrame, scale: int = 64, vector: str = "embedding", id: str = "vec_id", block_rows: int = BLOCK_ROWS,
    whole: bool = False,
) -> DataFrame:
    """The index: a row of bitmaps per block of about ``block_rows`` vectors.

    Vectors are dealt to blocks by a hash of the id and the vector. Shorter vectors
    count as filled up with zeros. Repeated rows are rows of their own.
    """
    rows = quantised(df, scale, vector, id, whole)
    rows = store(rows, "quantised")
    blocks = max(1, -(-rows.count() // block_rows))
    place = F.pmod(F.xxhash64("vec_id", "x"), F.lit(blocks))
    salted = rows.withColumn("block", place)

    def pack(key: tuple, table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        x = _matrix(table.column("x"))
        least, widths, planes = slices(x)
        ids = table.column("vec_id").to_numpy()
        return pa.table({
            "block": [key[0].as_py()], "n": pa.array([len(x)], pa.int32()), "dims": pa.array([x.shape[1]], pa.int32()),
            "planes": [planes.tobytes()], "widths": [widths.tobytes()], "least": [least.tobytes()],
            "ids": [ids.astype("<i8").tobytes()],
        })

    return salted.groupBy("block").applyInArrow(pack, _BLOCK)


class Block:
    """One row of the index, ready for queries."""

    def __init__(self, n: int, dims: int, planes: bytes, widths: bytes, least: bytes, ids: bytes):
        self.ids = np.frombuffer(ids, "<i8")
        self.least, self.widths = np.frombuffer(least, "<i8"), np.frombuffer(widths, "<i8")
        self.words = -(-n // 64)
        self.planes = np.frombuffer(planes, "<u8").reshape(-1, self.words)
        self.first = np.concatenate([[0], np.cumsum(self.widths)])
        self.all = np.full(self.words, ~np.uint64(0))
        if n % 64:
            self.all[-1] = (1 << n % 64) - 1
        self.order = np.argsort(self.ids, kind="stable")
        self.sorted = self.ids[self.order]

    def scores(self, query: np.ndarray) -> tuple[int, list[np.ndarray]]:
        """A constant, and the bitmaps that make up each row's score less the constant.

        A negative component takes the complement of a dimension's bitmaps.
        """
        base = 0
        columns: list[list[np.ndarray]] = []
        for dim, value in enumerate(query[: len(self.widths)].tolist()):
            width = int(self.widths[dim])
            base += value * int(self.least[dim])
            planes = self.planes[self.first[dim] : self.first[dim] + width]
            if value < 0:
                base += value * ((1 << width) - 1)
                planes = ~planes
            size, shift = abs(value), 0
            while size:
                if size & 1:
                    for bit in range(width):
                        _count(columns, shift + bit, planes[bit])
                size >>= 1
                shift += 1
        total, carry, place = [], None, 0
        while place < len(columns) or carry is not None:
            parts = columns[place] if place < len(columns) else []
            parts = parts + ([carry] if carry is not None else [])
            carry = None
            if len(parts) == 3:
                total.append(parts[0] ^ parts[1] ^ parts[2])
                carry = (parts[0] & parts[1]) | (parts[2] & (parts[0] | parts[1]))
            elif len(parts) == 2:
                total.append(parts[0] ^ parts[1])
                carry = parts[0] & parts[1]
            else:
                total.append(parts[0] if parts else np.zeros(self.words, np.uint64))
            place += 1
        return base, total

    def best(self, own: int, query: np.ndarray, k: int) -> list[tuple[int, int]]:
        """The k best ``(score, id)`` of the rows of other ids, ties to smaller ids."""
        base, total = self.scores(query)
        left = self.all.copy()
        a, b = np.searchsorted(self.sorted, [own, own + 1])
        for row in self.order[a:b].tolist():
            left[row // 64] &= ~(np.uint64(1) << np.uint64(row % 64))
        sure, sure_count = np.zeros(self.words, np.uint64), 0
        for plane in reversed(total):
            with_bit = left & plane
            count = sure_count + int(np.bitwise_count(with_bit).sum())
            if count > k:
                left = with_bit
            else:
                sure |= with_bit
                left &= ~plane
                sure_count = count
                if count == k:
                    left[:] = 0
                    break
        rows = np.flatnonzero(np.unpackbits((sure | left).view(np.uint8), bitorder="little"))
        word, place = rows // 64, (rows % 64).astype(np.uint64)
        # Sums may pass a long, so they are held in limbs.
        exact = np.zeros((-(-len(total) // _LIMB), len(rows)), np.int64)
        for bit, plane in enumerate(total):
            exact[bit // _LIMB] += ((plane[word] >> place & np.uint64(1)) << np.uint64(bit % _LIMB)).astype(np.int64)
        ids = self.ids[rows]
        order = np.lexsort((ids, *-exact))[:k]
        sums = [sum(int(x) << _LIMB * limb for limb, x in enumerate(exact[:, i])) for i in order]
        return [(base + score, int(ids[i])) for score, i in zip(sums, order, strict=True)]


def _count(columns: list[list[np.ndarray]], place: int, bits: np.ndarray) -> None:
    """Add a bitmap of weight 2 ** place; three of a weight become a sum and a carry."""
    while True:
        while len(columns) <= place:
            columns.append([])
        column = columns[place]
        if len(column) < 2:
            column.append(bits)
            return
        one, two = column
        part = one ^ two
        carry = (one & two) | (part & bits)
        columns[place] = [part ^ bits]
        place, bits = place + 1, carry


def search(
    index: DataFrame, queries: DataFrame, k: int = 20, group_queries: int = GROUP_QUERIES
) -> DataFrame:
    """The ``k`` best rows of an index for each of ``queries(vec_id, x)``.

    Gives ``(query_id, rank, vec_id, score)``: inner products of the quantised
    vectors, ranks from 1, ties to the smaller id. Rows with the query's own id are
    left out; with fewer others than k all are given. A row of queries is a query
    of its own, equal ones collapse. The index should be a stored table.
    """
    asked = queries.select("vec_id", "x").distinct()
    count = asked.count()
    groups = max(1, -(-count // group_queries))
    asked = asked.withColumn("group", F.pmod(F.xxhash64(F.lit(3), "vec_id", "x"), F.lit(groups)))
    asked = asked.groupBy("group").agg(F.collect_list(F.struct("vec_id", "x")).alias("queries"))
    pairs = index.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)).cast("array<bigint>")))
    pairs = pairs.join(asked, "group")
    parts = max(int(index.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    pairs = pairs.select("n", "dims", "planes", "widths", "least", "ids", "queries", "block", "group")
    pairs = pairs.repartition(parts, "block", "group").drop("block", "group")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                one = batch.slice(row, 1)
                block = Block(*(one.column(i)[0].as_py() for i in range(6)))
                found = []
                for query in one.column(6)[0].as_py():
                    vector = np.array(query["x"], dtype=np.int64)
                    best = block.best(query["vec_id"], vector, k)
                    found += [(query["vec_id"], query["x"], score, id) for score, id in best]
                columns = list(zip(*found, strict=True)) or [(), (), (), ()]
                kinds = [pa.int64(), pa.list_(pa.int64()), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                    names=["query_id", "x", "score", "vec_id"],
                )

    found = pairs.mapInArrow(run, "query_id long, x array<long>, score long, vec_id long")
    found = found.select("query_id", F.xxhash64("x").alias("version"), "score", "vec_id")
    best = Window.partitionBy("query_id", "version").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )


def top_k(
    df: DataFrame, k: int = 20, scale: int = 64, every: int = 20, vector: str = "embedding", id: str = "vec_id",
    whole: bool = False,
) -> DataFrame:
    """Index all vectors and search it with those whose id ``every`` divides.

    See :func:`quantised` for the rows that take part, :func:`search` for the result.
    A score beyond a long among the best of a block is an error.
    Ids may be of any type that can be sorted; ties go by that order, texts by their
    bytes. Ids that do not read as whole numbers of up to 20 digits are no queries, but
    are found by others.
    An empty table gives no rows.
    """
    if not is_whole_number(df.schema[id].dataType):
        return _top_k_of_any_ids(df.select(column_of(df, id).alias("id"), column_of(df, vector).alias("v")), k, scale, every, whole)
    index = store(build_index(df, scale, vector, id, whole=whole), "index")
    queries = quantised(df, scale, vector, id, whole).where(F.pmod("vec_id", F.lit(every)) == 0)
    return search(index, queries, k)


def _top_k_of_any_ids(given: DataFrame, k: int, scale: int, every: int, whole: bool) -> DataFrame:
    """:func:`top_k` by the places of ids in their order, which give way to the ids at the end."""
    placed = store(with_place(given, "id"), "placed")
    number = F.expr("try_cast(cast(id as string) as decimal(38, 18))")
    index = store(build_index(placed, scale, "v", "place", whole=whole), "index")
    queries = quantised(placed.where(number % every == 0), scale, "v", "place", whole)
    names = placed.where("id is not null").select("id", "place").distinct()
    found = search(index, queries, k)
    found = found.join(names.select(F.col("id").alias("one"), F.col("place").alias("query_id")), "query_id")
    found = found.join(names.select(F.col("id").alias("other"), F.col("place").alias("vec_id")), "vec_id")
    return found.select(F.col("one").alias("query_id"), "rank", F.col("other").alias("vec_id"), "score")
