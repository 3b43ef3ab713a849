"""Shards of near equal bytes: the smallest capacity that contiguous groups allow.

Rows of equal text are one group and stay together. Groups are ordered by the hash
of their text. The least capacity that lets so many shards hold all groups in order
is found by binary search, each capacity checked greedily.

The driver never sees all groups. It holds ranges of the order with their bytes,
and gets two bounds of the capacity: one with every range whole, one with ranges
cut anywhere. Only ranges in which a cut can lie between these bounds are split
further by a Spark job, until the bounds meet. Their number depends on the number
of shards, not on the rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.llm.rows import column_of, store

_FIRST_BITS = 14
_MORE_BITS = 8
_ROWS_PER_PART = 200_000
_MOST_PARTS = 4096


class Ranges:
    """Neighbouring ranges of ordered groups: where each begins, its bytes, and whether
    it is a single group."""

    def __init__(self, begin: np.ndarray, size: np.ndarray, single: np.ndarray):
        order = np.argsort(begin)
        self.begin, self.size, self.single = begin[order], size[order], single[order]
        self.upto = np.concatenate([[0], np.cumsum(self.size)])
        self.total = int(self.upto[-1])

    def whole(self, start: int, capacity: int) -> int:
        """The end of a shard from ``start`` on if no range is cut."""
        return int(self.upto[np.searchsorted(self.upto, start + capacity, side="right") - 1])

    def cut(self, start: int, capacity: int) -> int:
        """The end of a shard if ranges of several groups are cut anywhere."""
        end = min(start + capacity, self.total)
        at = int(np.searchsorted(self.upto, end, side="right")) - 1
        return int(self.upto[at]) if at < len(self.single) and self.single[at] else end

    def ends(self, capacity: int, shards: int, step) -> list[int]:
        found, start = [], 0
        for _ in range(shards):
            start = step(start, capacity)
            found.append(start)
        return found

    def least(self, low: int, shards: int, step) -> int:
        """The smallest capacity from ``low`` on at which all fits."""
        high = max(low, self.total)
        while low < high:
            middle = (low + high) // 2
            if self.ends(middle, shards, step)[-1] >= self.total:
                high = middle
            else:
                low = middle + 1
        return low

    def even_cuts(self, capacity: int, shards: int) -> list[int]:
        """Byte positions of cuts that keep to the capacity and are as even as it allows."""
        latest = [self.total]
        for _ in range(shards):  # from the end: how early the shards after a cut may begin
            wanted = latest[-1] - capacity
            latest.append(int(self.upto[np.searchsorted(self.upto, max(wanted, 0), side="left")]))
        cuts, start = [], 0
        for shard in range(1, shards):
            share = start + (self.total - start) / (shards - shard + 1)
            at = int(np.searchsorted(self.upto, share))
            near = self.upto[max(at - 1, 0) : at + 1]
            wanted = int(near[np.abs(near - share).argmin()])
            start = min(max(wanted, latest[shards - shard], start), self.whole(start, capacity))
            cuts.append(start)
        return cuts


def _ranges(groups: DataFrame, bits: int) -> tuple[np.ndarray, ...]:
    found = groups.groupBy(F.shiftright("group", 64 - bits).alias("range")).agg(
        F.sum("size").alias("size"), F.min("group").alias("begin"), F.count("*").alias("groups")
    ).select("begin", "size", "groups", "range").collect()
    table = np.array([tuple(row) for row in found], dtype=np.int64).reshape(-1, 4)
    return table[:, 0], table[:, 1], table[:, 2] == 1, table[:, 3]


def capacity_and_cuts(groups: DataFrame, shards: int) -> tuple[int, list[int]]:
    """The least capacity for ``groups(group, size)``, and the first group of each shard
    but the first; a shard without groups begins where the next one does."""
    bits = _FIRST_BITS
    begin, size, single, _ = _ranges(groups, bits)
    if not len(begin):
        return 0, []
    largest = int(groups.agg(F.max("size")).first()[0])
    ranges = Ranges(begin, size, single)
    while True:
        floor = max(largest, -(-ranges.total // shards))
        low, high = ranges.least(floor, shards, ranges.cut), ranges.least(floor, shards, ranges.whole)
        if low == high or bits >= 64:
            break
        first = ranges.ends(low, shards, ranges.whole)
        last = ranges.ends(high, shards, ranges.cut)
        open_ = np.zeros(len(ranges.begin), bool)
        for a, b in zip(first, last, strict=True):
            open_ |= (ranges.upto[1:] >= a) & (ranges.upto[:-1] <= b)
        open_ &= ~ranges.single
        names = (ranges.begin[open_] >> (64 - bits)).tolist()
        finer = groups.where(F.shiftright("group", 64 - bits).isin(names))
        bits = min(64, bits + _MORE_BITS)
        begin, size, single, _ = _ranges(finer, bits)
        ranges = Ranges(
            np.concatenate([ranges.begin[~open_], begin]), np.concatenate([ranges.size[~open_], size]),
            np.concatenate([ranges.single[~open_], single]),
        )
    # Ranges that were not split have several lengths of prefix; only begins matter here.
    at = np.searchsorted(ranges.upto, ranges.even_cuts(high, shards))
    begins = np.append(ranges.begin, np.iinfo(np.int64).max)
    return high, [int(begins[i]) for i in at]


def shard(df: DataFrame, shards: int = 24, text: str = "text", id: str = "doc_id") -> DataFrame:
    """Each row's id with its size, checksum, ``shard`` and ``slot`` within the shard.

    The size is the bytes of the text plus 8, the checksum CRC-32 of its UTF-8
    bytes; a null text has none and counts as empty. ``law`` is ``bytes``: the
    largest shard is as small as groups of equal texts in hash order allow, and the
    others are as even as that leaves them. Slots count from 0 without gaps, in no
    promised order. ``grown_shard`` is null.

    Repeated rows each have a slot, null ids too. A group larger than a fair share
    fills a shard alone; with fewer groups than shards some stay empty. Two texts
    whose 64-bit hashes are equal would be one group, which breaks nothing. An
    empty table gives no rows.
    """
    raw = F.coalesce(column_of(df, text), F.lit(""))
    sized = df.select(
        column_of(df, id).alias("doc_id"), (F.octet_length(raw) + F.lit(8)).cast("long").alias("size"),
        F.crc32(raw.cast("binary")).alias("text_crc32"), F.xxhash64(raw).alias("group"),
    )
    sized = store(sized, "sized")
    groups = store(sized.groupBy("group").agg(F.sum("size").alias("size")), "groups")
    _, cuts = capacity_and_cuts(groups, shards)
    number = F.size(F.filter(F.lit(cuts).cast("array<bigint>"), lambda c: c <= F.col("group")))
    rows = sized.count()
    parts = min(_MOST_PARTS, max(8, rows // (_ROWS_PER_PART * shards)))
    # The part of a row depends on its id too, so that a large group is not one window.
    part = F.pmod(F.xxhash64(F.lit(11), "doc_id", "group"), F.lit(parts))
    placed = sized.withColumn("shard", number.cast("int")).withColumn("part", part)
    counts = placed.groupBy("shard", "part").count()
    earlier = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("shard", "part", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("before"))
    in_part = Window.partitionBy("shard", "part").orderBy("doc_id", "group")
    placed = placed.withColumn("own", F.row_number().over(in_part))
    return placed.join(before, ["shard", "part"]).select(
        F.col("doc_id").alias(id), "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("before") + F.col("own") - 1).alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )
