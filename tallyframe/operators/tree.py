"""Comparing two large datasets that differ little: a tree of checksums first.

Keys are cut into ranges of their hash. For each range and column both sides have a
checksum that does not depend on the order of rows: sums of hashes of key and value. One
pass over both sides gives them, of which only a row per range and task is shuffled. The
ranges that differ are cut again by a second pass, and only rows of the ranges that still
differ go through the exact comparison. Rows of equal ranges are read, but never dealt.

What is different although the checksums are equal counts as a difference too, as in the
exact comparison: keys with a null part, and missing values on both sides. Repeated keys
stand for pairs of rows; they are found first and compared by their values as always.
Where they are too many to broadcast, their rows count in the checksums too, which may
open more ranges but never closes one, and saves a shuffle of all rows in each pass. The
second pass is left out where missing values and row counts alike show that it cannot help.

A difference is overlooked if both halves of the summed 64-bit hashes of a range agree by
chance, about once in 2 ** 64 differing ranges.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.operators.compare import CompareOptions, Comparison, broadcast_limit
from tallyframe.sources.scratch import stored

#: Ranges of the first pass, and parts of each in the second. So many numbers are the
#: most that a broadcast of differing ranges ever has.
RANGES = 4096
# Bytes that a number costs in a broadcast.
_RANGE_BYTES = 64


class TreeComparison(Comparison):
    """A comparison whose rows with single keys first pass a tree of checksums."""

    def __init__(
        self, source: DataFrame, target: DataFrame, keys, options: CompareOptions = CompareOptions(), ranges: int = RANGES
    ):
        super().__init__(source, target, keys, options)
        self._ranges = ranges

    def _placed(self, df: DataFrame, rows: str) -> DataFrame:
        """Rows of one side with their range ``r`` and the part ``p`` in it."""
        keys = ", ".join(f"{rows}_{slot}" for slot in self._key_slots)
        return df.selectExpr(
            "*",
            f"cast(pmod(xxhash64({keys}), {self._ranges}) as int) as r",
            f"cast(pmod(xxhash64(1, {keys}), {self._ranges}) as int) as p",
        )

    def _sums(self, df: DataFrame, rows: str) -> DataFrame:
        """One side's rows as what the checksums of their range add up, less for the target."""
        # Keys with a null part never meet, so their side is part of what is hashed.
        keys = [f"if({self._incomplete(f'{rows}_')}, '{rows}', '')", *(f"{rows}_{slot}" for slot in self._key_slots)]
        values = [f"{rows}_{slot}" for slot in self._slots]
        hashed = df.selectExpr(
            "r", "p", *[f"xxhash64({', '.join(keys)}, {value}) as h{i}" for i, value in enumerate(values)],
            *[f"cast({value} is null as int) as empty_{i}" for i, value in enumerate(values)],
        )
        sign = "" if rows == "m" else "-"
        return hashed.selectExpr(
            "r", "p", f"{sign}1 as rows",
            *[f"{sign}(h{i} & 4294967295) as low_{i}" for i in range(len(values))],
            *[f"{sign}shiftright(h{i}, 32) as high_{i}" for i in range(len(values))],
            *[f"empty_{i}" for i in range(len(values))],
        )

    def _summed_rows(self, df: DataFrame, rows: str) -> DataFrame:
        """The rows of one side that checksums are of: those of single keys, or all if that takes no shuffle."""
        if self._repeated is None or self._may_broadcast_repeated():
            return super()._single_rows(df, rows)
        return df.withColumnsRenamed({slot: f"{rows}_{slot}" for slot in df.columns})

    def _differing(self, parts: list[str], within: DataFrame | None = None) -> DataFrame:
        """The ranges, named by ``parts``, in which a checksum differs or a value is missing.

        ``least`` is a number of keys that surely differ, as far as rows of single keys go.
        """
        sides = []
        for df, rows in ((self._source, "m"), (self._target, "n")):
            placed = self._placed(self._summed_rows(df, rows), rows)
            if within is not None:
                placed = placed.join(F.broadcast(within), "r", "left_semi")
            sides.append(self._sums(placed, rows))
        figures = [c for c in sides[0].columns if c not in ("r", "p")]
        summed = sides[0].unionByName(sides[1]).groupBy(*parts).agg(
            *[F.sum(c).alias(c) for c in figures]
        )
        least = ", ".join(["abs(rows)", "0", *[f"{c} / 2" for c in figures if c.startswith("empty_")]])
        differing = summed.filter(" or ".join(f"{c} <> 0" for c in figures))
        return differing.selectExpr(*parts, f"greatest({least}) as least")

    @cached_property
    def _open(self) -> DataFrame | None:
        """The ranges to compare exactly, as a table that may be broadcast; None if all agree.

        The parts of ranges if a broadcast of them is as small as Spark's own, and else
        the ranges, of which there are never more than the first pass has.
        """
        found = stored(self._differing(["r"]))
        # So many keys dealt over the parts of their range are in so many of them.
        expected = found.selectExpr(f"sum({self._ranges} * (1 - exp(-least / {self._ranges}))) as parts").first()["parts"]
        if expected is None:
            return None
        limit = broadcast_limit(self._session)
        ranges = found.select("r")
        if expected * _RANGE_BYTES > limit:
            return ranges
        parts = stored(self._differing(["r", "p"], within=ranges).drop("least"))
        if parts.count() * _RANGE_BYTES <= limit:
            return parts
        return ranges

    def _single_rows(self, df: DataFrame, rows: str) -> DataFrame:
        if self._open is None:
            return super()._single_rows(df, rows).filter("false")
        placed = self._placed(super()._single_rows(df, rows), rows)
        return placed.join(F.broadcast(self._open), self._open.columns, "left_semi").drop("r", "p")


def data_compare_tree(
    source: DataFrame,
    target: DataFrame,
    keys,
    *,
    options: CompareOptions = CompareOptions(),
    ranges: int = RANGES,
) -> DataFrame:
    """The differing cells of both datasets, the same as ``data_compare`` gives.

    For datasets that are nearly equal: the more ranges of keys differ, or hold missing
    values, the less the two further passes over both sides save. They run while the frame
    is built. ``ranges`` is the number of ranges, and of parts of a range.
    """
    return TreeComparison(source, target, keys, options, ranges).differences()
