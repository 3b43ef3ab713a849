"""Periodic runs of words, found by recursive frequency splitting and a lag scan.

A run is a stretch of consecutive words with smallest period q, at least ``least``
words and at least ``2 * q``, that no neighbouring word extends. Every word of a run
occurs in it twice at least, so:

1. In each segment (first the whole text) a word that occurs once parts it. The pieces
   are segments of their own with counts of their own, and this recurs until segments
   are stable. Pieces of fewer than ``least`` words go. Most prose is gone after this.
2. What is left is scanned at lags. Short lags are scanned whole. For lags from 2B to
   4B - 1, B a power of two, a run holds a whole block of B words that starts at a
   multiple of B and stands again one lag later, so only the lags at which some block
   stands again are scanned, and only around it. B words are compared by one number
   each, that is the rank of the pair of numbers of its halves: exact, no hash. The
   octaves end when no B words stand twice.

Texts are taken several at a time in flat arrays, with a word of its own between two of
them, so nothing runs over an end. Time grows with n log n a text, whatever it holds.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.llm.rows import BLANKS, binary_parts, text_bytes, with_results

#: Lags below are scanned whole.
_SHORT = 16
#: Segments are parted further while one word in so many parts them.
_WORTH = 256
#: Bytes of texts that are taken together; a longer text is taken alone.
_TOGETHER = 1 << 20

_RUN = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")])


def _blank_table() -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[list(BLANKS)] = True
    return table


_IS_BLANK = _blank_table()


def words_of(data: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words in the bytes of texts, and each text's number of words.

    ``places`` are the texts' offsets in ``data``; no word goes over the end of a text.
    """
    word = ~_IS_BLANK[data]
    inside = np.concatenate([[False], word, [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    # Where a text ends in a word and the next begins with one, no blank parts them.
    cuts = np.unique(places[(places > 0) & (places < len(data))])
    cuts = cuts[word[cuts - 1] & word[cuts]]
    starts, ends = np.sort(np.concatenate([edges[::2], cuts])), np.sort(np.concatenate([edges[1::2], cuts]))
    return starts, ends, np.diff(np.searchsorted(starts, places))


def _bytes_of(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The bytes of words, without what lies between them."""
    return data[_covered(len(data), starts, ends)]


def _covered(size: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which of so many places the given ranges, apart from one another, cover."""
    mark = np.zeros(size + 1, np.int8)
    mark[starts] += 1
    mark[ends] -= 1
    return np.cumsum(mark[:-1], dtype=np.int8).astype(bool)


def _numbers(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Equal numbers for equal words."""
    if not len(starts):
        return np.zeros(0, np.int64)
    offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
    held = pa.py_buffer(_bytes_of(data, starts, ends))
    words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), held])
    return words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)


def surviving(numbers: np.ndarray, segment: np.ndarray, least: int) -> np.ndarray:
    """Positions in segments that no word occurring once in them parts any more.

    ``segment`` numbers the segment of each position, each of them consecutive. A segment
    in which such words are less than one in ``_WORTH`` stays with them, which bounds the
    rounds for any text; the scan is exact on any segment.
    """
    at = np.arange(len(numbers))
    settled: list[np.ndarray] = []
    while len(at):
        # Consecutive positions of one segment make a piece; short ones go.
        new = np.concatenate([[True], (at[1:] != at[:-1] + 1) | (segment[at[1:]] != segment[at[:-1]])])
        piece = np.cumsum(new) - 1
        size = np.bincount(piece)
        long = size[piece] >= least
        at, piece = at[long], piece[long]
        if not len(at):
            break
        order = np.lexsort((numbers[at], piece))
        p, w = piece[order], numbers[at][order]
        change = (p[1:] != p[:-1]) | (w[1:] != w[:-1])
        alone = np.concatenate([[True], change]) & np.concatenate([change, [True]])
        single = np.zeros(len(at), dtype=bool)
        single[order] = alone
        pieces = int(piece[-1]) + 1
        lost = np.bincount(piece[single], minlength=pieces)
        parted = lost * _WORTH > np.bincount(piece, minlength=pieces)
        settled.append(at[~parted[piece]])
        at = at[parted[piece] & ~single]
    return np.sort(np.concatenate(settled)) if settled else at


def _stretches(equal: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the stretches of true."""
    padded = np.concatenate([[False], equal, [False]])
    edges = np.flatnonzero(padded[1:] != padded[:-1])
    return edges[::2], edges[1::2]


def _ranked_pairs(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """One number for each pair, equal for equal pairs."""
    return np.unique(left * (int(right.max(initial=0)) + 1) + right, return_inverse=True)[1].astype(np.int64)


def _anchored(level: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray]:
    """``(block start, lag)`` where the block's words stand again 2 to 4 blocks later.

    ``level[i]`` is the number of the ``block`` words from i on.
    """
    n = len(level)
    order = np.lexsort((np.arange(n), level))
    keys = level[order] * (n + 1) + order
    at = np.arange(0, n, block)
    low = np.searchsorted(keys, level[at] * (n + 1) + np.minimum(at + 2 * block, n))
    high = np.searchsorted(keys, level[at] * (n + 1) + np.minimum(at + 4 * block, n))
    count = high - low
    begin = np.cumsum(count) - count
    pick = np.arange(int(count.sum())) - np.repeat(begin - low, count)
    starts = np.repeat(at, count)
    return starts, order[pick] - starts


def runs_in(x: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(start, length, period)`` of the runs of a sequence of numbers from 0 on.

    Ordered by start, then period. To part texts, give numbers that stand only once.
    """
    n = len(x)
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def keep(lag: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        good = ends - starts >= np.maximum(least - lag, lag)
        found.append((starts[good], (ends - starts + lag)[good], lag[good]))

    for lag in range(1, min(_SHORT, n // 2 + 1)):
        starts, ends = _stretches(x[lag:] == x[:-lag])
        keep(np.full(len(starts), lag), starts, ends)
    # levels[j][i] numbers the 2 ** j words from i on, as far as they stand in x.
    levels, block = [x], 1
    while 4 * block <= n:
        if 2 * block >= _SHORT:
            starts, lag = _anchored(levels[-1], block)
            if len(starts):
                order = np.lexsort((starts, lag))
                starts, lag = starts[order], lag[order]
                new = np.concatenate([[True], (lag[1:] != lag[:-1]) | (starts[1:] != starts[:-1] + block)])
                first = np.flatnonzero(new)
                last = np.concatenate([first[1:], [len(starts)]]) - 1
                low, high, lag = starts[first].copy(), starts[last] + block, lag[first]
                # Less than a block is left on either side; take it by halves.
                for j in reversed(range(len(levels) - 1)):
                    level, step = levels[j], 1 << j
                    same = low >= step
                    same[same] = level[low[same] - step] == level[low[same] - step + lag[same]]
                    low -= same * step
                    same = high + lag + step <= n
                    same[same] = level[high[same]] == level[high[same] + lag[same]]
                    high += same * step
                keep(lag, low, high)
        level = levels[-1]
        level = _ranked_pairs(level[: len(level) - block], level[block:])
        if len(level) == 0 or int(level.max()) + 1 == len(level):
            break
        levels.append(level)
        block *= 2
    if not found:
        return (np.zeros(0, np.int64),) * 3
    start, length, period = (np.concatenate(parts).astype(np.int64) for parts in zip(*found, strict=True))
    # The same stretch also has the multiples of its period; the smallest is its own.
    order = np.lexsort((period, length, start))
    start, length, period = start[order], length[order], period[order]
    own = np.concatenate([[True], (start[1:] != start[:-1]) | (length[1:] != length[:-1])]) if len(start) else start > 0
    start, length, period = start[own], length[own], period[own]
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]


def _of_texts(data: np.ndarray, places: np.ndarray, least: int):
    """Of some texts: numbers of words; starts, lengths and periods of all runs, and where
    each text's begin; the bytes of what is left, and where each text's begin."""
    starts, ends, counts = words_of(data, places)
    numbers = _numbers(data, starts, ends)
    text = np.repeat(np.arange(len(counts)), counts)
    left = surviving(numbers, text, least)
    # Surviving stretches behind one another, each behind a number of its own.
    new = np.concatenate([[True], (left[1:] != left[:-1] + 1) | (text[left[1:]] != text[left[:-1]])]) if len(left) else left > 0
    place = np.arange(len(left)) + np.cumsum(new)
    used = np.unique(numbers[left], return_inverse=True)[1]
    x = np.full(len(left) + int(new.sum()), -1, dtype=np.int64)
    x[place] = used
    gaps = np.flatnonzero(x < 0)
    x[gaps] = int(used.max(initial=-1)) + 1 + np.arange(len(gaps))
    start, length, period = runs_in(x, least)
    origin = np.zeros(len(x), dtype=np.int64)
    origin[place] = left
    start = origin[start]
    # A word goes if a run holds it behind the run's first period.
    depth = np.zeros(len(numbers) + 1, dtype=np.int64)
    np.add.at(depth, start + period, 1)
    np.subtract.at(depth, start + length, 1)
    kept = np.cumsum(depth[:-1]) == 0
    first_word = np.concatenate([[0], np.cumsum(counts)])
    owner = np.searchsorted(first_word, start, side="right") - 1
    runs = (start - first_word[owner], length, period, np.searchsorted(owner, np.arange(len(counts) + 1)))
    counts_kept = np.diff(np.concatenate([[0], np.cumsum(kept)])[first_word])
    return counts, runs, _joined(data, starts[kept], ends[kept], counts_kept)


def _joined(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of texts of these words with a blank between two, and the texts' offsets."""
    lengths = ends - starts
    last = np.zeros(len(starts), dtype=bool)
    last[np.cumsum(counts)[counts > 0] - 1] = True
    room = lengths + ~last
    out_ends = np.cumsum(room)
    made = np.full(int(out_ends[-1]) if len(out_ends) else 0, 0x20, dtype=np.uint8)
    to = out_ends - room
    made[_covered(len(made), to, to + lengths)] = _bytes_of(data, starts, ends)
    words = np.concatenate([[0], np.cumsum(counts)])
    return made, np.concatenate([[0], out_ends])[words]


def _groups(places: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about so many bytes, one text at least."""
    first, count = 0, len(places) - 1
    while first < count:
        last = int(np.searchsorted(places, places[first] + _TOGETHER, side="right")) - 1
        last = min(max(last, first + 1), count)
        yield first, last
        first = last


def periodic_runs(df: DataFrame, least: int = 12, text: str = "text") -> DataFrame:
    """The rows with ``n_words``, ``runs`` and ``collapsed``.

    ``runs`` lists ``(start, length, period)`` of every run of the text's words, by start,
    then period; words are what space and 09 to 0D separate, numbered from 0 and compared
    as they are. ``collapsed`` is the words that no run holds behind its first period,
    with single blanks.

    Null, empty and blank texts have no words, no runs and an empty ``collapsed``. Whole
    texts count: a text is held as a whole, with some 150 bytes for each word. Repeated
    rows stay, each with the same result; two runs never tie, as one start and period
    belong to one run. An empty table gives none. Columns named as results are replaced.
    """
    def run(columns: list[pa.Array]) -> list[pa.Array]:
        data, places = binary_parts(columns[0])
        parts = []
        for first, last in _groups(places):
            within = places[first : last + 1]
            parts.append(_of_texts(data[within[0] : within[-1]], within - within[0], least))
        items = pa.StructArray.from_arrays([_chained(p[1][k] for p in parts) for k in range(3)], _RUN.names)
        left = pa.py_buffer(np.concatenate([p[2][0] for p in parts]))
        ends = pa.py_buffer(_offsets(p[2][1] for p in parts))
        return [
            _chained(p[0] for p in parts),
            pa.ListArray.from_arrays(pa.array(_offsets(p[1][3] for p in parts)), items),
            pa.Array.from_buffers(pa.string(), len(columns[0]), [None, ends, left]),
        ]

    results = [
        T.StructField("n_words", T.LongType()), T.StructField("runs", T.ArrayType(_RUN)),
        T.StructField("collapsed", T.StringType()),
    ]
    return with_results(df, [text_bytes(df, text)], results, run)


def _chained(arrays: Iterable[np.ndarray]) -> pa.Array:
    return pa.array(np.concatenate(list(arrays)), pa.int64())


def _offsets(places: Iterable[np.ndarray]) -> np.ndarray:
    """Offsets of lists behind one another, each array those of some of them from 0 on."""
    return np.concatenate([[0], np.cumsum(np.concatenate([np.diff(p) for p in places]))]).astype(np.int32)


def greatest_run(runs: str = "runs") -> Column:
    """The run of greatest length; of equals that of smallest start, then period. Null if none."""
    better = lambda a, b: (
        a.isNull() | (b["length"] > a["length"])
        | ((b["length"] == a["length"]) & ((b["start"] < a["start"]) | ((b["start"] == a["start"]) & (b["period"] < a["period"]))))
    )
    nothing = F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>")
    return F.aggregate(runs, nothing, lambda a, b: F.when(better(a, b), b).otherwise(a))
