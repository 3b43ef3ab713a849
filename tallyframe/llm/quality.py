"""Quality of documents from a linear-chain conditional random field over their lines.

Every line is good or bad. A line's score comes from counts of its bytes and words
and from those of the lines before and after it; neighbouring labels have weights of
their own. Forward-backward gives each line's chance of being bad; the chances,
weighted by line length, are the document's bad share, and a logistic curve turns
the share into a score.

Labels are known for documents only. Lines of good documents are good. Lines of bad
ones start as bad; later rounds of fitting call those good that the field so far
finds good, while each bad document keeps its worst line.

The field is fitted on a bounded sample of labelled rows. Everything else happens
per row in Arrow batches; nothing is shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.llm.rows import binary_parts, column_of, text_bytes, with_results

#: Bounds of the training sample: rows in all, bytes and lines of each.
SAMPLE_ROWS = 4000
SAMPLE_BYTES = 200_000
SAMPLE_LINES = 2000

_LOWER, _UPPER, _DIGIT, _BLANK, _MARK, _CRY, _SIGN, _HIGH, _KINDS = range(9)
_WORDS, _SAME, _ENDED, _LONE, _COUNTS = range(_KINDS, _KINDS + 5)
_PIECE = 1 << 20


def _kinds() -> np.ndarray:
    kinds = np.full(256, _SIGN, np.uint8)
    kinds[0x80:] = _HIGH
    kinds[ord("a") : ord("z") + 1] = _LOWER
    kinds[ord("A") : ord("Z") + 1] = _UPPER
    kinds[ord("0") : ord("9") + 1] = _DIGIT
    kinds[list(b" \t\n\x0b\x0c\r")] = _BLANK
    kinds[list(b".,;:'\"()-")] = _MARK
    kinds[list(b"!?")] = _CRY
    return kinds


_KIND_OF = _kinds()
#: Numbers for a byte and for the one after it; words are told apart by the sum of
#: their products, that is by the pairs of neighbouring bytes that they hold.
_MIXED = np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
_AFTER = np.arange(1, 257, dtype=np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F) ^ _MIXED >> np.uint64(31)


def _add_piece(table: np.ndarray, data: np.ndarray, line: int) -> int:
    """Add the counts of some bytes to the table's lines from ``line`` on; the last line."""
    feeds = np.flatnonzero(data == 10)
    starts = np.concatenate([[0], feeds + 1])
    kinds = _KIND_OF[data]
    kinds_in = kinds.copy()
    kinds_in[feeds] = 255
    padded = starts[starts < len(data)]
    rows = table[line : line + len(starts)]
    for kind in range(_KINDS):
        sums = np.add.reduceat(kinds_in == kind, padded, dtype=np.int32)
        rows[: len(padded), kind] += sums
    # Where the line feed is the last byte, the line after it has no bytes here.
    blank = kinds == _BLANK
    edge = np.flatnonzero(blank[1:] != blank[:-1]) + 1
    begins = edge[~blank[edge]]
    ends = edge[blank[edge]]
    if len(data) and not blank[0]:
        begins = np.concatenate([[0], begins])
    if len(data) and not blank[-1]:
        ends = np.concatenate([ends, [len(data)]])
    if len(begins):
        of = np.searchsorted(starts, begins, side="right") - 1
        after = np.ones(len(data), np.uint64)
        after[:-1] = np.where(blank[1:], np.uint64(1), _AFTER[data[1:]])
        mixed = np.add.reduceat(np.where(blank, np.uint64(0), _MIXED[data] * after), begins)
        length = ends - begins
        same = np.zeros(len(begins), bool)
        same[1:] = (mixed[1:] == mixed[:-1]) & (length[1:] == length[:-1]) & (of[1:] == of[:-1])
        last = kinds[ends - 1]
        ended = (last == _SIGN) | (last == _CRY)
        lone = (length == 1) & (last == _SIGN)
        size = len(starts)
        for column, chosen in ((_WORDS, None), (_SAME, same), (_ENDED, ended), (_LONE, lone)):
            rows[:, column] += np.bincount(of if chosen is None else of[chosen], minlength=size).astype(np.int32)
    return line + len(feeds)


def line_counts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Counts of each line of each text, and the number of lines per text.

    Texts lie one after the other in ``data``. Long ones are counted in pieces of a
    fixed size, parted at a blank where there is one.
    """
    ends = zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)
    lines = np.array([np.count_nonzero(data[a:b] == 10) + 1 for a, b in ends], dtype=np.int64)
    table = np.zeros((int(lines.sum()), _COUNTS), np.int32)
    first = np.concatenate([[0], np.cumsum(lines)])
    for text, (begin, end) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
        line = int(first[text])
        while begin < end:
            upto = min(end, begin + _PIECE)
            if upto < end:
                blank = np.flatnonzero(_KIND_OF[data[upto - 4096 : upto]] == _BLANK)
                upto = upto - 4096 + int(blank[-1]) + 1 if len(blank) else upto
            line = _add_piece(table, data[begin:upto], line)
            begin = upto
    return table, lines


def features(counts: np.ndarray, lines: np.ndarray) -> np.ndarray:
    """Features of each line: its own, those of its neighbours, and its place."""
    size = counts[:, :_KINDS].sum(axis=1)
    inked = np.maximum(size - counts[:, _BLANK], 1)[:, None]
    words = np.maximum(counts[:, _WORDS], 1)[:, None]
    kinds = counts[:, [_LOWER, _UPPER, _DIGIT, _MARK, _CRY, _SIGN, _HIGH]] / inked
    shares = np.concatenate([kinds, counts[:, [_SAME, _ENDED, _LONE]] / words], axis=1)
    own = np.concatenate(
        [shares, np.sqrt(shares), np.log1p(size)[:, None] / 8, np.minimum(inked / words, 40) / 10, (size == 0)[:, None]],
        axis=1,
    ).astype(np.float32)
    before, after = np.zeros_like(own), np.zeros_like(own)
    before[1:], after[:-1] = own[:-1], own[1:]
    ends = np.cumsum(lines)
    is_first, is_last = np.zeros(len(own), np.float32), np.zeros(len(own), np.float32)
    is_first[ends - lines], is_last[ends - 1] = 1, 1
    before[is_first > 0], after[is_last > 0] = 0, 0
    return np.concatenate([own, before, after, is_first[:, None], is_last[:, None], np.ones((len(own), 1), np.float32)], axis=1)


def bad_chances(
    scores: np.ndarray, lines: np.ndarray, steps: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Forward-backward over all texts at once.

    ``scores`` says how much better each line is as bad; ``steps[i, j]`` is the weight
    of label j after i. Gives each line's chance of being bad, each text's log
    partition sum, and the expected number of each step.
    """
    order = np.argsort(-lines, kind="stable")
    first = (np.cumsum(lines) - lines)[order]
    size = lines[order]
    longest = int(size[0]) if len(size) else 0
    live = np.searchsorted(-size, -np.arange(longest), side="left")  # texts longer than t
    forward = np.zeros((len(scores), 2))
    for t in range(longest):
        at = first[: live[t]] + t
        forward[at, 1] = scores[at]
        if t:
            past = forward[at - 1]
            forward[at, 0] += np.logaddexp(past[:, 0] + steps[0, 0], past[:, 1] + steps[1, 0])
            forward[at, 1] += np.logaddexp(past[:, 0] + steps[0, 1], past[:, 1] + steps[1, 1])
    ends = first + size - 1
    total = np.logaddexp(forward[ends, 0], forward[ends, 1])
    backward = np.zeros((len(scores), 2))
    counted = np.zeros((2, 2))
    for t in range(longest - 2, -1, -1):
        at = first[: live[t + 1]] + t
        ahead = backward[at + 1] + np.stack([np.zeros(len(at)), scores[at + 1]], axis=1)
        for i in range(2):
            backward[at, i] = np.logaddexp(ahead[:, 0] + steps[i, 0], ahead[:, 1] + steps[i, 1])
            for j in range(2):
                counted[i, j] += np.exp(forward[at, i] + steps[i, j] + ahead[:, j] - total[: len(at)]).sum()
    all_total = np.empty(len(lines))
    all_total[order] = total
    chance = np.exp(forward[:, 1] + backward[:, 1] - np.repeat(all_total, lines))
    return np.clip(chance, 0, 1), all_total, counted


@dataclass(frozen=True)
class Field:
    """A fitted field and the curve from bad shares to scores."""

    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    steps: np.ndarray
    curve: tuple[float, float]

    def shares(self, counts: np.ndarray, lines: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each text's bad share, and each line's chance of being bad."""
        x = (features(counts, lines) - self.mean) / self.spread
        chance, _, _ = bad_chances(x @ self.weights, lines, self.steps)
        weight = counts[:, :_KINDS].sum(axis=1) + 1.0
        begins = np.cumsum(lines) - lines
        if not len(lines):
            return np.zeros(0), chance
        return np.add.reduceat(chance * weight, begins) / np.add.reduceat(weight, begins), chance

    def scores(self, shares: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(np.clip(self.curve[0] + self.curve[1] * _odds(shares), -60, 60)))


def _odds(shares: np.ndarray) -> np.ndarray:
    return np.log((shares + 0.005) / (1.005 - shares))


def fit(counts: np.ndarray, lines: np.ndarray, good: np.ndarray, share_good: float, rounds: int = 3, steps: int = 120) -> Field:
    """A field for labelled texts; ``share_good`` is the share of good ones at large."""
    x = features(counts, lines)
    mean, spread = x.mean(axis=0), x.std(axis=0)
    constant = spread < 1e-6
    mean[constant], spread[constant] = 0, 1
    x = (x - mean) / spread
    begins = np.cumsum(lines) - lines
    bad_line = np.repeat(~good, lines)
    of_bad = bad_line.copy()
    first = np.zeros(len(x), bool)
    first[begins] = True
    weights, change = np.zeros(x.shape[1]), np.zeros((2, 2))
    for _ in range(rounds):
        seen = np.zeros((2, 2))
        later = np.flatnonzero(~first)
        np.add.at(seen, (bad_line[later - 1].astype(int), bad_line[later].astype(int)), 1)
        state = [np.zeros(x.shape[1] + 4) for _ in range(2)]
        for step in range(1, steps + 1):
            chance, _, counted = bad_chances(x @ weights, lines, change)
            slope = np.concatenate([x.T @ (bad_line - chance) - 0.1 * weights, (seen - counted - 0.1 * change).ravel()])
            slope /= len(x)
            state[0] = 0.9 * state[0] + 0.1 * slope
            state[1] = 0.99 * state[1] + 0.01 * slope**2
            move = 0.1 * (state[0] / (1 - 0.9**step)) / (np.sqrt(state[1] / (1 - 0.99**step)) + 1e-9)
            weights, change = weights + move[:-4], change + move[-4:].reshape(2, 2)
        chance, _, _ = bad_chances(x @ weights, lines, change)
        worst = np.maximum.reduceat(chance, begins) if len(begins) else np.zeros(0)
        bad_line = of_bad & ((chance >= 0.5) | (chance >= np.repeat(worst, lines)))
    field = Field(mean, spread, weights, change, (0.0, 1.0))
    shares, _ = field.shares(counts, lines)
    balance = np.where(good, share_good / max(good.mean(), 1e-9), (1 - share_good) / max(1 - good.mean(), 1e-9))
    return Field(mean, spread, weights, change, _curve(_odds(shares), good, balance))


def _curve(odds: np.ndarray, good: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """The logistic curve through the odds of bad shares, by Newton's steps."""
    design = np.stack([np.ones(len(odds)), odds], axis=1)
    found = np.array([0.0, 0.5])
    for _ in range(50):
        bad = 1 / (1 + np.exp(-np.clip(design @ found, -30, 30)))
        slope = design.T @ (weight * (~good - bad)) - 0.5 * found
        bend = (design * (weight * bad * (1 - bad))[:, None]).T @ design + 0.5 * np.eye(2)
        found = found + np.linalg.solve(bend, slope)
    return float(found[0]), float(max(found[1], 0.0))


def in_fold(id: Column, folds: int = 5) -> Column:
    """Whether a row's id is in the held-out fold: CRC-32 of its text modulo ``folds`` is 0."""
    return F.pmod(F.crc32(F.coalesce(id.cast("string"), F.lit("")).cast("binary")), F.lit(folds)) == 0


def fit_on(
    df: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, text: str = "text", id: str = "doc_id", label: str = "quality"
) -> Field:
    """A field fitted on a bounded sample of ``labels(id, label)``, 1 for good and 0 for bad.

    Up to half of ``rows`` come from each label, those of the smallest hashes of
    their ids. Ids with both labels are bad; other labels and null ids are left out.
    Of rows that repeat an id the one of the smallest text counts; texts of over
    ``SAMPLE_BYTES`` or ``SAMPLE_LINES`` are left out. Without rows of both labels
    every text scores the share of good ones.
    """
    known = labels.select(column_of(labels, id).alias("id"), column_of(labels, label).cast("int").alias("good"))
    known = known.where(F.col("id").isNotNull() & F.col("good").isin(0, 1)).groupBy("id").agg(F.min("good").alias("good"))
    counted = {row["good"]: row["count"] for row in known.groupBy("good").count().collect()}
    picked = [
        known.where(F.col("good") == value).orderBy(F.xxhash64(F.lit(5), "id"), "id").limit(rows // 2) for value in (0, 1)
    ]
    texts = df.select(column_of(df, id).alias("id"), text_bytes(df, text).alias("text"))
    # At most ``rows`` ids and labels.
    texts = texts.join(F.broadcast(picked[0].unionByName(picked[1])), "id")
    texts = texts.where(F.length("text") <= SAMPLE_BYTES).groupBy("id", "good").agg(F.min("text").alias("text"))

    def count(columns: list[pa.Array]) -> list[pa.Array]:
        data, offsets = binary_parts(columns[0])
        table, lines = line_counts(data, offsets)
        ends = np.cumsum(lines)
        parts = [table[e - n : e].tobytes() if n <= SAMPLE_LINES else None for e, n in zip(ends, lines, strict=True)]
        return [pa.array(parts, pa.binary())]

    found = with_results(
        texts.select("id", "good", "text"), [F.col("text")], [T.StructField("counts", T.BinaryType())], count
    ).select("id", "good", "counts").where("counts is not null").orderBy("id").collect()
    good = np.array([row["good"] == 1 for row in found], bool)
    share = counted.get(1, 0) / max(1, sum(counted.values())) if counted else 0.5
    if not found or good.all() or not good.any():
        width = features(np.zeros((1, _COUNTS), np.int32), np.ones(1, np.int64)).shape[1]
        share = min(max(share, 0.01), 0.99)
        return Field(np.zeros(width), np.ones(width), np.zeros(width), np.zeros((2, 2)), (float(np.log((1 - share) / share)), 0.0))
    tables = [np.frombuffer(row["counts"], np.int32).reshape(-1, _COUNTS) for row in found]
    return fit(np.concatenate(tables), np.array([len(t) for t in tables]), good, share)


def score(df: DataFrame, field: Field, text: str = "text") -> DataFrame:
    """Each row with ``score``, from 0 to 1, higher for better texts.

    Only the text counts. Null and empty texts are one empty line and are scored
    like any other; equal texts score alike, repeated rows stay, and an empty table
    gives none. Columns named ``score`` are replaced.
    """
    shared = df.sparkSession.sparkContext.broadcast(field)

    def run(columns: list[pa.Array]) -> list[pa.Array]:
        data, offsets = binary_parts(columns[0])
        model, out = shared.value, np.zeros(len(offsets) - 1)
        begin = 0
        while begin < len(out):
            end = int(np.searchsorted(offsets, offsets[begin] + 4 * _PIECE, side="right")) - 1
            end = min(max(end, begin + 1), begin + 5000, len(out))
            part = offsets[begin : end + 1]
            shares, _ = model.shares(*line_counts(data[part[0] : part[-1]], part - part[0]))
            out[begin:end] = model.scores(shares)
            begin = end
        return [pa.array(out, pa.float64())]

    return with_results(df, [text_bytes(df, text)], [T.StructField("score", T.DoubleType())], run)


def line_chances(df: DataFrame, field: Field, text: str = "text") -> DataFrame:
    """Each row with ``bad_chances``, the chance of each line of the text to be bad."""
    shared = df.sparkSession.sparkContext.broadcast(field)

    def run(columns: list[pa.Array]) -> list[pa.Array]:
        data, offsets = binary_parts(columns[0])
        counts, lines = line_counts(data, offsets)
        _, chance = shared.value.shares(counts, lines)
        return [pa.array(np.split(chance, np.cumsum(lines)[:-1]), pa.list_(pa.float64()))]

    return with_results(df, [text_bytes(df, text)], [T.StructField("bad_chances", T.ArrayType(T.DoubleType()))], run)
