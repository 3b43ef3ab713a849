"""Byte-level BPE: encoding with a piece model made from the ranks, and decoding.

A rank file names byte strings in the order of their merges. From it a piece model
is serialised directly: every byte string becomes a piece of visible characters,
one for each byte, its score the negative rank, and the text is not normalised.
The library merges the adjacent pair with the best score first, the leftmost of
equals, which is the pair of lowest rank. So each pre-token gets the ids that the
ranks give. Ids are decoded with the inverse table.

Every task holds the model and a table of ids of pre-tokens seen before, which is
emptied when it is full; both are bounded by the vocabulary and a constant. Nothing
is shuffled.
"""

from __future__ import annotations

import base64
import struct
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.llm.rows import column_of, texts, with_results

#: Pre-tokens whose ids a task keeps, and the length up to which they are kept.
_CACHED = 400_000
_CACHED_LENGTH = 64
#: Characters of texts taken together, and pre-tokens of a longer text at a time.
_TOGETHER = 3_000_000
_AT_ONCE = 1 << 19


def read_ranks(path: str) -> list[bytes]:
    """Byte strings by rank, from lines of base64 and rank."""
    found = {}
    with open(path, "rb") as file:
        for line in file:
            if line.strip():
                piece, rank = line.split()
                found[int(rank)] = base64.b64decode(piece)
    if sorted(found) != list(range(len(found))):
        raise ValueError("the ranks must be 0, 1, 2 and so on")
    ranks = [found[i] for i in range(len(found))]
    if len(set(ranks)) != len(ranks):
        raise ValueError("a byte string has two ranks")
    lacking = {bytes([b]) for b in range(256)} - set(ranks)
    if lacking:
        raise ValueError(f"{len(lacking)} single bytes have no rank")
    return ranks


@lru_cache(maxsize=1)
def visible() -> list[str]:
    """A visible character for each byte: itself where Latin-1 shows one."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(0x100, 0x200))
    return [chr(b if b in shown else next(rest)) for b in range(256)]


def _varint(number: int) -> bytes:
    out = bytearray()
    while number >= 0x80:
        out.append(number & 0x7F | 0x80)
        number >>= 7
    out.append(number)
    return bytes(out)


def _number(field: int, value: int) -> bytes:
    return _varint(field << 3) + _varint(value & (1 << 64) - 1)


def _block(field: int, value: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(value)) + value


def piece_model(ranks: list[bytes]) -> bytes:
    """The serialised piece model; the id of a piece is its rank plus one.

    Field numbers are those of the public message: pieces 1 (text 1, score 2,
    type 3), training 2 (type 3, size 4, ids 40 to 43), normaliser 3 (name 1,
    dummy prefix 3, surplus blanks 4, escaped blanks 5).
    """
    shown = visible()
    message = [_block(1, _block(1, b"<unk>") + b"\x15" + struct.pack("<f", 0) + _number(3, 2))]
    for rank, piece in enumerate(ranks):
        text = "".join([shown[b] for b in piece]).encode()
        message.append(_block(1, _block(1, text) + b"\x15" + struct.pack("<f", -rank)))
    training = _number(3, 2) + _number(4, len(ranks) + 1) + _number(40, 0)
    training += b"".join(_number(field, -1) for field in (41, 42, 43))
    message.append(_block(2, training))
    message.append(_block(3, _block(1, b"identity") + b"".join(_number(f, 0) for f in (3, 4, 5))))
    return b"".join(message)


class PieceEncoder:
    """Ids of texts, as little-endian unsigned 32-bit integers.

    Ids of the pre-tokens met first stay in a table of bounded size; those of
    others are kept for as long as a group of texts needs them.
    """

    def __init__(self, model: bytes, ranks: list[bytes], pattern: str):
        import regex
        import sentencepiece

        self._pieces = sentencepiece.SentencePieceProcessor(model_proto=model)
        self._pattern = regex.compile(pattern)
        self._table = dict(enumerate(visible()))
        self._whole = {piece: rank for rank, piece in enumerate(ranks)}
        self._packed = [struct.pack("<I", max(i - 1, 0)) for i in range(len(ranks) + 1)]
        self._known: dict[str, bytes] = {}

    def _encode(self, tokens: list[str]) -> list[bytes]:
        raw = [t.encode() for t in tokens]
        shown = [r.decode("latin-1").translate(self._table) for r in raw]
        packed, out = self._packed, []
        for piece, ids in zip(raw, self._pieces.encode(shown, num_threads=1), strict=True):
            rank = self._whole.get(piece)
            whole = rank is not None
            out.append(packed[rank + 1] if whole else b"".join([packed[i] for i in ids]))
        return out

    def _joined(self, lists: list[list[str]]) -> list[bytes]:
        known = self._known
        new = list(set().union(*lists).difference(known))
        found = dict(zip(new, self._encode(new), strict=True))
        room = _CACHED - len(known)
        if room > 0:
            short = (x for x in found.items() if len(x[0]) <= _CACHED_LENGTH)
            known.update(islice(short, room))
        if all(map(known.__contains__, new)):
            return [b"".join(map(known.__getitem__, tokens)) for tokens in lists]
        return [b"".join([known.get(t) or found[t] for t in tokens]) for tokens in lists]

    def _long(self, text: str) -> bytes:
        matches, parts = self._pattern.finditer(text), []
        while tokens := [m.group() for m in islice(matches, _AT_ONCE)]:
            parts += self._joined([tokens])
        return b"".join(parts)

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text; texts are taken together up to a fixed length."""
        out: list[bytes] = []
        group: list[list[str]] = []
        length = 0
        for text in texts:
            if length + len(text) > _TOGETHER:
                out += self._joined(group)
                group, length = [], 0
            if len(text) > _TOGETHER:
                out.append(self._long(text))
            else:
                group.append(self._pattern.findall(text))
                length += len(text)
        return out + self._joined(group)


def decode_ids(ids: bytes, ranks: list[bytes]) -> bytes:
    """The bytes that packed ids stand for."""
    return b"".join(map(ranks.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


def encode(
    df: DataFrame, ranks: list[bytes], pattern: str, text: str = "text"
) -> DataFrame:
    """Each row with ``n_tokens`` and ``ids``, the ids of the whole text.

    ``ids`` is binary: little-endian unsigned 32-bit integers, one after the other
    (``numpy.frombuffer(ids, "<u4")``). Matches of ``pattern`` are encoded one by
    one, without special tokens; what no match covers is left out.

    A null or empty text has no ids. Long texts are taken a part at a time. Equal
    texts have equal ids, repeated rows stay, an empty table gives none. Columns
    named as the results are replaced, all others stay.
    """
    shared = df.sparkSession.sparkContext.broadcast((piece_model(ranks), ranks))
    held: dict[str, PieceEncoder] = {}

    def run(columns: list[pa.Array]) -> list[pa.Array]:
        if not held:
            held["it"] = PieceEncoder(*shared.value, pattern)
        found = held["it"].encode(texts(columns[0]))
        counts = pa.array([len(x) // 4 for x in found], pa.int64())
        return [counts, pa.array(found, pa.binary())]

    results = [T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType())]
    return with_results(df, [column_of(df, text)], results, run)


def decode(df: DataFrame, ranks: list[bytes], ids: str = "ids") -> DataFrame:
    """Each row with ``decoded``, the bytes its packed ids stand for.

    Null ids give no bytes; an id without a rank is an error. Columns named
    ``decoded`` are replaced.
    """
    shared = df.sparkSession.sparkContext.broadcast(ranks)

    def run(columns: list[pa.Array]) -> list[pa.Array]:
        table = shared.value
        found = [decode_ids(x or b"", table) for x in columns[0].to_pylist()]
        return [pa.array(found, pa.binary())]

    return with_results(df, [column_of(df, ids)], [T.StructField("decoded", T.BinaryType())], run)


def as_array(ids: Column) -> Column:
    """Packed ids as an array of longs, in DataFrame functions only."""
    digits = F.hex(ids)
    places = F.sequence(F.lit(0), F.floor(F.length(ids) / 4).cast("int") - 1)
    byte = lambda i, n: F.substring(digits, i * 8 + 1 + 2 * n, F.lit(2))
    number = lambda i: F.conv(F.concat(*(byte(i, n) for n in (3, 2, 1, 0))), 16, 10).cast("long")
    return F.when(F.length(ids) > 0, F.transform(places, number)).otherwise(F.array().cast("array<bigint>"))
