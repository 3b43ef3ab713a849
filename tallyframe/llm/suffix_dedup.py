"""Removing what an earlier document holds too, byte strings of a fixed length.

The strings that begin in documents are their suffixes, cut at ``length`` bytes.
Sorting all of them would move each byte ``length`` times, so most are settled before:

1. Every string holds an anchor, the gram with the least hash in it. Neighbouring
   strings share anchors; the strings of one anchor in a row are a run. Equal strings
   have equal anchors at the same place in them.
2. Documents are dealt to blocks, which are ranges of ids. For each block the hashes
   of anchors, and of the whole bytes of their runs, go to tasks by anchor, packed.
   An anchor of one document only needs nothing more. Where all runs of an anchor are
   alike, the first block keeps them and later ones lose them. The rest is mixed.
3. The bytes of mixed runs, each once for a block, are dealt by anchor, and their
   suffixes are sorted deep-shallow: multikey quicksort on eight bytes at a time down
   to a shallow depth, then blind tries for the groups that still agree, which look
   only at bytes where members of a group differ. Suffixes that end up together are
   equal, and the least id among them is known. An anchor with very many different
   runs is not one group: its strings are grouped one by one in a Spark aggregation.
4. The answers go back to the blocks, whose documents lose the bytes covered.

Blocks, ranges of anchors and groups have bounded sizes whatever the input's; a
passage that many documents share reaches a task once per block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.rows import binary_parts, column_of, range_buckets, store, text_bytes, with_place

_GRAM = 20
_SHALLOW = 16
_PIECE = 1 << 18
_BLOCK_BYTES = 32 << 20
_RANGE_BYTES = 8 << 20
_MOST_BLOCKS = 1 << 16
_ENTRIES = 1 << 19
#: Runs sorted together, and different runs of one anchor up to which it is one group.
_TOGETHER = 6000
HOT_RUNS = 20_000

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_GONE, _FIRST, _MIXED = 1, 2, 3
_LOW = np.uint64(0xFFFFFFFF)
_TABLES: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power(exponent: int) -> np.uint64:
    return np.uint64(pow(_BASE, exponent, 1 << 64))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


def _grams(data: np.ndarray, length: int) -> np.ndarray:
    """Hashes of the strings of ``length`` bytes, by doubling."""
    power = data.astype(np.uint64) + np.uint64(1)
    made, size, total = None, 1, 0
    while size <= length:
        if length & size:
            made = power if made is None else made[: len(data) - total - size + 1] * _power(size) + power[total:]
            total += size
        if 2 * size <= length:
            power = power[:-size] * _power(size) + power[size:]
        size *= 2
    return _mix(made)


def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    if not _TABLES or max(_TABLES) < size:
        tables = []
        for base in (_BASE, _INVERSE):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            tables.append(np.multiply.accumulate(table))
        _TABLES.clear()
        _TABLES[size] = (tables[0], tables[1])
    return _TABLES[max(_TABLES)]


class Runs:
    """Runs of strings: where the first and last begin, the document, and two hashes."""

    def __init__(self, first, last, doc, anchor, bytes_):
        self.first, self.last, self.doc, self.anchor, self.bytes = first, last, doc, anchor, bytes_


def _pieces(offsets: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Parts ``(begin, end, upto)`` of the bytes: strings begin before end, bytes go on
    to upto. Whole documents together, long ones in parts counted from their beginning."""
    begin = 0
    ends = offsets.tolist()
    for low, high in zip(ends[:-1], ends[1:], strict=True):
        if high - begin > _PIECE and low > begin:
            yield begin, low, low
            begin = low
        while high - begin > _PIECE:
            yield begin, begin + _PIECE, high
            begin += _PIECE
    if ends[-1] > begin:
        yield begin, ends[-1], ends[-1]


def find_runs(data: np.ndarray, offsets: np.ndarray, length: int) -> Runs:
    """The runs of texts that lie one after the other."""
    gram = min(_GRAM, length)
    found: list[list[np.ndarray]] = []
    for begin, end, upto in _pieces(offsets):
        part = data[begin : min(upto, end + length - 1)]
        if len(part) < length:
            continue
        hashes = _grams(part, gram)
        # The leftmost of equal hashes: the smaller place makes the smaller number.
        keys = (hashes & ~_LOW) | np.arange(len(hashes), dtype=np.uint64)
        span, wanted = 1, length - gram + 1
        while span < wanted:
            more = min(span, wanted - span)
            keys = np.minimum(keys[:-more], keys[more:])
            span += more
        low, high = np.searchsorted(offsets, [begin, begin + len(part)], side="right")
        inner = offsets[low : high + 1]
        at = np.arange(min(len(keys), end - begin))
        doc = np.zeros(len(at), np.int64)
        np.add.at(doc, inner[inner - begin < len(at)] - begin, 1)
        doc = np.cumsum(doc) + low - 1
        place = (keys[: len(at)] & _LOW).astype(np.int64)
        fits = at + begin + length <= offsets[doc + 1]
        new = np.ones(len(at), bool)
        new[1:] = (place[1:] != place[:-1]) | (doc[1:] != doc[:-1]) | (fits[1:] != fits[:-1])
        first = np.flatnonzero(new)
        last = np.concatenate([first[1:], [len(at)]]) - 1
        chosen = fits[first]
        first, last = first[chosen], last[chosen]
        up, down = _powers(_PIECE + 4 * length + 64 if len(part) <= _PIECE + 4 * length else len(part) + 1)
        total = np.concatenate([[np.uint64(0)], np.cumsum((part.astype(np.uint64) + np.uint64(1)) * up[: len(part)])])
        sums = (total[last + length] - total[first]) * down[first]
        shape = (place[first] - first) * 1024 + (last - first)
        found.append([first + begin, last + begin, doc[first], hashes[place[first]], _mix(sums + shape.astype(np.uint64) * _power(3))])
    if not found:
        none = np.zeros(0, np.int64)
        return Runs(none, none, none, none.astype(np.uint64), none.astype(np.uint64))
    return Runs(*(np.concatenate(parts) for parts in zip(*found, strict=True)))


def _texts(batch: pa.RecordBatch, column: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Parts of a batch of bounded bytes, or of one document, with bytes and offsets."""
    data, offsets = binary_parts(batch.column(column))
    begin = 0
    while begin < batch.num_rows:
        end = int(np.searchsorted(offsets, offsets[begin] + 4 * _PIECE, side="right")) - 1
        end = min(max(end, begin + 1), batch.num_rows)
        part = offsets[begin : end + 1]
        yield batch.slice(begin, end - begin), data[part[0] : part[-1]], part - part[0]
        begin = end


# -- packed entries: sorted 32-bit keys as differences, and 40 bits of a hash, by bytes --


def _pack(keys: np.ndarray, hashes: np.ndarray) -> tuple[bytes, bytes]:
    steps = np.diff(keys, prepend=np.uint64(0)).astype("<u4")
    planes = hashes.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]
    return np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 4).T).tobytes(), planes.tobytes()


def _unpack(keys: bytes, hashes: bytes) -> tuple[np.ndarray, np.ndarray]:
    steps = np.ascontiguousarray(np.frombuffer(keys, np.uint8).reshape(4, -1).T).view("<u4").ravel()
    wide = np.zeros((len(steps), 8), np.uint8)
    wide[:, :5] = np.frombuffer(hashes, np.uint8).reshape(-1, 5)
    return np.cumsum(steps, dtype=np.uint64), wide.view("<u8").ravel()


def _new(*columns: np.ndarray) -> np.ndarray:
    """Where sorted rows differ from the one before."""
    out = np.ones(len(columns[0]), bool)
    out[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return out


def _entries(block, key, bytes_, doc) -> Iterator[tuple[int, int, bytes, bytes]]:
    """``(range, block, keys, hashes)``: of each block and anchor the first and the last
    run by hash and document, which tell whether there are several and whether alike."""
    order = np.lexsort((doc, bytes_, key, block))
    block, key, bytes_, doc = block[order], key[order], bytes_[order], doc[order]
    distinct = np.flatnonzero(_new(block, key, bytes_, doc))
    block, key, bytes_ = block[distinct], key[distinct], bytes_[distinct]
    first = _new(block, key)
    kept = first | np.append(first[1:], True)
    block, key, bytes_ = block[kept], key[kept], bytes_[kept]
    part = key >> np.uint64(32)
    begins = np.flatnonzero(_new(block, part))
    for a, b in zip(begins.tolist(), [*begins[1:].tolist(), len(key)], strict=True):
        yield int(part[a]), int(block[a]), *_pack(key[a:b] & _LOW, bytes_[a:b])


def anchor_entries(blocked: DataFrame, length: int, shift: int) -> DataFrame:
    """``(range, block, keys, hashes)`` of all documents, packed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        size = 0
        for batch in batches:
            for rows, data, offsets in _texts(batch, 2):
                runs = find_runs(data, offsets, length)
                block, place = rows.column(0).to_numpy()[runs.doc], rows.column(1).to_numpy()[runs.doc]
                held.append([block, runs.anchor >> np.uint64(shift), runs.bytes & np.uint64((1 << 40) - 1), place])
                size += len(block)
                if size > _ENTRIES:
                    yield _entry_batch(held)
                    held, size = [], 0
        if size:
            yield _entry_batch(held)

    return blocked.select("block", "place", "text").mapInArrow(run, "range long, block long, keys binary, hashes binary")


def _entry_batch(held: list[list[np.ndarray]]) -> pa.RecordBatch:
    rows = list(_entries(*(np.concatenate(parts) for parts in zip(*held, strict=True))))
    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary()]
    columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)]
    return pa.RecordBatch.from_arrays(columns, names=["range", "block", "keys", "hashes"])


def _judged(block: np.ndarray, key: np.ndarray, bytes_: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(block, key, code)`` for the anchors of one range that need an answer."""
    order = np.lexsort((block, key))
    block, key, bytes_ = block[order], key[order], bytes_[order]
    begins = np.flatnonzero(_new(key))
    sizes = np.diff(np.append(begins, len(key)))
    alike = np.minimum.reduceat(bytes_, begins) == np.maximum.reduceat(bytes_, begins)
    code = np.where(np.repeat(alike, sizes), _GONE, _MIXED)
    in_first = block == np.repeat(block[begins], sizes)
    code[in_first & (code == _GONE)] = _FIRST
    # In the first block only an anchor of several documents is of interest.
    twice = np.append(~_new(block, key)[1:], False) | ~_new(block, key)
    code[(code == _FIRST) & ~twice] = 0
    code[np.repeat(sizes, sizes) < 2] = 0
    kept = (code > 0) & _new(block, key)
    return block[kept], key[kept], code[kept]


def judge(entries: DataFrame) -> DataFrame:
    """``(block, range, keys, codes)``: what blocks have to know about their anchors."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for batch in batches:
            for row in range(batch.num_rows):
                part, block, keys, hashes = (c[row].as_py() for c in batch.columns)
                if part != now:
                    if held:
                        yield answers(now, held)
                    now, held = part, []
                unpacked = _unpack(keys, hashes)
                held.append((np.full(len(unpacked[0]), block, np.int32), unpacked[0].astype(np.uint32), unpacked[1]))
        if held:
            yield answers(now, held)

    def answers(part: int, held: list) -> pa.RecordBatch:
        block, key, code = _judged(*(np.concatenate(parts) for parts in zip(*held, strict=True)))
        order = np.lexsort((key, block))
        block, key, code = block[order], key[order], code[order]
        begins = np.flatnonzero(_new(block)) if len(block) else np.zeros(0, np.int64)
        ends = [*begins[1:].tolist(), len(block)]
        rows = [(int(block[a]), part, key[a:b].astype("<u4").tobytes(), code[a:b].astype(np.uint8).tobytes())
                for a, b in zip(begins.tolist(), ends, strict=False)]
        kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary()]
        columns = list(zip(*rows, strict=True)) or [(), (), (), ()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["block", "range", "keys", "codes"]
        )

    dealt = entries.repartition("range").sortWithinPartitions("range")
    return dealt.mapInArrow(run, "block long, range long, keys binary, codes binary")


# -- suffixes: multikey quicksort to a shallow depth, then blind tries ------------------


def equal_suffixes(strings: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order of strings (rows of bytes) by group and content, and in it where a
    string differs from the one before."""
    count, length = strings.shape
    order = np.argsort(group, kind="stable")
    new = _new(group[order]) if count else np.zeros(0, bool)
    shallow = min(_SHALLOW, length // 8 * 8)
    order, new = _multikey_quicksort(strings, order, new, shallow)
    return _blind_tries(strings, order, new, shallow)


def _multikey_quicksort(strings, order, new, shallow):
    """Ternary partitions of all segments at once, eight bytes at a time.

    A segment is what lies between two marks of ``new``. Each round splits every
    open segment at a pivot of its own into less, equal and greater; equal ones go
    on with their next eight bytes until the shallow depth.
    """
    words = np.ascontiguousarray(strings[:, :shallow]).view(">u8").astype(np.uint64)
    depth = np.zeros(len(order), np.int64)
    while True:
        begins = np.flatnonzero(new)
        sizes = np.diff(np.append(begins, len(order)))
        open_ = (sizes > 1) & (depth[begins] < words.shape[1])
        if not open_.any():
            return order, new
        begin, size = begins[open_], sizes[open_]
        upto = np.cumsum(size)
        at = np.arange(int(upto[-1])) + np.repeat(begin - (upto - size), size)
        level = depth[at]
        word = words[order[at], level]
        three = np.stack([words[order[begin + step], depth[begin]] for step in (size * 0, size // 2, size - 1)])
        pivot = np.repeat(np.sort(three, axis=0)[1], size)
        side = (word > pivot).astype(np.int8) + (word >= pivot)
        segment = np.repeat(np.arange(len(begin)), size)
        moved = np.argsort(segment * 3 + side, kind="stable")
        order[at] = order[at][moved]
        side = side[moved]
        depth[at] = level + (side == 1)
        new[at[1:]] |= (segment[1:] == segment[:-1]) & (side[1:] != side[:-1])


def _blind_tries(strings, order, new, shallow):
    """Split segments that agree so far at the first byte where a member differs.

    A segment is a node of a blind trie: bytes before its branching place are the
    same in all members and never looked at again. Members without any difference
    make a leaf.
    """
    done = np.zeros(len(order), bool)
    while True:
        begins = np.flatnonzero(new)
        sizes = np.diff(np.append(begins, len(order)))
        open_ = (sizes > 1) & ~done[begins]
        if not open_.any():
            return order, new
        begin, size = begins[open_], sizes[open_]
        upto = np.cumsum(size)
        starts = upto - size
        at = np.arange(int(upto[-1])) + np.repeat(begin - starts, size)
        rest = strings[order[at], shallow:]
        differs = rest != np.repeat(rest[starts], size, axis=0)
        place = np.where(differs.any(axis=1), differs.argmax(axis=1), rest.shape[1])
        branch = np.minimum.reduceat(place, starts)
        leaf = branch == rest.shape[1]
        done[begin[leaf]] = True
        branching = np.repeat(~leaf, size)
        at, segment = at[branching], np.repeat(np.arange(len(begin)), size)[branching]
        byte = rest[branching, np.repeat(branch, size)[branching]].astype(np.int64)
        moved = np.argsort(segment * 256 + byte, kind="stable")
        order[at] = order[at][moved]
        byte = byte[moved]
        new[at[1:]] |= (segment[1:] == segment[:-1]) & (byte[1:] != byte[:-1])


def _suffixes(runs: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray]:
    """All strings of runs, and the run of each."""
    sizes = np.array([len(r) - length + 1 for r in runs])
    data = np.frombuffer(b"".join(runs), np.uint8)
    begins = np.cumsum(sizes + length - 1) - (sizes + length - 1)
    run = np.repeat(np.arange(len(runs)), sizes)
    at = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes) + begins[run]
    return np.lib.stride_tricks.sliding_window_view(data, length)[at], run


def least_ids(keys: np.ndarray, runs: list[bytes], ids: np.ndarray, length: int) -> np.ndarray:
    """For each run the bits of its strings that a smaller id holds too.

    Equal strings of one key meet wherever they lie in their runs.
    """
    strings, run = _suffixes(runs, length)
    order, new = equal_suffixes(strings, keys[run])
    begins = np.flatnonzero(new)
    least = np.minimum.reduceat(ids[run[order]], begins)
    gone = np.empty(len(order), bool)
    gone[order] = np.repeat(least, np.diff(np.append(begins, len(order)))) < ids[run[order]]
    sizes = np.bincount(run, minlength=len(runs))
    place = np.arange(len(run)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    bits = np.where(gone, np.uint64(1) << place.astype(np.uint64), np.uint64(0))
    return np.bitwise_or.reduceat(bits, np.cumsum(sizes) - sizes)


_ANSWER = "block long, key long, hash long, bits long, id long"


def sort_runs(runs: DataFrame, length: int) -> DataFrame:
    """``(block, key, hash, bits, id)`` for ``runs(key, run, block, hash, id)``."""
    counts = runs.groupBy("key").count().where(F.col("count") > HOT_RUNS)
    hot = store(counts.select("key"), "hot-anchors")
    usual = runs.join(hot, "key", "left_anti").repartition("key").sortWithinPartitions("key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            begin = 0
            keys = batch.column(0).to_numpy()
            while begin < len(keys):
                # Whole keys together, as many as fit; a key goes on into the next batch.
                room = min(len(keys), begin + max(_TOGETHER - size, 1))
                room = int(np.searchsorted(keys, keys[room - 1], side="right"))
                if held and size >= _TOGETHER and keys[begin] != held[-1].column(0)[-1].as_py():
                    yield sorted_(held)
                    held, size = [], 0
                    continue
                if size >= _TOGETHER:
                    room = int(np.searchsorted(keys, keys[begin], side="right"))
                held.append(batch.slice(begin, room - begin))
                size += room - begin
                begin = room
        if held:
            yield sorted_(held)

    def sorted_(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held).combine_chunks()
        key, _, block, hash_, id_ = (table.column(i) for i in range(5))
        bits = least_ids(key.to_numpy(), table.column(1).to_pylist(), id_.to_numpy(), length)
        columns = [block, key, hash_, pa.array(bits.view(np.int64)), id_]
        return pa.Table.from_arrays(columns, names=["block", "key", "hash", "bits", "id"]).combine_chunks().to_batches()[0]

    usual = usual.select("key", "run", "block", "hash", "id").mapInArrow(run, _ANSWER)
    if hot.isEmpty():
        return usual
    # One row for each string of a hot anchor; equal ones meet as partial minima.
    many = runs.join(hot, "key", "left_semi")
    at = F.posexplode(F.transform(F.sequence(F.lit(1), F.length("run") - length + 1), lambda i: F.substring("run", i, F.lit(length))))
    many = store(many.select("block", "key", "hash", "id", at.alias("place", "string")), "hot-strings")
    least = store(many.groupBy("key", "string").agg(F.min("id").alias("least")), "hot-least")
    many = many.join(least, ["key", "string"])
    bit = F.when(F.col("least") < F.col("id"), F.expr("shiftleft(1L, place)")).otherwise(F.lit(0).cast("long"))
    return usual.unionByName(
        many.groupBy("block", "key", "hash", "id").agg(F.bit_or(bit).alias("bits")).select("block", "key", "hash", "bits", "id")
    )


# -- blocks -----------------------------------------------------------------------------


class _Codes:
    """What a block knows about its anchors."""

    def __init__(self, rows: list[tuple[int, bytes, bytes]]):
        keys = [np.frombuffer(k, "<u4").astype(np.uint64) | np.uint64(part << 32) for part, k, _ in rows]
        codes = [np.frombuffer(c, np.uint8) for *_, c in rows]
        self.keys = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
        codes = np.concatenate(codes) if codes else np.zeros(0, np.uint8)
        order = np.argsort(self.keys)
        self.keys, self.codes = self.keys[order], codes[order]

    def of(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes (0: none), and where they stand."""
        if not len(self.keys):
            return np.zeros(len(keys), np.uint8), np.zeros(len(keys), np.int64)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.codes[at], 0), at


def _by_block(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, pa.RecordBatch]]:
    """Batches cut where the block or the kind of row, the first two columns, changes."""
    for batch in batches:
        if batch.num_rows:
            block, kind = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            cuts = np.flatnonzero(_new(block, kind)).tolist()
            for a, b in zip(cuts, [*cuts[1:], batch.num_rows], strict=True):
                yield int(block[a]), int(kind[a]), batch.slice(a, b - a)


def mixed_runs(stream: DataFrame, length: int, shift: int) -> DataFrame:
    """``(key, run, block, hash, id)``: each block's different runs of mixed anchors, with
    the least id that holds each in the block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, known, codes, held = None, [], None, {}
        for block, kind, batch in _by_block(batches):
            if block != now:
                if held:
                    yield given(now, held)
                now, known, codes, held = block, [], None, {}
            if kind == 0:
                known += list(zip(*(batch.column(i).to_pylist() for i in (2, 6, 7)), strict=True))
                continue
            codes = codes or _Codes(known)
            for rows, data, offsets in _texts(batch, 6):
                runs = find_runs(data, offsets, length)
                key = runs.anchor >> np.uint64(shift)
                code, _ = codes.of(key)
                at = np.flatnonzero(code == _MIXED)
                ids = rows.column(2).to_numpy()[runs.doc[at]]
                for k, h, a, b, id_ in zip(key[at].tolist(), runs.bytes[at].view(np.int64).tolist(), runs.first[at].tolist(),
                                           runs.last[at].tolist(), ids.tolist(), strict=True):
                    if (k, h) not in held:
                        held[k, h] = (data[a : b + length].tobytes(), id_)
        if held:
            yield given(now, held)

    def given(block: int, held: dict) -> pa.RecordBatch:
        size = len(held)
        return pa.RecordBatch.from_arrays(
            [pa.array([k for k, _ in held], pa.int64()), pa.array([r for r, _ in held.values()], pa.binary()),
             pa.array(np.full(size, block)), pa.array([h for _, h in held], pa.int64()),
             pa.array([i for _, i in held.values()], pa.int64())],
            names=["key", "run", "block", "hash", "id"],
        )

    return stream.mapInArrow(run, "key long, run binary, block long, hash long, id long")


def _join_hash(key: np.ndarray, hash_: np.ndarray) -> np.ndarray:
    return _mix(key) ^ hash_


class _Block:
    """Which strings of a block's documents go."""

    def __init__(self, known: list, sorted_: list[pa.RecordBatch], length: int, shift: int):
        self.codes, self.length, self.shift = _Codes(known), length, shift
        self.owner = np.full(len(self.codes.keys), -(1 << 63), np.int64)
        self.owned = np.zeros(len(self.codes.keys), bool)
        columns = [np.concatenate([b.column(i).to_numpy() for b in sorted_]) if sorted_ else np.zeros(0, np.int64) for i in range(2, 6)]
        joined = _join_hash(columns[0].view(np.uint64), columns[1].view(np.uint64))
        order = np.argsort(joined)
        self.joined, self.bits, self.least = joined[order], columns[2][order].view(np.uint64), columns[3][order]

    def covered(self, data: np.ndarray, offsets: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Which bytes of documents, in the order of their ids, go."""
        length = self.length
        runs = find_runs(data, offsets, length)
        key = runs.anchor >> np.uint64(self.shift)
        code, at = self.codes.of(key)
        own = ids[runs.doc]
        whole = code == _GONE
        first = np.flatnonzero(code == _FIRST)
        if len(first):
            place, seen = np.unique(at[first], return_index=True)
            free = ~self.owned[place]
            self.owner[place[free]] = own[first[seen[free]]]
            self.owned[place] = True
            whole[first] = own[first] != self.owner[at[first]]
        starts = np.zeros(len(data) + 1, np.int32)
        mixed = np.flatnonzero(code == _MIXED)
        if len(mixed):
            joined = _join_hash(key[mixed], runs.bytes[mixed])
            found = np.searchsorted(self.joined, joined)
            bits, later = self.bits[found], own[mixed] > self.least[found]
            whole[mixed[later]] = True
            mixed, bits = mixed[~later], bits[~later]
            size = runs.last[mixed] - runs.first[mixed] + 1
            upto = np.cumsum(size)
            step = np.arange(int(upto[-1]) if len(upto) else 0) - np.repeat(upto - size, size)
            on = (np.repeat(bits, size) >> step.astype(np.uint64) & np.uint64(1)) != 0
            at_byte = (np.repeat(runs.first[mixed], size) + step)[on]
            starts[at_byte] += 1
            starts[at_byte + 1] -= 1
        np.add.at(starts, runs.first[whole], 1)
        np.add.at(starts, runs.last[whole] + 1, -1)
        # Bytes that a string covers which begins at most length - 1 bytes before.
        begins = np.concatenate([[0], np.cumsum(np.cumsum(starts[:-1]) > 0)])
        upto = np.arange(1, len(data) + 1)
        return begins[upto] > begins[np.maximum(upto - length, 0)]


def _cut(batch: pa.RecordBatch, block: _Block) -> Iterator[pa.RecordBatch]:
    for rows, data, offsets in _texts(batch, 6):
        gone = block.covered(data, offsets, rows.column(2).to_numpy())
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets[:-1]] = True
        begin = np.flatnonzero(gone & (edge[:-1] | ~np.concatenate([[False], gone[:-1]])))
        end = np.flatnonzero(gone & (np.append(edge[1:-1], True) | ~np.append(gone[1:], False))) + 1 if len(data) else begin
        kept_upto = np.concatenate([[0], np.cumsum(~gone)])
        kept = data[~gone].tobytes()
        cut = kept_upto[offsets].tolist()
        sizes = np.diff(offsets)
        spans = np.diff(np.searchsorted(begin, offsets))
        own = np.searchsorted(begin, offsets).astype(np.int32)
        shift = np.repeat(offsets[:-1], spans)
        yield pa.RecordBatch.from_arrays(
            [rows.column(8), pa.array(sizes), pa.array(sizes - np.diff(kept_upto[offsets])), pa.array(spans.astype(np.int64)),
             pa.array([kept[a:b] for a, b in zip(cut[:-1], cut[1:], strict=True)], pa.binary()),
             pa.ListArray.from_arrays(own, pa.array(begin - shift)), pa.ListArray.from_arrays(own, pa.array(end - shift))],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "begins", "ends"],
        )


def remove_repeats(df: DataFrame, length: int = 50, text: str = "text", id: str = "doc_id") -> DataFrame:
    """Each row's id with its text's bytes that no earlier document holds in such strings.

    A byte goes if a string of ``length`` bytes covers it that also begins in a
    document with a smaller id; strings lie inside one document, may overlap, and
    are judged on the texts as given. Results are ``n_bytes``, ``n_removed``,
    ``n_spans`` (runs of bytes removed), ``kept`` (the rest, as bytes, since a cut may
    part a character) and the ``begins`` and ``ends`` of the spans.

    ``length`` is from 20 to 64. Null texts are empty; texts shorter than ``length``
    keep all. Rows that share an id are one document's and none is earlier than
    another; null ids come before all others and share an id too. Ids may be of any type
    that can be sorted; texts go by their bytes. An empty table gives no rows.
    """
    if not _GRAM <= length <= 64:
        raise ValueError("the length must be from 20 to 64 bytes")
    spark = df.sparkSession
    given = df.select(
        column_of(df, id).alias("doc_id"), text_bytes(df, text).alias("text")
    )
    given = with_place(given, "doc_id").withColumn("place", F.coalesce("place", F.lit(-(1 << 63))))
    size = given.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = int(min(_MOST_BLOCKS, max(-(-size // _BLOCK_BYTES), spark.sparkContext.defaultParallelism)))
    given = given.withColumn("block", range_buckets(given, "place", blocks).cast("long"))
    shift = 32 - int(size // _RANGE_BYTES).bit_length()
    codes = store(judge(anchor_entries(given, length, shift)), "anchors")

    zero, none = F.lit(0).cast("long"), F.lit(None).cast("binary")
    no_id = F.lit(None).cast(df.schema[id].dataType).alias("doc_id")
    texts = given.select(
        "block", F.lit(2).alias("kind"), F.col("place").alias("a"), zero.alias("b"), zero.alias("c"), zero.alias("d"),
        F.col("text").alias("one"), none.alias("two"), "doc_id",
    )
    known = codes.select(
        "block", F.lit(0).alias("kind"), F.col("range").alias("a"), zero.alias("b"), zero.alias("c"), zero.alias("d"),
        F.col("keys").alias("one"), F.col("codes").alias("two"), no_id,
    )

    def stream(rows: DataFrame) -> DataFrame:
        """A task for each block."""
        return rows.repartitionById(blocks, F.col("block").cast("int")).sortWithinPartitions("block", "kind", "a")

    runs = mixed_runs(stream(known.unionByName(texts)), length, shift)
    answers = sort_runs(store(runs, "mixed-runs"), length).select(
        "block", F.lit(1).alias("kind"), F.col("key").alias("a"), F.col("hash").alias("b"), F.col("bits").alias("c"),
        F.col("id").alias("d"), none.alias("one"), none.alias("two"), no_id,
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, codes_of, sorted_, held = None, [], [], None
        for block, kind, batch in _by_block(batches):
            if block != now:
                now, codes_of, sorted_, held = block, [], [], None
            if kind == 0:
                codes_of += list(zip(*(batch.column(i).to_pylist() for i in (2, 6, 7)), strict=True))
            elif kind == 1:
                sorted_.append(batch)
            else:
                held = held or _Block(codes_of, sorted_, length, shift)
                yield from _cut(batch, held)

    kind = df.schema[id].dataType.simpleString()
    cut = stream(known.unionByName(answers).unionByName(texts)).mapInArrow(
        run, f"`{id}` {kind}, n_bytes long, n_removed long, n_spans long, kept binary, begins array<long>, ends array<long>"
    )
    return cut
