"""Nested data as flat tables, and back.

A struct becomes columns of its table, an array or map a table of its own with a row per
element, so arrays beside one another do not multiply. Every row has a key that its
children name, and an element its place; both together rebuild the input exactly, nulls,
empty arrays and structs of nulls included.

Rebuilding deals every table once, by the row of the input that its keys begin with: what
belongs to one row then meets without another shuffle. Elements without arrays of their
own, most of the rows, stand beside one another in their table and are dealt in runs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.functions.columns import column_of, ref, split_columns
from tallyframe.sources.scratch import stored

#: Key of a row, key of the row it belongs to, and its place there.
ROW, PARENT, PLACE = "_row", "_parent", "_place"
_VALUE, _ITEMS = "value", "_items"
# Key of the input's row that a row belongs to.
_ROOT = "_root"


def _nullable(kind: T.DataType) -> T.DataType:
    """The type with nulls allowed wherever it can hold some."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _nullable(f.dataType), True, f.metadata) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_nullable(kind.elementType), True)
    if isinstance(kind, T.MapType):
        return T.MapType(_nullable(kind.keyType), _nullable(kind.valueType), True)
    return kind


def _element_of(kind: T.DataType) -> T.DataType:
    """The type of a table's elements; those of a map are its entries."""
    if isinstance(kind, T.MapType):
        return T.StructType([T.StructField("key", kind.keyType), T.StructField("value", kind.valueType)])
    return kind.elementType


def _parts(value: Column, kind: T.DataType, name: str) -> Iterator[tuple[str, Column, Column | None, T.DataType]]:
    """Columns of a value: name, what the table holds, the elements if it has any, the type.

    A struct's own column says whether it is there, an array's or map's how many elements
    it has, null for none at all.
    """
    if isinstance(kind, T.StructType):
        yield name, value.isNotNull(), None, kind
        for field in kind.fields:
            yield from _parts(value.getField(field.name), field.dataType, f"{name}.{field.name}")
    elif isinstance(kind, (T.ArrayType, T.MapType)):
        items = F.map_entries(value) if isinstance(kind, T.MapType) else value
        yield name, F.when(value.isNotNull(), F.size(value)), items, kind
    else:
        yield name, value, None, kind


@dataclass(frozen=True)
class Tables:
    """Flat tables by path; ``""`` is the one with a row per row of the input."""

    schema: T.StructType
    frames: dict[str, DataFrame]

    def __getitem__(self, path: str) -> DataFrame:
        return self.frames[path]

    def rebuilt(self) -> DataFrame:
        """The rows of the input, in its schema but that nulls are allowed everywhere."""
        whole = self._with_children("", [(f.name, f.dataType) for f in self.schema.fields], 0)
        return whole.select(*[self._value(whole, f.dataType, f.name, "").alias(f.name) for f in self.schema.fields])

    def _with_children(self, path: str, kinds: list[tuple[str, T.DataType]], depth: int) -> DataFrame:
        """A table with the elements of its arrays and maps beside them, dealt by the input's rows if it has any."""
        frame, children = self.frames[path], _children(kinds)
        if not children:
            return frame
        row = F.struct(*[ref(c) for c in frame.columns]).alias("row")
        root = _root(PARENT, depth - 1) if depth else ref(ROW)
        # Groups of a root's keys, unlike joins on them, make do with rows that are dealt by the root.
        stacked = frame.withColumn(_ROOT, root).repartition(_ROOT).select(ref(_ROOT), ref(ROW).alias("key"), row)
        for i, (part, element) in enumerate(children):
            runs = self._runs(_below(path, part), element, depth + 1).withColumnsRenamed({PARENT: "key", "run": f"run{i}"})
            stacked = stacked.unionByName(runs, allowMissingColumns=True)
        found = [F.collect_list(c).alias(c) for c in stacked.columns if c not in (_ROOT, "key")]
        grouped = stacked.groupBy(ref(_ROOT), ref("key")).agg(*found)
        items = [_in_order(ref(f"run{i}")).alias(f"{_ITEMS}:{part}") for i, (part, _) in enumerate(children)]
        whole = grouped.select(ref(_ROOT), "row", *items).withColumn("row", F.explode("row"))
        return whole.select(ref(_ROOT), "row.*", *[ref(f"{_ITEMS}:{part}") for part, _ in children])

    def _runs(self, path: str, element: T.DataType, depth: int) -> DataFrame:
        """The elements of a table in runs: root, parent, and the first place with the items from there on."""
        kinds = [(_VALUE, element)]
        rows = self._with_children(path, kinds, depth)
        item = self._value(rows, element, _VALUE, path).alias("item")
        rows = rows.filter(ref(PARENT).isNotNull())
        cells = [ref(PARENT), ref(PLACE).alias("place")]
        run = F.struct("place", "items").alias("run")
        if _children(kinds):
            return rows.select(ref(_ROOT), *cells, F.array(item).alias("items")).select(ref(_ROOT), ref(PARENT), run)
        if _in_arrow(element):
            runs = _joined(rows.select(*cells, item))
        else:
            runs = rows.select(*cells, F.array(item).alias("items"))
        dealt = runs.withColumn(_ROOT, _root(PARENT, depth - 1)).repartition(_ROOT)
        return dealt.select(ref(_ROOT), ref(PARENT), run)

    def _value(self, frame: DataFrame, kind: T.DataType, name: str, path: str) -> Column:
        own = column_of(frame, name)
        if isinstance(kind, T.StructType):
            fields = [self._value(frame, f.dataType, f"{name}.{f.name}", path).alias(f.name) for f in kind.fields]
            return F.when(own, F.struct(*fields)).cast(kind)
        if isinstance(kind, (T.ArrayType, T.MapType)):
            items = T.ArrayType(_element_of(kind))
            held = F.when(own == 0, F.array().cast(items)).when(own > 0, column_of(frame, f"{_ITEMS}:{name}").cast(items))
            return F.map_from_entries(held).cast(kind) if isinstance(kind, T.MapType) else held.cast(kind)
        return own


def _children(kinds: list[tuple[str, T.DataType]]) -> list[tuple[str, T.DataType]]:
    """The arrays and maps of a table's columns, and the types of their elements."""
    parts = [p for name, kind in kinds for p in _parts(F.lit(None).cast(kind), kind, name)]
    return [(part, _element_of(inner)) for part, _, items, inner in parts if items is not None]


def _root(key: str, places: int) -> Column:
    """A key without its last so many places."""
    if not places:
        return ref(key)
    return F.left(ref(key), F.length(ref(key)) - F.length(F.substring_index(ref(key), "/", -places)) - 1)


def _in_order(runs: Column) -> Column:
    """The items of runs by their places; null for none at all."""
    placed = F.flatten(F.transform(runs, lambda run: F.transform(
        run["items"], lambda x, i: F.struct((run["place"] + i).alias("place"), x.alias("item"))
    )))
    # Places tell all elements of a row apart, so that sorting never looks at the items.
    ordered = F.transform(F.array_sort(placed, lambda a, b: a["place"] - b["place"]), lambda x: x["item"])
    return F.when(F.size(runs) == 1, runs[0]["items"]).when(F.size(runs) > 1, ordered)


def _in_arrow(kind: T.DataType) -> bool:
    """Whether values keep their type and all their bits on the way to Python and back."""
    if isinstance(kind, T.StructType):
        return all(_in_arrow(f.dataType) for f in kind.fields)
    if isinstance(kind, T.StringType):
        return kind == T.StringType()
    return isinstance(kind, (T.NumericType, T.BooleanType, T.BinaryType, T.DateType, T.TimestampType))


def _joined(rows: DataFrame) -> DataFrame:
    """Rows of one parent whose places follow one another as a single row, with the first place."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            parent, place, items = batch.columns
            begins = np.ones(batch.num_rows, bool)
            begins[1:] = np.diff(place.to_numpy()) != 1
            begins[1:] |= pc.not_equal(parent[1:], parent[:-1]).to_numpy(zero_copy_only=False)
            at = np.flatnonzero(begins)
            items = pa.ListArray.from_arrays(pa.array(np.append(at, batch.num_rows), pa.int32()), items)
            first = pa.array(at)
            yield pa.RecordBatch.from_arrays(
                [parent.take(first), place.take(first), items], names=[PARENT, "place", "items"]
            )

    kind = T.ArrayType(rows.schema["item"].dataType)
    return rows.mapInArrow(run, T.StructType([*rows.schema.fields[:2], T.StructField("items", kind)]))


def _below(path: str, name: str) -> str:
    return f"{path}/{name}" if path else name


def flatten_tables(df: DataFrame, keys=None) -> Tables:
    """The tables of a nested dataset.

    The table ``""`` has ``_row`` and the columns; ``a.b`` is field ``b`` of struct ``a``.
    Each array or map has a table by its path, such as ``a.b`` or, inside an array ``c``,
    ``c/value.d``, with ``_row``, ``_parent``, ``_place`` and ``value``, or ``value.x`` for
    a field ``x`` (a map's entries have ``key`` and ``value``).

    ``keys`` name columns that tell rows apart, and give keys that a later run finds again.
    Without them rows are numbered in a stored copy. Names that would repeat are an error.
    """
    given = [column_of(df, key).alias(key) for key in split_columns(keys)]
    if given:
        row = F.to_json(F.struct(*given), {"ignoreNullFields": "false"})
        numbered = df.withColumn(ROW, row)
    else:
        numbered = stored(df.withColumn(ROW, F.monotonically_increasing_id().cast("string")))
    frames: dict[str, DataFrame] = {}

    def add(path: str, frame: DataFrame, before: list[Column], kinds: list[tuple[str, T.DataType]]) -> None:
        parts = [p for name, kind in kinds for p in _parts(ref(name), kind, name)]
        names = [ROW, *(p[0] for p in parts), *([PARENT, PLACE] if path else [])]
        repeated = {n for n in names if [m.lower() for m in names].count(n.lower()) > 1}
        if repeated:
            raise ValueError(f"tables of {path or 'the rows'!r} repeat columns {sorted(repeated)}")
        frames[path] = frame.select(*before, *[value.alias(name) for name, value, _, _ in parts])
        for name, _, items, kind in parts:
            if items is None:
                continue
            rows = frame.select(ref(ROW).alias(PARENT), F.posexplode(items).alias(PLACE, _VALUE))
            rows = rows.withColumn(ROW, F.concat_ws("/", PARENT, PLACE))
            add(_below(path, name), rows, [ref(ROW), ref(PARENT), ref(PLACE)], [(_VALUE, _element_of(kind))])

    add("", numbered, [ref(ROW)], [(f.name, f.dataType) for f in df.schema.fields])
    return Tables(_nullable(df.schema), frames)
