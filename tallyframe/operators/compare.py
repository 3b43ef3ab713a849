"""Comparing two datasets column by column.

Rows meet on their keys. A key that several rows share on both sides stands for
every pair of its rows, and the figures count those pairs; but no plan here ever
builds them:

* keys with at most one row on each side go through one full outer join that
  serves all columns;
* repeated keys, if there are any, are counted per key, column and value. The
  number of equal pairs then is a sum of products, whatever the key's share of
  the data. Partial counts shrink a hot key inside the map tasks.

Which keys repeat is found first, by a pass over the keys alone. Without
repeated keys only the join is left, over keys that are unique on both sides and
hence cannot be skewed.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace
from decimal import Decimal
from functools import cached_property
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.functions.columns import (
    balanced,
    column_of,
    find_field,
    is_native,
    ref,
    require_columns,
    same_name,
    shared_form,
    split_columns,
    sql_text,
    trimmed_text,
)
from tallyframe.operators.keys import key_rows, tally
from tallyframe.results import DATA, Check, Names, inline_rows, spread
from tallyframe.sources.scratch import ready_for_checkpoints, stored

Normalizer = Callable[[Column], Column]

_CELL = ("c", "source_value", "target_value", "kind")
_LARGEST = 2**63 - 1
_DEFAULT_SCALE = 18
# A number is a whole one and a fraction from 0 on below 1, each exact, so that its size
# does not take fraction digits away. Whole ones of so many digits leave room for sums.
_WHOLE, _WHOLE_DIGITS = "decimal(38,0)", 36
# Digits of a tolerance, and of a number in exponent notation, with the fraction's.
_NUMBER_DIGITS = 37
# A broadcast key costs more than its own bytes once it sits in a hash table.
_KEY_OVERHEAD = 64
# Rows of one key that a task takes without trouble.
_HOT_ROWS = 1_000_000
# Tasks that share a hot key's rows where the hot keys do not fit into a broadcast.
_HOT_TASKS = 64


@dataclass(frozen=True)
class CompareOptions:
    """How values are compared.

    columns      columns to compare; by default the source's, less the keys
    normalizers  per column, a function applied to the trimmed text of both sides
    tolerance    per column, the largest difference of numbers that still counts
                 as equal; equal texts are equal whatever they hold
    scale        fraction digits of the numbers that a tolerance is applied to. No
                 value is rounded: one that is finer, or has more than 36 digits
                 before the point, is compared as text
    """

    columns: str | Sequence[str] | None = None
    normalizers: Mapping[str, Normalizer] = field(default_factory=dict)
    tolerance: Mapping[str, float | str | Decimal] = field(default_factory=dict)
    scale: int = _DEFAULT_SCALE


def _by_name(mapping: Mapping, name: str):
    for key, value in mapping.items():
        if key.strip().lower() == name.lower():
            return value
    return None


def _as_count(total: str) -> str:
    """A total as long, or an error: pairs of a hot key can pass what a long holds."""
    exact = _exact(total)
    return (
        f"if({exact} between -{_LARGEST} and {_LARGEST}, try_cast({exact} as bigint), "
        f"cast(raise_error(concat('a count of pairs exceeds a long: ', {exact})) as bigint))"
    )


def _wide(count: str) -> str:
    """A count that can be multiplied by another one."""
    return f"cast({count} as decimal(20,0))"


def _exact(total: str) -> str:
    return f"cast({total} as decimal(38,0))"


@dataclass(frozen=True)
class _RepeatedKeys:
    """Stored keys with their rows ``m`` and ``n`` per side, and their measures.

    ``size`` and ``hot_size`` are the bytes of all and of the hot keys in a broadcast.
    """

    rows: DataFrame
    size: int
    figures: Mapping[str, int]

    hot_size: int


class Comparison:
    """Source and target, brought into one form and met on their keys."""

    def __init__(
        self,
        source: DataFrame,
        target: DataFrame,
        keys,
        options: CompareOptions = CompareOptions(),
    ):
        self.keys = require_columns(keys, "key column")
        self.columns = split_columns(options.columns) or [
            name for name in source.columns if not same_name(name, self.keys)
        ]
        self.options = options
        self._session = source.sparkSession
        self._key_slots = [f"k{i}" for i in range(len(self.keys))]
        self._slots = [f"v{i}" for i in range(len(self.columns))]
        self._allowed = [self._allowed_difference(name) for name in self.columns]

        key_forms = [shared_form(source, target, key) for key in self.keys]
        forms = [self._value_form(source, target, name) for name in self.columns]
        self._exact_columns = [self._is_exact(source, target, name) for name in self.columns]
        self._native_keys = [is_native(source, target, key) for key in self.keys]
        self._given = (source, target)

        def side(df: DataFrame, position: int) -> DataFrame:
            return df.select(
                *[f[position].alias(s) for f, s in zip(key_forms, self._key_slots)],
                *[f[position].alias(s) for f, s in zip(forms, self._slots)],
            )

        self._source, self._target = side(source, 0), side(target, 1)

    # -- the form in which values are compared ------------------------------

    def _allowed_difference(self, name: str) -> Decimal | None:
        """Tolerance of a column, a whole number of units of the last fraction digit."""
        allowed = _by_name(self.options.tolerance, name)
        if allowed is None:
            return None
        allowed = Decimal(str(allowed))
        units = allowed.scaleb(self.options.scale)
        if units < 0 or units != units.to_integral_value() or allowed >= self._bound:
            raise ValueError(
                f"tolerance {allowed} of {name!r} must be a multiple of the last "
                f"of {self.options.scale} fraction digits, not negative, and below "
                f"{self._bound:f}"
            )
        return allowed

    @property
    def _bound(self) -> Decimal:
        """What tolerances, and numbers in exponent notation, stay below."""
        return Decimal(1).scaleb(_NUMBER_DIGITS - 1 - self.options.scale)

    def _held(self, number: str) -> str:
        return f"cast({number} as decimal({_NUMBER_DIGITS},{self.options.scale}))"

    def _in_exponents(self, text: str) -> tuple[str, str]:
        """A text in exponent notation as number with a fraction, and as a whole one, each
        null if that takes rounding."""
        scale = self.options.scale
        number = f"try_{self._held(text)}"
        fraction = f"regexp_replace(regexp_extract({text}, '[.]([0-9]*)', 1), '0+$', '')"
        exponent = f"regexp_extract({text}, '[eE]([+-]?[0-9]+)$', 1)"
        digits = f"length({fraction}) - coalesce(try_cast({exponent} as int), 0)"
        return (
            f"if({digits} <= {scale} and abs({number}) < {self._bound:f}BD, {number}, null)",
            f"if({digits} <= 0, try_cast({text} as {_WHOLE}), null)",
        )

    @property
    def _fraction(self) -> str:
        return f"decimal({self.options.scale + 1},{self.options.scale})"

    def _parts(self, tolerance: Decimal) -> tuple[str, str]:
        """A tolerance as whole number and fraction."""
        whole = int(tolerance)
        return f"cast({whole}BD as {_WHOLE})", f"cast({tolerance - whole:f}BD as {self._fraction})"

    def _with_numbers(self, df: DataFrame, prefix: str = "") -> DataFrame:
        """With ``w`` and ``f`` of the columns that have a tolerance: the whole number not
        above a value, and what is left; null where a value is no number."""
        for i, slot in enumerate(self._slots):
            if self._allowed[i] is not None:
                value, w, f = f"{prefix}{slot}", f"{prefix}w{i}", f"{prefix}f{i}"
                add = self._add_exact if self._exact_columns[i] else self._add_from_text
                df = add(df, value, w, f)
        return df

    def _bounded(self, w: str, f: str) -> tuple[str, str]:
        """Both parts, or null for both if one is or the whole is too large."""
        good = f"abs({w}) < 1{'0' * _WHOLE_DIGITS}BD and {f} is not null"
        return f"if({good}, {w}, null)", f"if({good}, {f}, null)"

    def _add_exact(self, df: DataFrame, value: str, w: str, f: str) -> DataFrame:
        rest = f"({value} - floor({value}))"
        held = f"try_cast({rest} as {self._fraction})"
        df = df.selectExpr(
            "*", f"cast(floor({value}) as {_WHOLE}) as __w", f"if({held} = {rest}, {held}, null) as __f"
        )
        return self._kept(df, w, f, ["__w", "__f"])

    def _add_from_text(self, df: DataFrame, value: str, w: str, f: str) -> DataFrame:
        number, whole_number = self._in_exponents(value)
        df = df.selectExpr(
            "*",
            f"{value} rlike '^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)$' as __plain",
            f"{value} like '-%' as __minus",
            f"trim(leading '+' from trim(leading '-' from {value})) as __digits",
        ).selectExpr(
            "*",
            "substring_index(__digits, '.', 1) as __ones",
            "if(__digits like '%.%', trim(trailing '0' from substring_index(__digits, '.', -1)), '') as __decimals",
            f"if(__plain, null, {number}) as __odd",
            f"if(__plain, null, {whole_number}) as __large",
        ).selectExpr(
            "*",
            f"if(__plain, try_cast(if(__ones = '', '0', __ones) as {_WHOLE}), null) as __a",
            f"if(__plain and length(__decimals) <= {self.options.scale}, "
            f"try_cast(concat('0.', __decimals, '0') as {self._fraction}), null) as __b",
        )
        whole = f"""case when not __plain then coalesce(cast(floor(__odd) as {_WHOLE}), __large)
            when not __minus then __a
            else cast(-__a - if(__b > 0, 1BD, 0BD) as {_WHOLE}) end"""
        rest = f"""case when not __plain
            then cast(coalesce(__odd - floor(__odd), __large - __large) as {self._fraction})
            when __minus and __b > 0 then cast(1BD - __b as {self._fraction}) else __b end"""
        df = df.selectExpr("*", f"{whole} as __w", f"{rest} as __f")
        return self._kept(df, w, f, [c for c in df.columns if c.startswith("__")])

    def _kept(self, df: DataFrame, w: str, f: str, temporary: list[str]) -> DataFrame:
        whole, rest = self._bounded("__w", "__f")
        return df.selectExpr("*", f"{whole} as {w}", f"{rest} as {f}").drop(*temporary)

    def _value_form(self, source, target, name: str) -> tuple[Column, Column]:
        normalizer = _by_name(self.options.normalizers, name)
        tolerated = _by_name(self.options.tolerance, name) is not None
        if normalizer is None and (not tolerated or self._is_exact(source, target, name)):
            return shared_form(source, target, name)

        def form(df: DataFrame) -> Column:
            text = trimmed_text(ref(find_field(df, name).name))
            if normalizer is not None:
                text = F.trim(normalizer(text).cast("string"))
            return text

        return form(source), form(target)

    def _is_exact(self, source, target, name: str) -> bool:
        """Whether a column holds whole or decimal numbers as they are, not as text."""
        if _by_name(self.options.normalizers, name) is not None:
            return False
        kind = find_field(source, name).dataType
        return is_native(source, target, name) and isinstance(kind, (T.IntegralType, T.DecimalType))

    def _equal(self, position: int) -> str:
        """Equality of a pair's values; with a tolerance d, m - n <= d and n - m <= d."""
        slot, allowed = self._slots[position], self._allowed[position]
        equal = f"m_{slot} = n_{slot}"
        if allowed is not None:
            dw, df = self._parts(allowed)

            def at_most(one: str, other: str) -> str:
                # Whole parts in full, and fractions that make up for one of them at most.
                over = f"({one}_w{position} - {other}_w{position} - {dw})"
                rest = f"({one}_f{position} - {other}_f{position} - {df})"
                return f"({over} < 0 or ({over} = 0 and {rest} <= 0) or ({over} = 1 and {rest} <= -1))"

            equal += f" or ({at_most('m', 'n')} and {at_most('n', 'm')})"
        return f"coalesce({equal}, false)"

    # -- repeated keys ------------------------------------------------------

    @cached_property
    def _repeated(self) -> _RepeatedKeys | None:
        """Keys with several rows on a side; None when there are none."""
        slots = [F.col(slot) for slot in self._key_slots]
        ready_for_checkpoints(self._session)
        repeated = (
            tally(self._source, self._target, slots, slots, self._key_slots)
            .selectExpr(*self._key_slots, "__source_rows as m", "__target_rows as n")
            .filter("m > 1 or n > 1")
            .checkpoint()
        )
        key_bytes = [f"coalesce(octet_length(cast({s} as string)), 0)" for s in self._key_slots]
        size = " + ".join([str(_KEY_OVERHEAD), *key_bytes])
        measured = repeated.selectExpr(
            f"sum({size}) as bytes",
            f"coalesce(sum(if(m + n >= {_HOT_ROWS}, {size}, 0)), 0) as hot_bytes",
            "sum(m) as source_records",
            "sum(n) as target_records",
            "count_if(n = 0) as source_only",
            "count_if(m = 0) as target_only",
            "count_if(n > 1) as repeated",
        ).first()
        if measured["bytes"] is None:
            return None
        figures = measured.asDict()
        return _RepeatedKeys(
            repeated, figures.pop("bytes"), figures, figures.pop("hot_bytes")
        )

    def _repeated_on(self, rows: str) -> DataFrame:
        """Repeated keys that one side has, and in how many parts to handle their values."""
        return self._repeated.rows.filter(f"{rows} > 0").selectExpr(
            *[f"{slot} as r_{slot}" for slot in self._key_slots],
            f"cast(ceil((m + n) / {_HOT_ROWS}) as int) as parts",
            f"m + n >= {_HOT_ROWS} as hot",
        )

    def _may_broadcast_repeated(self) -> bool:
        return self._repeated.size <= broadcast_limit(self._session)

    def _may_broadcast_hot(self) -> bool:
        return 0 < self._repeated.hot_size <= broadcast_limit(self._session)

    def _meet_hot(self, df: DataFrame, hot: DataFrame, how: str) -> DataFrame:
        """Joins the rows of one side with hot keys, no task getting all rows of one."""
        if self._may_broadcast_hot():
            return df.join(F.broadcast(hot), self._on_repeated(), how)
        # Every hot key goes to all parts, and a row to the part of the task it is in.
        everywhere = hot.selectExpr("*", f"explode(sequence(0, {_HOT_TASKS - 1})) as r_part")
        placed = df.selectExpr("*", f"pmod(spark_partition_id(), {_HOT_TASKS}) as part")
        together = self._on_repeated() & F.expr("part = r_part")
        return placed.join(everywhere, together, how).drop("part", "r_part")

    def _rows_of_repeated(self, df: DataFrame, rows: str) -> DataFrame:
        """The rows of one side whose keys repeat, with the ``parts`` of their keys."""
        wanted, kept = self._repeated_on(rows), [*df.columns, "parts"]
        if self._may_broadcast_repeated():
            return df.join(F.broadcast(wanted), self._on_repeated()).select(*kept)
        if not self._repeated.hot_size:
            return df.join(wanted, self._on_repeated()).select(*kept)
        hot = wanted.filter("hot")
        others = self._meet_hot(df, hot, "left_anti")
        return self._meet_hot(df, hot, "inner").select(*kept).unionByName(
            others.join(wanted.filter("not hot"), self._on_repeated()).select(*kept)
        )

    def _on_repeated(self) -> Column:
        return F.expr(" and ".join(f"{s} <=> r_{s}" for s in self._key_slots))

    # -- keys with at most one row on each side -----------------------------

    def _incomplete(self, prefix: str = "") -> str:
        return " or ".join(f"{prefix}{slot} is null" for slot in self._key_slots)

    def _single_rows(self, df: DataFrame, rows: str) -> DataFrame:
        """One side without its repeated keys: keys, row count and values.

        ``lone`` parts keys with a null from those of the other side.
        """
        if self._repeated is not None and self._may_broadcast_repeated():
            repeated = F.broadcast(self._repeated_on(rows))
            df = df.join(repeated, self._on_repeated(), "left_anti")
        elif self._repeated is not None:
            # Too many to broadcast. The keys and ``lone`` are what the sides meet on
            # later, so that both joins take one shuffle and one sort of the rows.
            repeated = self._repeated_on(rows)
            if self._repeated.hot_size:
                df = self._meet_hot(df, repeated.filter("hot"), "left_anti")
                repeated = repeated.filter("not hot")
            df = df.selectExpr("*", f"if({self._incomplete()}, '{rows}', '') as lone")
            repeated = repeated.selectExpr(
                "*", f"if({self._incomplete('r_')}, '{rows}', '') as r_lone"
            )
            same_key = self._on_repeated() & F.expr("lone = r_lone")
            df = df.join(repeated, same_key, "left_anti")
        named = [name for name in df.columns if name not in self._key_slots]
        return df.selectExpr(
            *[f"{slot} as {rows}_{slot}" for slot in self._key_slots],
            f"1 as {rows}",
            *[f"{name} as {rows}_{name}" for name in named],
        )

    def _singles(self) -> DataFrame:
        source, target = self._single_rows(self._source, "m"), self._single_rows(self._target, "n")
        equals = "<=>" if "m_lone" in source.columns else "="
        same_key = [f"m_{slot} {equals} n_{slot}" for slot in self._key_slots]
        if equals == "<=>":
            same_key.append("m_lone = n_lone")
        met = source.join(target, F.expr(" and ".join(same_key)), "full_outer").selectExpr(
            *[f"coalesce(m_{slot}, n_{slot}) as {slot}" for slot in self._key_slots],
            "m",
            "n",
            *[f"{side}_{slot}" for side in "mn" for slot in self._slots],
        )
        return self._with_numbers(self._with_numbers(met, "m_"), "n_")

    # -- repeated keys, counted by value ------------------------------------

    def _value_counts(self) -> DataFrame:
        """Rows of each side per repeated key, column and value.

        ``s_hits`` is the number of target rows of the key whose value equals
        this one, ``t_hits`` the number of source rows.
        """
        tolerated = any(limit is not None for limit in self._allowed)

        def cell(i: int, slot: str) -> str:
            parts = ["w", "f"] if tolerated else []
            named = [
                f"{part}{i} as {part}" if self._allowed[i] is not None
                else f"cast(null as {_WHOLE if part == 'w' else self._fraction}) as {part}"
                for part in parts
            ]
            return f"struct({', '.join([f'{i} as c', f'cast({slot} as string) as v', *named])})"

        cells = [cell(i, slot) for i, slot in enumerate(self._slots)]

        def side(df: DataFrame, rows: str) -> DataFrame:
            return self._with_numbers(self._rows_of_repeated(df, rows)).selectExpr(
                *self._key_slots,
                "parts",
                f"if({self._incomplete()}, '{rows}', null) as lone",
                f"{int(rows == 'm')} as s",
                f"{int(rows == 'n')} as t",
                inline_rows(cells),
            )

        value = ["v", "w", "f"] if tolerated else ["v"]
        counted = (
            side(self._source, "m")
            .unionByName(side(self._target, "n"))
            .groupBy(*self._key_slots, "lone", "parts", "c", *value)
            .agg(F.expr("sum(s) as s"), F.expr("sum(t) as t"))
        )
        alike = ["if(v is null, 0, t) as s_hits", "if(v is null, 0, s) as t_hits"]
        if not tolerated:
            return counted.selectExpr("*", *alike)
        words = counted.filter("w is null").selectExpr("* except (w, f)", *alike)
        probes = self._probes(counted.filter("w is not null"))
        if not self._repeated.hot_size:
            return words.unionByName(self._hits(probes, []))
        few = self._hits(probes.filter("parts = 1"), [])
        return words.unionByName(few).unionByName(self._hits_of_hot(probes.filter("parts > 1")))

    @property
    def _group(self) -> list[str]:
        return [*self._key_slots, "lone", "parts", "c"]

    def _probes(self, counted: DataFrame) -> DataFrame:
        """Each value at its own place, and where the values begin and end that equal it.

        In the order of ``w, f, role`` all rows up to the end (role 2), less those before
        the beginning (role 0), are the ones within the tolerance.
        """
        whole, rest = (
            " ".join(
                f"when {i} then {self._parts(limit)[part]}"
                for i, limit in enumerate(self._allowed)
                if limit is not None
            )
            for part in (0, 1)
        )
        placed = counted.selectExpr("*", f"case c {whole} end as dw", f"case c {rest} end as df")

        def probe(role: int, w: str, f: str, weighs: int) -> str:
            return (
                f"struct({role} as role, cast({w} as {_WHOLE}) as w, cast({f} as {self._fraction}) as f, "
                f"s * {weighs} as s_here, t * {weighs} as t_here)"
            )

        return placed.selectExpr(
            *self._group,
            "v",
            "s",
            "t",
            inline_rows(
                [
                    probe(0, "w - dw - if(f < df, 1BD, 0BD)", "f - df + if(f < df, 1BD, 0BD)", 0),
                    probe(1, "w", "f", 1),
                    probe(2, "w + dw + if(f + df >= 1, 1BD, 0BD)", "f + df - if(f + df >= 1, 1BD, 0BD)", 0),
                ]
            ),
        )

    def _hits(self, probes: DataFrame, piece: list[str], before: tuple[str, str] = ("0", "0")) -> DataFrame:
        """``s_hits`` and ``t_hits`` of the values by running sums over each group, or over
        each ``piece`` of one, with what stands before it."""
        so_far = (
            f"over (partition by {', '.join([*self._group, *piece])} order by w, f, role "
            "rows between unbounded preceding and current row)"
        )
        summed = probes.selectExpr(
            *self._group, "v", "s", "t", "role",
            f"sum(t_here) {so_far} + {before[1]} as t_run",
            f"sum(s_here) {so_far} + {before[0]} as s_run",
        )
        return summed.groupBy(*self._group, "v", "s", "t").agg(
            F.expr("sum((role - 1) * t_run) as s_hits"), F.expr("sum((role - 1) * s_run) as t_hits")
        )

    def _pieces(self, probes: DataFrame) -> DataFrame:
        """Probes in ranges of group and number, stored with the number of their range.

        A hot key's values so are in many tasks, each of which sorts only its own.
        """
        ranged = probes.repartitionByRange(*[F.col(c) for c in [*self._group, "w", "f", "role"]])
        return stored(ranged.selectExpr("*", "spark_partition_id() as piece"))

    def _hits_of_hot(self, probes: DataFrame) -> DataFrame:
        pieces = self._pieces(probes)
        earlier = (
            f"over (partition by {', '.join(self._group)} order by piece "
            "rows between unbounded preceding and 1 preceding)"
        )
        sums = pieces.groupBy(*self._group, "piece").agg(
            F.expr("sum(s_here) as s_sum"), F.expr("sum(t_here) as t_sum")
        )
        offsets = sums.selectExpr(
            *[f"{name} as o_{name}" for name in [*self._group, "piece"]],
            f"coalesce(sum(s_sum) {earlier}, 0) as s_before",
            f"coalesce(sum(t_sum) {earlier}, 0) as t_before",
        )
        same = " and ".join(f"{name} <=> o_{name}" for name in [*self._group, "piece"])
        return self._hits(pieces.join(offsets, F.expr(same)), ["piece"], ("s_before", "t_before"))

    # -- figures ------------------------------------------------------------

    def _figures(self) -> DataFrame:
        """One row: figures on the keys, and per column pairs and source rows.

        A pair is kept when both values are there or both are missing. A missing
        partner counts as a missing value. Two missing values are never equal.
        A source row is unsound in a column if it has no partner or differs from
        one of them.
        """
        # Each column's equality is a column of its own, so that it is found once a pair.
        compared = self._singles().selectExpr(
            "m", "n",
            *[f"m_{slot} is null as m_none_{i}" for i, slot in enumerate(self._slots)],
            *[f"n_{slot} is null as n_none_{i}" for i, slot in enumerate(self._slots)],
            *[f"{self._equal(i)} as same_{i}" for i in range(len(self._slots))],
        )
        summed = []
        for i in range(len(self._slots)):
            summed += [
                f"count_if(m_none_{i} = n_none_{i}) as kept_{i}",
                f"count_if(same_{i}) as equal_{i}",
                f"count_if(m is not null and not same_{i}) as unsound_{i}",
            ]
        singles = compared.selectExpr(
            "count(m) as source_records",
            "count(n) as target_records",
            "count_if(n is null) as source_only",
            "count_if(m is null) as target_only",
            "bigint(0) as repeated",
            *summed,
        )
        if self._repeated is None:
            return singles
        on_keys = self._repeated.figures
        together = singles
        if self._slots:
            by_column = self._repeated_figures().selectExpr(
                *[
                    f"sum(if(c = {i}, {what}, null)) as {what}_{i}"
                    for i in range(len(self._slots))
                    for what in ("kept", "equal", "unsound")
                ]
            )
            together = singles.unionByName(by_column, allowMissingColumns=True)
        return together.selectExpr(
            *[f"sum({n}) + {on_keys.get(n, 0)} as {n}" for n in singles.columns]
        )

    def _repeated_groups(self) -> DataFrame:
        """Per repeated key and column the rows of each side and the equal pairs."""
        group = [*self._key_slots, "lone", "c"]
        counts = self._value_counts().selectExpr(
            *group, "v is null as missing", "s", "t", "s_hits"
        )
        if any(limit is not None for limit in self._allowed):
            # Within a tolerance several values can equal every row of the target.
            counts = counts.groupBy(*group, "missing", "s_hits").agg(
                F.expr("sum(s) as s"), F.expr("sum(t) as t")
            )
        return counts.groupBy(*group).agg(
            F.expr("sum(if(missing, 0, s)) as s_known"),
            F.expr("sum(if(missing, 0, t)) as t_known"),
            F.expr("sum(if(missing, s, 0)) as s_null"),
            F.expr("sum(if(missing, t, 0)) as t_null"),
            F.expr(f"sum({_wide('s')} * {_wide('s_hits')}) as equal"),
            F.expr("max(s_hits) as most_hits"),
            F.expr("max_by(s, s_hits) as s_most"),
        )

    def _repeated_figures(self) -> DataFrame:
        """Kept and equal pairs and unsound rows per column, out of repeated keys."""
        kept = f"""case when s_known + s_null = 0 then {_wide('t_null')}
            when t_known + t_null = 0 then {_wide('s_null')}
            else {_wide('s_known')} * {_wide('t_known')}
               + {_wide('s_null')} * {_wide('t_null')} end"""
        sound = "if(most_hits > 0 and most_hits = t_known + t_null, s_most, 0)"
        return self._repeated_groups().groupBy("c").agg(
            F.expr(f"sum({kept}) as kept"),
            F.expr("sum(equal) as equal"),
            F.expr(f"sum({_exact(f's_known + s_null - {sound}')}) as unsound"),
        )

    def _require_columns(self) -> None:
        if not self._slots:
            raise ValueError("there is no column to compare besides the keys")

    def column_summary(self, count_qa: int | None = None) -> DataFrame:
        """Per column the total, the equal pairs and what is missing to the total."""
        self._require_columns()
        total = "source_records" if count_qa is None else f"{count_qa}BD"
        cells = [
            f"struct({sql_text(name)} as column, {_exact(total)} as total, "
            f"{_exact(f'equal_{i}')} as equal, "
            f"{_exact(f'{total} - equal_{i}')} as unequal)"
            for i, name in enumerate(self.columns)
        ]
        return (
            self._figures()
            .selectExpr(inline_rows(cells))
            .selectExpr(
                "column",
                f"{_as_count('total')} as total",
                f"{_as_count('equal')} as match_count",
                f"{_as_count('unequal')} as mismatch_count",
                "if(total = 0, null, double(unequal) * 100 / double(total))"
                " as mismatch_pct",
            )
        )

    def pair_figures(self) -> DataFrame:
        """Per column the equal, the unequal and all kept pairs."""
        self._require_columns()
        cells = [
            f"struct({sql_text(name)} as column, "
            f"{_as_count(f'equal_{i}')} as match_count, "
            f"{_as_count(f'kept_{i} - equal_{i}')} as mismatch_count, "
            f"{_as_count(f'kept_{i}')} as total)"
            for i, name in enumerate(self.columns)
        ]
        return self._figures().selectExpr(inline_rows(cells))

    def validation(
        self,
        names: Names = Names(),
        count_qa: int | None = None,
        checks: Sequence[Check] = (DATA,),
    ) -> DataFrame:
        """Result rows: the data check fails when a source row is not found again.

        Its figure adds up, over the columns, the source rows without a partner and
        those that differ from one. With ``count_qa`` it is that number of rows per
        column less the equal pairs, and differing rows fail the check even so.

        The checks on keys can be had from the same figures, as long as
        :attr:`answers_key_checks` holds.
        """

        def summed(figure: str) -> str:
            cells = [_exact(f"{figure}_{i}") for i in range(len(self._slots))]
            if not cells:
                return _exact("0")
            # Summed as an array, since a wide table would make a very deep sum.
            return (
                f"aggregate(array({', '.join(cells)}), {_exact('0')}, "
                f"(sum, x) -> {_exact('sum + x')})"
            )

        unequal = summed("unsound")
        if count_qa is not None:
            unequal = f"{_exact(f'{count_qa}BD')} * {len(self._slots)} - {summed('equal')}"
        figures = self._figures().selectExpr(
            "*",
            f"{_as_count(_exact(unequal))} as unequal",
            f"{summed('unsound')} > 0 as differs",
        )
        return spread(figures, key_rows(checks, self.keys, names))

    @cached_property
    def answers_key_checks(self) -> bool:
        """Whether the keys as given tell rows apart just as they were met here.

        Text keys do when none has blanks around it, which one scan of the key
        columns finds out.
        """
        padded = []
        for key, native in zip(self.keys, self._native_keys):
            pair = [find_field(df, key) for df in self._given]
            if native:
                continue
            if not any(isinstance(f.dataType, T.StringType) for f in pair):
                return False
            padded.append([ref(f.name).cast("string") for f in pair])
        if not padded:
            return True
        sides = [
            df.select(
                balanced(
                    or_,
                    [
                        F.coalesce(pair[i] != F.trim(pair[i]), F.lit(False))
                        for pair in padded
                    ],
                ).alias("padded")
            )
            for i, df in enumerate(self._given)
        ]
        return not sides[0].unionByName(sides[1]).agg(F.max("padded")).first()[0]

    # -- the differing cells ------------------------------------------------

    def differences(self) -> DataFrame:
        """The differing cells: keys, column, both values, pairs and their kind.

        ``kind`` is ``pair`` where the two values stand for ``pairs`` pairs of
        rows, and ``only_in_source`` or ``only_in_target`` where the key has no
        partner. A repeated key can have several values of a column on both
        sides; its value combinations are not listed, but each side's values,
        as ``value_in_source`` and ``value_in_target``, with the number of pairs
        in which each one differs.
        """
        self._require_columns()
        cells = [
            f"struct({i} as c, cast(m_{slot} as string) as source_value, "
            f"cast(n_{slot} as string) as target_value, {self._equal(i)} as equal)"
            for i, slot in enumerate(self._slots)
        ]
        equal = [self._equal(i) for i in range(len(self._slots))]
        found = (
            self._singles()
            .filter(f"not ({' and '.join(equal)})")
            .selectExpr(
                *self._key_slots,
                "case when n is null then 'only_in_source'"
                " when m is null then 'only_in_target' else 'pair' end as kind",
                inline_rows(cells),
            )
            .filter("not equal")
            .selectExpr(*self._key_slots, "bigint(1) as pairs", *_CELL)
        )
        if self._repeated is not None:
            found = found.unionByName(self._repeated_differences())
        names = ", ".join(sql_text(name) for name in self.columns)
        return found.select(
            *[F.col(s).alias(key) for s, key in zip(self._key_slots, self.keys)],
            F.expr(f"get(array({names}), c) as column"),
            "source_value",
            "target_value",
            "pairs",
            "kind",
        )

    def differing_keys(self) -> DataFrame:
        """Distinct keys with a differing cell, without listing the cells."""
        self._require_columns()
        equal = [self._equal(i) for i in range(len(self._slots))]
        found = (
            self._singles().filter(f"not ({' and '.join(equal)})").select(*self._key_slots)
        )
        if self._repeated is not None:
            s, t = _wide("s_known + s_null"), _wide("t_known + t_null")
            found = found.unionByName(
                self._repeated_groups()
                .filter(f"s_known + s_null = 0 or t_known + t_null = 0 or equal < {s} * {t}")
                .select(*self._key_slots)
            )
        return found.distinct().toDF(*self.keys)

    def _repeated_differences(self) -> DataFrame:
        group = [*self._key_slots, "lone", "parts", "c"]
        counted = self._value_counts()
        stats = {
            "m": "sum(s)",
            "n": "sum(t)",
            "s_values": "count_if(s > 0)",
            "t_values": "count_if(t > 0)",
            "s_value": "max(if(s > 0, v, null))",
            "t_value": "max(if(t > 0, v, null))",
        }
        if self._repeated.hot_size:
            # The values of a hot key meet their figures in several tasks.
            figures = counted.groupBy(*group).agg(*[F.expr(f"{what} as {name}") for name, what in stats.items()])
            figures = figures.withColumnsRenamed({name: f"g_{name}" for name in group})
            same_group = " and ".join(f"{name} <=> g_{name}" for name in [*group, "part"])
            met = counted.selectExpr("*", "pmod(xxhash64(v), parts) as part").join(
                figures.selectExpr("*", "explode(sequence(0, g_parts - 1)) as g_part"), F.expr(same_group)
            )
        else:
            within = f"over (partition by {', '.join(group)})"
            met = counted.selectExpr("*", *[f"{what} {within} as {name}" for name, what in stats.items()])

        def cell(kind: str, left: str, right: str, pairs: str) -> str:
            return (
                f"struct('{kind}' as kind, cast({left} as string) as source_value, "
                f"cast({right} as string) as target_value, {_as_count(pairs)} as pairs)"
            )

        s_unequal = f"{_wide('s')} * {_wide('n - s_hits')}"
        t_unequal = f"{_wide('t')} * {_wide('m - t_hits')}"
        from_source = f"""case when s = 0 then null
            when n = 0 then {cell('only_in_source', 'v', 'null', 's')}
            when t_values = 1 then {cell('pair', 'v', 't_value', s_unequal)}
            when s_values > 1 then {cell('value_in_source', 'v', 'null', s_unequal)}
            end"""
        from_target = f"""case when t = 0 then null
            when m = 0 then {cell('only_in_target', 'null', 'v', 't')}
            when t_values = 1 then null
            when s_values = 1 then {cell('pair', 's_value', 'v', t_unequal)}
            else {cell('value_in_target', 'null', 'v', t_unequal)} end"""
        return (
            met.selectExpr(
                *self._key_slots, "c", f"explode(array({from_source}, {from_target})) as x"
            )
            .filter("x.pairs > 0")
            .selectExpr(*self._key_slots, "x.pairs", *[
                name if name == "c" else f"x.{name}" for name in _CELL
            ])
        )


def broadcast_limit(session) -> int:
    """Bytes up to which Spark itself broadcasts; negative where it never does."""
    setting = session.conf.get("spark.sql.autoBroadcastJoinThreshold").strip().lower()
    number = setting.rstrip("bkmgt")
    power = "bkmgt".index(setting[len(number) :][:1] or "b")
    return int(number) * 1024**power


def compare_columns(
    source: DataFrame,
    target: DataFrame,
    keys,
    *,
    count_qa: int | None = None,
    options: CompareOptions = CompareOptions(),
) -> DataFrame:
    """``column, total, match_count, mismatch_count, mismatch_pct`` per column.

    The total is the number of source rows unless ``count_qa`` is given.
    """
    return Comparison(source, target, keys, options).column_summary(count_qa)


def compare_one_column(
    source: DataFrame,
    target: DataFrame,
    keys,
    column: str,
    *,
    options: CompareOptions = CompareOptions(),
) -> DataFrame:
    """``column, match_count, mismatch_count, total`` over the kept pairs."""
    narrowed = replace(options, columns=[column])
    return Comparison(source, target, keys, narrowed).pair_figures()


def data_compare(
    source: DataFrame,
    target: DataFrame,
    keys,
    *,
    options: CompareOptions = CompareOptions(),
) -> DataFrame:
    """The differing cells of both datasets; see :meth:`Comparison.differences`."""
    return Comparison(source, target, keys, options).differences()


def data_validation(
    source: DataFrame,
    target: DataFrame,
    keys,
    *,
    count_qa: int | None = None,
    names: Names = Names(),
    options: CompareOptions = CompareOptions(),
) -> DataFrame:
    """The result row of the column comparison."""
    return Comparison(source, target, keys, options).validation(names, count_qa)


def failing_keys(differences: DataFrame, keys) -> DataFrame:
    """Distinct keys among the differing cells."""
    keys = require_columns(keys, "key column")
    return differences.select(*[column_of(differences, k).alias(k) for k in keys]).distinct()
