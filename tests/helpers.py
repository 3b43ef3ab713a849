"""Comparing frames with plain Python, for tests only."""

from collections import Counter, defaultdict
from decimal import Decimal


def rows(df, *columns):
    picked = df.select(*columns) if columns else df
    return sorted((tuple(row) for row in picked.collect()), key=repr)


def results(df):
    """Result rows as ``(check number, column): (source, target, failed, status)``."""
    return {
        (row["tc_id"], row["column"]): (
            row["source_records"],
            row["target_records"],
            row["failed_records"],
            row["status"],
        )
        for row in df.collect()
    }


def trimmed(value):
    return None if value is None else str(value).strip(" ")


def every_pair(source, target, key_count=1):
    """All pairs of rows that a full outer join on the leading columns gives."""
    def key_of(row):
        return tuple(trimmed(v) for v in row[:key_count])

    by_key = defaultdict(list)
    for row in target:
        by_key[key_of(row)].append(row)
    met, pairs = set(), []
    for row in source:
        key = key_of(row)
        partners = [] if None in key else by_key.get(key, [])
        met.add(key)
        pairs += [(row, partner) for partner in partners] or [(row, None)]
    for key, partners in by_key.items():
        if None in key or key not in met:
            pairs += [(None, partner) for partner in partners]
    return pairs


def equal(left, right, tolerance=None):
    if left is None or right is None:
        return False
    if tolerance is None:
        return trimmed(left) == trimmed(right)
    return abs(Decimal(str(left)) - Decimal(str(right))) <= Decimal(str(tolerance))


def figures(source, target, position, key_count=1, tolerance=None):
    """``(match, mismatch, kept)`` of one column over all pairs."""
    match = kept = 0
    for left, right in every_pair(source, target, key_count):
        a = None if left is None else left[position]
        b = None if right is None else right[position]
        if (a is None) == (b is None):
            kept += 1
            match += equal(a, b, tolerance)
    return match, kept - match, kept


def unequal_pairs(source, target, position, key_count=1, tolerance=None):
    """Number of unequal pairs per key, and per key and source or target value."""
    by_key, by_source, by_target = Counter(), Counter(), Counter()
    for left, right in every_pair(source, target, key_count):
        a = None if left is None else left[position]
        b = None if right is None else right[position]
        if not equal(a, b, tolerance):
            key = tuple(trimmed(v) for v in (left or right)[:key_count])
            by_key[key] += 1
            if left is not None:
                by_source[key, trimmed(a)] += 1
            if right is not None:
                by_target[key, trimmed(b)] += 1
    return by_key, by_source, by_target
