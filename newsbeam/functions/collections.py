"""Map and array scalars of the nested day document (SCL-9..13).

These work inside one row: a bounded part of a symbol's list (see
``operators.nest``).  Whole-day merges run as joins and aggregates in
``operators.merge``; ``merge_record_lists`` is the per-row form for two
record lists of the same (day, symbol, part).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def map_get_or_empty(m, key) -> Column:
    """SCL-10: ``m[key]``, an empty list of the value type when the key is absent."""
    m = _col(m)
    k = key if isinstance(key, Column) else F.lit(key)
    empty = F.slice(F.flatten(F.map_values(m)), 1, 0)  # only evaluated for absent keys
    return F.when(F.map_contains_key(m, k), F.element_at(m, k)).otherwise(empty)


def has_key(m, key) -> Column:
    """SCL-11: the map holds ``key``."""
    return F.map_contains_key(_col(m), key if isinstance(key, Column) else F.lit(key))


def append(arr, value) -> Column:
    """SCL-12: ``arr`` with ``value`` added at the end."""
    return F.array_append(_col(arr), value)


def field_of(arr, field: str) -> Column:
    """SCL-13: one struct field over an array of structs."""
    return F.transform(_col(arr), lambda x: x[field])


def contains_value(arr, value) -> Column:
    """SCL-9: exact membership."""
    return F.array_contains(_col(arr), value)


def merge_record_lists(stored, batch, key: str = "headline") -> Column:
    """Stored records, then each batch record whose ``key`` is neither stored
    nor held by an earlier batch record (the first copy wins)."""
    s, b = _col(stored), _col(batch)
    s = F.coalesce(s, F.filter(b, lambda _: F.lit(False)))
    b = F.coalesce(b, F.filter(s, lambda _: F.lit(False)))
    seen = field_of(s, key)
    indexed = F.transform(b, lambda x, i: F.struct(x.alias("r"), i.alias("i")))
    fresh = F.filter(indexed, lambda e: ~F.array_contains(seen, e["r"][key]) & (
        F.array_position(field_of(b, key), e["r"][key]) == e["i"] + 1))
    return F.concat(s, F.transform(fresh, lambda e: e["r"]))
