"""Filter terms, key comparisons and key orderings as plain Column expressions.

Comparisons over several segments are written out as OR of AND: that form reaches the
Parquet reader as a pushed filter, a comparison of structs does not.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import Column, functions as F

from keyloom.layout import KeySpec, as_key

Order = list[tuple[str, bool]]


@dataclass(frozen=True)
class Term:
    """One filter term; ``connector`` joins it to the term that follows."""

    column: str
    op: str
    value: Any
    connector: str = "and"


def any_of(parts: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, parts) if parts else F.lit(False)


def all_of(parts: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, parts) if parts else F.lit(True)


def _compare(term: Term) -> Column:
    left, right = F.col(term.column), F.lit(term.value)
    ops = {
        "=": lambda: left == right,
        ">": lambda: left > right,
        "<": lambda: left < right,
        "<>": lambda: left != right,
        ">=": lambda: left >= right,
        "<=": lambda: left <= right,
        "startswith": lambda: left.startswith(term.value),
    }
    if term.op not in ops:
        raise ValueError(f"unknown comparison {term.op!r}")
    return ops[term.op]()


def where_terms(terms: Sequence[Term | tuple]) -> Column:
    """AND binds tighter than OR; the last connector is ignored; no terms means all rows."""
    groups: list[list[Column]] = [[]]
    terms = [t if isinstance(t, Term) else Term(*t) for t in terms]
    for i, term in enumerate(terms):
        groups[-1].append(_compare(term))
        if term.connector.lower() == "or" and i + 1 < len(terms):
            groups.append([])
    return any_of([all_of(g) for g in groups])


def key_order(key: KeySpec | str | Sequence[str], recnum: str | None = None, by: Sequence[str] = ()) -> Order:
    """Group columns, key segments, then the record number as the tie-break."""
    order = [(c, False) for c in by] + as_key(key).order
    if recnum is not None and recnum not in [c for c, _ in order]:
        order.append((recnum, False))
    return order


def flipped(order: Order) -> Order:
    return [(c, not d) for c, d in order]


def sort_columns(order: Order, backward: bool = False) -> list[Column]:
    """Ascending puts nulls first, descending puts them last, so backward is the exact reverse."""
    if backward:
        order = flipped(order)
    return [F.col(c).desc_nulls_last() if d else F.col(c).asc_nulls_first() for c, d in order]


# -- column against column -------------------------------------------------------------


def later(left: Sequence[Column], right: Sequence[Column], descending: Sequence[bool]) -> Column:
    """True when ``left`` comes strictly after ``right`` in key order (null-safe)."""
    parts = []
    for i, desc in enumerate(descending):
        l, r = left[i], right[i]
        if desc:
            strict = F.coalesce(l < r, l.isNull() & r.isNotNull())
        else:
            strict = F.coalesce(l > r, r.isNull() & l.isNotNull())
        parts.append(all_of([left[j].eqNullSafe(right[j]) for j in range(i)] + [strict]))
    return any_of(parts)


# -- column against value --------------------------------------------------------------


def _later_than_value(column: str, desc: bool, value: Any) -> Column:
    c = F.col(column)
    if value is None:
        return F.lit(False) if desc else c.isNotNull()
    v = F.lit(value)
    return (c < v) | c.isNull() if desc else c > v


def _equals_value(column: str, value: Any) -> Column:
    return F.col(column).isNull() if value is None else F.col(column) == F.lit(value)


def _strictly_after(order: Order, values: Sequence[Any]) -> Column:
    parts = []
    for i, (c, d) in enumerate(order):
        prefix = [_equals_value(order[j][0], values[j]) for j in range(i)]
        parts.append(all_of(prefix + [_later_than_value(c, d, values[i])]))
    return any_of(parts)


def _leading_bound(order: Order, values: Sequence[Any]) -> Column:
    """Implied by the comparison; lets a file sorted on the first segment skip row groups."""
    (name, desc), value = order[0], values[0]
    c = F.col(name)
    if value is None:
        return c.isNull() if desc else F.lit(True)
    return (c <= F.lit(value)) | c.isNull() if desc else c >= F.lit(value)


def key_predicate(key: KeySpec | str | Sequence[str], op: str, values: Sequence[Any]) -> Column:
    """Records whose key is equal to, later or earlier than ``values`` in key order.

    A ``None`` value puts no constraint on its segment.  "Greater" means later in key
    order, so on a descending segment it selects smaller column values.
    """
    kept = [(s, v) for s, v in zip(as_key(key).order, values) if v is not None]
    if not kept:
        return F.lit(True)
    order, vals = [s for s, _ in kept], [v for _, v in kept]
    same = all_of([_equals_value(c, v) for (c, _), v in zip(order, vals)])
    if op == "=":
        return same
    if op not in (">", ">=", "<", "<="):
        raise ValueError(f"unknown key comparison {op!r}")
    if op.startswith("<"):
        order = flipped(order)
    strict = _strictly_after(order, vals)
    if len(order) == 1:
        return strict if len(op) == 1 else _leading_bound(order, vals)
    return _leading_bound(order, vals) & (strict if len(op) == 1 else strict | same)


@dataclass(frozen=True)
class Cursor:
    """A place in key order: the key values and record number of one record."""

    keys: tuple
    recnum: Any


def after_cursor(
    key: KeySpec | str | Sequence[str], cursor: Cursor, recnum: str = "recnum", backward: bool = False
) -> Column:
    """Records strictly after (or before) a cursor in (key, recnum) order."""
    order = key_order(key, recnum)
    values = list(cursor.keys) + ([cursor.recnum] if len(order) > len(cursor.keys) else [])
    if backward:
        order = flipped(order)
    strict = _strictly_after(order, values)
    return strict if len(order) == 1 else _leading_bound(order, values) & strict
