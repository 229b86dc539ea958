"""Total orders, top-k and keyset pages."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame

from ..layout import ROW, Field, Layout
from ..types import Kind
from .predicates import column, compare


@dataclass(frozen=True)
class Sort:
    field: Field
    descending: bool

    def column(self) -> Column:
        here = column(self.field)
        return here.desc() if self.descending else here.asc()


def default_sorts(layout: Layout) -> list[Sort]:
    """Newest first, then identity, then the row's fingerprint."""
    found = [Sort(layout.field(layout.timestamp), True)]
    found += [Sort(layout.field(n), False) for n in layout.identity if n != layout.timestamp]
    if layout.stored:
        found.append(Sort(Field(ROW, Kind("string")), False))
    return found


def sorts_of(value: object, layout: Layout) -> list[Sort]:
    """Sorts from ``[{"field", "direction"}]``, made total by the default ones."""
    if not isinstance(value, Sequence) or isinstance(value, (str, bytes)):
        raise TypeError("orderBy must be an array")
    own = []
    for item in value:
        if not isinstance(item, Mapping) or set(item) != {"field", "direction"} or item["direction"] not in ("asc", "desc"):
            raise ValueError("an orderBy entry has a field and a direction, asc or desc")
        field = layout.field(item["field"])
        if field.nullable or field.many:
            raise ValueError("only fields that are never null can order")
        if field.name in {s.field.name for s in own}:
            raise ValueError("a field orders only once")
        own.append(Sort(field, item["direction"] == "desc"))
    named = {s.field.name for s in own}
    return own + [s for s in default_sorts(layout) if s.field.name not in named]


def after(sorts: Sequence[Sort], values: Sequence[object]) -> Column:
    """Rows that come after a place in the order: equal in the first keys, then beyond it in the next."""
    if len(values) != len(sorts):
        raise ValueError("a place has a value for each sort")
    branches = []
    for n, sort in enumerate(sorts):
        same = [compare(s.field, "eq", v) for s, v in zip(sorts[:n], values)]
        branches.append(reduce(lambda a, b: a & b, [*same, compare(sort.field, "lt" if sort.descending else "gt", values[n])]))
    return reduce(lambda a, b: a | b, branches)


def page(df: DataFrame, sorts: Sequence[Sort], size: int, place: Sequence[object] | None = None) -> DataFrame:
    """The first ``size + 1`` rows after a place: one more than a page, to see whether there are more."""
    return (df if place is None else df.where(after(sorts, place))).orderBy(*[s.column() for s in sorts]).limit(size + 1)


def place_of(row: Mapping[str, object], sorts: Sequence[Sort]) -> list[object]:
    return [s.field.kind.to_result(row[s.field.name]) for s in sorts]


