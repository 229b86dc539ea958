"""Predicates over a layout's columns, for both front ends.

Values are always bound as literals of the column's own type; names only ever come from the layout. On a
field of many values a comparison is with the whole array. Texts of bytes fields are decoded from
base64 before they are compared with what is stored.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.timestamps import parse_instant
from ..layout import Field, Layout

COMPARISONS: dict[str, Callable[[Column, Column], Column]] = {
    "eq": lambda a, b: a == b,
    "ne": lambda a, b: a != b,
    "lt": lambda a, b: a < b,
    "lte": lambda a, b: a <= b,
    "gt": lambda a, b: a > b,
    "gte": lambda a, b: a >= b,
}


def column(field: Field) -> Column:
    return F.col(f"`{field.name}`")


def _ntz(ticks: int) -> Column:
    """A timestamp without zone, as a literal that Parquet filters can use."""
    return F.lit(datetime(1970, 1, 1) + timedelta(microseconds=ticks // 1000)).cast(T.TimestampNTZType())


def compare_ticks(field: Field, op: str, ticks: int) -> Column:
    """Comparison of an instant with nanoseconds, exact also where the table holds microseconds."""
    here = column(field)
    if field.kind.encoding != "ntz":
        return COMPARISONS[op](here, F.lit(ticks).cast("long"))
    if op in ("eq", "ne") and ticks % 1000:
        return F.when(here.isNotNull(), F.lit(op == "ne"))
    up = op in ("lt", "gte") and ticks % 1000 != 0
    return COMPARISONS[op](here, _ntz(ticks + 1000 if up else ticks))


def compare(field: Field, op: str, value: object) -> Column:
    if op not in COMPARISONS:
        raise ValueError(f"unsupported filter operator {op!r}")
    if value is None:
        raise ValueError("compare with null by isNull")
    if field.kind.name == "utcTimestamp" and not field.many:
        return compare_ticks(field, op, parse_instant(value))
    return COMPARISONS[op](column(field), field.kind.literal(value, many=field.many))


def member(field: Field, values: object, *, negated: bool = False) -> Column:
    """Three-valued membership: with a null among the values, what is not found is null."""
    if not isinstance(values, Sequence) or isinstance(values, (str, bytes)):
        raise TypeError("in and notIn need an array")
    if not values:
        raise ValueError("in and notIn need a value")
    if field.kind.encoding == "ntz":
        found = reduce(lambda a, b: a | b, [F.lit(None).cast("boolean") if v is None else compare(field, "eq", v) for v in values])
    else:
        found = column(field).isin([F.lit(None) if v is None else field.kind.literal(v, many=field.many) for v in values])
    return ~found if negated else found


def null_test(field: Field, wanted: object) -> Column:
    if not isinstance(wanted, bool):
        raise TypeError("isNull needs a boolean")
    return column(field).isNull() if wanted else column(field).isNotNull()


def fields_compared(left: Field, op: str, right: Field) -> Column:
    if op not in COMPARISONS:
        raise ValueError(f"unsupported filter operator {op!r}")
    if left.kind.spark_type() != right.kind.spark_type() or left.many != right.many:
        raise ValueError("only fields of one type can be compared")
    return COMPARISONS[op](column(left), column(right))


def all_of(parts: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, parts) if parts else F.lit(True)


Bounds = dict[str, tuple[str | None, str | None]]


def mapping_filter(where: object, layout: Layout) -> tuple[Column, Bounds]:
    """A ``where`` object: field to value, or to operators and values; all must hold.

    Also returns the (lower, upper) bound given for each field. Fields and operators are taken in
    sorted order, so that equal filters make equal plans.
    """
    if not isinstance(where, Mapping):
        raise TypeError("where must be an object")
    parts, bounds = [], {}
    for name, wanted in sorted(where.items()):
        field = layout.field(name)
        if not isinstance(wanted, Mapping):
            parts.append(compare(field, "eq", wanted))
            continue
        lower = upper = None
        for op, value in sorted(wanted.items()):
            if op in ("in", "notIn"):
                parts.append(member(field, value, negated=op == "notIn"))
            elif op == "isNull":
                parts.append(null_test(field, value))
            else:
                parts.append(compare(field, op, value))
                lower = value if op in ("gt", "gte") else lower
                upper = value if op in ("lt", "lte") else upper
        bounds[name] = (lower, upper)
    return all_of(parts), bounds
