"""The plan front end: a small syntax tree of expressions, projections, groups and pages.

A plan is an object with ``operation`` (query, get, aggregate), ``resource``, and ``filter``, ``projection``,
``orderBy``, ``groupBy``, ``aggregates``, ``page`` {size, cursor}, ``includeTotal``, ``consistency``, ``schemaFingerprint``,
``budget`` {rows, bytes}, ``empty``. Expressions are objects with one key: ``and``, ``or``, ``not``, ``isNull``,
``isNotNull``, ``in``, ``notIn``, ``timestampRange``, or a comparison ``eq`` ... ``gte`` of a field with a
field or a literal. Joins, traversals, computed projections and scalar functions are refused.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..cursor import CursorSigner
from ..errors import CapabilityUnsupported, OperationInvalid
from ..functions.canonical import fingerprint
from ..functions.timestamps import parse_instant
from ..layout import Field, Layout, Resource
from ..operators import aggregates
from ..operators.ordering import page, sorts_of
from ..operators.predicates import COMPARISONS, all_of, compare, compare_ticks, fields_compared, member, null_test
from ..settings import Settings
from .compiled import Compiled, Output, scan
from .guards import bounded, consistency
from .mapping import grouped

KEYS = {"operation", "resource", "filter", "projection", "orderBy", "groupBy", "aggregates", "page", "includeTotal", "consistency", "schemaFingerprint", "budget", "empty"}
REFUSED = {"joins", "traversal", "targets", "having", "offset", "distinct"}


def _field(value: object, layout: Layout) -> Field:
    if not isinstance(value, Mapping) or not set(value) <= {"field", "resource"} or "field" not in value:
        raise OperationInvalid("an operand must be a field")
    if "resource" in value and Resource.parse(value["resource"]) != layout.resource:
        raise OperationInvalid("a field names another resource")
    return layout.field(value["field"])


def _one(node: object) -> tuple[str, object]:
    if not isinstance(node, Mapping) or len(node) != 1:
        raise OperationInvalid("an expression is an object with one key")
    return next(iter(node.items()))


def _range(body: object, layout: Layout) -> Column:
    if not isinstance(body, Mapping) or not set(body) <= {"field", "start", "end", "startInclusive", "endInclusive"}:
        raise OperationInvalid("a timestampRange has field, start, end, startInclusive and endInclusive")
    field = layout.field(body.get("field"))
    if field.kind.name != "utcTimestamp":
        raise OperationInvalid("a timestampRange needs an instant")
    parts = []
    if body.get("start") is not None:
        parts.append(compare_ticks(field, "gte" if body.get("startInclusive", True) else "gt", parse_instant(body["start"])))
    if body.get("end") is not None:
        parts.append(compare_ticks(field, "lte" if body.get("endInclusive", False) else "lt", parse_instant(body["end"])))
    if not parts:
        raise OperationInvalid("a timestampRange needs a start or an end")
    return all_of(parts)


def expression(node: object, layout: Layout) -> Column:
    kind, body = _one(node)
    if kind in ("and", "or"):
        if not isinstance(body, Sequence) or isinstance(body, (str, bytes)) or not body:
            raise OperationInvalid(f"{kind} needs an array of expressions")
        parts = [expression(x, layout) for x in body]
        return reduce((lambda a, b: a & b) if kind == "and" else (lambda a, b: a | b), parts)
    if kind == "not":
        return ~expression(body, layout)
    if kind in ("isNull", "isNotNull"):
        return null_test(_field(body, layout), kind == "isNull")
    if kind in ("in", "notIn"):
        if not isinstance(body, Mapping) or set(body) != {"field", "values"}:
            raise OperationInvalid(f"{kind} has a field and values")
        return member(layout.field(body["field"]), body["values"], negated=kind == "notIn")
    if kind == "timestampRange":
        return _range(body, layout)
    if kind in COMPARISONS:
        if not isinstance(body, Sequence) or isinstance(body, (str, bytes)) or len(body) != 2:
            raise OperationInvalid(f"{kind} has two operands")
        left = _field(body[0], layout)
        if isinstance(body[1], Mapping) and set(body[1]) == {"literal"}:
            return compare(left, kind, body[1]["literal"])
        return fields_compared(left, kind, _field(body[1], layout))
    raise OperationInvalid(f"unsupported expression {kind!r}")


def ranges(node: object, layout: Layout) -> list[Mapping[str, object]]:
    """Full ranges of the timestamp that must hold: the whole filter's, or those of its outermost ``and``.

    A range under ``or`` or ``not`` does not bound the rows and does not count.
    """
    kind, body = _one(node)
    if kind == "and":
        return [r for x in body for r in ranges(x, layout)]
    if kind == "timestampRange" and body.get("field") == layout.timestamp and body.get("start") is not None and body.get("end") is not None:
        return [body]
    return []


def compile_wire(plan: Mapping[str, object], table: DataFrame, layout: Layout, settings: Settings, *, scope: str | None = None, signer: CursorSigner | None = None, now_ticks: int | None = None) -> Compiled:
    if not isinstance(plan, Mapping):
        raise TypeError("a plan is an object")
    if REFUSED & set(plan):
        raise CapabilityUnsupported(f"not offered: {sorted(REFUSED & set(plan))}")
    if set(plan) - KEYS:
        raise OperationInvalid(f"unsupported keys {sorted(set(plan) - KEYS)}")
    operation = plan.get("operation")
    if operation not in ("query", "get", "aggregate"):
        raise OperationInvalid(f"unsupported operation {operation!r}")
    consistency(plan.get("consistency"))
    if Resource.parse(plan.get("resource")) != layout.resource:
        raise OperationInvalid("the plan is for another resource")
    if plan.get("schemaFingerprint") is not None and plan["schemaFingerprint"] != layout.schema_fingerprint:
        raise OperationInvalid("the plan was made for another schema")
    budget = plan.get("budget", {})
    if not isinstance(budget, Mapping) or not set(budget) <= {"rows", "bytes"} or any(isinstance(v, bool) or not isinstance(v, int) or v < 1 for v in budget.values()):
        raise OperationInvalid("a budget has rows and bytes")
    own_page = plan.get("page", {})
    if not isinstance(own_page, Mapping) or not set(own_page) <= {"size", "cursor"}:
        raise OperationInvalid("a page has size and cursor")
    size = own_page.get("size", 50)
    if isinstance(size, bool) or not isinstance(size, int) or not 1 <= size <= settings.max_page_size:
        raise OperationInvalid(f"a page's size is a whole number from 1 to {settings.max_page_size}")
    node = plan.get("filter")
    predicate = F.lit(True) if node is None else expression(node, layout)
    if operation == "get":
        span = None
    else:
        found = [] if node is None else ranges(node, layout)
        if len(found) != 1:
            raise OperationInvalid("exactly one full timestampRange must bound the timestamp")
        span = bounded(found[0]["start"], found[0]["end"], settings)
    empty = plan.get("empty") is True
    rows = scan(table, layout, scope, F.lit(False) if empty else predicate, span, now_ticks)
    if operation == "aggregate":
        keys = []
        for k in plan.get("groupBy", ()):
            keys.append(_field(k, layout).name if isinstance(k, Mapping) else layout.field(k).name)
        metrics = aggregates.metrics_of([dict(m, function="quantile", quantile=m.get("quantile", 0.5)) if isinstance(m, Mapping) and m.get("function") == "percentile" else m for m in plan.get("aggregates", ())])
        made = grouped(rows, layout, keys, metrics, size)
        made.empty, made.budget = empty, dict(budget)
        return made
    sorts = sorts_of(plan.get("orderBy", ()), layout)
    outputs, columns = [], {}
    for item in plan.get("projection") or [{"field": n} for n in layout.names]:
        if not isinstance(item, Mapping) or not set(item) <= {"field", "alias", "resource"}:
            raise OperationInvalid("only fields can be projected, under an alias if need be")
        field = _field({k: v for k, v in item.items() if k != "alias"}, layout)
        name = item.get("alias") or field.name
        if not isinstance(name, str) or name in columns:
            raise OperationInvalid("two projections have the same name")
        columns[name] = field.name
        outputs.append(Output(name, field.kind, field.many))
    stable = {k: v for k, v in plan.items() if k != "page"} | {"size": size}
    binding = {"plan": fingerprint(stable), "schema": layout.schema_fingerprint, "layout": layout.layout_fingerprint, "scope": scope, "size": size}
    place = None
    if own_page.get("cursor") is not None:
        if signer is None:
            raise OperationInvalid("cursors are not offered here")
        place = signer.verify(own_page["cursor"], binding)
    counted = rows.agg(F.count(F.lit(1)).alias("total")) if plan.get("includeTotal") is True else None
    needed = dict.fromkeys([*columns.values(), *(s.field.name for s in sorts)])
    frame = page(rows.select(*[F.col(f"`{n}`") for n in needed]), sorts, size, place)
    return Compiled(frame, tuple(outputs), size, sorts=sorts, binding=binding, counted=counted, columns=columns, empty=empty, budget=dict(budget))
