"""The mapping-first front end: ``query``, ``get`` and ``aggregate`` objects.

``where`` (field to value or operators), ``select``, ``orderBy``, ``limit``, ``cursor``; or ``metrics`` and ``groupBy``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..cursor import CursorSigner
from ..errors import OperationInvalid
from ..functions.canonical import fingerprint
from ..layout import Layout
from ..operators import aggregates
from ..operators.ordering import page, sorts_of
from ..operators.predicates import mapping_filter
from ..settings import Settings
from .compiled import Compiled, Output, scan
from .guards import mapping_bounds

OPERATIONS = ("query", "get", "aggregate")


def names_of(value: object, what: str, layout: Layout) -> tuple[str, ...]:
    if not isinstance(value, Sequence) or isinstance(value, (str, bytes)):
        raise TypeError(f"{what} must be an array of fields")
    names = tuple(layout.field(n).name for n in value)
    if len(set(names)) < len(names):
        raise ValueError(f"{what} names a field twice")
    return names


def grouped(rows: DataFrame, layout: Layout, keys: Sequence[str], metrics: Sequence[aggregates.Metric], size: int) -> Compiled:
    """Groups, one row more than allowed at most: the caller refuses a result that was cut."""
    clash = set(keys) & {m.name for m in metrics}
    if clash:
        raise ValueError(f"metrics and groups share the names {sorted(clash)}")
    frame, kinds = aggregates.aggregate(rows, layout, keys, metrics, size + 1)
    outputs = [Output(k, layout.field(k).kind, layout.field(k).many) for k in keys]
    outputs += [Output(m.name, kind, m.field is not None and m.function in ("min", "max") and layout.field(m.field).many) for m, kind in zip(metrics, kinds)]
    return Compiled(frame, tuple(outputs), size, aggregate=True)


def compile_mapping(operation: str, request: Mapping[str, object], table: DataFrame, layout: Layout, settings: Settings, *, scope: str | None = None, signer: CursorSigner | None = None, now_ticks: int | None = None) -> Compiled:
    if operation not in OPERATIONS:
        raise OperationInvalid(f"unsupported operation {operation!r}")
    if "metrics" in request:
        operation = "aggregate"
    allowed = {"where", "metrics", "groupBy", "consistency"} if operation == "aggregate" else {"where", "select", "orderBy", "limit", "cursor", "consistency", "includeTotal"}
    if set(request) - allowed:
        raise OperationInvalid(f"unsupported keys {sorted(set(request) - allowed)}")
    predicate, bounds = mapping_filter(request.get("where", {}), layout)
    span = None if operation == "get" else mapping_bounds(bounds, layout, settings)
    rows = scan(table, layout, scope, predicate, span, now_ticks)
    if operation == "aggregate":
        keys = names_of(request.get("groupBy", ()), "groupBy", layout)
        return grouped(rows, layout, keys, aggregates.metrics_of(request.get("metrics")), settings.max_page_size)
    names = names_of(request.get("select") or layout.names, "select", layout)
    size = request.get("limit", 1 if operation == "get" else 50)
    if isinstance(size, bool) or not isinstance(size, int) or not 1 <= size <= settings.max_page_size:
        raise OperationInvalid(f"limit must be a whole number from 1 to {settings.max_page_size}")
    sorts = sorts_of(request.get("orderBy", ()), layout)
    stable = {k: v for k, v in request.items() if k != "cursor"} | {"operation": operation, "resource": layout.resource.canonical}
    binding = {"plan": fingerprint(stable), "schema": layout.schema_fingerprint, "layout": layout.layout_fingerprint, "scope": scope, "size": size}
    place = None
    if request.get("cursor") is not None:
        if signer is None:
            raise OperationInvalid("cursors are not offered here")
        place = signer.verify(request["cursor"], binding)
    counted = rows.agg(F.count(F.lit(1)).alias("total")) if request.get("includeTotal") is True else None
    needed = dict.fromkeys([*names, *(s.field.name for s in sorts)])
    frame = page(rows.select(*[F.col(f"`{n}`") for n in needed]), sorts, size, place)
    outputs = tuple(Output(n, layout.field(n).kind, layout.field(n).many) for n in names)
    return Compiled(frame, outputs, size, sorts=sorts, binding=binding, counted=counted)
