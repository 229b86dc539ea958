"""Bounds that every query must keep."""

from __future__ import annotations

from ..errors import OperationInvalid
from ..functions.timestamps import SECOND, parse_instant
from ..layout import Layout
from ..settings import Settings


def bounded(start: object, end: object, settings: Settings) -> tuple[int, int]:
    """A time range in nanoseconds: not empty, and no longer than allowed."""
    lower, upper = parse_instant(start), parse_instant(end)
    if not 0 < upper - lower <= settings.max_time_range_seconds * SECOND:
        raise OperationInvalid(f"the time range must be over 0 and up to {settings.max_time_range_seconds} s long")
    return lower, upper


def mapping_bounds(bounds: dict, layout: Layout, settings: Settings) -> tuple[int, int]:
    """The range of a ``where`` object. Equality is no bound."""
    lower, upper = bounds.get(layout.timestamp, (None, None))
    if lower is None or upper is None:
        raise OperationInvalid(f"{layout.timestamp!r} needs a lower and an upper bound")
    return bounded(lower, upper, settings)


def consistency(value: object) -> None:
    if value not in (None, "eventual"):
        raise OperationInvalid("only eventual consistency is offered")
