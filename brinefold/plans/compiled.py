"""What both front ends compile to, and the scan below them."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.timestamps import period_text
from ..layout import PERIOD, SCOPE, Layout
from ..operators.dedup import collapse
from ..operators.ordering import Sort
from ..types import Kind


@dataclass(frozen=True)
class Output:
    """A result column and how it is spelled."""

    name: str
    kind: Kind | None
    many: bool = False


@dataclass
class Compiled:
    """A plan. ``frame`` may hold columns beyond ``outputs`` that order it, and one row beyond the page that
    tells whether there is more; ``visible`` has the page's rows and the outputs alone."""

    frame: DataFrame
    outputs: tuple[Output, ...]
    page_size: int
    aggregate: bool = False
    sorts: Sequence[Sort] = ()
    binding: dict = field(default_factory=dict)
    counted: DataFrame | None = None
    columns: dict[str, str] = field(default_factory=dict)
    empty: bool = False
    budget: dict = field(default_factory=dict)

    @property
    def visible(self) -> DataFrame:
        if self.aggregate:
            return self.frame.select(*[F.col(f"`{o.name}`") for o in self.outputs])
        return self.frame.limit(self.page_size).select(*[F.col(f"`{self.columns.get(o.name, o.name)}`").alias(o.name) for o in self.outputs])


def scan(table: DataFrame | Callable[[tuple[int, int] | None], DataFrame], layout: Layout, scope: str | None, predicate: Column, span: tuple[int, int] | None, now_ticks: int | None = None) -> DataFrame:
    """Scope first, then the time range on the partition column, then deduplication, then the predicate.

    The range on the instant alone would not prune partitions that are derived from it. A function as ``table`` is
    told the range, so that it need not even list files of other periods. Rows past their retention are gone whether
    or not their files are.
    """
    rows = table(span) if callable(table) else table
    if layout.stored:
        rows = rows.where(F.col(SCOPE) == F.lit(scope))
        if span is not None:
            rows = rows.where(F.col(PERIOD).between(period_text(span[0], layout.partition), period_text(span[1], layout.partition)))
        if layout.dedup:
            rows = collapse(rows, layout)
    rows = rows.where(predicate)
    if layout.retention_seconds is not None and now_ticks is not None:
        second = 1_000_000_000
        edge = (now_ticks // second - layout.retention_seconds + 1) * second  # whole seconds, as retention counts them
        from ..operators.predicates import compare_ticks

        rows = rows.where(compare_ticks(layout.field(layout.timestamp), "gte", edge))
    return rows
