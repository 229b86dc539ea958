"""Initial migrations: a fingerprinted bundle of layouts, and its application."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from .functions.canonical import fingerprint
from .layout import Layout
from .sources.store import Store


@dataclass(frozen=True)
class Migration:
    layouts: tuple[Layout, ...]

    @property
    def steps(self) -> list[dict]:
        made = [{"step": "create", "resource": x.resource.canonical, "schema": x.spark_schema().jsonValue()} for x in self.layouts]
        return made + [{"step": "register", "resource": x.resource.canonical, "layoutFingerprint": x.layout_fingerprint} for x in self.layouts]

    @property
    def fingerprint(self) -> str:
        return fingerprint(self.steps)


def plan_migration(layouts: Sequence[Layout]) -> Migration:
    """Layouts in the order of their resources, each resource once."""
    ordered = tuple(sorted(layouts, key=lambda x: x.resource))
    if not ordered:
        raise ValueError("a migration needs a layout")
    if len({x.resource for x in ordered}) < len(ordered):
        raise ValueError("a resource has two layouts")
    return Migration(ordered)


def apply_migration(migration: Migration, store: Store, *, expected: str | None = None) -> list[str]:
    """Make all tables' folders and register the layouts; applying again changes nothing, and another layout for a resource is refused."""
    if expected is not None and expected != migration.fingerprint:
        raise ValueError("the migration is not the expected one")
    from .health import verify_layout

    for layout in migration.layouts:
        verify_layout(store, layout, registered=False)  # stored data must fit before the registry says so
    for layout in migration.layouts:
        store.create(layout)
    for layout in migration.layouts:
        store.register(layout)
    return [x.resource.canonical for x in migration.layouts]
