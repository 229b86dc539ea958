"""Limits and secrets of an engine."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, fields


@dataclass(frozen=True)
class Settings:
    root: str
    binding_id: str = "main"
    cursor_secret: str | None = None  # none: cursors hold within one session only
    max_batch_rows: int = 10_000
    max_batch_bytes: int = 16 << 20
    max_time_range_seconds: int = 31 * 86_400
    retry_window_seconds: int = 86_400
    cursor_ttl_seconds: int = 900
    operation_timeout_ms: int = 30_000
    max_result_bytes: int = 4 << 20
    max_page_size: int = 500

    #: Least and greatest values (fixed).
    BOUNDS = {
        "max_batch_rows": (1, 1_000_000),
        "max_batch_bytes": (1, 1 << 30),
        "max_time_range_seconds": (1, 366 * 86_400),
        "retry_window_seconds": (1, 7 * 86_400),
        "cursor_ttl_seconds": (1, 86_400),
        "operation_timeout_ms": (1, 3_600_000),
        "max_result_bytes": (1, 1 << 30),
        "max_page_size": (1, 500),
    }

    def __post_init__(self):
        for name, (least, most) in self.BOUNDS.items():
            value = getattr(self, name)
            if isinstance(value, bool) or not isinstance(value, int) or not least <= value <= most:
                raise ValueError(f"{name} must be a whole number from {least} to {most}")
        for name in ("root", "binding_id", *(["cursor_secret"] if self.cursor_secret is not None else [])):
            if not isinstance(getattr(self, name), str) or not getattr(self, name):
                raise ValueError(f"{name} must be text")

    @classmethod
    def parse(cls, value: Mapping[str, object]) -> Settings:
        """Settings from a closed set of keys."""
        unknown = set(value) - {f.name for f in fields(cls)}
        if unknown:
            raise ValueError(f"unknown settings: {sorted(unknown)}")
        return cls(**value)
