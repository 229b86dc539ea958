"""A bounded query engine for logs, spans, metric points, usage and other time series, on Spark."""

from .errors import AdapterFailure, CapabilityUnsupported, CursorInvalid, DeadlineExceeded, EngineError, LayoutDrift, LimitExceeded, OperationInvalid, ScopeMismatch
from .layout import Field, Layout, Resource, Schema, compile_schema
from .migrations import Migration, apply_migration, plan_migration
from .session import Context, Request, Result, Session
from .settings import Settings
from .sources.store import Receipt, Store
from .types import Kind

__all__ = [
    "AdapterFailure", "CapabilityUnsupported", "Context", "CursorInvalid", "DeadlineExceeded", "EngineError", "Field", "Kind", "Layout", "LayoutDrift", "LimitExceeded",
    "Migration", "OperationInvalid", "Receipt", "Request", "Resource", "Result", "Schema", "ScopeMismatch", "Session", "Settings", "Store", "apply_migration", "compile_schema", "plan_migration",
]
