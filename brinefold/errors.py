"""Errors of the engine, each with a stable code and whether a retry may help."""

from __future__ import annotations


class EngineError(Exception):
    code = "ENGINE_ERROR"
    transient = False


class OperationInvalid(EngineError, ValueError):
    """The request is malformed or not allowed."""

    code = "OPERATION_INVALID"


class CapabilityUnsupported(EngineError):
    """The request is well formed but not offered."""

    code = "CAPABILITY_UNSUPPORTED"


class ScopeMismatch(EngineError):
    """The request names another binding, resource or scope."""

    code = "OPERATION_SCOPE"


class CursorInvalid(OperationInvalid):
    """A cursor is forged, expired or belongs to another query."""

    code = "CURSOR_INVALID"


class LimitExceeded(EngineError):
    """A result or a batch is larger than its limit."""

    code = "LIMIT_EXCEEDED"


class DeadlineExceeded(EngineError):
    code = "DEADLINE_EXCEEDED"
    transient = True


class LayoutDrift(EngineError):
    """Stored data or the registry differ from the layout."""

    code = "LAYOUT_DRIFT"


class AdapterFailure(EngineError):
    """Anything unexpected below the engine."""

    code = "ADAPTER_FAILURE"
    transient = True
