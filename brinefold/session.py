"""Sessions: requests in, results out.

Operations are ``evidence.append``, ``evidence.query``, ``structured.put``, ``structured.get``, ``structured.query`` and
``structured.aggregate``. Input that holds a ``queryPlan`` goes to the plan front end, other input to the
mapping-first one.
"""

from __future__ import annotations

import secrets
import threading
import time
import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from functools import partial

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession

from .cursor import CursorSigner
from .errors import AdapterFailure, CapabilityUnsupported, DeadlineExceeded, EngineError, LimitExceeded, OperationInvalid, ScopeMismatch
from .functions.canonical import canonical_json, fingerprint, scope_digest
from .health import OPERATIONS, VERSION, manifest, probe, verify_layout
from .layout import Layout, Resource
from .operators.ordering import place_of
from .plans.compiled import Compiled
from .plans.guards import consistency
from .plans.mapping import compile_mapping
from .plans.wire import compile_wire
from .settings import Settings
from .sources.store import Store, records_of

#: Seconds between attempts to cancel the jobs of a request that is late.
CANCEL_EVERY = 0.2


@dataclass(frozen=True)
class Context:
    tenant: str | None = None
    scope: Mapping[str, str] = field(default_factory=dict)
    idempotency_key: str | None = None
    deadline: float | None = None  # seconds since 1970

    @property
    def digest(self) -> str:
        return scope_digest(self.tenant, self.scope)


@dataclass(frozen=True)
class Request:
    operation: str
    resources: tuple[Resource, ...]
    input: Mapping[str, object]
    context: Context = Context()
    binding_id: str = "main"
    version: str = VERSION
    request_id: str = field(default_factory=lambda: uuid.uuid4().hex)

    @classmethod
    def of(cls, operation: str, resource: Resource | str, value: Mapping[str, object], **more: object) -> Request:
        return cls(operation, (Resource.parse(resource),), value, **more)


@dataclass(frozen=True)
class Result:
    data: object
    cursor: str | None = None
    total: int | None = None
    provenance: Mapping[str, object] = field(default_factory=dict)


class Session:
    def __init__(self, spark: SparkSession, layouts: Sequence[Layout], settings: Settings, *, tables: Mapping[Resource, DataFrame] | None = None, clock_ns=time.time_ns):
        """``tables``: frames of foreign resources, whose layouts have ``stored=False`` and which can't be written."""
        self.spark, self.settings = spark, settings
        self.layouts = {x.resource: x for x in layouts}
        self.store = Store(spark, settings, clock_ns)
        self._tables = dict(tables or {})
        self._signer = CursorSigner(settings.cursor_secret or secrets.token_hex(32), settings.cursor_ttl_seconds, lambda: clock_ns() / 1e9)
        self._open = True

    def manifest(self) -> dict:
        return manifest(list(self.layouts.values()), self.settings)

    def probe(self) -> dict:
        return probe(self.spark)

    def verify(self) -> None:
        for layout in self.layouts.values():
            if layout.stored:
                verify_layout(self.store, layout)

    def close(self) -> None:
        self._open = False

    def begin(self) -> None:
        raise CapabilityUnsupported("transactions are not offered")

    commit = rollback = begin

    def execute(self, request: Request) -> Result:
        """Run a request. What is wrong with it raises ``OperationInvalid``; what goes wrong below, ``AdapterFailure``."""
        if not self._open:
            raise OperationInvalid("the session is closed")
        try:
            return self._execute(request)
        except EngineError:
            raise
        except PySparkException as e:
            raise AdapterFailure(str(e)) from e
        except (TypeError, ValueError) as e:
            raise OperationInvalid(str(e)) from e
        except Exception as e:
            raise AdapterFailure(str(e)) from e

    def _execute(self, request: Request) -> Result:
        if request.binding_id != self.settings.binding_id:
            raise ScopeMismatch("the request is for another binding")
        if len(request.resources) != 1:
            raise OperationInvalid("an operation has exactly one resource")
        layout = self.layouts.get(request.resources[0])
        if layout is None:
            raise ScopeMismatch(f"unknown resource {request.resources[0].canonical}")
        if request.operation not in OPERATIONS or request.version != VERSION:
            raise CapabilityUnsupported(f"{request.operation} {request.version} is not offered")
        catalog, method = request.operation.split(".")
        if catalog != layout.resource.catalog:
            raise OperationInvalid(f"{request.operation} is not for {layout.resource.catalog} resources")
        until = time.monotonic() + self._seconds(request)
        if method in ("append", "put"):
            return self._write(request, layout, method, until)
        return self._read(self.compile(request), layout, until)

    def compile(self, request: Request) -> Compiled:
        """The plan of a read, not yet run."""
        layout = self.layouts[request.resources[0]]
        scope = request.context.digest if layout.stored else None
        table = partial(self.store.table, layout, scope) if layout.stored else self._tables[layout.resource]
        options = {"scope": scope, "signer": self._signer, "now_ticks": self.store.now()}
        consistency(request.input.get("consistency"))
        plan = request.input.get("queryPlan")
        if plan is not None:
            return compile_wire(plan, table, layout, self.settings, **options)
        return compile_mapping(request.operation.split(".")[1], request.input, table, layout, self.settings, **options)

    def _seconds(self, request: Request) -> float:
        left = self.settings.operation_timeout_ms / 1000
        if request.context.deadline is not None:
            left = min(left, request.context.deadline - self.store.now() / 1e9)
        if left <= 0:
            raise DeadlineExceeded("the deadline has passed")
        return left

    def batch_id(self, request: Request, layout: Layout) -> str:
        """Equal for retries: of the request's content, scope and idempotency key (or else its id)."""
        stable = {"binding": request.binding_id, "operation": request.operation, "input": fingerprint(request.input), "resource": layout.resource.canonical, "schema": layout.schema_fingerprint, "scope": request.context.digest, "key": request.context.idempotency_key or request.request_id}
        return "b1_" + fingerprint(stable).removeprefix("sha256:")

    def _write(self, request: Request, layout: Layout, method: str, until: float) -> Result:
        if not layout.stored:
            raise CapabilityUnsupported("a foreign table can't be written")
        if method == "append" and request.input.get("requireAtomic"):
            raise CapabilityUnsupported("atomic evidence is not offered")
        if method == "put" and request.input.get("expectedVersion") is not None:
            raise CapabilityUnsupported("compare-and-set is not offered")
        allowed = {"records", "data", "requireAtomic"} if method == "append" else {"data", "expectedVersion"}
        if set(request.input) - allowed or ("records" in request.input and "data" in request.input):
            raise OperationInvalid(f"{request.operation} takes {sorted(allowed)}")
        records = records_of(request.input.get("records", request.input.get("data")))
        own = {"scope": request.context.digest, "tenant": request.context.tenant, "batch": self.batch_id(request, layout)}
        receipt = self._timed(lambda: self.store.append(layout, records, **own), until)  # a retry finishes what was cut off
        return Result(receipt.to_dict(), provenance={"deduplication": "retry-window", "layoutFingerprint": layout.layout_fingerprint, "visibility": "eventual"})

    def _timed(self, work: Callable[[], object], until: float) -> object:
        """What ``work`` returns, or ``DeadlineExceeded``: jobs still running then are cancelled."""
        seconds = until - time.monotonic()
        if seconds <= 0:
            raise DeadlineExceeded("the deadline has passed")
        tag, done, late = f"brinefold-{uuid.uuid4().hex}", threading.Event(), threading.Event()

        def watch() -> None:
            if not done.wait(seconds):
                late.set()
            while not done.wait(CANCEL_EVERY):  # the work may be between two jobs, or start others
                self.spark.sparkContext.cancelJobsWithTag(tag)

        watcher = threading.Thread(target=watch, daemon=True)
        self.spark.sparkContext.addJobTag(tag)
        watcher.start()
        try:
            made = work()
            if late.is_set():  # done, but not in time; a write that is sent again finds itself done
                raise DeadlineExceeded(f"the operation took over {seconds:.1f} s")
            return made
        except Exception as e:
            if late.is_set() and not isinstance(e, DeadlineExceeded):
                raise DeadlineExceeded(f"the operation took over {seconds:.1f} s") from e
            raise
        finally:
            done.set()
            watcher.join()
            self.spark.sparkContext.removeJobTag(tag)

    def _read(self, plan: Compiled, layout: Layout, until: float) -> Result:
        rows = [] if plan.empty else self._timed(plan.frame.collect, until)  # page_size + 1 rows at most
        if plan.aggregate and len(rows) > plan.page_size:
            raise LimitExceeded(f"more than {plan.page_size} groups, which have no order to be cut in")
        shown = [r.asDict() for r in rows[: plan.page_size]]
        items = []
        for row in shown:
            items.append({o.name: o.kind.to_result(v, many=o.many) if o.kind is not None else v for o in plan.outputs for v in [row[plan.columns.get(o.name, o.name)]]})
        size = len(canonical_json(items).encode())
        most = min(self.settings.max_result_bytes, plan.budget.get("bytes", self.settings.max_result_bytes))
        if size > most or len(items) > plan.budget.get("rows", len(items)):
            raise LimitExceeded(f"the result has {len(items)} rows and {size} bytes; {most} bytes and {plan.budget.get('rows', 'any')} rows are allowed")
        cursor = None
        if not plan.aggregate and len(rows) > plan.page_size:
            cursor = self._signer.issue(plan.binding, place_of(shown[-1], plan.sorts))
        total = None if plan.counted is None else 0 if plan.empty else self._timed(plan.counted.collect, until)[0]["total"]
        facts = {"pushdown": "complete", "scopePredicate": "first" if layout.stored else "none", "cursor": "signed-live-keyset" if cursor else "none", "layoutFingerprint": layout.layout_fingerprint, "visibility": "eventual"}
        return Result(items, cursor, total, facts)

    def pages(self, request: Request) -> Iterator[Result]:
        """All pages of a mapping-first query, one after another."""
        value = dict(request.input)
        while True:
            found = self.execute(Request(request.operation, request.resources, value, request.context, request.binding_id))
            yield found
            if found.cursor is None:
                return
            value["cursor"] = found.cursor
