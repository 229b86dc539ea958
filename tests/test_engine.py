import dataclasses
import json
import random
import time

import pytest
from pyspark.sql import functions as F

from brinefold import CapabilityUnsupported, Context, CursorInvalid, DeadlineExceeded, Field, Kind, Layout, LayoutDrift, LimitExceeded, OperationInvalid, Request, Resource, Schema, ScopeMismatch, Session, Settings, apply_migration, compile_schema, plan_migration
from brinefold.functions.timestamps import format_instant, instant_column, parse_instant

NOON = parse_instant("2024-03-05T12:00:00Z")
DAY = {"gte": "2024-03-05T00:00:00Z", "lt": "2024-03-06T00:00:00Z"}
POINTS = Schema((Field("observed_at", Kind("utcTimestamp")), Field("series_id", Kind("string")), Field("service", Kind("string"), True), Field("value", Kind("float64"))), ("series_id",), "observed_at", ("service",), ("value",))


def point(i, value, at=NOON, service="checkout"):
    return {"observed_at": format_instant(at), "series_id": f"checkout-{i}", "service": service, "value": value}


@pytest.fixture
def make(spark, tmp_path):
    def made(catalog="structured", schema=POINTS, clock=None, **more):
        names = {k: more.pop(k) for k in list(more) if k in {f.name for f in dataclasses.fields(Settings)}}
        layout = compile_schema(f"{catalog}/shop/points", schema, **more)
        session = Session(spark, [layout], Settings(root=f"file://{tmp_path}/store", **names), **({"clock_ns": clock} if clock else {}))
        return session, layout

    return made


def write(session, layout, data, tenant="t", **more):
    operation = "evidence.append" if layout.resource.catalog == "evidence" else "structured.put"
    return session.execute(Request.of(operation, layout.resource, {"data": data}, context=Context(tenant, {"site": "x"}, **more)))


def read(session, layout, value, tenant="t", operation=None):
    operation = operation or f"{layout.resource.catalog}.query"
    return session.execute(Request.of(operation, layout.resource, value, context=Context(tenant, {"site": "x"})))


def test_quantile_retry_and_scope(make):
    session, layout = make("evidence")
    data = [point(i, 10.0 * i) for i in range(1, 5)]
    first, again = (write(session, layout, data, idempotency_key="k") for _ in range(2))
    assert first.data == again.data == {"acceptedRows": 4, "batchId": first.data["batchId"], "visibility": "eventual"}
    assert len(read(session, layout, {"where": {"observed_at": DAY}}).data) == 4
    assert read(session, layout, {"where": {"observed_at": DAY}}, tenant="other").data == []
    got = read(session, layout, {"where": {"observed_at": DAY}, "metrics": [{"name": "p99", "function": "quantile", "field": "value", "quantile": 0.99}, {"name": "n", "function": "count"}]})
    assert got.data == [{"p99": 40.0, "n": 4}]


def test_last_version_wins_and_a_late_retry_does_not(make):
    session, layout = make()
    write(session, layout, point(1, 1.0), idempotency_key="a")
    write(session, layout, [point(1, 2.0), point(1, 3.0)], idempotency_key="b")
    write(session, layout, point(1, 1.0), idempotency_key="a")
    query = {"where": {"observed_at": DAY}}
    assert [r["value"] for r in read(session, layout, query).data] == [3.0]
    # a retry of a batch that was begun and not finished keeps the first time
    batch = next(n for n in session.store.files.names(f"{session.store._base(layout)}/ledger") if n.endswith(".done"))
    for name in session.store.files.names(f"{session.store._base(layout)}/ledger"):
        if name.endswith(".done"):
            session.store.files.delete(f"{session.store._base(layout)}/ledger/{name}")
    assert batch
    write(session, layout, point(1, 1.0), idempotency_key="a")
    assert [r["value"] for r in read(session, layout, query).data] == [3.0]


def test_predicates_do_not_bring_back_old_versions(make):
    session, layout = make()
    write(session, layout, point(1, 1.0), idempotency_key="a")
    write(session, layout, point(1, 9.0), idempotency_key="b")
    assert read(session, layout, {"where": {"observed_at": DAY, "value": {"lt": 5}}}).data == []


def test_append_only_keeps_what_differs(make):
    session, layout = make("evidence")
    rows = [point(1, 0.0, NOON + 1), point(1, 1.0, NOON + 1), point(1, 2.0, NOON + 2)]
    for key in "ab":
        write(session, layout, rows, idempotency_key=key)
    assert sorted(r["value"] for r in read(session, layout, {"where": {"observed_at": DAY}}).data) == [0.0, 1.0, 2.0]
    raw, plain = make("evidence", dedup=False)
    assert len(read(raw, plain, {"where": {"observed_at": DAY}}).data) == 6


def test_nanosecond_order_and_bounds(make):
    session, layout = make("evidence")
    base = parse_instant("2024-03-05T12:00:00.123456Z")
    write(session, layout, [point(i, float(i), base + n) for i, n in enumerate((789, 790, 791, 791))])
    got = read(session, layout, {"where": {"observed_at": DAY}, "select": ["series_id", "observed_at"]})
    assert [r["series_id"] for r in got.data] == ["checkout-2", "checkout-3", "checkout-1", "checkout-0"]
    one = read(session, layout, {"where": {"observed_at": {"gte": format_instant(base + 790), "lt": format_instant(base + 791)}}})
    assert [r["observed_at"] for r in one.data] == ["2024-03-05T12:00:00.123456790Z"]
    ends = read(session, layout, {"where": {"observed_at": DAY}, "metrics": [{"name": "a", "function": "min", "field": "observed_at"}, {"name": "b", "function": "max", "field": "observed_at"}]})
    assert ends.data == [{"a": format_instant(base + 789), "b": format_instant(base + 791)}]


@pytest.mark.parametrize("tied", [False, True])
def test_pages_meet_each_row_once(make, tied):
    session, layout = make("evidence")
    rows = [point(0 if tied else i, float(i), NOON + (0 if tied else random.Random(i).randint(0, 3))) for i in range(7)]
    write(session, layout, rows)
    request = Request.of("evidence.query", layout.resource, {"where": {"observed_at": DAY}, "limit": 2}, context=Context("t", {"site": "x"}))
    pages = list(session.pages(request))
    assert [len(p.data) for p in pages] == [2, 2, 2, 1] and pages[-1].cursor is None
    seen = [r["value"] for p in pages for r in p.data]
    assert sorted(seen) == [float(i) for i in range(7)]
    assert seen == [r["value"] for r in read(session, layout, {"where": {"observed_at": DAY}}).data]


def test_cursors_are_bound_and_expire(make):
    now = [NOON]
    session, layout = make("evidence", clock=lambda: now[0], cursor_ttl_seconds=60)
    write(session, layout, [point(i, float(i)) for i in range(3)])
    query = {"where": {"observed_at": DAY}, "limit": 1}
    cursor = read(session, layout, query).cursor
    assert read(session, layout, query | {"cursor": cursor}).data
    bad = [({"limit": 2}, cursor, "t"), ({}, cursor, "other"), ({}, cursor[:-1] + ("0" if cursor[-1] != "0" else "1"), "t"), ({}, "x.y", "t"), ({}, 5, "t"), ({"orderBy": [{"field": "value", "direction": "asc"}]}, cursor, "t")]
    for change, token, tenant in bad:
        with pytest.raises(CursorInvalid):
            read(session, layout, query | change | {"cursor": token}, tenant=tenant)
    now[0] += 61 * 10**9
    with pytest.raises(CursorInvalid):
        read(session, layout, query | {"cursor": cursor})


INVALID = [
    {}, {"where": {}}, {"where": {"observed_at": {"gte": DAY["gte"]}}}, {"where": {"observed_at": "2024-03-05T00:00:00Z"}}, {"where": {"observed_at": {"gte": DAY["lt"], "lt": DAY["gte"]}}},
    {"where": {"observed_at": {"gte": "2024-01-01T00:00:00Z", "lt": "2024-03-01T00:00:00Z"}}}, {"where": {"observed_at": DAY, "nope": 1}}, {"where": {"observed_at": DAY, "service": {"prefix": "c"}}},
    {"where": {"observed_at": DAY, "service": {"in": []}}}, {"where": {"observed_at": DAY, "service": {"in": "abc"}}}, {"where": {"observed_at": DAY, "service": {"isNull": 1}}}, {"where": {"observed_at": DAY, "service": None}},
    {"where": {"observed_at": DAY}, "limit": 0}, {"where": {"observed_at": DAY}, "limit": 501}, {"where": {"observed_at": DAY}, "limit": True}, {"where": {"observed_at": DAY}, "select": "value"},
    {"where": {"observed_at": DAY}, "select": ["nope"]}, {"where": {"observed_at": DAY}, "orderBy": [{"field": "service", "direction": "asc"}]}, {"where": {"observed_at": DAY}, "orderBy": [{"field": "value"}]},
    {"where": {"observed_at": DAY}, "orderBy": [{"field": "value", "direction": "up"}]}, {"where": {"observed_at": DAY}, "offset": 3}, {"where": {"observed_at": DAY}, "consistency": "strong"},
    {"where": {"observed_at": DAY}, "metrics": []}, {"where": {"observed_at": DAY}, "metrics": [{"name": "x", "function": "median", "field": "value"}]}, {"where": {"observed_at": DAY}, "metrics": [{"name": "x", "function": "sum"}]},
    {"where": {"observed_at": DAY}, "metrics": [{"name": "x", "function": "sum", "field": "service"}]}, {"where": {"observed_at": DAY}, "metrics": [{"name": "x", "function": "quantile", "field": "value", "quantile": 1}]},
    {"where": {"observed_at": DAY}, "metrics": [{"name": "x", "function": "sum", "field": "value", "distinct": True}]}, {"where": {"observed_at": DAY}, "metrics": [{"name": "x", "function": "count", "extra": 1}]},
    {"where": {"observed_at": DAY}, "metrics": [{"name": "x", "function": "count"}] * 2}, {"where": {"_sys_row": "x", "observed_at": DAY}}, {"where": [1]},
]


def test_invalid_requests(make):
    session, layout = make("structured")
    for value in INVALID:
        with pytest.raises(OperationInvalid):
            read(session, layout, value)


def test_invalid_writes(make):
    session, layout = make("structured", max_batch_rows=3, max_batch_bytes=2000)
    good = point(1, 1.0)
    for data in ([], 5, "x", [5], good | {"more": 1}, {k: v for k, v in good.items() if k != "value"}, good | {"value": None}, good | {"value": "1"}, good | {"observed_at": "2024-03-05"}):
        with pytest.raises(OperationInvalid):
            write(session, layout, data)
    for data in ([good] * 4, good | {"service": "x" * 3000}):
        with pytest.raises(LimitExceeded):
            write(session, layout, data)
    assert read(session, layout, {"where": {"observed_at": DAY}}).data == []


def test_what_is_not_offered(make):
    session, layout = make("evidence")
    context = Context("t", {"site": "x"})
    for operation, value, more in [("evidence.append", {"data": point(1, 1.0), "requireAtomic": True}, {}), ("evidence.patch", {}, {}), ("evidence.query", {}, {"version": "2.0.0"})]:
        with pytest.raises(CapabilityUnsupported):
            session.execute(Request.of(operation, layout.resource, value, context=context, **more))
    with pytest.raises(ScopeMismatch):
        session.execute(Request.of("evidence.query", layout.resource, {}, binding_id="else"))
    with pytest.raises(ScopeMismatch):
        session.execute(Request.of("evidence.query", "evidence/shop/none", {}))
    with pytest.raises(OperationInvalid):
        session.execute(Request.of("structured.query", layout.resource, {}))
    with pytest.raises(OperationInvalid):
        session.execute(Request("evidence.query", (layout.resource, layout.resource), {}))
    with pytest.raises(DeadlineExceeded):
        session.execute(Request.of("evidence.query", layout.resource, {}, context=Context(deadline=1.0)))
    for call in (session.begin, session.commit, session.rollback):
        with pytest.raises(CapabilityUnsupported):
            call()
    structured, layout = make("structured")
    with pytest.raises(CapabilityUnsupported):
        structured.execute(Request.of("structured.put", layout.resource, {"data": point(1, 1.0), "expectedVersion": 1}))
    session.close()
    with pytest.raises(OperationInvalid):
        session.execute(Request.of("evidence.query", layout.resource, {}))


def test_get_needs_no_range(make):
    session, layout = make()
    write(session, layout, [point(1, 1.0), point(2, 2.0, service=None)])
    assert read(session, layout, {"where": {"series_id": "checkout-2"}}, operation="structured.get").data == [point(2, 2.0, service=None)]


def wire(layout, **more):
    return {"queryPlan": {"operation": "query", "resource": layout.resource.canonical, "filter": {"timestampRange": {"field": "observed_at", "start": DAY["gte"], "end": DAY["lt"]}}} | more}


def test_plans(make):
    session, layout = make("evidence")
    write(session, layout, [point(i, 10.0 * i, service=None if i == 4 else "a") for i in range(1, 5)])
    span = wire(layout)["queryPlan"]["filter"]
    got = read(session, layout, wire(layout, filter={"and": [span, {"or": [{"eq": [{"field": "value"}, {"literal": 10}]}, {"isNull": {"field": "service"}}]}]}, projection=[{"field": "series_id", "alias": "id"}], includeTotal=True, page={"size": 1}))
    assert got.data == [{"id": "checkout-1"}] and got.total == 2 and got.cursor
    rest = read(session, layout, wire(layout, filter={"and": [span, {"or": [{"eq": [{"field": "value"}, {"literal": 10}]}, {"isNull": {"field": "service"}}]}]}, projection=[{"field": "series_id", "alias": "id"}], includeTotal=True, page={"size": 1, "cursor": got.cursor}))
    assert rest.data == [{"id": "checkout-4"}] and rest.cursor is None
    assert read(session, layout, wire(layout, operation="aggregate", groupBy=["service"], aggregates=[{"name": "m", "function": "percentile", "field": "value"}])).data in ([{"service": "a", "m": 20.0}, {"service": None, "m": 40.0}], [{"service": None, "m": 40.0}, {"service": "a", "m": 20.0}])
    assert read(session, layout, wire(layout, empty=True)).data == []
    assert read(session, layout, wire(layout, schemaFingerprint=layout.schema_fingerprint, filter={"and": [span, {"not": {"lt": [{"field": "value"}, {"literal": 35}]}}]})).data[0]["value"] == 40.0


def test_plan_refusals(make):
    session, layout = make("evidence")
    write(session, layout, [point(i, float(i)) for i in range(4)])
    span = wire(layout)["queryPlan"]["filter"]
    bad = [
        {"filter": None}, {"filter": {"or": [span, span]}}, {"filter": {"not": span}}, {"filter": {"and": [span, span]}}, {"filter": {"gte": [{"field": "observed_at"}, {"literal": DAY["gte"]}]}},
        {"filter": {"and": [span, {"contains": 1}]}}, {"filter": {"and": [span, {"eq": [{"field": "value"}, {"field": "series_id"}]}]}}, {"filter": {"and": [span, {"eq": [{"field": "value", "resource": "evidence/a/b"}, {"literal": 1}]}]}},
        {"projection": [{"function": "upper"}]}, {"projection": [{"field": "value"}, {"field": "series_id", "alias": "value"}]}, {"orderBy": [{"field": "nope", "direction": "asc"}]}, {"page": {"size": 0}}, {"page": {"size": 501}},
        {"schemaFingerprint": "sha256:0"}, {"consistency": "strong"}, {"resource": "evidence/a/b"}, {"operation": "delete"}, {"surprise": 1}, {"budget": {"rows": 0}},
        {"operation": "aggregate", "aggregates": [{"name": "x", "function": "sum", "field": "value", "distinct": True}]}, {"operation": "aggregate", "aggregates": []},
    ]
    for change in bad:
        with pytest.raises(OperationInvalid):
            read(session, layout, wire(layout, **change))
    for change in ({"joins": []}, {"traversal": {}}, {"offset": 1}):
        with pytest.raises(CapabilityUnsupported):
            read(session, layout, wire(layout, **change))
    with pytest.raises(LimitExceeded):
        read(session, layout, wire(layout, budget={"rows": 3}))


def test_result_limits(make):
    session, layout = make("evidence", max_page_size=3, max_result_bytes=400)
    write(session, layout, [point(i, float(i), service=f"s{i}") for i in range(4)])
    with pytest.raises(LimitExceeded):
        read(session, layout, {"where": {"observed_at": DAY}, "metrics": [{"name": "n", "function": "count"}], "groupBy": ["service"]})
    session.settings = dataclasses.replace(session.settings, max_result_bytes=50)
    with pytest.raises(LimitExceeded):
        read(session, layout, {"where": {"observed_at": DAY}, "limit": 3})


def test_retention_and_expiry(make):
    now = [NOON]
    session, layout = make("evidence", clock=lambda: now[0], retention_seconds=86_400, partition="day")
    write(session, layout, [point(1, 1.0), point(2, 2.0, NOON - 86_399 * 10**9), point(3, 3.0, NOON - 86_400 * 10**9)])
    span = {"where": {"observed_at": {"gte": "2024-03-03T00:00:00Z", "lt": "2024-03-06T00:00:00Z"}}}
    assert [r["value"] for r in read(session, layout, span).data] == [1.0, 2.0]
    assert session.store.expire(layout) == []
    now[0] += 86_400 * 10**9
    assert session.store.expire(layout) == ["2024-03-04"]
    assert session.store.table(layout).count() == 1


def test_compaction_changes_no_result(make):
    session, layout = make()
    for k in range(4):
        write(session, layout, [point(i, float(i + 10 * k)) for i in range(3)], idempotency_key=str(k))
    query = {"where": {"observed_at": DAY}}
    before = read(session, layout, query).data
    assert session.store.table(layout).count() == 12
    assert session.store.compact(layout) == 1 and session.store.compact(layout) == 0
    assert session.store.table(layout).count() == 3
    assert read(session, layout, query).data == before
    write(session, layout, [point(0, 0.0), point(1, 1.0), point(2, 2.0)], idempotency_key="0")  # a retry after compaction
    assert read(session, layout, query).data == before


def test_forgetting_old_batches(make):
    now = [NOON]
    session, layout = make(clock=lambda: now[0], retry_window_seconds=60)
    write(session, layout, point(1, 1.0), idempotency_key="a")
    assert session.store.forget(layout) == 0
    now[0] += 61 * 10**9
    assert session.store.forget(layout) == 1
    assert session.store.files.names(f"{session.store._base(layout)}/ledger") == []


def test_all_kinds_round_trip(make):
    golden = "1234567890123456789012345678901234567890123456789012345678.123456789012345678"
    wide = {"kind": "decimal", "precision": 76, "scale": 18}
    values = {
        "id": ("string", "r"), "at": ("utcTimestamp", "2024-03-05T12:00:00.000000001Z"), "flag": ("boolean", False), "tiny": ("int8", -1), "small": ("int16", 300), "mid": ("int32", 70_000), "big": ("int64", 2**62), "ratio": ("float64", 0.1),
        "raw": ("bytes", "AAH/"), "uuid": ("uuid", "12345678-1234-5678-1234-56781234567a"), "day": ("date", "2024-02-29"), "lasts": ("duration", 5), "level": ("enum", "hot"),
        "body": ("json", {"b": [1, None, {"x": "y"}], "a": 1.5}), "ref": ("recordRef", {"k": 1}), "object": ("objectRef", "o"), "place": ("wgs84Point", [1.5, -2.5]), "price": ({"kind": "decimal", "precision": 20, "scale": 2}, "12.30"), "wide": (wide, golden),
    }
    fields = [Field.of(n, k, nullable=n not in ("id", "at")) for n, (k, _) in values.items()] + [Field.of("tags", "string", nullable=True, many=True), Field.of("nums", wide, many=True)]
    session, layout = make("evidence", Schema(tuple(fields), ("id",), "at"))
    record = {n: v for n, (_, v) in values.items()} | {"tags": ["a", None], "nums": [golden, "-1.000000000000000000"]}
    empty = {"id": "e", "at": "2024-03-05T12:00:00Z", "tags": [], "nums": []}
    write(session, layout, [record, empty])
    got = {r["id"]: r for r in read(session, layout, {"where": {"at": DAY}}).data}
    assert got["r"] == record
    assert got["e"] == {n: None for n in values} | empty
    for name in ("raw", "uuid", "day", "big", "flag", "price", "wide", "tags", "place", "body"):
        found = read(session, layout, {"where": {"at": DAY, name: {"eq": record[name]}}})
        assert [r["id"] for r in found.data] == ["r"], name
    total = read(session, layout, {"where": {"at": DAY}, "metrics": [{"name": "s", "function": "sum", "field": "wide"}, {"name": "m", "function": "max", "field": "wide"}, {"name": "c", "function": "sum", "field": "price"}]})
    assert total.data == [{"s": golden, "m": golden, "c": "12.30"}]


def test_wide_sums_of_both_signs(make):
    wide = {"kind": "decimal", "precision": 76, "scale": 18}
    session, layout = make("evidence", Schema((Field.of("id", "string"), Field.of("at", "utcTimestamp"), Field.of("v", wide)), ("id",)))
    numbers = ["9" * 58 + ".5", "-" + "9" * 58 + ".25", "-0.000000000000000001", "123456789012345678901234567890"]
    write(session, layout, [{"id": str(i), "at": "2024-03-05T12:00:00Z", "v": v} for i, v in enumerate(numbers)])
    from decimal import Decimal, localcontext

    with localcontext() as c:
        c.prec = 100
        want = sum(map(Decimal, numbers))
    got = read(session, layout, {"where": {"at": DAY}, "metrics": [{"name": "s", "function": "sum", "field": "v"}, {"name": "least", "function": "min", "field": "v"}]}).data[0]
    assert Decimal(got["s"]) == want and Decimal(got["least"]) == Decimal(numbers[1])


def test_empty_aggregates(make):
    session, layout = make("evidence")
    metrics = [{"name": "n", "function": "count"}] + [{"name": f, "function": f, "field": "value"} for f in ("sum", "avg", "min", "max")] + [{"name": "q", "function": "quantile", "field": "value", "quantile": 0.5}]
    assert read(session, layout, {"where": {"observed_at": DAY}, "metrics": metrics}).data == [{"n": 0, "sum": None, "avg": None, "min": None, "max": None, "q": None}]


def test_bulk_frames_match_records(make, spark):
    session, layout = make("evidence")
    frame = spark.range(50).select(F.lit(NOON).cast("long").alias("observed_at"), F.concat(F.lit("checkout-"), "id").alias("series_id"), F.lit("a").alias("service"), F.col("id").cast("double").alias("value"))
    own = {"scope": Context("t", {"site": "x"}).digest, "tenant": "t"}
    assert session.store.append_frame(layout, frame, batch="b", **own).accepted_rows == 50
    assert session.store.append_frame(layout, frame, batch="b", **own).accepted_rows == 50
    got = read(session, layout, {"where": {"observed_at": DAY}, "metrics": [{"name": "s", "function": "sum", "field": "value"}]})
    assert got.data == [{"s": sum(map(float, range(50)))}]
    with pytest.raises(OperationInvalid):
        session.store.append_frame(layout, frame.drop("value"), batch="c", **own)
    with pytest.raises(OperationInvalid):
        session.store.append_frame(layout, frame.withColumn("value", F.lit(1)), batch="c", **own)


def test_scans_are_pruned(make):
    session, layout = make("evidence", partition="day")
    write(session, layout, [point(i, 1.0, NOON + i * 86_400 * 10**9) for i in range(-3, 3)])
    plan = session.compile(Request.of("evidence.query", layout.resource, {"where": {"observed_at": DAY, "series_id": "checkout-0"}}, context=Context("t", {"site": "x"})))
    text = plan.frame._jdf.queryExecution().executedPlan().toString()
    assert "_sys_period" in text.split("PartitionFilters:")[1].split("]")[0] and "_sys_scope" in text.split("PartitionFilters:")[1].split("]")[0]
    pushed = text.split("PushedFilters:")[1].split("\n")[0]
    assert "observed_at" in pushed and "series_id" in pushed and "TakeOrderedAndProject" in text


def test_migration_registry_and_drift(make, spark, tmp_path):
    session, layout = make()
    migration = plan_migration([layout])
    assert [s["step"] for s in migration.steps] == ["create", "register"]
    with pytest.raises(LayoutDrift):
        session.verify()
    with pytest.raises(ValueError):
        apply_migration(migration, session.store, expected="sha256:0")
    assert apply_migration(migration, session.store, expected=migration.fingerprint) == [layout.resource.canonical]
    apply_migration(migration, session.store)
    write(session, layout, point(1, 1.0))
    session.verify()
    assert session.store.registered() == [layout]
    other = compile_schema(layout.resource, Schema((*POINTS.fields, Field("more", Kind("string"), True)), ("series_id",), "observed_at"))
    with pytest.raises(LayoutDrift):
        apply_migration(plan_migration([other]), session.store)
    for bad in ([], [layout, layout]):
        with pytest.raises(ValueError):
            plan_migration(bad)


def test_layouts():
    layout = compile_schema("evidence/a/b", POINTS, retention_seconds=5, administrative=[("owner", "x")])
    assert layout.append_only and layout.names == ("observed_at", "series_id", "service", "value")
    assert Layout.from_dict(json.loads(json.dumps(layout.to_dict()))) == layout
    for change in ({"retentionSeconds": 6}, {"more": 1}, {"layoutFingerprint": "sha256:0"}):
        with pytest.raises(ValueError):
            Layout.from_dict(layout.to_dict() | change)
    bad = [
        {"identity": ()}, {"identity": ("series_id", "series_id")}, {"identity": ("service",)}, {"identity": ("none",)}, {"timestamp": "value"}, {"dimensions": ("series_id",)}, {"measurements": ("none",)},
        {"fields": (*POINTS.fields, POINTS.fields[0])}, {"fields": (*POINTS.fields, Field("_sys_x", Kind("string")))}, {"consistency": "strong"}, {"indexes": ("none",)},
        {"timestamp": None, "fields": (*POINTS.fields, Field("other", Kind("utcTimestamp")))},
    ]
    for change in bad:
        with pytest.raises(ValueError):
            compile_schema("structured/a/b", dataclasses.replace(POINTS, **change))
    for more in ({"partition": "year"}, {"profile": "none"}, {"retention_seconds": 0}, {"append_only": True}):
        with pytest.raises(ValueError):
            compile_schema("structured/a/b", POINTS, **more)
    for bad in ("a/b", "other/a/b", "structured//x", 5):
        with pytest.raises((ValueError, TypeError)):
            Resource.parse(bad)


def test_settings_manifest_and_probe(make):
    with pytest.raises(ValueError):
        Settings.parse({"root": "x", "surprise": 1})
    for name, value in (("max_page_size", 501), ("max_batch_rows", 0), ("cursor_ttl_seconds", 86_401), ("max_time_range_seconds", 367 * 86_400), ("root", "")):
        with pytest.raises(ValueError):
            Settings.parse({"root": "x"} | {name: value})
    session, layout = make("evidence")
    assert "append-only" in session.manifest()["features"] and len(session.manifest()["kinds"]) == 18
    loose, _ = make("evidence", append_only=False)
    assert "append-only" not in loose.manifest()["features"]
    assert session.probe()["ready"]


def test_instant_columns(spark):
    texts = ["1969-12-31T23:59:59.999999999Z", "2024-01-02 03:04:05.5+01:00", "2024-01-02t03:04:05z", "2024-01-02", None, "2024-01-02T03:04:05.1234567891Z"]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(instant_column(F.col("t"))).collect()]
    assert got == [parse_instant(t) for t in texts[:3]] + [None] * 3


def test_both_ways_of_writing_are_one_evidence(make, spark):
    session, layout = make("evidence")
    write(session, layout, [point(i, i / 7, NOON + i, "a" if i % 2 else None) for i in range(20)])
    frame = spark.range(20).select((F.lit(NOON) + F.col("id")).alias("observed_at"), F.concat(F.lit("checkout-"), "id").alias("series_id"), F.when(F.col("id") % 2 == 1, "a").alias("service"), (F.col("id") / 7).alias("value"))
    session.store.append_frame(layout, frame, batch="b", scope=Context("t", {"site": "x"}).digest, tenant="t")
    assert session.store.table(layout).count() == 40
    assert len(read(session, layout, {"where": {"observed_at": DAY}}).data) == 20


def test_only_folders_of_the_range_are_listed(make):
    session, layout = make("evidence", partition="day")
    write(session, layout, [point(i, 1.0, NOON + i * 86_400 * 10**9) for i in range(-3, 3)])
    write(session, layout, [point(i, 1.0, NOON + i * 86_400 * 10**9) for i in range(-3, 3)], tenant="other")
    seen, names = [], session.store.files.names
    session.store.files.names = lambda path: seen.append(path) or names(path)
    plan = session.compile(Request.of("evidence.query", layout.resource, {"where": {"observed_at": DAY}}, context=Context("t", {"site": "x"})))
    listed = [x for x in seen if "_sys_period=" in x]
    assert len(listed) == 2 and all("2024-03-05" in x or "2024-03-06" in x for x in listed)  # the range ends with a day's first instant
    assert len(plan.frame.inputFiles()) == 2 and len(read(session, layout, {"where": {"observed_at": DAY}}).data) == 1


@pytest.mark.parametrize("dedup", [True, False])
def test_replaced_batches_stay_for_running_queries(make, dedup):
    now = [NOON]
    session, layout = make("evidence", append_only=False, dedup=dedup, clock=lambda: now[0])
    for k in range(3):
        write(session, layout, [point(i, float(k)) for i in range(4)], idempotency_key=str(k))
    query = {"where": {"observed_at": DAY}, "orderBy": [{"field": "value", "direction": "asc"}]}
    before, running = read(session, layout, query).data, session.store.table(layout)
    open_batch = "b1_open"
    session.store.files.create(session.store._ledger(layout, open_batch, "begun"), json.dumps({"ingested": NOON}))
    assert session.store.compact(layout) == 1 and session.store.compact(layout) == 0
    assert read(session, layout, query).data == before and running.count() == 12
    assert session.store.sweep(layout) == 0
    now[0] += 3601 * 10**9
    assert session.store.sweep(layout) == 3 and session.store.sweep(layout) == 0
    assert read(session, layout, query).data == before
    write(session, layout, point(9, 9.0), idempotency_key="more")
    assert session.store.compact(layout) == 1
    assert len(read(session, layout, query).data) == len(before) + 1
    now[0] += 3601 * 10**9
    assert session.store.sweep(layout) == 2 and len(read(session, layout, query).data) == len(before) + 1


def test_writes_keep_deadlines(make):
    session, layout = make()
    import time

    slow = session.store.append
    session.store.append = lambda *a, **k: (time.sleep(1.5), slow(*a, **k))[1]
    with pytest.raises(DeadlineExceeded):
        write(session, layout, point(1, 1.0), deadline=time.time() + 1, idempotency_key="k")
    session.store.append = slow
    assert write(session, layout, point(1, 1.0), idempotency_key="k").data["acceptedRows"] == 1
    assert len(read(session, layout, {"where": {"observed_at": DAY}}).data) == 1


def test_late_queries_are_cancelled(spark):
    layout = compile_schema("structured/demo/slow", Schema((Field("id", Kind("int64")), Field("at", Kind("utcTimestamp"))), ("id",), "at"), stored=False)
    # hours of work
    table = spark.range(0, 10**13, 1, 4).selectExpr("id", "1709596800000000000 + id % 86400 * 1000000000 as at")
    session = Session(spark, [layout], Settings(root="file:///nowhere"), tables={layout.resource: table})
    value = {"where": {"at": DAY}, "metrics": [{"name": "n", "function": "count"}, {"name": "most", "function": "max", "field": "id"}]}
    began = time.time()
    with pytest.raises(DeadlineExceeded):
        session.execute(Request.of("structured.aggregate", layout.resource, value, context=Context(deadline=began + 4)))
    assert time.time() - began < 15
    assert not spark.sparkContext.statusTracker().getActiveJobsIds()
    assert spark.range(3).count() == 3  # later work is not cancelled


def test_cursors_of_another_session_or_layout(make):
    session, layout = make("evidence")
    write(session, layout, [point(i, 1.0) for i in range(4)])
    query = {"where": {"observed_at": DAY}, "limit": 2}
    cursor = read(session, layout, query).cursor
    assert len(read(session, layout, query | {"cursor": cursor}).data) == 2
    again, _ = make("evidence")  # without a secret of its own
    with pytest.raises(CursorInvalid):
        read(again, layout, query | {"cursor": cursor})
    first, _ = make("evidence", cursor_secret="s")
    cursor = read(first, layout, query).cursor
    other, changed = make("evidence", cursor_secret="s", profile="metric")
    with pytest.raises(CursorInvalid):
        read(other, changed, query | {"cursor": cursor})


@pytest.mark.parametrize("kind", ["float64", "int64", {"kind": "decimal", "precision": 76, "scale": 18}, {"kind": "decimal", "precision": 38, "scale": 10}])
def test_quantiles_equal_sorted_values(make, kind):
    rng = random.Random(str(kind))
    numbers = [rng.choice([rng.randint(-5, 5), rng.randint(-(10**6), 10**6)]) for _ in range(3000)]
    spelled = (lambda n: n) if isinstance(kind, str) else (lambda n: f"{n}.5")
    session, layout = make("evidence", Schema((Field.of("id", "int64"), Field.of("at", "utcTimestamp"), Field.of("g", "string", nullable=True), Field.of("v", kind, nullable=True)), ("id",)))
    rows = [{"id": i, "at": "2024-03-05T12:00:00Z", "g": rng.choice(["a", "b", None]), "v": None if i % 10 == 0 else spelled(n)} for i, n in enumerate(numbers)]
    rows += [{"id": 5000, "at": "2024-03-05T12:00:00Z", "g": "alone", "v": spelled(1)}, {"id": 5001, "at": "2024-03-05T12:00:00Z", "g": "none"}]
    write(session, layout, rows)
    shares = [0.001, 0.5, 0.99]
    metrics = [{"name": f"q{i}", "function": "quantile", "field": "v", "quantile": q} for i, q in enumerate(shares)] + [{"name": "n", "function": "count", "field": "v"}]
    from decimal import Decimal

    def want(group):
        own = sorted((Decimal(str(r["v"])) for r in rows if r.get("v") is not None and (group == "*" or r["g"] == group)))
        return [own[int(q * len(own))] if own else None for q in shares] + [len(own)]

    for keys in ([], ["g"]):
        got = read(session, layout, {"where": {"at": DAY}, "metrics": metrics, **({"groupBy": keys} if keys else {})}).data
        assert len(got) == (5 if keys else 1)
        for r in got:
            assert [None if r[f"q{i}"] is None else Decimal(str(r[f"q{i}"])) for i in range(3)] + [r["n"]] == want(r["g"] if keys else "*")


def test_probe_refuses_old_versions():
    from types import SimpleNamespace

    from brinefold.health import probe

    fake = lambda v: SimpleNamespace(version=v, catalog=SimpleNamespace(functionExists=lambda f: True), conf=SimpleNamespace(get=lambda k: "UTC"))
    assert probe(fake("4.1.2"))["ready"] and not probe(fake("3.5.1"))["ready"]
