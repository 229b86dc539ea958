"""The engine's operators as named queries over the synthetic tables, each with equivalent SQL.

``events`` is read as a foreign table: its timestamps without zone stay as they are, so that bounds on them
reach the Parquet scan. Queries that need stored data derive a stored table from it.
"""

from __future__ import annotations

import tempfile
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.canonical import scope_digest
from ..functions.timestamps import format_instant
from ..layout import Field, Layout, Schema, compile_schema
from ..operators.dedup import latest
from ..plans.compiled import scan
from ..plans.mapping import compile_mapping
from ..plans.wire import compile_wire
from ..session import Context, Request, Session
from ..settings import Settings
from ..types import Kind

_NTZ = Kind("utcTimestamp", encoding="ntz")
SETTINGS = Settings(root="unused", cursor_secret="catalogue")
EVENTS = compile_schema(
    "structured/demo/events",
    Schema(
        (Field("event_id", Kind("int64")), Field("ts", _NTZ), Field("user_id", Kind("int64")), Field("event_type", Kind("string"), True), Field("value", Kind("float64"), True), Field("props", Kind("json"), True)),
        ("event_id",), "ts", ("user_id", "event_type"), ("value",),
    ),
    stored=False,
)
#: The same with exact numbers, for sums that are equal to the last bit in any engine.
MONEY = compile_schema("structured/demo/events", Schema((*(f for f in EVENTS.fields if f.name != "value"), Field("value", Kind("decimal", 18, 2), True)), ("event_id",), "ts", ("user_id", "event_type"), ("value",)), stored=False)
#: All of the table, within the 31 days that a request may ask for.
RANGE = {"gte": "2024-01-01T00:00:00Z", "lt": "2024-02-01T00:00:00Z"}
WHERE_RANGE = "ts >= TIMESTAMP '2024-01-01' AND ts < TIMESTAMP '2024-02-01'"
SPAN = {"timestampRange": {"field": "ts", "start": RANGE["gte"], "end": RANGE["lt"]}}
COLUMNS = "event_id, event_type, props, ts, user_id, value"


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def holed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with nulls: errors have no type, and values under 20 none."""
    return events(spark, sf_dir).withColumn("event_type", F.nullif("event_type", F.lit("error"))).withColumn("value", F.when(F.col("value") >= 20, F.col("value")))


HOLED_SQL = "(SELECT event_id, ts, user_id, nullif(event_type, 'error') AS event_type, CASE WHEN value >= 20 THEN value END AS value, props FROM events)"


def exact(df: DataFrame) -> DataFrame:
    return df.withColumn("value", F.col("value").cast("decimal(18,2)"))


def rows(request: dict, table=events, layout: Layout = EVENTS, operation: str = "query") -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: compile_mapping(operation, request, table(spark, sf_dir), layout, SETTINGS).visible


def filtered(where: dict, table=events) -> Callable[[SparkSession, str], DataFrame]:
    """Every row that a filter lets through, without a page: ids, as the filter decides nothing else."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        from ..operators.predicates import mapping_filter
        from ..plans.guards import mapping_bounds

        predicate, bounds = mapping_filter({"ts": RANGE} | where, EVENTS)
        return scan(table(spark, sf_dir), EVENTS, None, predicate, mapping_bounds(bounds, EVENTS, SETTINGS)).select("event_id")

    return run


def wired(node: dict, table=events) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        from ..plans.wire import expression

        return scan(table(spark, sf_dir), EVENTS, None, expression({"and": [SPAN, node]}, EVENTS), None).select("event_id")

    return run


def plan(value: dict, table=events, layout: Layout = EVENTS) -> Callable[[SparkSession, str], DataFrame]:
    full = {"operation": "query", "resource": "structured/demo/events"} | value
    return lambda spark, sf_dir: compile_wire(full, table(spark, sf_dir), layout, SETTINGS).visible


def aggregate(metrics: list[dict], keys: tuple[str, ...] = (), table=holed, doubles: tuple[str, ...] = ()) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        made = compile_mapping("aggregate", {"where": {"ts": RANGE}, "metrics": metrics, "groupBy": list(keys)}, exact(table(spark, sf_dir)), MONEY, SETTINGS).visible
        for name in doubles:
            made = made.withColumn(name, F.col(name).cast("double"))
        return made

    return run


def _metric(name: str, function: str, field: str | None = None, **more: object) -> dict:
    return {"name": name, "function": function} | ({"field": field} if field else {}) | more


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per type: count, distinct users, sum, average, least, greatest and 99th percentile of all days."""
    metrics = [_metric("n", "count"), _metric("users", "count", "user_id", distinct=True), _metric("total", "sum", "value"), _metric("least", "min", "value"), _metric("most", "max", "value"), _metric("p99", "quantile", "value", quantile=0.99)]
    made = compile_mapping("aggregate", {"where": {"ts": RANGE}, "metrics": metrics, "groupBy": ["event_type"]}, exact(events(spark, sf_dir)), MONEY, SETTINGS).visible
    numbers = [F.col(c).cast("double").alias(c) for c in ("total", "least", "most", "p99")]
    return made.select("event_type", "n", "users", *numbers, (F.col("total").cast("double") / F.col("n")).alias("mean"))


_Q = "list(CAST(value AS DECIMAL(18,2)) ORDER BY value) FILTER (value IS NOT NULL)"
FLAGSHIP_SQL = f"""
    SELECT event_type, count(*) AS n, count(DISTINCT user_id) AS users, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total,
        CAST(min(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS least, CAST(max(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS most,
        CAST(({_Q})[CAST(floor(0.99 * count(value)) AS INTEGER) + 1] AS DOUBLE) AS p99, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS mean
    FROM events WHERE {WHERE_RANGE} GROUP BY event_type
"""

STORED = Schema((Field("part", Kind("int64")), Field("line", Kind("int32")), Field("at", Kind("utcTimestamp")), Field("quantity", Kind("float64")), Field("price", Kind("float64"))), ("part", "line"), "at", (), ("quantity", "price"))


def _session(spark: SparkSession, layout: Layout) -> Session:
    """A session whose tables lie in the shared folder, or for a local master without one in a temporary folder."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = "file://" + tempfile.gettempdir()
    from uuid import uuid4

    root = f"{base.rstrip('/')}/catalogue-{uuid4().hex}"
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(path)
    return Session(spark, [layout], Settings(root=root, cursor_secret="catalogue", max_time_range_seconds=366 * 86_400))


def dedup_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last version of each order line. Lines repeat; all other columns order their versions."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    order = [F.col(c).desc() for c in ("l_shipdate", "l_extendedprice", "l_quantity", "l_partkey", "l_suppkey", "l_discount", "l_tax", "l_returnflag", "l_linestatus")]
    return latest(lines, ["l_orderkey", "l_linenumber"], order)


def _ticks(column: str) -> F.Column:
    return (F.unix_micros(F.col(column).cast("timestamp")) * 1000).alias("at")


def _orders_as_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.col("o_orderkey").alias("part"), F.lit(1).alias("line"), _ticks("o_orderdate"), F.col("o_totalprice").alias("quantity"), F.col("o_custkey").cast("double").alias("price"))


def dedup_append_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evidence appended twice, and once more with other contents: identical rows coalesce, different ones all stay."""
    layout = compile_schema("evidence/demo/orders", STORED, partition="month")
    session, frame = _session(spark, layout), _orders_as_stored(spark, sf_dir)
    own = {"scope": scope_digest("t", {}), "tenant": "t"}
    session.store.append_frame(layout, frame, batch="b1", **own)
    session.store.append_frame(layout, frame, batch="b2", **own)
    session.store.append_frame(layout, frame.where("part % 3 = 0").withColumn("quantity", F.lit(-1.0)), batch="b3", **own)
    return scan(session.store.table(layout), layout, own["scope"], F.lit(True), None).select("part", "quantity")


def put_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Structured rows put twice: the later version of a key is read."""
    layout = compile_schema("structured/demo/orders", STORED, partition="month")
    session, frame = _session(spark, layout), _orders_as_stored(spark, sf_dir)
    own = {"scope": scope_digest("t", {}), "tenant": "t"}
    session.store.append_frame(layout, frame, batch="b1", **own)
    session.store.append_frame(layout, frame.where("part % 3 = 0").withColumn("quantity", F.lit(-1.0)), batch="b2", **own)
    session.store.append_frame(layout, frame, batch="b1", **own)  # a late retry changes nothing
    session.store.compact(layout)
    return scan(session.store.table(layout), layout, own["scope"], F.lit(True), None).select("part", "quantity")


def scope_isolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    layout = compile_schema("structured/demo/orders", STORED, partition="month")
    session, frame = _session(spark, layout), _orders_as_stored(spark, sf_dir)
    for tenant in ("a", "b"):
        session.store.append_frame(layout, frame.where(f"part % 2 = {int(tenant == 'b')}"), batch=tenant, scope=scope_digest(tenant, {}), tenant=tenant)
    found = scan(session.store.table(layout), layout, scope_digest("b", {}), F.col("quantity") > 1000, None)
    return found.select("part", "quantity")


def retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows older than ten days, at a fixed time, are not read."""
    short = compile_schema("structured/demo/events", Schema(EVENTS.fields, ("event_id",), "ts"), stored=False, retention_seconds=10 * 86_400)
    now = 1_705_795_200_500_000_000  # 2024-01-21T00:00:00.5Z
    return scan(events(spark, sf_dir), short, None, F.lit(True), None, now).select("event_id")


#: Records of one batch: the limit of a request is part of what it is.
BATCH_ROWS = 500
RECORDED = Schema((Field("id", Kind("int64")), Field("at", Kind("utcTimestamp")), Field("kind", Kind("string"), True), Field("value", Kind("float64")), Field("amount", Kind("decimal", 60, 20))), ("id",), "at")


def _records(spark: SparkSession, sf_dir: str) -> list[dict]:
    """The first events, as a caller would send them."""
    first = events(spark, sf_dir).select("event_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("at"), "event_type", "value").orderBy("event_id").limit(BATCH_ROWS).collect()
    return [{"id": r.event_id, "at": format_instant(r["at"] * 1000), "kind": r.event_type, "value": r.value, "amount": f"{r.event_id + 1}00000000000000000000000000.5"} for r in first]


def append_retry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same batch of records sent three times is stored once."""
    layout = compile_schema("evidence/demo/points", RECORDED)
    session, records = _session(spark, layout), _records(spark, sf_dir)
    for _ in range(3):
        session.execute(Request.of("evidence.append", layout.resource, {"records": records}, context=Context("t", {}, "key")))
    return session.store.table(layout).select("id", "value")


def put_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records put, and some of them put again with other values: the last version of each is read."""
    layout = compile_schema("structured/demo/points", RECORDED)
    session, records = _session(spark, layout), _records(spark, sf_dir)
    for key, sent in (("a", records), ("b", [r | {"value": -1.0, "kind": None} for r in records if r["id"] % 3 == 0])):
        session.execute(Request.of("structured.put", layout.resource, {"data": sent}, context=Context("t", {}, key)))
    return session.compile(Request.of("structured.query", layout.resource, {"where": {"at": RANGE}, "select": ["id", "kind", "value"], "limit": BATCH_ROWS}, context=Context("t", {}))).visible


def wide_decimals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sum, least and greatest of decimals of over 38 digits, by the last two digits of the id, as texts."""
    layout = compile_schema("structured/demo/points", RECORDED)
    session = _session(spark, layout)
    context = Context("t", {}, "key")
    session.execute(Request.of("structured.put", layout.resource, {"data": _records(spark, sf_dir)}, context=context))
    metrics = [_metric("total", "sum", "amount"), _metric("least", "min", "amount"), _metric("most", "max", "amount"), _metric("mid", "quantile", "amount", quantile=0.5)]
    made = session.execute(Request.of("structured.query", layout.resource, {"where": {"at": RANGE}, "metrics": metrics, "groupBy": ["kind"]}, context=context))
    return spark.createDataFrame([tuple(r[n] for n in ("kind", "total", "least", "most", "mid")) for r in made.data], "kind string, total string, least string, most string, mid string")


def evidence_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evidence that is not append-only: of one key's rows the last is read, as of structured data."""
    layout = compile_schema("evidence/demo/orders", STORED, partition="month", append_only=False)
    session, frame = _session(spark, layout), _orders_as_stored(spark, sf_dir)
    own = {"scope": scope_digest("t", {}), "tenant": "t"}
    session.store.append_frame(layout, frame, batch="b1", **own)
    session.store.append_frame(layout, frame.where("part % 5 = 0").withColumn("quantity", F.lit(-2.0)), batch="b2", **own)
    return scan(session.store.table(layout), layout, own["scope"], F.lit(True), None).select("part", "quantity")


def cursor_traversal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first pages of a query, one after another by their cursors. Only the cursors pass through the driver."""
    session = Session(spark, [EVENTS], SETTINGS, tables={EVENTS.resource: events(spark, sf_dir)})
    value = {"where": {"ts": RANGE}, "select": ["event_id"], "limit": 400, "orderBy": [{"field": "user_id", "direction": "desc"}]}
    pages = []
    for n in range(4):
        request = Request.of("structured.query", EVENTS.resource, value)
        pages.append(session.compile(request).visible.select(F.lit(n).alias("page"), "event_id"))
        cursor = session.execute(request).cursor
        if cursor is None:
            break
        value = value | {"cursor": cursor}
    return reduce(DataFrame.union, pages)


_ORDERS_SQL = "SELECT o_orderkey AS part, o_totalprice AS quantity FROM orders"


_FIRST_SQL = f"(SELECT * FROM events ORDER BY event_id LIMIT {BATCH_ROWS})"


def _wide_sql(number: str, halves: str = "1") -> str:
    """The text of ``number`` followed by 26 zeros and ``halves`` halves, with twenty fractional digits."""
    half = f"CAST({halves} AS BIGINT)"
    return f"CAST({number} AS VARCHAR) || lpad(CAST({half} // 2 AS VARCHAR), 26, '0') || '.' || CASE WHEN {half} % 2 = 1 THEN '5' ELSE '0' END || repeat('0', 19)"


def _ids(condition: str, table: str = "events") -> str:
    return f"SELECT event_id FROM {table} WHERE {WHERE_RANGE} AND ({condition})"


def _agg(columns: str, keys: str = "") -> str:
    return f"SELECT {keys + ', ' if keys else ''}{columns} FROM (SELECT event_id, ts, user_id, event_type, CAST(value AS DECIMAL(18,2)) AS value FROM {HOLED_SQL}) WHERE {WHERE_RANGE}" + (f" GROUP BY {keys}" if keys else "")


def _quantile_sql(q: float) -> str:
    return f"CAST((list(value ORDER BY value) FILTER (value IS NOT NULL))[CAST(floor({q} * count(value)) AS INTEGER) + 1] AS DOUBLE) AS q"


def _page_sql(order: str, offset: int, size: int, columns: str = COLUMNS) -> str:
    return f"SELECT {columns} FROM (SELECT *, row_number() OVER (ORDER BY {order}) AS rn FROM events WHERE {WHERE_RANGE}) WHERE rn > {offset} AND rn <= {offset + size}"


def keyset_page_2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second page of 25, from the place at which the first ends."""
    from ..operators.ordering import page, sorts_of
    from ..operators.predicates import mapping_filter

    predicate, _ = mapping_filter({"ts": RANGE}, EVENTS)
    sorts = sorts_of([{"field": "user_id", "direction": "asc"}], EVENTS)
    whole = scan(events(spark, sf_dir), EVENTS, None, predicate, None)
    last = page(whole, sorts, 24).collect()[-1].asDict()
    from ..operators.ordering import place_of

    return page(whole, sorts, 24, place_of(last, sorts)).select("event_id", "event_type", "props", "ts", "user_id", "value")


CATALOGUE = [
    ("flagship", flagship, FLAGSHIP_SQL),
    ("scan_all", lambda spark, sf_dir: scan(events(spark, sf_dir), EVENTS, None, F.lit(True), None).select(*EVENTS.names), f"SELECT {COLUMNS} FROM events"),
    ("filter_eq", filtered({"event_type": "click"}), _ids("event_type = 'click'")),
    ("filter_ne", filtered({"event_type": {"ne": "click"}}, holed), _ids("event_type <> 'click'", HOLED_SQL)),
    ("filter_lt", filtered({"value": {"lt": 50}}), _ids("value < 50")),
    ("filter_lte", filtered({"user_id": {"lte": 40}}), _ids("user_id <= 40")),
    ("filter_gt", filtered({"value": {"gt": 50.5}}), _ids("value > 50.5")),
    ("filter_gte", filtered({"user_id": {"gte": 40}}), _ids("user_id >= 40")),
    ("filter_in", filtered({"event_type": {"in": ["click", "view"]}}), _ids("event_type IN ('click', 'view')")),
    ("filter_in_with_null", filtered({"event_type": {"notIn": ["click", None]}}, holed), _ids("event_type NOT IN ('click', NULL)", HOLED_SQL)),
    ("filter_not_in", filtered({"event_type": {"notIn": ["click", "view"]}}, holed), _ids("event_type NOT IN ('click', 'view')", HOLED_SQL)),
    ("filter_is_null", filtered({"event_type": {"isNull": True}}, holed), _ids("event_type IS NULL", HOLED_SQL)),
    ("filter_is_not_null", filtered({"value": {"isNull": False}}, holed), _ids("value IS NOT NULL", HOLED_SQL)),
    ("filter_and", filtered({"event_type": "click", "value": {"gte": 10, "lt": 90}}), _ids("event_type = 'click' AND value >= 10 AND value < 90")),
    ("filter_or", wired({"or": [{"eq": [{"field": "event_type"}, {"literal": "click"}]}, {"gt": [{"field": "value"}, {"literal": 90}]}]}), _ids("event_type = 'click' OR value > 90")),
    ("filter_not", wired({"not": {"in": {"field": "event_type", "values": ["click", "view"]}}}, holed), _ids("NOT event_type IN ('click', 'view')", HOLED_SQL)),
    ("filter_field_field", wired({"lt": [{"field": "event_id"}, {"field": "user_id"}]}, lambda spark, sf_dir: events(spark, sf_dir).withColumn("user_id", F.col("user_id") * 40)), _ids("event_id < user_id * 40")),
    ("time_range_incl", wired({"timestampRange": {"field": "ts", "start": "2024-01-06T00:00:00Z", "end": "2024-01-07T00:00:00Z", "endInclusive": True}}), _ids("ts >= TIMESTAMP '2024-01-06' AND ts <= TIMESTAMP '2024-01-07'")),
    ("time_range_excl", wired({"timestampRange": {"field": "ts", "start": "2024-01-06T00:00:00.000000001Z", "startInclusive": False, "end": "2024-01-07T00:00:00Z"}}), _ids("ts > TIMESTAMP '2024-01-06' AND ts < TIMESTAMP '2024-01-07'")),
    ("project_columns", rows({"where": {"ts": RANGE}, "select": ["value", "event_id"], "limit": 500}), _page_sql("ts DESC, event_id", 0, 500, "value, event_id")),
    ("project_alias", plan({"filter": SPAN, "projection": [{"field": "event_id", "alias": "id"}, {"field": "value", "alias": "amount"}], "page": {"size": 100}}), _page_sql("ts DESC, event_id", 0, 100, "event_id AS id, value AS amount")),
    ("topk_default_order", rows({"where": {"ts": RANGE}, "limit": 50}), _page_sql("ts DESC, event_id", 0, 50)),
    ("order_by_multi", rows({"where": {"ts": RANGE}, "limit": 80, "orderBy": [{"field": "user_id", "direction": "desc"}, {"field": "event_id", "direction": "asc"}]}), _page_sql("user_id DESC, event_id, ts DESC", 0, 80)),
    ("keyset_page_2", keyset_page_2, _page_sql("user_id, ts DESC, event_id", 25, 25)),
    ("get_by_identity", rows({"where": {"event_id": 77}}, operation="get"), f"SELECT {COLUMNS} FROM events WHERE event_id = 77"),
    ("empty_plan", plan({"filter": SPAN, "empty": True}), f"SELECT {COLUMNS} FROM events WHERE false"),
    ("agg_count", aggregate([_metric("n", "count")]), _agg("count(*) AS n")),
    ("agg_count_field", aggregate([_metric("n", "count", "event_type")]), _agg("count(event_type) AS n")),
    ("agg_count_distinct", aggregate([_metric("n", "count", "user_id", distinct=True)]), _agg("count(DISTINCT user_id) AS n")),
    ("agg_sum", aggregate([_metric("total", "sum", "value")], doubles=("total",)), _agg("CAST(sum(value) AS DOUBLE) AS total")),
    ("agg_avg", lambda spark, sf_dir: aggregate([_metric("mean", "avg", "value")])(spark, sf_dir).select(F.round(F.col("mean").cast("double"), 4).alias("mean")), _agg("round(CAST(sum(value) AS DOUBLE) / count(value), 4) AS mean")),
    ("agg_min", aggregate([_metric("least", "min", "value"), _metric("first", "min", "ts")], doubles=("least",)), _agg("CAST(min(value) AS DOUBLE) AS least, min(ts) AS first")),
    ("agg_max", aggregate([_metric("most", "max", "value"), _metric("last", "max", "ts")], doubles=("most",)), _agg("CAST(max(value) AS DOUBLE) AS most, max(ts) AS last")),
    *[(f"agg_quantile_{round(q * 100)}", aggregate([_metric("q", "quantile", "value", quantile=q)], ("event_type",), doubles=("q",)), _agg(_quantile_sql(q), "event_type")) for q in (0.5, 0.95, 0.99)],
    ("agg_percentile", lambda spark, sf_dir: plan({"operation": "aggregate", "filter": SPAN, "groupBy": ["event_type"], "aggregates": [_metric("q", "percentile", "value")], "page": {"size": 100}}, lambda s, d: exact(holed(s, d)), MONEY)(spark, sf_dir).withColumn("q", F.col("q").cast("double")), _agg(_quantile_sql(0.5), "event_type")),
    ("group_by_one", aggregate([_metric("n", "count"), _metric("total", "sum", "value")], ("event_type",), doubles=("total",)), _agg("count(*) AS n, CAST(sum(value) AS DOUBLE) AS total", "event_type")),
    ("group_by_two", lambda spark, sf_dir: exact_groups(spark, sf_dir), f"SELECT event_type, user_id % 50 AS cohort, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total FROM {HOLED_SQL} WHERE {WHERE_RANGE} GROUP BY 1, 2"),
    ("total_over", lambda spark, sf_dir: compile_mapping("query", {"where": {"ts": RANGE}, "limit": 10, "includeTotal": True}, events(spark, sf_dir), EVENTS, SETTINGS).counted, f"SELECT count(*) AS total FROM events WHERE {WHERE_RANGE}"),
    ("dedup_latest", dedup_latest, "SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_extendedprice DESC, l_quantity DESC, l_partkey DESC, l_suppkey DESC, l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC) AS rn FROM lineitem) WHERE rn = 1"),
    ("dedup_append_only", dedup_append_only, f"{_ORDERS_SQL} UNION ALL SELECT part, -1.0::DOUBLE FROM ({_ORDERS_SQL}) WHERE part % 3 = 0"),
    ("put_versions", put_versions, f"SELECT part, CASE WHEN part % 3 = 0 THEN -1.0::DOUBLE ELSE quantity END AS quantity FROM ({_ORDERS_SQL})"),
    ("scope_isolation", scope_isolation, f"SELECT part, quantity FROM ({_ORDERS_SQL}) WHERE part % 2 = 1 AND quantity > 1000"),
    ("retention", retention, "SELECT event_id FROM events WHERE date_trunc('second', ts) + INTERVAL 10 DAY > TIMESTAMP '2024-01-21 00:00:00'"),
    ("append_retry_idempotent", append_retry, f"SELECT event_id AS id, value FROM {_FIRST_SQL}"),
    ("put_records", put_records, f"SELECT event_id AS id, CASE WHEN event_id % 3 <> 0 THEN event_type END AS kind, CASE WHEN event_id % 3 = 0 THEN -1.0::DOUBLE ELSE value END AS value FROM {_FIRST_SQL}"),
    ("wide_decimals", wide_decimals, f"SELECT event_type AS kind, {_wide_sql('sum(event_id + 1)', 'count(*)')} AS total, {_wide_sql('min(event_id + 1)')} AS least, {_wide_sql('max(event_id + 1)')} AS most, {_wide_sql('(list(event_id + 1 ORDER BY event_id))[CAST(floor(0.5 * count(*)) AS INTEGER) + 1]')} AS mid FROM {_FIRST_SQL} GROUP BY event_type"),
    ("evidence_versions", evidence_versions, f"SELECT part, CASE WHEN part % 5 = 0 THEN -2.0::DOUBLE ELSE quantity END AS quantity FROM ({_ORDERS_SQL})"),
    ("cursor_traversal", cursor_traversal, f"SELECT CAST((rn - 1) // 400 AS INTEGER) AS page, event_id FROM (SELECT event_id, row_number() OVER (ORDER BY user_id DESC, ts DESC, event_id) AS rn FROM events WHERE {WHERE_RANGE}) WHERE rn <= 1600"),
]


def exact_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two keys, one of them derived so that there are at most 500 groups."""
    cohorts = compile_schema("structured/demo/events", Schema((*MONEY.fields, Field("cohort", Kind("int64"))), ("event_id",), "ts"), stored=False)
    table = exact(holed(spark, sf_dir)).withColumn("cohort", F.col("user_id") % 50)
    made = compile_mapping("aggregate", {"where": {"ts": RANGE}, "metrics": [_metric("n", "count"), _metric("total", "sum", "value")], "groupBy": ["event_type", "cohort"]}, table, cohorts, SETTINGS).visible
    return made.withColumn("total", F.col("total").cast("double"))


QUERIES = {name: query for name, query, _ in CATALOGUE}
ORACLE_SQL = {name: sql for name, _, sql in CATALOGUE if sql is not None}
