"""What an engine offers, whether its environment is fit for it, and whether stored data fit the layouts."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import SparkSession

from .errors import LayoutDrift
from .layout import HIDDEN, PARTITIONED, Layout
from .operators.aggregates import FUNCTIONS
from .operators.predicates import COMPARISONS
from .settings import Settings
from .sources.store import Store
from .types import KINDS

VERSION = "1.0.0"
OPERATIONS = ("evidence.append", "evidence.query", "structured.put", "structured.get", "structured.query", "structured.aggregate")
NEEDED_VERSION = (4, 0)
NEEDED_FUNCTIONS = ("try_element_at", "percentile_approx", "sha2", "to_json", "xxhash64", "row_number")


def manifest(layouts: Sequence[Layout], settings: Settings) -> dict:
    """Capabilities. Append-only is only claimed if all evidence has it."""
    evidence = [x for x in layouts if x.resource.catalog == "evidence"]
    features = ["bounded-time-range", "scope-isolation", "signed-keyset-cursor", "exact-aggregates", "retry-window-deduplication"]
    if evidence and all(x.append_only for x in evidence):
        features.append("append-only")
    return {
        "version": VERSION,
        "operations": {name: [VERSION] for name in OPERATIONS},
        "kinds": sorted(KINDS),
        "predicates": sorted([*COMPARISONS, "in", "notIn", "isNull", "isNotNull", "and", "or", "not", "timestampRange"]),
        "aggregates": sorted([*FUNCTIONS, "percentile"]),
        "features": sorted(features),
        "unsupported": ["atomic-evidence", "compare-and-set", "joins", "native-sql", "offset-pagination", "patch", "transactions", "traversal"],
        "limits": {"pageRows": settings.max_page_size, "batchRows": settings.max_batch_rows, "batchBytes": settings.max_batch_bytes, "timeRangeSeconds": settings.max_time_range_seconds, "retryWindowSeconds": settings.retry_window_seconds, "cursorSeconds": settings.cursor_ttl_seconds, "resultBytes": settings.max_result_bytes},
        "resources": {x.resource.canonical: x.layout_fingerprint for x in sorted(layouts, key=lambda x: x.resource)},
    }


def probe(spark: SparkSession) -> dict:
    """Version, time zone and functions; ``ready`` if all are as needed."""
    numbers = tuple(int(n) for n in re.findall(r"\d+", spark.version)[:2])
    missing = [f for f in NEEDED_FUNCTIONS if not spark.catalog.functionExists(f)]
    zone = spark.conf.get("spark.sql.session.timeZone")
    return {"engine": spark.version, "timeZone": zone, "missingFunctions": missing, "ready": not missing and zone == "UTC" and numbers >= NEEDED_VERSION}


def verify_layout(store: Store, layout: Layout, *, registered: bool = True) -> None:
    """Raise ``LayoutDrift`` unless the registry and the stored files' own schema fit the layout."""
    if registered:
        entry = store.registry_entry(layout)
        if entry is None:
            raise LayoutDrift(f"{layout.resource.canonical} is not registered")
        if entry.layout_fingerprint != layout.layout_fingerprint:
            raise LayoutDrift(f"{layout.resource.canonical} is registered with another layout")
    if not store._partitions(layout):
        return
    own = {f.name: f.dataType for f in store.spark.read.parquet(store.data_path(layout)).schema.fields}
    wanted = {f.name: f.dataType for f in layout.spark_schema().fields}
    for name in PARTITIONED:
        if name not in own:
            raise LayoutDrift(f"{layout.resource.canonical} is not partitioned by {name}")
        own.pop(name), wanted.pop(name)
    odd = sorted(n for n in own.keys() | wanted.keys() if own.get(n) != wanted.get(n))
    if odd:
        raise LayoutDrift(f"{layout.resource.canonical} differs from its layout in {odd}")
    assert {n for n, _ in HIDDEN} - set(PARTITIONED) <= set(own)
