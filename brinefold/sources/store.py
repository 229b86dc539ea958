"""Tables of Parquet files: ``<root>/<resource>/data/_sys_scope=/_sys_period=/_sys_batch=``.

Scope and period are partition columns. A query names its scope's folders of its time range to the reader, so that no
others are even listed. Rows within a file are sorted by the sort key, whose row-group statistics then skip within it.

A batch is written below its own identifier with dynamic partition overwrite. A ledger entry is made before,
with the ingestion time, and another after. A retry of a batch that was finished writes nothing; one of a batch that
was not writes again with the first ingestion time, so that a late retry can't overtake newer versions.

Compaction adds a batch to a period and a note of the batches that it replaces, ``<root>/<resource>/replaced/<scope>/<period>/``.
The note decides what readers see: until it is there, not the new batch, and from then on, not the old ones. Those are
deleted only by a later ``sweep``, as queries that began before may still read them.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..errors import LayoutDrift, LimitExceeded, OperationInvalid
from ..functions.canonical import canonical_json, row_fingerprint
from ..functions.timestamps import SECOND, period_of, period_text
from ..layout import BATCH, INGESTED, ORDINAL, PARTITIONED, PERIOD, RESOURCE, ROW, SCOPE, TENANT, VERSION, Layout
from ..operators.dedup import collapse
from ..settings import Settings
from .files import Files


@dataclass(frozen=True)
class Receipt:
    accepted_rows: int
    batch_id: str
    visibility: str = "eventual"

    def to_dict(self) -> dict:
        return {"acceptedRows": self.accepted_rows, "batchId": self.batch_id, "visibility": self.visibility}


def records_of(value: object) -> list[Mapping[str, object]]:
    """One record or an array of them."""
    found = [value] if isinstance(value, Mapping) else value
    if not isinstance(found, Sequence) or isinstance(found, (str, bytes)):
        raise TypeError("a batch is a record or an array of records")
    if any(not isinstance(r, Mapping) or any(not isinstance(k, str) for k in r) for r in found):
        raise TypeError("a record is an object")
    return list(found)


def check_bounds(records: Sequence[Mapping[str, object]], settings: Settings) -> None:
    if not records:
        raise OperationInvalid("a batch needs a record")
    if len(records) > settings.max_batch_rows:
        raise LimitExceeded(f"a batch has up to {settings.max_batch_rows} rows")
    if len(canonical_json(list(records)).encode()) > settings.max_batch_bytes:
        raise LimitExceeded(f"a batch has up to {settings.max_batch_bytes} bytes")


def coerce(record: Mapping[str, object], layout: Layout) -> dict[str, object]:
    """Stored values of a record, which may have the schema's fields only and needs those that can't be null."""
    stored, wrong = {}, [f"has unknown fields {sorted(odd)}"] if (odd := record.keys() - layout.by_name.keys()) else []
    for name, field in layout.by_name.items():
        if not field.nullable and record.get(name) is None:
            wrong.append(f"has a null for {name!r}" if name in record else f"lacks {name!r}")
            continue
        try:
            stored[name] = field.kind.coerce(record.get(name), many=field.many)
        except (TypeError, ValueError) as e:
            wrong.append(f"has a wrong {name!r}: {e}")
    if wrong:
        raise OperationInvalid(f"the record {wrong[0]}")
    return stored


#: Name of a batch that compaction made.
COMPACTED = "compact-"
#: Partitions that one job compacts.
COMPACT_AT_A_TIME = 1000


class Store:
    def __init__(self, spark: SparkSession, settings: Settings, clock_ns=time.time_ns):
        self.spark, self.settings, self._clock, self.files = spark, settings, clock_ns, Files(spark)

    def _base(self, layout: Layout) -> str:
        return f"{self.settings.root.rstrip('/')}/{layout.resource.canonical}"

    def data_path(self, layout: Layout) -> str:
        return f"{self._base(layout)}/data"

    def table(self, layout: Layout, scope: str | None = None, span: tuple[int, int] | None = None) -> DataFrame:
        """All rows and columns as they are stored, of a scope and of the periods that a range of instants touches if given.

        The schema is given, never inferred, and only folders that can hold such rows are listed.
        """
        live = self.files.each(lambda part: self._live(layout, *part), self._partitions(layout, scope, span))
        folders = [x for found in live for x in found]
        if not folders:
            return self.spark.createDataFrame([], layout.spark_schema())
        return self._read(layout, folders)

    def _read(self, layout: Layout, folders: Sequence[str]) -> DataFrame:
        return self.spark.read.schema(layout.spark_schema()).option("basePath", self.data_path(layout)).parquet(*folders)

    def _notes(self, layout: Layout, scope: str, period: str) -> dict[str, dict]:
        """What each compacted batch of a partition replaces, and since when."""
        base = f"{self._base(layout)}/replaced/{scope}/{period}"
        return {n.removesuffix(".json"): json.loads(self.files.read(f"{base}/{n}")) for n in self.files.names(base) if n.endswith(".json")}

    def _batches(self, layout: Layout, scope: str, period: str) -> tuple[list[str], bool]:
        """The batches that readers of a partition see, and whether that is all of them."""
        there = [n.split("=", 1)[1] for n in self.files.names(self._folder(layout, scope, period)) if n.startswith(f"{BATCH}=")]
        notes = self._notes(layout, scope, period)
        gone = {n for note in notes.values() for n in note["replaced"]}
        seen = [n for n in there if n not in gone and (n in notes or not n.startswith(COMPACTED))]
        return seen, len(seen) == len(there)

    def _live(self, layout: Layout, scope: str, period: str) -> list[str]:
        folder = self._folder(layout, scope, period)
        seen, every = self._batches(layout, scope, period)
        return ([folder] if seen else []) if every else [f"{folder}/{BATCH}={n}" for n in seen]

    def create(self, layout: Layout) -> None:
        """Make the folders of a table that has no rows yet."""
        for path in (self.data_path(layout), f"{self._base(layout)}/ledger"):
            self.files.make(path)

    def now(self) -> int:
        return self._clock()

    def _ledger(self, layout: Layout, batch: str, state: str) -> str:
        return f"{self._base(layout)}/ledger/{batch}.{state}"

    def append(self, layout: Layout, records: Sequence[Mapping[str, object]], *, scope: str, tenant: str | None, batch: str) -> Receipt:
        check_bounds(records, self.settings)
        rows = []
        for n, record in enumerate(records):
            values = coerce(record, layout)
            hidden = {TENANT: tenant or "", ROW: "", RESOURCE: layout.resource.canonical, VERSION: layout.schema_version, INGESTED: 0, ORDINAL: n}
            rows.append(hidden | values | {SCOPE: scope, PERIOD: period_text(values[layout.timestamp], layout.partition), BATCH: batch})
        schema = layout.spark_schema()
        return self._write(layout, lambda: self.spark.createDataFrame([tuple(r[f.name] for f in schema.fields) for r in rows], schema).withColumn(ROW, row_fingerprint(layout.names)), batch)

    def append_frame(self, layout: Layout, frame: DataFrame, *, scope: str, tenant: str | None, batch: str) -> Receipt:
        """Append a frame of stored types, of any size, without rows passing through the driver.

        Its columns must be just the layout's. Of equal keys in it the one whose fingerprint sorts last wins.
        """
        if set(frame.columns) != set(layout.names):
            raise OperationInvalid("the frame's columns must be the schema's")
        for f in layout.fields:
            if frame.schema[f.name].dataType != f.spark_field().dataType:
                raise OperationInvalid(f"{f.name!r} has the type {frame.schema[f.name].dataType.simpleString()}")
        strict = [n for n, f in layout.by_name.items() if not f.nullable]
        checked = frame.select(*[F.coalesce(F.col(f"`{n}`"), F.raise_error(F.lit(f"{n} can't be null"))).alias(n) if n in strict else F.col(f"`{n}`") for n in layout.names])
        mark = row_fingerprint(layout.names)
        ticks = F.col(f"`{layout.timestamp}`")
        hidden = {TENANT: F.lit(tenant or ""), ROW: mark, RESOURCE: F.lit(layout.resource.canonical), VERSION: F.lit(layout.schema_version), INGESTED: F.lit(0).cast("long"), ORDINAL: F.conv(F.substring(mark, 1, 15), 16, 10).cast("long"), SCOPE: F.lit(scope), PERIOD: period_of(ticks, layout.partition), BATCH: F.lit(batch)}
        rows = checked.select("*", *[c.alias(n) for n, c in hidden.items()]).select(*layout.spark_schema().names)
        # periods together, in as many tasks and files as their sizes ask for
        return self._write(layout, lambda: rows.hint("rebalance", PERIOD), batch)

    def _write(self, layout: Layout, rows: Callable[[], DataFrame], batch: str) -> Receipt:
        done = self.files.read(self._ledger(layout, batch, "done"))
        if done is not None:
            return Receipt(json.loads(done)["rows"], batch)
        self.files.create(self._ledger(layout, batch, "begun"), json.dumps({"ingested": self._clock()}))
        ingested = json.loads(self.files.read(self._ledger(layout, batch, "begun")))["ingested"]
        seen = Observation()
        frame = rows().withColumn(INGESTED, F.lit(ingested).cast("long")).observe(seen, F.count(F.lit(1)).alias("rows"))
        key = [F.col(f"`{k}`") for k in layout.sort_key if k not in PARTITIONED]
        ordered = frame.sortWithinPartitions(*[F.col(c) for c in PARTITIONED], *key)
        ordered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*PARTITIONED).parquet(self.data_path(layout))
        count = seen.get["rows"]
        self.files.create(self._ledger(layout, batch, "done"), json.dumps({"ingested": ingested, "rows": count, "at": self._clock()}))
        return Receipt(count, batch)

    def _partitions(self, layout: Layout, scope: str | None = None, span: tuple[int, int] | None = None) -> list[tuple[str, str]]:
        """(scope, period) of the partitions, from the names of folders."""
        base = self.data_path(layout)
        scopes = [scope] if scope is not None else [n.split("=", 1)[1] for n in self.files.names(base) if n.startswith(f"{SCOPE}=")]
        least, most = ("", "~") if span is None else (period_text(t, layout.partition) for t in span)
        named = self.files.each(lambda s: self.files.names(f"{base}/{SCOPE}={s}"), scopes)
        found = [(s, n.split("=", 1)[1]) for s, names in zip(scopes, named) for n in names if n.startswith(f"{PERIOD}=")]
        return [(s, p) for s, p in found if least <= p <= most]

    def _folder(self, layout: Layout, scope: str, period: str) -> str:
        return f"{self.data_path(layout)}/{SCOPE}={scope}/{PERIOD}={period}"

    def compact(self, layout: Layout) -> int:
        """Rewrite partitions of several finished batches as one each, without replaced versions; partitions rewritten.

        One job rewrites up to ``COMPACT_AT_A_TIME`` partitions, into files of the size that adaptive execution aims at.
        Batches that are begun and not done are left alone.
        """
        ledger = set(self.files.names(f"{self._base(layout)}/ledger"))
        open_ = {n.removesuffix(".begun") for n in ledger if n.endswith(".begun")} - {n.removesuffix(".done") for n in ledger if n.endswith(".done")}
        every = self._partitions(layout)
        seen = self.files.each(lambda part: [n for n in self._batches(layout, *part)[0] if n not in open_], every)
        work = {part: old for part, old in zip(every, seen) if len(old) > 1}
        parts = sorted(work)
        for at in range(0, len(parts), COMPACT_AT_A_TIME):
            own = parts[at : at + COMPACT_AT_A_TIME]
            rows = self._read(layout, [f"{self._folder(layout, *p)}/{BATCH}={n}" for p in own for n in work[p]])
            name, spare = f"{COMPACTED}{uuid.uuid4().hex}", f"{self._base(layout)}/spare-{uuid.uuid4().hex}"
            key = [F.col(f"`{k}`") for k in layout.sort_key if k not in PARTITIONED]
            whole = (collapse(rows, layout) if layout.dedup else rows).drop(BATCH).hint("rebalance", SCOPE, PERIOD)
            whole.sortWithinPartitions(SCOPE, PERIOD, *key).write.partitionBy(SCOPE, PERIOD).parquet(spare)

            def settle(part: tuple[str, str], name: str = name, spare: str = spare) -> None:
                self.files.move(f"{spare}/{SCOPE}={part[0]}/{PERIOD}={part[1]}", f"{self._folder(layout, *part)}/{BATCH}={name}")
                self.files.create(f"{self._base(layout)}/replaced/{part[0]}/{part[1]}/{name}.json", json.dumps({"replaced": work[part], "at": self._clock()}))

            self.files.each(settle, own)
            self.files.delete(spare)
        return len(parts)

    def sweep(self, layout: Layout, grace_seconds: int = 3600) -> int:
        """Delete batches that were replaced longer ago than that; how many."""
        gone = 0
        for scope, period in self._partitions(layout):
            base = f"{self._base(layout)}/replaced/{scope}/{period}"
            for name, note in self._notes(layout, scope, period).items():
                if note["replaced"] and note["at"] + grace_seconds * SECOND < self._clock():
                    for n in note["replaced"]:
                        self.files.delete(f"{self._folder(layout, scope, period)}/{BATCH}={n}")
                        if n.startswith(COMPACTED):
                            self.files.delete(f"{base}/{n}.json")
                    self.files.replace(f"{base}/{name}.json", json.dumps({"replaced": [], "at": note["at"]}))
                    gone += len(note["replaced"])
        return gone

    def expire(self, layout: Layout) -> list[str]:
        """Delete partitions all of whose rows are past their retention; their periods. Reads hide such rows anyway."""
        if layout.retention_seconds is None:
            return []
        edge = period_text(self._clock() - layout.retention_seconds * SECOND, layout.partition)
        gone = [(s, p) for s, p in self._partitions(layout) if p < edge]
        for scope, period in gone:
            self.files.delete(self._folder(layout, scope, period))
            self.files.delete(f"{self._base(layout)}/replaced/{scope}/{period}")
        return sorted({p for _, p in gone})

    def forget(self, layout: Layout) -> int:
        """Drop ledger entries of batches finished longer ago than the retry window; how many."""
        gone = 0
        for name in self.files.names(f"{self._base(layout)}/ledger"):
            if name.endswith(".done"):
                path = f"{self._base(layout)}/ledger/{name}"
                if json.loads(self.files.read(path))["at"] + self.settings.retry_window_seconds * SECOND < self._clock():
                    self.files.delete(path)
                    self.files.delete(path.removesuffix("done") + "begun")
                    gone += 1
        return gone

    # registry

    def _registry(self, layout: Layout) -> str:
        return f"{self.settings.root.rstrip('/')}/registry/{layout.resource.canonical.replace('/', '__')}.json"

    def registered(self) -> list[Layout]:
        base = f"{self.settings.root.rstrip('/')}/registry"
        return [Layout.from_dict(json.loads(self.files.read(f"{base}/{n}"))) for n in self.files.names(base) if n.endswith(".json")]

    def registry_entry(self, layout: Layout) -> Layout | None:
        text = self.files.read(self._registry(layout))
        return None if text is None else Layout.from_dict(json.loads(text))

    def register(self, layout: Layout) -> None:
        known = self.registry_entry(layout)
        if known is not None and known.layout_fingerprint != layout.layout_fingerprint:
            raise LayoutDrift(f"{layout.resource.canonical} is registered with another layout")
        if known is None:
            self.files.create(self._registry(layout), canonical_json(layout.to_dict()))
