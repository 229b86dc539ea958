"""Resources, schemas and the layouts compiled from them."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import types as T

from .functions.canonical import canonical_json, fingerprint
from .types import Kind

CATALOGS = ("structured", "evidence")
PROFILES = ("log", "span", "metric", "usage", "cost", "time-series", "analytical")
PARTITIONS = ("hour", "day", "month")
PREFIX = "_sys_"
SCOPE, TENANT, BATCH, ROW, RESOURCE, VERSION, INGESTED, ORDINAL, PERIOD = (PREFIX + n for n in ("scope", "tenant", "batch", "row", "resource", "version", "ingested", "ordinal", "period"))
HIDDEN = ((SCOPE, T.StringType()), (TENANT, T.StringType()), (BATCH, T.StringType()), (ROW, T.StringType()), (RESOURCE, T.StringType()), (VERSION, T.StringType()), (INGESTED, T.LongType()), (ORDINAL, T.LongType()))
PARTITIONED = (SCOPE, PERIOD, BATCH)
_NAME = re.compile(r"[A-Za-z0-9][A-Za-z0-9_.-]{0,126}")


@dataclass(frozen=True, order=True)
class Resource:
    catalog: str
    namespace: str
    name: str

    def __post_init__(self):
        if self.catalog not in CATALOGS:
            raise ValueError(f"a catalog is one of {CATALOGS}")
        if not _NAME.fullmatch(self.namespace) or not _NAME.fullmatch(self.name):
            raise ValueError("a resource's names are letters, digits and _ . -")

    @property
    def canonical(self) -> str:
        return f"{self.catalog}/{self.namespace}/{self.name}"

    @classmethod
    def parse(cls, value: object) -> Resource:
        if isinstance(value, Resource):
            return value
        if isinstance(value, str):
            parts = value.split("/")
        elif isinstance(value, Mapping) and set(value) == {"catalog", "namespace", "name"}:
            parts = [value["catalog"], value["namespace"], value["name"]]
        else:
            raise TypeError("a resource is catalog/namespace/name")
        if len(parts) != 3:
            raise ValueError("a resource is catalog/namespace/name")
        return cls(*parts)


@dataclass(frozen=True)
class Field:
    name: str
    kind: Kind
    nullable: bool = False
    many: bool = False

    @classmethod
    def of(cls, name: str, kind: object, *, nullable: bool = False, many: bool = False) -> Field:
        return cls(name, Kind.parse(kind), nullable, many)

    def spark_field(self) -> T.StructField:
        kind = self.kind.spark_type()
        # a nullable field of many values has nullable elements
        return T.StructField(self.name, T.ArrayType(kind, True) if self.many else kind, self.nullable and not self.many)

    def to_json(self) -> dict:
        return {"name": self.name, "kind": self.kind.to_json(), "nullable": self.nullable, "many": self.many}


@dataclass(frozen=True)
class Schema:
    """A closed set of fields. Without ``timestamp`` the only instant among them is it."""

    fields: tuple[Field, ...]
    identity: tuple[str, ...]
    timestamp: str | None = None
    dimensions: tuple[str, ...] = ()
    measurements: tuple[str, ...] = ()
    indexes: tuple[str, ...] = ()
    version: str = "1.0.0"
    consistency: str = "eventual"


@dataclass(frozen=True)
class Layout:
    """How one resource is stored and what its columns mean. ``stored`` is False for a foreign table without hidden columns."""

    resource: Resource
    fields: tuple[Field, ...]
    identity: tuple[str, ...]
    timestamp: str
    dimensions: tuple[str, ...] = ()
    measurements: tuple[str, ...] = ()
    indexes: tuple[str, ...] = ()
    schema_version: str = "1.0.0"
    profile: str = "analytical"
    partition: str = "month"
    retention_seconds: int | None = None
    append_only: bool = False
    dedup: bool = True
    stored: bool = True
    administrative: tuple[tuple[str, str], ...] = field(default=())

    def __post_init__(self):
        object.__setattr__(self, "fields", tuple(sorted(self.fields, key=lambda f: f.name)))
        known = self.by_name
        for name in known:
            if not name or name.startswith(PREFIX) or "\0" in name or "`" in name:
                raise ValueError(f"a field may not be named {name!r}")
        if len(known) < len(self.fields):
            raise ValueError("two fields have the same name")
        if not self.identity or len(set(self.identity)) < len(self.identity):
            raise ValueError("a resource needs distinct identity fields")
        roles = [("timestamp", [self.timestamp]), ("identity", self.identity), ("dimension", self.dimensions), ("measurement", self.measurements)]
        seen: dict[str, str] = {}
        for role, names in roles:
            for n in names:
                if n not in known:
                    raise ValueError(f"the {role} names an unknown field {n!r}")
                if seen.setdefault(n, role) != role:
                    raise ValueError(f"{n!r} has two roles")
        if known[self.timestamp].kind.name != "utcTimestamp":
            raise ValueError("the timestamp must be an instant")
        if any(known[n].nullable or known[n].many for n in (self.timestamp, *self.identity)):
            raise ValueError("timestamp and identity can be neither null nor many")
        if any(n not in known for n in self.indexes):
            raise ValueError("an index names an unknown field")
        if self.profile not in PROFILES or self.partition not in PARTITIONS:
            raise ValueError(f"a profile is one of {PROFILES}, a partition one of {PARTITIONS}")
        if self.retention_seconds is not None and self.retention_seconds < 1:
            raise ValueError("retention is at least a second")
        if self.append_only and self.resource.catalog != "evidence":
            raise ValueError("only evidence is append-only")

    @cached_property
    def by_name(self) -> dict[str, Field]:
        return {f.name: f for f in self.fields}

    @property
    def names(self) -> tuple[str, ...]:
        return tuple(f.name for f in self.fields)

    @property
    def sort_key(self) -> tuple[str, ...]:
        """Rows with equal values here are versions of one row."""
        key = (SCOPE, self.timestamp, *self.identity) if self.stored else (self.timestamp, *self.identity)
        return (*key, ROW) if self.append_only and self.stored else key

    def field(self, name: object) -> Field:
        if not isinstance(name, str) or name not in self.by_name:
            raise ValueError(f"unknown field {name!r}")
        return self.by_name[name]

    def spark_schema(self) -> T.StructType:
        """All stored columns; those of the partition path last."""
        user = [f.spark_field() for f in self.fields]
        if not self.stored:
            return T.StructType(user)
        inner = [T.StructField(n, t) for n, t in HIDDEN if n not in PARTITIONED]
        return T.StructType([*inner, *user, *(T.StructField(n, T.StringType()) for n in PARTITIONED)])

    @property
    def schema_fingerprint(self) -> str:
        return fingerprint({"fields": [f.to_json() for f in self.fields], "identity": list(self.identity), "timestamp": self.timestamp, "version": self.schema_version})

    def _body(self) -> dict:
        return {
            "resource": self.resource.canonical, "fields": [f.to_json() for f in self.fields], "identity": list(self.identity), "timestamp": self.timestamp,
            "dimensions": list(self.dimensions), "measurements": list(self.measurements), "indexes": list(self.indexes), "schemaVersion": self.schema_version,
            "profile": self.profile, "partition": self.partition, "retentionSeconds": self.retention_seconds, "appendOnly": self.append_only, "dedup": self.dedup,
            "stored": self.stored, "administrative": [list(x) for x in self.administrative],
        }

    @property
    def layout_fingerprint(self) -> str:
        return fingerprint(self._body())

    def to_dict(self) -> dict:
        return self._body() | {"layoutFingerprint": self.layout_fingerprint}

    @classmethod
    def from_dict(cls, value: Mapping[str, object]) -> Layout:
        """A layout from its document, whose fingerprint must be right."""
        body = dict(value)
        mark = body.pop("layoutFingerprint", None)
        if mark != fingerprint(body):
            raise ValueError("the layout's fingerprint is wrong")
        try:
            made = cls(
                Resource.parse(body.pop("resource")), tuple(Field(f["name"], Kind.parse(f["kind"]), f["nullable"], f["many"]) for f in body.pop("fields")), tuple(body.pop("identity")), body.pop("timestamp"),
                tuple(body.pop("dimensions")), tuple(body.pop("measurements")), tuple(body.pop("indexes")), body.pop("schemaVersion"), body.pop("profile"), body.pop("partition"),
                body.pop("retentionSeconds"), body.pop("appendOnly"), body.pop("dedup"), body.pop("stored"), tuple(tuple(x) for x in body.pop("administrative")),
            )
        except KeyError as e:
            raise ValueError(f"the layout lacks {e}") from e
        if body:
            raise ValueError(f"the layout has unknown keys {sorted(body)}")
        return made


def compile_schema(resource: Resource | str, schema: Schema, *, profile: str = "analytical", partition: str = "month", retention_seconds: int | None = None, dedup: bool = True, append_only: bool | None = None, stored: bool = True, administrative: Sequence[tuple[str, str]] = ()) -> Layout:
    """The layout of a resource. Evidence is append-only unless said otherwise."""
    resource = Resource.parse(resource)
    if schema.consistency != "eventual":
        raise ValueError("only eventual consistency is offered")
    timestamp = schema.timestamp
    if timestamp is None:
        instants = [f.name for f in schema.fields if f.kind.name == "utcTimestamp"]
        if len(instants) != 1:
            raise ValueError("name the timestamp: there is not exactly one instant")
        timestamp = instants[0]
    if append_only is None:
        append_only = resource.catalog == "evidence" and stored
    return Layout(resource, tuple(schema.fields), tuple(schema.identity), timestamp, tuple(schema.dimensions), tuple(schema.measurements), tuple(schema.indexes), schema.version, profile, partition, retention_seconds, append_only, dedup, stored, tuple(administrative))


def layout_document(layout: Layout) -> str:
    return canonical_json(layout.to_dict())
