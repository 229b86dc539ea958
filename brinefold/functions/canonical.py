"""Canonical JSON and the fingerprints taken of it.

Rows are fingerprinted by one expression over their stored values, whichever way they come in.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def canonical_json(value: object) -> str:
    """Sorted keys, no spaces, no NaN, text as it is."""
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)


def fingerprint(value: object) -> str:
    return "sha256:" + hashlib.sha256(canonical_json(value).encode()).hexdigest()


def scope_digest(tenant: str | None, scope: Mapping[str, str]) -> str:
    """Hex digest that binds rows to a tenant and scope."""
    return hashlib.sha256(canonical_json({"scope": dict(sorted(scope.items())), "tenant": tenant}).encode()).hexdigest()


def row_fingerprint(names: Sequence[str]) -> Column:
    """Digest of a row with every field of the schema, absent ones as null."""
    whole = F.struct(*[F.col(f"`{n}`") for n in sorted(names)])
    return F.sha2(F.to_json(whole, {"ignoreNullFields": "false"}), 256)
