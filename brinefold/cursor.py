"""Signed, expiring places in an ordered result."""

from __future__ import annotations

import base64
import hashlib
import hmac
import json
import time
from collections.abc import Mapping

from .errors import CursorInvalid
from .functions.canonical import canonical_json


class CursorSigner:
    """Issues and verifies cursors with a key derived from a secret."""

    def __init__(self, secret: str, ttl_seconds: int, clock=time.time):
        self._key = hashlib.sha256(b"brinefold cursor\0" + secret.encode()).digest()
        self._ttl, self._clock = ttl_seconds, clock

    def _mark(self, body: bytes) -> str:
        return hmac.new(self._key, body, hashlib.sha256).hexdigest()

    def issue(self, binding: Mapping[str, object], place: list[object]) -> str:
        body = canonical_json({"binding": dict(binding), "place": place, "expires": int(self._clock()) + self._ttl}).encode()
        return base64.urlsafe_b64encode(body).decode().rstrip("=") + "." + self._mark(body)

    def verify(self, token: object, binding: Mapping[str, object]) -> list[object]:
        """The place, if the cursor was issued for just this query, schema, scope and page size and is not too old."""
        if not isinstance(token, str) or token.count(".") != 1:
            raise CursorInvalid("a cursor is opaque text")
        text, mark = token.split(".")
        try:
            body = base64.urlsafe_b64decode(text + "=" * (-len(text) % 4))
        except ValueError as e:
            raise CursorInvalid("the cursor is damaged") from e
        if not hmac.compare_digest(self._mark(body), mark):
            raise CursorInvalid("the cursor's signature is wrong")
        found = json.loads(body)
        if found["binding"] != dict(binding):
            raise CursorInvalid("the cursor belongs to another query, schema, scope or page size")
        if found["expires"] < self._clock():
            raise CursorInvalid("the cursor has expired")
        return found["place"]
