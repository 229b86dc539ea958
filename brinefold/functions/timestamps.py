"""Instants as signed nanoseconds since 1970 in UTC."""

from __future__ import annotations

import re
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

SECOND = 1_000_000_000
_EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)
#: RFC 3339 with an offset and up to nine fractional digits (fixed value).
INSTANT = r"(\d{4}-\d\d-\d\d)[Tt ](\d\d:\d\d:\d\d)(\.\d{1,9})?([Zz]|[+-]\d\d:[0-5]\d)"
_SHAPE = re.compile(INSTANT, re.ASCII)


def parse_instant(text: object) -> int:
    """Nanoseconds of an RFC 3339 text with an offset and at most nine digits of a second."""
    if not isinstance(text, str):
        raise TypeError("an instant must be text with an offset")
    if not (found := _SHAPE.fullmatch(text)):
        raise ValueError(f"not an instant with an offset and up to nine fractional digits: {text!r}")
    day, clock, part, zone = found.groups()
    whole = datetime.fromisoformat(f"{day}T{clock}{zone.upper()}")
    digits = (part or ".")[1:]
    ticks = int(whole.timestamp()) * SECOND + int(digits + "0" * (9 - len(digits)))
    if ticks.bit_length() > 63 and ticks != -(1 << 63):
        raise ValueError("an instant must fit into 64 bits of nanoseconds")
    return ticks


def format_instant(ticks: int) -> str:
    """Whole microseconds are spelled as such (none if zero), others with nine digits."""
    seconds, part = divmod(ticks, SECOND)
    at = (_EPOCH + timedelta(seconds=seconds)).strftime("%Y-%m-%dT%H:%M:%S")
    at = at.rjust(19, "0")  # years below 1000
    if not part:
        return f"{at}Z"
    return f"{at}.{part // 1000:06d}Z" if part % 1000 == 0 else f"{at}.{part:09d}Z"


def instant_column(text: Column) -> Column:
    """The same for a column of text; null where the text is no instant."""
    piece = lambda n: F.regexp_extract(text, f"^{INSTANT}$", n)
    whole = F.try_to_timestamp(F.concat(piece(1), F.lit("T"), piece(2), F.upper(piece(4))))
    digits = F.rpad(F.substring(piece(3), 2, 9), 9, "0")
    return F.when(text.rlike(f"^{INSTANT}$"), F.unix_seconds(whole) * F.lit(SECOND) + digits.cast("long"))


def period_of(ticks: Column, unit: str) -> Column:
    """Partition value of an instant: ``2024-01``, ``2024-01-31`` or ``2024-01-31-23``."""
    at = F.timestamp_seconds(F.floor(ticks / F.lit(SECOND).cast("decimal(20,0)")).cast("long"))
    return F.date_format(at, {"month": "yyyy-MM", "day": "yyyy-MM-dd", "hour": "yyyy-MM-dd-HH"}[unit])


def period_text(ticks: int, unit: str) -> str:
    at = _EPOCH + timedelta(seconds=ticks // SECOND)
    return at.strftime({"month": "%Y-%m", "day": "%Y-%m-%d", "hour": "%Y-%m-%d-%H"}[unit])
