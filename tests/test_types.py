import base64
from datetime import date
from decimal import Decimal

import pytest
from hypothesis import given
from hypothesis import strategies as st

from brinefold.functions import decimals
from brinefold.functions.timestamps import format_instant, parse_instant, period_text
from brinefold.types import KINDS, Kind


@pytest.mark.parametrize(
    "text,ticks",
    [
        ("1970-01-01T00:00:00Z", 0),
        ("1970-01-01T00:00:00.000000001Z", 1),
        ("1969-12-31T23:59:59.999999999Z", -1),
        ("1970-01-01 01:00:00+01:00", 0),
        ("1970-01-01t00:00:00.5z", 500_000_000),
        ("2024-01-02T03:04:05.123456789-02:30", 1704173645123456789),
    ],
)
def test_instants(text, ticks):
    assert parse_instant(text) == ticks
    assert parse_instant(format_instant(ticks)) == ticks


@pytest.mark.parametrize("text", ["2024-01-01T00:00:00", "2024-01-01", "2024-01-01T00:00:00.1234567890Z", "2024-13-01T00:00:00Z", "2500-01-01T00:00:00Z", "2024-01-01T00:00:00+1:00", ""])
def test_what_is_no_instant(text):
    with pytest.raises(ValueError):
        parse_instant(text)


def test_spelling_of_instants():
    assert format_instant(1_000) == "1970-01-01T00:00:00.000001Z"
    assert format_instant(1) == "1970-01-01T00:00:00.000000001Z"
    assert format_instant(10**9) == "1970-01-01T00:00:01Z"
    assert period_text(-1, "hour") == "1969-12-31-23"
    with pytest.raises(TypeError):
        parse_instant(5)


@given(st.integers(-(2**63), 2**63 - 1))
def test_instants_round_trip(ticks):
    assert parse_instant(format_instant(ticks)) == ticks


ACCEPTED = [
    ("boolean", True, True), ("int8", -128, -128), ("int16", 32767, 32767), ("int32", -(2**31), -(2**31)), ("int64", 2**63 - 1, 2**63 - 1), ("duration", 5, 5),
    ("float64", 3, 3.0), ("float64", 1.5, 1.5), ("string", "ä", "ä"), ("enum", "any", "any"), ("bytes", base64.b64encode(b"\0x").decode(), bytearray(b"\0x")),
    ("uuid", "12345678-1234-5678-1234-56781234567A", "12345678-1234-5678-1234-56781234567a"), ("utcTimestamp", "1970-01-01T00:00:01Z", 10**9), ("date", "2024-02-29", date(2024, 2, 29)),
    ("json", {"b": 1, "a": [None]}, '{"a":[null],"b":1}'), ("recordRef", {"x": "y"}, '{"x":"y"}'), ("objectRef", "o", '"o"'), ("wgs84Point", [180, -90], (180.0, -90.0)),
    ({"kind": "decimal", "precision": 10, "scale": 2}, "12.34", Decimal("12.34")), ({"kind": "decimal", "precision": 10, "scale": 1}, 0.1, Decimal("0.1")),
]


@pytest.mark.parametrize("kind,value,stored", ACCEPTED)
def test_accepted(kind, value, stored):
    made = Kind.parse(kind)
    assert made.coerce(value) == stored
    assert made.coerce([value, None], many=True) == [stored, None]
    assert made.coerce(None) is None


REFUSED = [
    ("boolean", 1), ("int8", 128), ("int8", True), ("int64", 2**63), ("int32", 1.0), ("float64", float("nan")), ("float64", "1"), ("float64", True), ("string", 5), ("enum", None.__class__),
    ("bytes", "=="), ("bytes", b"x"), ("uuid", "x"), ("utcTimestamp", "2024-01-01"), ("date", "2024-02-30"), ("date", 5), ("json", float("inf")), ("wgs84Point", [181, 0]), ("wgs84Point", [0]),
    ("wgs84Point", ["1", 2]), ("wgs84Point", [True, 2]), ({"kind": "decimal", "precision": 3, "scale": 1}, "1000"), ({"kind": "decimal", "precision": 3, "scale": 1}, "1.23"),
    ({"kind": "decimal", "precision": 3, "scale": 1}, "NaN"), ({"kind": "decimal", "precision": 3, "scale": 1}, "x"), ({"kind": "decimal", "precision": 3, "scale": 1}, True),
]


@pytest.mark.parametrize("kind,value", REFUSED)
def test_refused(kind, value):
    with pytest.raises((TypeError, ValueError)):
        Kind.parse(kind).coerce(value)


def test_many_needs_an_array():
    for value in ("abc", 5, None):
        with pytest.raises(TypeError):
            Kind("string").coerce(value, many=True)


def test_kinds():
    assert len(KINDS) == 18
    for bad in ("map", {"kind": "decimal", "precision": 77, "scale": 0}, {"kind": "decimal", "precision": 5, "scale": 6}):
        with pytest.raises(ValueError):
            Kind.parse(bad)


@given(st.integers(-(10**76) + 1, 10**76 - 1), st.integers(-(10**76) + 1, 10**76 - 1))
def test_wide_decimals_sort_and_round_trip(a, b):
    x, y = (decimals.encode(Decimal(n).scaleb(-18) if abs(n) < 10**28 else Decimal(n), 76, 18 if abs(n) < 10**28 else 0) for n in (a, b))
    assert decimals.decode(x, 0) == a and decimals.decode(y, 0) == b
    assert (x < y) == (a < b)


def test_results_are_spelled_as_json():
    point = Kind.parse({"kind": "decimal", "precision": 76, "scale": 18})
    golden = "1234567890123456789012345678901234567890123456789012345678.123456789012345678"
    assert point.to_result(point.coerce(golden)) == golden
    assert Kind("json").to_result('{"a":1}') == {"a": 1}
    assert Kind("date").to_result(date(2024, 1, 2)) == "2024-01-02"
    assert Kind("bytes").to_result(bytearray(b"\xff")) == "/w=="
    with pytest.raises(ValueError):
        Kind("float64").to_result(float("inf"))
