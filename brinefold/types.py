"""Logical kinds: what they accept, how they are stored, and how results spell them."""

from __future__ import annotations

import base64
import json
import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date
from decimal import Decimal, InvalidOperation
from uuid import UUID

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .functions import decimals
from .functions.canonical import canonical_json
from .functions.timestamps import format_instant, parse_instant

INTEGER_BITS = {"int8": 8, "int16": 16, "int32": 32, "int64": 64, "duration": 64}
_SIMPLE = {
    "boolean": T.BooleanType(),
    "int8": T.ByteType(),
    "int16": T.ShortType(),
    "int32": T.IntegerType(),
    "int64": T.LongType(),
    "float64": T.DoubleType(),
    "string": T.StringType(),
    "bytes": T.BinaryType(),
    "uuid": T.StringType(),
    "utcTimestamp": T.LongType(),
    "date": T.DateType(),
    "duration": T.LongType(),
    "enum": T.StringType(),
    "json": T.StringType(),
    "recordRef": T.StringType(),
    "objectRef": T.StringType(),
    "wgs84Point": T.StructType([T.StructField("lon", T.DoubleType()), T.StructField("lat", T.DoubleType())]),
}
KINDS = (*_SIMPLE, "decimal")
JSON_KINDS = ("json", "recordRef", "objectRef")
NUMERIC_KINDS = (*INTEGER_BITS, "float64", "decimal")


@dataclass(frozen=True)
class Kind:
    """A logical type. ``encoding`` is ``ntz`` for instants that a foreign table holds as timestamps without zone."""

    name: str
    precision: int = 0
    scale: int = 0
    encoding: str = ""

    def __post_init__(self):
        if self.name not in KINDS:
            raise ValueError(f"unsupported logical type {self.name!r}")
        if self.name == "decimal" and not (1 <= self.precision <= decimals.MAX_PRECISION and 0 <= self.scale <= self.precision):
            raise ValueError("a decimal has 1 to 76 digits and no more fractional ones")

    @classmethod
    def parse(cls, value: object) -> Kind:
        if isinstance(value, Kind):
            return value
        if isinstance(value, str):
            return cls(value)
        if isinstance(value, Mapping) and set(value) <= {"kind", "precision", "scale", "encoding"} and isinstance(value.get("kind"), str):
            return cls(value["kind"], int(value.get("precision", 0)), int(value.get("scale", 0)), str(value.get("encoding", "")))
        raise TypeError("a logical type is a name or an object with kind, precision and scale")

    def to_json(self) -> object:
        if self.name == "decimal":
            return {"kind": "decimal", "precision": self.precision, "scale": self.scale}
        return {"kind": self.name, "encoding": self.encoding} if self.encoding else self.name

    @property
    def wide(self) -> bool:
        return self.name == "decimal" and self.precision > 38

    def spark_type(self) -> T.DataType:
        if self.name == "decimal":
            return decimals.wide_type() if self.wide else T.DecimalType(self.precision, self.scale)
        return T.TimestampNTZType() if self.encoding == "ntz" else _SIMPLE[self.name]

    def coerce(self, value: object, *, many: bool = False) -> object:
        """The stored form of a JSON value. Null stays null; elements of arrays may be null."""
        if many:
            if not isinstance(value, Sequence) or isinstance(value, (str, bytes, bytearray)):
                raise TypeError("a field of many values needs an array")
            return [self.coerce(x) for x in value]
        return None if value is None else getattr(self, f"_take_{self.name}", self._take_integer)(value)

    def _take_boolean(self, value: object) -> bool:
        if not isinstance(value, bool):
            raise TypeError("a boolean field needs a boolean")
        return value

    def _take_integer(self, value: object) -> int:
        if isinstance(value, bool) or not isinstance(value, int):
            raise TypeError(f"an {self.name} field needs a whole number")
        edge = 1 << (INTEGER_BITS[self.name] - 1)
        if not -edge <= value < edge:
            raise ValueError(f"{value} is out of the range of {self.name}")
        return value

    def _take_float64(self, value: object) -> float:
        _real(value, "a float64 field's value")
        if not math.isfinite(float(value)):
            raise ValueError("a float64 field needs a finite number")
        return float(value)

    def _text(self, value: object) -> str:
        if not isinstance(value, str):
            raise TypeError(f"a field of kind {self.name} needs text")
        return value

    _take_string = _take_enum = _text

    def _take_bytes(self, value: object) -> bytearray:
        return bytearray(base64.b64decode(self._text(value), validate=True))

    def _take_uuid(self, value: object) -> str:
        return str(UUID(self._text(value)))

    def _take_utcTimestamp(self, value: object) -> int:  # noqa: N802
        return parse_instant(value)

    def _take_date(self, value: object) -> date:
        return date.fromisoformat(self._text(value))

    def _take_json(self, value: object) -> str:
        return canonical_json(value)

    _take_recordRef = _take_objectRef = _take_json  # noqa: N815

    def _take_wgs84Point(self, value: object) -> tuple[float, float]:  # noqa: N802
        if not isinstance(value, Sequence) or isinstance(value, (str, bytes)) or len(value) != 2:
            raise TypeError("a point is [longitude, latitude]")
        lon, lat = (float(_real(x, "a point's coordinate")) for x in value)
        if not (abs(lon) <= 180 and abs(lat) <= 90):
            raise ValueError("a point's coordinates are out of range")
        return lon, lat

    def number(self, value: object) -> Decimal:
        """A decimal. Floating-point numbers count by their shortest spelling, not their binary expansion."""
        text = value if isinstance(value, str) else repr(_real(value, "a decimal field's value"))
        try:
            found = Decimal(text)
        except InvalidOperation as e:
            raise ValueError(f"not a decimal: {value!r}") from e
        if not found.is_finite():
            raise ValueError("a decimal field needs a finite number")
        decimals.scaled(found, self.precision, self.scale)
        return found

    def _take_decimal(self, value: object) -> object:
        found = self.number(value)
        return decimals.encode(found, self.precision, self.scale) if self.wide else found

    def literal(self, value: object, *, many: bool = False) -> Column:
        """A literal of the stored type for comparison with a column of this kind."""
        stored = self.coerce(value, many=many)
        if many:
            return F.array(*[self._literal(x) for x in stored]).cast(T.ArrayType(self.spark_type()))
        return self._literal(stored)

    def _literal(self, stored: object) -> Column:
        if stored is None:
            return F.lit(None).cast(self.spark_type())
        if self.name == "wgs84Point":
            return F.struct(F.lit(stored[0]).alias("lon"), F.lit(stored[1]).alias("lat"))
        if self.wide:
            return F.struct(*[F.lit(x).cast("decimal(27,0)").alias(n) for n, x in zip(decimals.LIMBS, stored)])
        return F.lit(stored).cast(self.spark_type())

    def to_result(self, value: object, *, many: bool = False) -> object:
        """The JSON form of a collected value."""
        if value is None:
            return None
        if many:
            return [self.to_result(x) for x in value]
        if self.name == "utcTimestamp":
            return format_instant(value if isinstance(value, int) else ticks_of(value))
        if self.name == "float64":
            if not math.isfinite(value):
                raise ValueError("a result is not a finite number")
            return value
        if self.name == "bytes":
            return base64.b64encode(bytes(value)).decode()
        if self.name in JSON_KINDS:
            return json.loads(value)
        if self.name == "date":
            return value.isoformat()
        if self.name == "wgs84Point":
            return [value[0], value[1]]
        if self.name == "decimal":
            return format(decimals.decode(value, self.scale) if self.wide else value, "f")
        return value


def _real(value: object, what: str) -> int | float:
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        return value
    raise TypeError(f"{what} must be a number")


def ticks_of(at) -> int:
    """Nanoseconds of a datetime without zone."""
    from datetime import datetime, timedelta

    return (at - datetime(1970, 1, 1)) // timedelta(microseconds=1) * 1000
