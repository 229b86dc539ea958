"""Decimals of up to 76 digits.

Spark's own decimals have 38 digits. Wider ones are scaled integers in three limbs of base 10 ** 27,
split by floor division, so that only the highest limb has a sign: the struct then sorts like the
number, and sums of limbs add up to the sum.
"""

from __future__ import annotations

from decimal import Decimal, localcontext

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_PRECISION = 76
BASE = 10**27
LIMBS = ("h", "m", "l")


def wide_type() -> T.StructType:
    return T.StructType([T.StructField(n, T.DecimalType(27, 0)) for n in LIMBS])


def encode(value: Decimal, precision: int, scale: int) -> tuple[Decimal, Decimal, Decimal]:
    number = scaled(value, precision, scale)
    rest, low = divmod(number, BASE)
    high, middle = divmod(rest, BASE)
    return Decimal(high), Decimal(middle), Decimal(low)


def scaled(value: Decimal, precision: int, scale: int) -> int:
    with localcontext() as context:
        context.prec = 200
        moved = value.scaleb(scale)
        if moved != moved.to_integral_value():
            raise ValueError(f"a decimal has more than {scale} fractional digits")
        number = int(moved)
    if abs(number) >= 10**precision:
        raise ValueError(f"a decimal has more than {precision} digits")
    return number


def decode(limbs: tuple | None, scale: int) -> Decimal | None:
    """Also of sums of limbs, which may be wider than a limb."""
    if limbs is None or limbs[0] is None:
        return None
    number = (int(limbs[0]) * BASE + int(limbs[1])) * BASE + int(limbs[2])
    with localcontext() as context:
        context.prec = 200
        return Decimal(number).scaleb(-scale)


def wide_sum(column: Column) -> Column:
    return F.struct(*[F.sum(column[n]).alias(n) for n in LIMBS])
