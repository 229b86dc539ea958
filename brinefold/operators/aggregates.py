"""Exact aggregates. None is approximated.

A quantile is found in two passes. The first takes a sketch of each group along with the other aggregates, whose
error is bounded by rank: two of its values enclose the place sought. The second counts the values between them, and
all smaller ones together, both combined map-side; only what lies between is put in order. So no task holds a group.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from ..functions.decimals import wide_sum
from ..layout import Layout
from ..types import NUMERIC_KINDS, Kind
from .predicates import column

FUNCTIONS = ("count", "sum", "avg", "min", "max", "quantile")
#: Ranks of a sketch are right to one part in so many.
ACCURACY = 10_000
_ALL = "_sys_all"


@dataclass(frozen=True)
class Metric:
    name: str
    function: str
    field: str | None = None
    distinct: bool = False
    quantile: float | None = None


def _order(values: Column, kind: Kind) -> Column | None:
    """A number whose order is the values' (ties may be more); none for decimals of over 38 digits."""
    if kind.wide:
        return None
    number = values.cast("double")
    return F.when(F.isnan(number), F.lit(float("inf"))).otherwise(number)


def _same(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    return reduce(lambda x, y: x & y, (left[f"`{k}`"].eqNullSafe(right[f"`{k}`"]) for k in keys))


def lower_quantile(rows: DataFrame, known: DataFrame, keys: Sequence[str], metric: Metric, layout: Layout, name: str) -> DataFrame:
    """``keys`` and in ``name`` the value at place floor(q n) from 0 of the sorted values that are not null.

    ``known`` has a row for each group: its keys, and what ``_enclosing`` says of the metric. It is broadcast, and the
    caller bounds its rows.
    """
    field = layout.field(metric.field)
    values, order = column(field), _order(column(field), field.kind)
    own = known.select(*[F.col(f"`{k}`").alias(f"_sys_key{i}") for i, k in enumerate(keys)], *[F.col(f"{name}_{x}").alias(f"_sys_{x}") for x in ("n", "lo", "hi")])
    met = rows.where(values.isNotNull()).join(F.broadcast(own), reduce(lambda x, y: x & y, (F.col(f"`{k}`").eqNullSafe(F.col(f"_sys_key{i}")) for i, k in enumerate(keys))))
    inside = F.lit(True)
    if order is not None:
        met, inside = met.where(order <= F.col("_sys_hi")), order >= F.col("_sys_lo")
    # values below are counted as one, null
    counted = met.groupBy(*[F.col(f"`{k}`") for k in keys], "_sys_n", F.when(inside, values).alias(name)).agg(F.count("*").alias("_sys_count"))
    upto = F.sum("_sys_count").over(W.Window.partitionBy(*[F.col(f"`{k}`") for k in keys]).orderBy(F.col(name).asc_nulls_first()).rowsBetween(W.Window.unboundedPreceding, 0))
    place = F.floor(F.lit(metric.quantile) * F.col("_sys_n")) + 1
    ranked = counted.withColumn("_sys_upto", upto)
    return ranked.where((F.col("_sys_upto") >= place) & (F.col("_sys_upto") - F.col("_sys_count") < place)).select(*[F.col(f"`{k}`") for k in keys], name)


def _enclosing(metric: Metric, layout: Layout, name: str) -> list[Column]:
    field = layout.field(metric.field)
    order = _order(column(field), field.kind)
    count = F.count(column(field)).alias(f"{name}_n")
    if order is None:
        return [count, F.lit(None).cast("double").alias(f"{name}_lo"), F.lit(None).cast("double").alias(f"{name}_hi")]
    shares = [max(0.0, metric.quantile - 3 / ACCURACY), min(1.0, metric.quantile + 3 / ACCURACY)]
    both = F.percentile_approx(order, F.array(*map(F.lit, shares)), F.lit(ACCURACY))
    return [count, both[0].alias(f"{name}_lo"), both[1].alias(f"{name}_hi")]


def aggregate(rows: DataFrame, layout: Layout, keys: Sequence[str], metrics: Sequence[Metric], most: int) -> tuple[DataFrame, list[Kind | None]]:
    """A row for each group, ``most`` of them at most in the order of their keys, and the kinds that the metrics are spelled by."""
    made = [expression(m, layout) for m in metrics]
    wanted = [(f"_sys_quantile{i}", m) for i, m in enumerate(metrics) if m.function == "quantile"]
    columns = [e.alias(m.name) for m, (e, _) in zip(metrics, made) if m.function != "quantile"] + [c for name, m in wanted for c in _enclosing(m, layout, name)]
    if keys:
        by = list(keys)
        frame = rows.groupBy(*[column(layout.field(k)) for k in keys]).agg(*columns)
        frame = frame.orderBy(*[F.col(f"`{k}`") for k in keys]).limit(most) if wanted else frame.limit(most)
    else:
        by, rows, frame = [_ALL], rows.withColumn(_ALL, F.lit(1)), rows.agg(*columns).withColumn(_ALL, F.lit(1))
    whole = frame
    for name, metric in wanted:
        found = lower_quantile(rows, frame, by, metric, layout, name)
        whole = whole.join(F.broadcast(found), _same(whole, found, by), "left").select(whole["*"], found[name])
    names = [F.col(f"`{m.name}`") if m.function != "quantile" else F.col(f"_sys_quantile{i}").alias(m.name) for i, m in enumerate(metrics)]
    return whole.select(*[F.col(f"`{k}`") for k in keys], *names), [kind for _, kind in made]


def expression(metric: Metric, layout: Layout) -> tuple[Column | None, Kind | None]:
    """The aggregate (None of a quantile, which is none of its own), and the kind that its result is spelled by (None: as it is)."""
    if metric.function not in FUNCTIONS:
        raise ValueError(f"unsupported aggregate {metric.function!r}")
    if (metric.quantile is not None) != (metric.function == "quantile"):
        raise ValueError("a quantile, and only a quantile, has a share")
    if metric.distinct and (metric.function != "count" or metric.field is None):
        raise ValueError("only a count of a field can be distinct")
    if metric.field is None:
        if metric.function != "count":
            raise ValueError(f"{metric.function} needs a field")
        return F.count(F.lit(1)), None
    field = layout.field(metric.field)
    values, kind = column(field), field.kind
    if metric.function == "count":
        return (F.count_distinct(values) if metric.distinct else F.count(values)), None
    if metric.function in ("min", "max"):
        return (F.min(values) if metric.function == "min" else F.max(values)), kind
    if kind.name not in NUMERIC_KINDS or field.many:
        raise ValueError(f"{metric.function} needs a field of numbers")
    if metric.function == "quantile":
        q = metric.quantile
        if isinstance(q, bool) or not isinstance(q, (int, float)) or not 0 < q < 1:
            raise ValueError("a quantile's share is between 0 and 1")
        return None, kind
    if kind.wide:
        if metric.function == "avg":
            raise ValueError("the average of a decimal over 38 digits is not offered: take sum and count")
        return wide_sum(values), kind
    if metric.function == "sum":
        return F.sum(values), kind if kind.name == "decimal" else None
    return F.avg(values), Kind("float64") if kind.name != "decimal" else Kind("decimal", 38, min(38, kind.scale + 4))


def metrics_of(value: object) -> list[Metric]:
    """Metrics from their closed objects; at least one."""
    if not isinstance(value, Sequence) or isinstance(value, (str, bytes)) or not value:
        raise ValueError("an aggregate needs an array of metrics")
    made = []
    for item in value:
        if not isinstance(item, dict) or not set(item) <= {"name", "function", "field", "distinct", "quantile"}:
            raise ValueError("a metric has name, function, field, distinct and quantile")
        if not isinstance(item.get("name"), str) or not item["name"] or not isinstance(item.get("function"), str):
            raise ValueError("a metric needs a name and a function")
        if not isinstance(item.get("distinct", False), bool):
            raise TypeError("distinct is a boolean")
        made.append(Metric(item["name"], item["function"], item.get("field"), item.get("distinct", False), item.get("quantile")))
    if len({m.name for m in made}) < len(made):
        raise ValueError("two metrics have the same name")
    return made
