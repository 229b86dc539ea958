"""Read-time deduplication of versions.

A row's versions have the same sort key. Of structured data the last one is kept: that ingested last,
and within a batch the last in order. Append-only keys contain the row's fingerprint, so that
only identical rows fall together. Deduplication stands below all predicates that are not on the key;
the optimizer moves those on the key through the window into the scan, and cuts each key down to one
row map-side before the shuffle, so a key with very many versions does not crowd one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from ..layout import INGESTED, ORDINAL, ROW, Layout

_RANK = "_sys_rank"


def latest(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row of each key: the first in ``order``."""
    window = W.Window.partitionBy(*[F.col(f"`{k}`") for k in keys]).orderBy(*order)
    return df.withColumn(_RANK, F.row_number().over(window)).where(F.col(_RANK) == 1).drop(_RANK)


def collapse(df: DataFrame, layout: Layout) -> DataFrame:
    """A stored table without the versions that were replaced."""
    return latest(df, layout.sort_key, [F.col(INGESTED).desc(), F.col(ORDINAL).desc(), F.col(ROW).asc()])
