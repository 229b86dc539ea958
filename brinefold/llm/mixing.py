"""Mixing sources to target weights by Pfair scheduling.

A source's rows are cut into blocks in a fixed pseudo-random order. Of W slots that a period has, a
source of weight w gets w: its block j is released at slot floor(j W / w) and due by slot
ceil((j + 1) W / w), and each slot goes to the released block that is due first. At every slot, each
source is then less than one block from its share. The order of sources repeats with the period, so a
block's slot is arithmetic on its number; only the period is simulated. When a source has no blocks
left, a new phase begins in which the others share its slots by their weights; no row is left out.

Ranks within a source come from hash buckets of about ``BUCKET_ROWS`` rows, more of them the more rows the
source has: counts of (source, bucket) are combined map-side and summed up in order, at two levels, and rows
are only ever sorted within a bucket, so that a source with a third of all rows crowds no task.

Defined results: sources without a weight, null ones too, share the weight ``other`` as one group; rows
with equal or null ids are dealt out and ordered by a hash of all their columns, of any type, and each keeps its own
place (only rows that are equal in every column share a bucket); an empty table gives an empty table; input columns
with the names of the added ones are replaced.
"""

from __future__ import annotations

import heapq
import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from .common import hashable

#: Target weights of the synthetic sources, and of all others together: slots of 100.
WEIGHTS = {"src0": 20} | {f"src{i}": 4 for i in range(1, 20)}
OTHER = 4
BLOCK_ROWS = 8
#: Rows that a bucket is meant to hold.
BUCKET_ROWS = 2000
#: Buckets whose counts are summed up together.
SPAN = 1024
#: Slots of all phases together, as each source that ends begins another: what the driver simulates and tasks look up.
MAX_SLOTS = 2_000_000
ADDED = ("mix_group", "mix_block", "mix_slot", "mix_position")


def period(weights: dict[str, int]) -> dict[str, list[int]]:
    """Slots of each group's blocks within one period, earliest deadline first."""
    total, slots = sum(weights.values()), {g: [] for g in weights}
    waiting, ready = [(0, g) for g in weights], []  # by release, by deadline
    for t in range(total):
        while waiting and waiting[0][0] <= t:
            group = heapq.heappop(waiting)[1]
            heapq.heappush(ready, (-(-(len(slots[group]) + 1) * total // weights[group]), group))
        group = heapq.heappop(ready)[1]
        slots[group].append(t)
        if len(slots[group]) < weights[group]:
            heapq.heappush(waiting, (len(slots[group]) * total // weights[group], group))
    return slots


def phases(blocks: dict[str, int], weights: dict[str, int]) -> list[tuple]:
    """``(group, first block, end block, first slot, weight, period, slots)`` for each phase and group."""
    left = {g: n for g, n in blocks.items() if n}
    done, start, made = dict.fromkeys(left, 0), 0, []
    while left:
        active = {g: weights[g] for g in left}
        total, slots = sum(active.values()), period(active)
        end = min((n - 1) // active[g] * total + slots[g][(n - 1) % active[g]] for g, n in left.items()) + 1
        for g in list(left):
            got = end // total * active[g] + sum(s < end % total for s in slots[g])
            if got:
                made.append((g, done[g], done[g] + got, start, active[g], total, slots[g]))
            done[g] += got
            left[g] -= got
            if not left[g]:
                del left[g]
        start += end
    return made


def mix(docs: DataFrame, **options: object) -> DataFrame:
    """``docs`` with ``mix_group``, ``mix_block`` (number in its group), ``mix_slot`` (from 0) and ``mix_position`` (from 0, without gaps between blocks of full size). Options: those of ``placed``."""
    return placed(docs, **options)[0]


def stream(docs: DataFrame, *, parts: int | None = None, **options: object) -> DataFrame:
    """``mix`` with the rows in the order of their positions: partitions hold equal numbers of slots, one after another.

    A slot names its partition, so texts aren't computed a second time for a sample of the order. ``parts``: as many as a shuffle has, unless given.
    """
    rows, slots = placed(docs, **options)
    parts = max(1, min(slots, parts or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    return rows.repartitionById(parts, (F.col("mix_slot") * parts / max(1, slots)).cast("int")).sortWithinPartitions("mix_position")


def placed(docs: DataFrame, *, weights: dict[str, int] | None = None, other: int = OTHER, block_rows: int = BLOCK_ROWS, id_col: str = "doc_id", source_col: str = "source", seed: int = 7, bucket_rows: int = BUCKET_ROWS) -> tuple[DataFrame, int]:
    """What ``mix`` returns, and the number of slots."""
    weights = dict(WEIGHTS if weights is None else weights)
    if min([other, *weights.values()]) < 1 or len(weights) > 1000 or (len(weights) + 1) * (sum(weights.values()) + other) > MAX_SLOTS:
        raise ValueError(f"weights must be whole numbers from 1, for at most 1000 sources; sources (and the others) times slots of a period may be {MAX_SLOTS}")
    spark, named = docs.sparkSession, list(weights)
    docs = docs.drop(*ADDED)
    aside = {c: f"user{c}" for c in docs.columns if c.startswith("__")}  # names that helper columns could clash with
    docs, id_col, source_col = docs.withColumnsRenamed(aside), aside.get(id_col, id_col), aside.get(source_col, source_col)
    # a group's name is "=" and the source; "" is the group of all others
    source = F.col(f"`{source_col}`").cast("string")
    by_group = {f"={s}": w for s, w in weights.items()} | {"": other}
    group = F.when(source.isin(named), F.concat(F.lit("="), source)).otherwise(F.lit(""))
    mark = F.xxhash64(F.lit(seed), F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")))
    counts = {r[0]: r[1] for r in docs.select(group.alias("g")).groupBy("g").count().collect()}  # a row for each of at most 1001 groups
    buckets = {g: math.ceil(n / bucket_rows) for g, n in counts.items()}
    own = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for g in buckets for x in (g, buckets[g])]), group), F.lit(1)) if buckets else F.lit(1)
    rest = F.xxhash64(*[hashable(f) for f in docs.schema])
    bucket = F.pmod(F.shiftright(F.xxhash64(mark, rest), 7), own)
    rows = docs.select("*", group.alias("mix_group"), bucket.alias("__bucket"), mark.alias("__mark"), rest.alias("__rest"))
    sizes = docs.select(group.alias("mix_group"), bucket.alias("__bucket")).groupBy("mix_group", "__bucket").count().withColumn("__span", F.floor(F.col("__bucket") / SPAN))
    earlier = lambda c, key, by: F.coalesce(F.sum(c).over(W.Window.partitionBy(*key).orderBy(by).rowsBetween(W.Window.unboundedPreceding, -1)), F.lit(0))
    spans = sizes.groupBy("mix_group", "__span").agg(F.sum("count").alias("n")).select("mix_group", "__span", earlier("n", ["mix_group"], "__span").alias("__above"))
    starts = sizes.select("mix_group", "__bucket", "__span", earlier("count", ["mix_group", "__span"], "__bucket").alias("__inside")).join(spans, ["mix_group", "__span"])
    starts = starts.select("mix_group", "__bucket", (F.col("__above") + F.col("__inside")).alias("__before"))
    within = F.row_number().over(W.Window.partitionBy("mix_group", "__bucket").orderBy("__mark", F.col(f"`{id_col}`"), "__rest"))
    ranked = rows.withColumn("__within", within).join(starts, ["mix_group", "__bucket"]).withColumn("__rank", F.col("__before") + F.col("__within") - 1)
    blocks = {g: math.ceil(n / block_rows) for g, n in counts.items()}
    plan = phases(blocks, by_group)
    slots = sum(blocks.values())  # each slot has a block
    schema = "mix_group string, __first long, __end long, __start long, __weight long, __period long, __slots array<long>"
    table = F.broadcast(spark.createDataFrame(plan, schema))  # at most a row for each two groups, its slots checked above
    block = F.floor(F.col("__rank") / block_rows)
    blocked = ranked.withColumn("mix_block", block).join(table, "mix_group").where("mix_block >= __first and mix_block < __end")
    k = F.col("mix_block") - F.col("__first")
    slot = F.col("__start") + F.floor(k / F.col("__weight")) * F.col("__period") + F.element_at("__slots", (F.pmod(k, F.col("__weight")) + 1).cast("int"))
    done = blocked.withColumn("mix_slot", slot).withColumn("mix_position", slot * block_rows + F.pmod(F.col("__rank"), F.lit(block_rows))).select(*[F.col(f"`{c}`") for c in docs.columns], *ADDED)
    return done.withColumnsRenamed({v: k for k, v in aside.items()}), slots
