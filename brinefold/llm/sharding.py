"""Shard placement by a permutation-filled lookup table.

Every shard has its own preference order over the slots of a table of prime size, and the shards take
turns claiming the slot that they like best of those still free. A row's key is hashed to a slot; the
table, whose size is checked, is broadcast, so that placement is one hash and one look-up and no shuffle.
When a shard comes or goes, nearly all slots of the others stay where they were.

Defined results: a null key is placed like the empty string; repeated keys share a shard; an empty table
gives an empty table; columns named ``slot`` or ``shard`` in the input are replaced.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Slots of the table; a prime well over 100 times the shards that are usual.
TABLE_SIZE = 65_537
MAX_TABLE_SIZE = 1_000_003
SHARDS = 64


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % k for k in range(2, int(n**0.5) + 1))


def _number(*parts: object) -> int:
    return int.from_bytes(hashlib.md5("\0".join(map(str, parts)).encode()).digest()[:8], "big")


def fill_table(shards: list[str], size: int = TABLE_SIZE, turns: dict[str, int] | None = None) -> list[int]:
    """Index of the owning shard for each slot. ``turns``: slots that a shard claims each round (1 unless given)."""
    if not shards or len(set(shards)) < len(shards):
        raise ValueError("shards must be distinct and not none")
    if not _is_prime(size) or not len(shards) <= size <= MAX_TABLE_SIZE:
        raise ValueError(f"the table's size must be a prime from the number of shards to {MAX_TABLE_SIZE}")
    at = [_number("offset", s) % size for s in shards]
    step = [_number("step", s) % (size - 1) + 1 for s in shards]
    claims = [(turns or {}).get(s, 1) for s in shards]
    if min(claims) < 1:
        raise ValueError("each shard needs at least one turn")
    owner, free = [-1] * size, size
    while free:
        for i, n in enumerate(claims):
            for _ in range(min(n, free)):
                while owner[at[i]] >= 0:
                    at[i] = (at[i] + step[i]) % size
                owner[at[i]] = i
                free -= 1
    return owner


def table_frame(spark: SparkSession, owner: list[int]) -> DataFrame:
    """``slot``, ``shard``: decoded by the JVM from one binary literal of two bytes a slot."""
    packed = F.lit(bytearray(b"".join(i.to_bytes(2, "big") for i in owner)))
    two = F.hex(F.substring(packed, (F.col("slot") * 2 + 1).cast("int"), F.lit(2)))
    return spark.range(0, len(owner), 1, 4).withColumnRenamed("id", "slot").select("slot", F.conv(two, 16, 10).cast("int").alias("shard"))


def slot_of(key: F.Column, size: int) -> F.Column:
    digits = F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, 15)
    return F.pmod(F.conv(digits, 16, 10).cast("long"), F.lit(size))


def place(docs: DataFrame, *, key: str = "doc_id", shards: int | list[str] = SHARDS, size: int = TABLE_SIZE, turns: dict[str, int] | None = None) -> DataFrame:
    """``docs`` with ``slot`` and ``shard`` (the shard's index in ``shards``)."""
    names = [f"shard-{i}" for i in range(shards)] if isinstance(shards, int) else shards
    if len(names) > 65_536:
        raise ValueError("at most 65536 shards")
    table = F.broadcast(table_frame(docs.sparkSession, fill_table(names, size, turns)))
    return docs.drop("shard").withColumn("slot", slot_of(F.col(f"`{key}`"), size)).join(table, "slot").select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in ("slot", "shard")], "slot", "shard")
