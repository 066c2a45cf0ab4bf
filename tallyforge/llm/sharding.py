"""Placement of keys on shards through a permutation-filled lookup table.

Every shard has its own preference order of the slots of a prime-sized table: a start and a step
hashed from its name.  The shards take turns; each claims the first slot of its order that is still
free, until the table is full.  A key hashes to a slot, and the slot's owner is its shard.  Shares
differ by at most one slot between equal shards, and when a shard leaves, few keys change between
those that stay.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyforge.llm.common import hex_number

SHARDS = tuple(f"shard-{i:02d}" for i in range(32))
# At least a hundred slots per shard keep the shares within one percent of each other.
TABLE_SIZE = 4093


def _number(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:8], 16)


def fill_table(
    shards: Sequence[str], size: int = TABLE_SIZE, turns: Sequence[int] | None = None
) -> list[int]:
    """Owner (index into ``shards``) of each slot; its size depends on the two parameters only.

    ``turns`` gives a shard that many claims per round (1 each by default).
    """
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shards: at least one, each once")
    if size < len(shards) or any(size % d == 0 for d in range(2, int(size**0.5) + 1)):
        raise ValueError("size: a prime, at least the number of shards")
    turns = list(turns or [1] * len(shards))
    if len(turns) != len(shards) or min(turns) < 0 or not any(turns):
        raise ValueError("turns: a count per shard, not all of them 0")
    place = [_number(f"start:{name}") % size for name in shards]
    step = [_number(f"step:{name}") % (size - 1) + 1 for name in shards]
    owner = [-1] * size
    free = size
    while free:
        for shard, claims in enumerate(turns):
            for _ in range(min(claims, free)):
                while owner[place[shard]] >= 0:
                    place[shard] = (place[shard] + step[shard]) % size
                owner[place[shard]] = shard
                free -= 1
    return owner


def lookup_table(
    spark: SparkSession, shards: Sequence[str], size: int = TABLE_SIZE, turns: Sequence[int] | None = None
) -> DataFrame:
    """``slot, shard``: one row per slot."""
    owners = ",".join(map(str, fill_table(shards, size, turns)))
    names = F.array(*[F.lit(name) for name in shards])
    slots = spark.range(1).select(F.posexplode(F.split(F.lit(owners), ",")).alias("slot", "owner"))
    return slots.select("slot", F.element_at(names, F.col("owner").cast("int") + 1).alias("shard"))


def slot_of(key: Column, size: int = TABLE_SIZE) -> Column:
    """Slot of a key: its md5 modulo the table's size; a null key counts as the empty text."""
    text = F.coalesce(key.cast("string"), F.lit(""))
    return F.pmod(hex_number(F.md5(text), 1, 8), F.lit(size)).cast("int")


def place(
    rows: DataFrame,
    key: str,
    shards: Sequence[str] = SHARDS,
    size: int = TABLE_SIZE,
    turns: Sequence[int] | None = None,
    spread_by: str | None = None,
    spread: int = 1,
) -> DataFrame:
    """``rows`` with ``slot`` and ``shard`` (columns of those names are replaced).

    The table has ``size`` rows by construction, so it is broadcast; no row is moved.  Where one key
    may hold a large share of the rows, ``spread_by`` names a column that varies within it: the key
    then has ``spread`` slots, and a row's slot depends on both columns.  Null and empty keys share a
    slot; repeated rows are placed alike; an empty table gives no rows.
    """
    by = F.coalesce(F.col(f"`{key}`").cast("string"), F.lit(""))
    if spread_by:
        part = F.pmod(F.xxhash64(F.col(f"`{spread_by}`")), F.lit(spread))
        by = F.concat_ws("#", by, part.cast("string"))
    kept = [c for c in rows.columns if c not in ("slot", "shard")]
    placed = rows.select(*[F.col(f"`{c}`") for c in kept], slot_of(by, size).alias("slot"))
    table = lookup_table(rows.sparkSession, shards, size, turns)
    return placed.join(F.broadcast(table), "slot").select(*[F.col(f"`{c}`") for c in kept], "slot", "shard")


def shares(placed: DataFrame) -> DataFrame:
    """``shard, n_rows, n_slots``: how evenly the rows fell."""
    return placed.groupBy("shard").agg(
        F.count(F.lit(1)).alias("n_rows"), F.approx_count_distinct("slot").alias("n_slots")
    )
