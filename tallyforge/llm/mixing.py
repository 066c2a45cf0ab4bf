"""Mixing of sources to target weights by fair scheduling of blocks.

A source of weight w has windows: its block k (from 0) is released at floor(k / w) and due at
ceil((k + 1) / w), counted in slots of one block each.  In every slot the released block that is due
first is taken.  Since the weights add up to one, every block meets its window, and at any slot t a
source has had within less than one block of w * t.

With weights in whole units the schedule repeats after as many slots as there are units, so the slot
of any block follows from one period.  When a source runs out, the others go on with their weights
scaled up and their windows begun anew: nothing is repeated and nothing left out.
"""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyforge.llm.common import digest_block, ranked, shuffle_partitions

# Target weights of the sources of ``documents``, in units.  Source 0, by far the largest, is held
# down; all sources without an entry (null too) share one pool.
TARGET_UNITS = {f"src{i}": units for i, units in enumerate([8, 7, 6, 6, 5, 5, 5, 5, 4, 4, 4, 4, 3, 3, 3, 3, 2, 2, 2, 2])}
OTHER = "*"
OTHER_UNITS = 3
BLOCK_ROWS = 8

_PHASES = (
    "array<struct<pool string, phases array<struct<"
    "first long, beyond long, slot0 long, period long, units long, slots array<long>>>>>"
)


def one_period(units: Mapping[str, int]) -> dict[str, list[int]]:
    """Slots of each source's blocks in one period of ``sum(units)`` slots, earliest deadline first.

    Of equal deadlines, the source that comes first in ``units`` is taken.
    """
    period = sum(units.values())
    names = list(units)
    slots: dict[str, list[int]] = {name: [] for name in names}
    for slot in range(period):
        due = []
        for rank, name in enumerate(names):
            k, u = len(slots[name]), units[name]
            if k < u and k * period // u <= slot:
                due.append((-(-(k + 1) * period // u), rank))
        slots[names[min(due)[1]]].append(slot)
    return slots


def phases(units: Mapping[str, int], blocks: Mapping[str, int]) -> dict[str, list[dict]]:
    """For each source the phases it takes part in: which of its blocks, and at which slots they go.

    A phase ends with the slot that takes the last block of some source.  There are at most as many
    phases as sources, and none depends on the number of rows.
    """
    left = {name: blocks.get(name, 0) for name in units}
    done = dict.fromkeys(units, 0)
    plan: dict[str, list[dict]] = {name: [] for name in units}
    slot0 = 0
    while active := {name: units[name] for name in units if left[name] > 0}:
        slots, period = one_period(active), sum(active.values())
        last = min(
            (left[name] - 1) // u * period + slots[name][(left[name] - 1) % u] for name, u in active.items()
        )
        whole, rest = divmod(last + 1, period)
        for name, u in active.items():
            taken = whole * u + sum(slot < rest for slot in slots[name])
            if taken:
                phase = {"first": done[name], "beyond": done[name] + taken, "slot0": slot0}
                plan[name].append(phase | {"period": period, "units": u, "slots": slots[name]})
            done[name] += taken
            left[name] -= taken
        slot0 += last + 1
    return plan


def _plan_table(spark: SparkSession, plan: dict[str, list[dict]]) -> DataFrame:
    text = json.dumps([{"pool": name, "phases": found} for name, found in plan.items()])
    return spark.range(1).select(F.inline(F.from_json(F.lit(text), _PHASES)))


def mix(
    rows: DataFrame,
    doc_id: str = "doc_id",
    source: str = "source",
    units: Mapping[str, int] = TARGET_UNITS,
    other_units: int = OTHER_UNITS,
    block_rows: int = BLOCK_ROWS,
    carry: Column | None = None,
) -> DataFrame:
    """``doc_id, source, pool, block, release, deadline, slot, place`` of every row (and ``carried``).

    A source's rows form blocks of ``block_rows`` in the order of their ids' md5; its last block may
    hold fewer.  Rows in the mixed order are sorted by ``slot, place``.  Sources without units, and
    null, share the pool ``*``.  Rows that repeat an id are placed one after the other; an empty
    table gives no rows; other columns are read only through ``carry``.

    To the driver comes one count per pool, a number fixed by ``units``.  The plan, bounded by the
    units as well, is broadcast.  A source that holds a third of the rows is numbered in blocks of
    its rows, never in one task.
    """
    if min(units.values(), default=1) < 1 or other_units < 1 or OTHER in units:
        raise ValueError("units: whole numbers from 1, and no source named '*'")
    spark = rows.sparkSession
    blocks = 4 * shuffle_partitions(spark)
    named = F.col(f"`{source}`").cast("string")
    key = F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit(""))
    pooled = rows.select(
        F.col(f"`{doc_id}`").alias("doc_id"),
        named.alias("source"),
        F.when(named.isin(list(units)), named).otherwise(OTHER).alias("pool"),
        digest_block(key, blocks).alias("_block"),
        F.md5(key).alias("_digest"),
        *([] if carry is None else [carry.alias("carried")]),
    )
    sizes = {r["pool"]: r["count"] for r in pooled.groupBy("pool").count().collect()}
    plan = phases(
        dict(units) | {OTHER: other_units}, {pool: -(-count // block_rows) for pool, count in sizes.items()}
    )
    order = ["_digest", "doc_id", "source"] + ([] if carry is None else [F.xxhash64("carried")])
    numbered = ranked(pooled, ["pool"], "_block", order, "_rank", blocks)
    placed = (
        numbered.withColumn("block", F.floor(F.col("_rank") / block_rows))
        .join(F.broadcast(_plan_table(spark, plan)), "pool")
        .withColumn("phase", F.filter("phases", lambda p: (F.col("block") >= p["first"]) & (F.col("block") < p["beyond"]))[0])
        .withColumn("nth", F.col("block") - F.col("phase.first"))
    )
    nth, period, own, slot0 = F.col("nth"), F.col("phase.period"), F.col("phase.units"), F.col("phase.slot0")
    turns = F.floor(nth / own)
    return placed.select(
        "doc_id",
        "source",
        "pool",
        "block",
        (slot0 + F.floor(nth * period / own)).alias("release"),
        (slot0 + F.ceil((nth + 1) * period / own)).alias("deadline"),
        (slot0 + turns * period + F.get("phase.slots", (nth - turns * own).cast("int"))).alias("slot"),
        (F.col("_rank") % block_rows).cast("int").alias("place"),
        *([] if carry is None else ["carried"]),
    )


def interleave(
    docs: DataFrame,
    doc_id: str = "doc_id",
    source: str = "source",
    units: Mapping[str, int] = TARGET_UNITS,
    other_units: int = OTHER_UNITS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """All rows of ``docs``, columns as they are, in the mixed order: written, its files follow one another."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    mixed = mix(docs, doc_id, source, units, other_units, block_rows, carry=row)
    order = ["slot", "place"]
    parts = shuffle_partitions(docs.sparkSession)
    return mixed.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("carried.*")
