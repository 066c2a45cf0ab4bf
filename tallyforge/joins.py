"""Equi-joins against a side that is usually, but not provably, small."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

BROADCAST_BYTES = 64 * 1024 * 1024
SALTS = 32


def _cell_bytes(name: str, kind: T.DataType) -> Column:
    cell = F.col(f"`{name}`")
    if isinstance(kind, (T.StringType, T.BinaryType)):
        size = F.octet_length(cell) + 16
    elif isinstance(kind, T.ArrayType):
        if isinstance(kind.elementType, (T.DoubleType, T.FloatType, T.LongType, T.IntegerType)):
            size = F.size(cell) * 8 + 16
        else:
            size = F.octet_length(F.to_json(F.struct(cell)))
    elif isinstance(kind, (T.StructType, T.MapType)):
        size = F.octet_length(F.to_json(F.struct(cell)))
    else:
        return F.lit(8)
    return F.greatest(F.coalesce(size, F.lit(8)), F.lit(8))


def table_bytes(df: DataFrame) -> int:
    """Measured size of the rows of ``df``: one aggregate, nothing collected but the total."""
    row = F.lit(16).cast("long")
    for field in df.schema.fields:
        row = row + _cell_bytes(field.name, field.dataType).cast("long")
    return df.agg(F.sum(row).alias("bytes")).first()["bytes"] or 0


def join_small(
    big: DataFrame,
    small: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    salt_by: Sequence[str] = (),
    limit_bytes: int = BROADCAST_BYTES,
    salts: int = SALTS,
    null_safe: bool = False,
    small_bytes: int | None = None,
) -> DataFrame:
    """``big`` joined to ``small`` ('inner' or 'left') without trusting ``small`` to stay small.

    Up to ``limit_bytes`` (measured, or given by who has) the small side is broadcast.  Beyond, it is a
    shuffle join; when ``salt_by`` names columns that vary within one join key, every key is spread over
    ``salts`` partitions, so a key holding a third of ``big`` does not land in one task.
    The salt is a hash of row values, hence the same on a re-run after a lost executor.  With
    ``null_safe`` a null key meets a null key, otherwise none.
    """
    if how not in ("inner", "left"):
        raise ValueError("join_small keeps or filters the big side: how is 'inner' or 'left'")
    on = list(on)
    fits = (table_bytes(small) if small_bytes is None else small_bytes) <= limit_bytes
    if not fits and salt_by:
        big = big.withColumn("_salt", F.pmod(F.xxhash64(*salt_by), F.lit(salts)).cast("int"))
        small = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        on = [*on, "_salt"]
    small = F.broadcast(small) if fits else small
    if not null_safe:
        return big.join(small, on, how).drop("_salt")
    # Names of their own for the small side's keys, so that both sides may stem from one table.
    own = {k: f"_on_{i}" for i, k in enumerate(on)}
    other = small.select(*[F.col(k).alias(n) for k, n in own.items()], *[c for c in small.columns if c not in on])
    same = None
    for k, n in own.items():
        pair = big[k].eqNullSafe(other[n])
        same = pair if same is None else same & pair
    return big.join(other, same, how).drop(*own.values(), "_salt")
