"""Class shares, samples and splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

def hash_place(ids: Sequence[str], seed: int = 0) -> Column:
    """Eight hexadecimal digits from the ids and a seed: where a row lies between 00000000 and
    ffffffff, whatever the partitioning and however often a lost task is re-run."""
    text = F.concat_ws(":", F.lit(str(seed)), *[F.col(c).cast("string") for c in ids])
    return F.substring(F.md5(text), 1, 8)


def _below(place: Column, fraction: float) -> Column:
    """True for about ``fraction`` of all places; digits compare as text."""
    edge = int(fraction * (1 << 32))
    return F.lit(True) if edge >= 1 << 32 else place < F.lit(f"{edge:08x}")


def hash_sample(df: DataFrame, ids: Sequence[str], fraction: float, seed: int = 0) -> DataFrame:
    """Sample without replacement of about ``fraction`` of the rows."""
    return df.where(_below(hash_place(ids, seed), fraction))


def hash_split(
    df: DataFrame,
    ids: Sequence[str],
    weights: Sequence[tuple[str, float]] = (("train", 0.7), ("test", 0.3)),
    seed: int = 0,
    column: str = "set",
) -> DataFrame:
    """Adds the name of the set each row belongs to; no row is moved."""
    total = sum(weight for _, weight in weights)
    place = hash_place(ids, seed)
    name, reached = F.when(F.lit(False), F.lit("")), 0.0
    for label, weight in weights[:-1]:
        reached += weight
        name = name.when(_below(place, reached / total), F.lit(label))
    return df.withColumn(column, name.otherwise(F.lit(weights[-1][0])))


def random_sample(df: DataFrame, fraction: float, seed: int | None = None) -> DataFrame:
    """Spark's own row sampling, for rows without an id."""
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def random_split(df: DataFrame, weights: Sequence[float], seed: int | None = None):
    """Spark's own row split, for rows without an id."""
    return df.randomSplit(list(weights), seed)


def set_sizes(df: DataFrame, column: str = "set") -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def class_distribution(df: DataFrame, label: str, names: DataFrame | None = None) -> DataFrame:
    """``label[, name], n, percent`` by falling count.

    The total is a scalar sub-query over the class counts, not a window over all of them.
    ``names`` is an optional ``label, name`` table of the classes.
    """
    counts = df.groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    shares = counts.withColumn("percent", F.lit(100.0) * F.col("n") / total)
    if names is not None:
        shares = shares.join(names, "label", "left").select("label", "name", "n", "percent")
    return shares.orderBy(F.desc("n"), F.asc("label"))


def one_vs_rest(label: Column, chosen) -> Column:
    """1.0 for the chosen class, 0.0 for every other."""
    return (label == F.lit(chosen)).cast("double")
