"""Per-measure statistics of long measurement vectors and of plain values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tallyforge.functions.order import with_ordered_bits
from tallyforge.joins import join_small, table_bytes
from tallyforge.session import materialise
from tallyforge.sources.stations import days_of, of_equal_length

# The tail percentiles of the statistics table, in parts per thousand.
TAILS = {"low1000": 1, "low100": 10, "high100": 990, "high1000": 999}


def _recorded(value: str) -> Column:
    return F.col(value).isNotNull() & ~F.isnan(F.col(value))


def day_values(station_years: DataFrame, keys: Sequence[str] = ("measurement",)) -> DataFrame:
    """Rows (keys..., day, value), day from 1, missing entries left out."""
    rows = station_years.select(*keys, F.posexplode_outer("values").alias("pos", "value"))
    recorded = rows.where(_recorded("value"))
    return recorded.select(*keys, (F.col("pos") + 1).alias("day"), "value")


def day_profile(station_years: DataFrame, keys: Sequence[str] = ("measurement",)) -> DataFrame:
    """``keys..., day, mean, var, ne`` over the recorded values of each day.

    Each task reduces its rows to one per (key, day) before the exchange.  Vectors of one key that
    differ in length are a data error.
    """
    value = F.when(_recorded("value"), F.col("value"))
    profile = of_equal_length(
        days_of(station_years, keys).groupBy(*keys, "day"),
        F.avg(value).alias("mean"), F.var_pop(value).alias("var"), F.count(value).alias("ne"),
    )
    return profile.where(F.col("ne") > 0)


def day_counts(station_years: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``keys..., day, rows, recorded, missing``: also days nobody recorded."""
    counts = of_equal_length(
        days_of(station_years, keys).groupBy(*keys, "day"),
        F.count(F.lit(1)).alias("rows"), F.count_if(_recorded("value")).alias("recorded"),
    )
    return counts.withColumn("missing", F.col("rows") - F.col("recorded"))


def bands(profile: DataFrame) -> DataFrame:
    """Adds ``std, low, high``: one standard deviation around the mean of the day."""
    std = F.sqrt("var")
    return profile.select(
        "*", std.alias("std"), (F.col("mean") - std).alias("low"), (F.col("mean") + std).alias("high")
    )


DIGIT = 16  # bits counted at a time
DIGITS = 2**DIGIT


def _chosen(counts: str, rank: str, before: str) -> str:
    """SQL of where the ``rank``-th value lies in ordered ``counts`` (``digit, n, value``): its rank among the
    values of that entry, the entry's digit put behind the digits ``before``, and its value."""
    return f"""aggregate({counts},
        struct({rank} AS rank, CAST(NULL AS BIGINT) AS prefix, CAST(NULL AS DOUBLE) AS value),
        (so_far, e) -> CASE WHEN so_far.prefix IS NOT NULL THEN so_far
            WHEN so_far.rank <= e.n THEN struct(so_far.rank AS rank, {before} * {DIGITS}L + e.digit AS prefix, e.value AS value)
            ELSE struct(so_far.rank - e.n AS rank, so_far.prefix AS prefix, so_far.value AS value) END)"""


def exact_percentiles(df: DataFrame, keys: Sequence[str], value: str, per_mille: dict[str, int]) -> DataFrame:
    """``keys..., n, mean, std, <one column per name>``: of each key's recorded values their number,
    moments, and for each name the smallest value whose share of values at or below reaches the given
    parts per thousand, exact.  Null keys are a key like others.

    Radix selection: a double becomes a long of the same order, whose 64 bits are counted 16 at a time.
    The first pass counts the highest digit of all values, each later one the next digit of those values
    that share their digits so far with a wanted rank, for all ranks and keys at once.  Counts are combined
    in the tasks; a key has at most 65,536 of them per rank, however many or equal its values are.
    """
    keys, names = list(keys), list(per_mille)
    values = df.select(*keys, (F.col(value).cast("double") + 0.0).alias("value")).where(_recorded("value"))
    values = with_ordered_bits(values, "value")
    # No value is null here; said so, the optimiser does not repeat the whole expression in a null check.
    bits = F.coalesce("bits", F.lit(0).cast("long"))
    no_value = F.lit(None).cast("double").alias("value")

    digits = values.groupBy(*keys, F.shiftright(bits, 64 - DIGIT).cast("long").alias("digit")).agg(
        F.count(F.lit(1)).alias("n"), no_value, F.avg("value").alias("mean"), F.var_pop("value").alias("var")
    )
    entry = F.struct("digit", "n", "value", "mean", "var")
    first = digits.groupBy(*keys).agg(F.sort_array(F.collect_list(entry)).alias("h"), F.sum("n").alias("n"))

    def added(of: str) -> str:
        return f"aggregate(h, CAST(0 AS DOUBLE), (total, e) -> total + {of})"

    def rank(name: str) -> str:
        """Smallest whole number not under n * share / 1000, at least 1."""
        return f"greatest((n * {int(per_mille[name])} + 999) div 1000, 1L)"

    state = first.selectExpr("*", f"{added('e.n * e.mean')} / n AS mean")
    state = state.selectExpr(
        *[f"`{k}`" for k in keys], "n", "mean",
        f"sqrt({added('e.n * (e.var + (e.mean - mean) * (e.mean - mean))')} / n) AS std",
        f"array({', '.join(_chosen('h', rank(name), '0L') for name in names)}) AS wanted",
    )

    size = None
    for shift in range(64 - 2 * DIGIT, -1, -DIGIT):
        state = materialise(state)
        # Rows of the same keys and as many ranks in every round.
        size = table_bytes(state) if size is None else size
        prefixes = state.select(*keys, F.expr("array_distinct(wanted.prefix)").alias("prefixes"))
        rows = join_small(values, prefixes, keys, salt_by=["value"], null_safe=True, small_bytes=size)
        so_far = F.shiftright(bits, shift + DIGIT).cast("long")
        digit = F.shiftright(bits, shift).cast("long").bitwiseAND(F.lit(DIGITS - 1).cast("long"))
        counted = (
            rows.where(F.array_contains("prefixes", so_far))
            .groupBy(*keys, so_far.alias("prefix"), digit.alias("digit"))
            # All values of a last digit are the same number.
            .agg(F.count(F.lit(1)).alias("n"), F.min("value").alias("value") if shift == 0 else no_value)
        )
        listed = counted.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("prefix", "digit", "n", "value"))).alias("h"))
        both = join_small(listed, state, keys, null_safe=True, small_bytes=size)

        next_ = _chosen("filter(h, x -> x.prefix = w.prefix)", "w.rank", "w.prefix")
        state = both.selectExpr(*[f"`{k}`" for k in keys], "n", "mean", "std", f"transform(wanted, w -> {next_}) AS wanted")
    return state.select(*keys, "n", "mean", "std", *[F.expr(f"wanted[{i}].value").alias(n) for i, n in enumerate(names)])


def measure_stats(df: DataFrame, key: str = "measurement", value: str = "value") -> DataFrame:
    """``key, n, mean, std`` and the four tail percentiles of each measure."""
    return exact_percentiles(df, [key], value, TAILS)


def histogram(
    df: DataFrame, stats: DataFrame, key: str = "measurement", value: str = "value", width: float = 5.0
) -> DataFrame:
    """``key, bin, lo, n``: values from low100 to high100 inclusive in bins of ``width``."""
    limits = materialise(stats.select(key, "low100", "high100"))
    recorded = df.where(_recorded(value)).select(key, value)
    rows = join_small(recorded, limits, [key], salt_by=[value], null_safe=True)
    kept = rows.where(F.col(value).between(F.col("low100"), F.col("high100")))
    bin_ = F.floor((F.col(value) - F.col("low100")) / width).cast("int")
    counts = kept.groupBy(key, bin_.alias("bin"), "low100").agg(F.count(F.lit(1)).alias("n"))
    return counts.select(key, "bin", (F.col("low100") + F.col("bin") * width).alias("lo"), "n")
