"""Doubles as whole numbers of the same order, for counting digit by digit."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, functions as F

FRACTION = 2**52


def with_ordered_bits(df: DataFrame, value: str, name: str = "bits") -> DataFrame:
    """``df`` with the 64 bits of a double column as a long that rises with it.

    Equal numbers, also 0.0 and -0.0, have equal bits; null has null; not for NaN.  Built from exponent and
    fraction by exact steps only (powers of two), so it stays in generated code.  The logarithm merely
    guesses the exponent; both neighbours are tried.  Each step is a column of its own, which the
    optimiser does not repeat where it is used.
    """
    size, guess, scaled = F.col("_size"), F.col("_guess"), F.col("_scaled")
    high, low = scaled >= 2, (scaled < 1) & (guess > -1022)
    exponent = F.when(high, guess + 1).when(low, guess - 1).otherwise(guess).cast("long")
    fraction = F.when(high, scaled / 2).when(low, scaled * 2).otherwise(scaled)
    # A subnormal number keeps the least exponent and a fraction below 1: the same sum.
    bits = (exponent + 1022) * FRACTION + (fraction * float(FRACTION)).cast("long")
    special = F.when(size == 0, F.lit(0).cast("long")).when(size == F.lit(math.inf), F.lit(2047 * FRACTION))
    return (
        df.withColumn("_size", F.abs(value))
        .withColumn("_guess", F.greatest(F.least(F.floor(F.log2(size)), F.lit(1023)), F.lit(-1022)))
        .withColumn("_scaled", size / F.pow(F.lit(2.0), guess))
        .withColumn("_bits", special.otherwise(bits))
        .withColumn(name, F.when(F.col(value) < 0, -F.col("_bits")).otherwise(F.col("_bits")))
        .drop("_size", "_guess", "_scaled", "_bits")
    )
