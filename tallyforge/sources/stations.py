"""Long measurement vectors: flattening, selection, derived measures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, GroupedData, functions as F


def flatten_stations(nested: DataFrame) -> DataFrame:
    """One row per station, measurement and year from nested station records."""
    rows = nested.select("station", F.explode("measurements").alias("m"))
    return rows.select("station", "m.measurement", "m.year", "m.values")


def _fits(dim: int) -> Column:
    return F.coalesce(F.size("values") == dim, F.lit(False))


def require_length(station_years: DataFrame, dim: int) -> DataFrame:
    """The rows as they are; a vector that is null or has not ``dim`` entries is a data error."""
    values = F.col("values")
    found = F.when(values.isNull(), F.lit("null")).otherwise(F.size(values).cast("string"))
    message = F.concat(F.lit(f"expected {dim} values, got "), found)
    return station_years.withColumn("values", F.when(_fits(dim), values).otherwise(F.raise_error(message)))


def keep_length(station_years: DataFrame, dim: int) -> DataFrame:
    """Only the rows whose vector has ``dim`` entries; :func:`length_report` tells how many are set aside."""
    return station_years.where(_fits(dim))


def length_report(station_years: DataFrame, dim: int, key: str = "measurement") -> DataFrame:
    """``key, rows, null_vectors, wrong_length, shortest, longest`` of every measure."""
    size = F.size("values")
    return station_years.groupBy(key).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("values").isNull()).alias("null_vectors"),
        F.count_if(F.col("values").isNotNull() & (size != dim)).alias("wrong_length"),
        F.min(F.when(F.col("values").isNotNull(), size)).alias("shortest"),
        F.max(F.when(F.col("values").isNotNull(), size)).alias("longest"),
    )


def days_of(station_years: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``keys..., day, value, length`` for every entry, missing ones too; a vector that is null or empty
    is a data error."""
    values = F.col("values")
    sound = F.when(F.coalesce(F.size(values) > 0, F.lit(False)), values).otherwise(
        F.raise_error(F.lit("a vector is null or empty")).cast("array<double>")
    )
    rows = station_years.select(*keys, F.size(values).alias("length"), F.posexplode_outer(sound).alias("pos", "value"))
    return rows.select(*keys, (F.col("pos") + 1).alias("day"), "value", "length")


def of_equal_length(days: GroupedData, *aggregates: Column) -> DataFrame:
    """Aggregates of :func:`days_of` by key and day; a data error where vectors of one key differ in length.

    Vectors of different lengths meet on their first day at the latest, so it costs two numbers a day
    and no pass of its own.
    """
    found = days.agg(*aggregates, F.min("length").alias("_shortest"), F.max("length").alias("_longest"))
    message = F.concat(
        F.lit("vectors of one measure have "), F.col("_shortest").cast("string"), F.lit(" to "),
        F.col("_longest").cast("string"), F.lit(" entries"),
    )
    same = F.when(F.col("_shortest") == F.col("_longest"), F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))
    return found.where(same).drop("_shortest", "_longest")


def has_missing(values: Column) -> Column:
    """True when any entry is NaN or null."""
    return F.exists(values, lambda x: x.isNull() | F.isnan(x))


STEPS = {"mean": lambda x, y: (x + y) / 2, "range": lambda x, y: x - y}


def derive_measures(station_years: DataFrame, wanted: Sequence[tuple[str, str, str, str]]) -> DataFrame:
    """Derived measures ``(name, left, right, how)`` of the vectors of two measures of one station and year.

    ``how`` is 'mean' for (left+right)/2 or 'range' for left-right; NaN stays NaN.  The vectors of a
    station and year are gathered once for all derived measures: one shuffle, of the measures needed.
    A repeated vector pairs like any other; a station and year without a partner gives nothing, and so do
    rows whose station or year is null; vectors of unequal length, or a null one, are a data error.
    """
    needed = sorted({m for _, left, right, _ in wanted for m in (left, right)})
    entries = station_years.where(
        F.col("measurement").isin(needed) & F.col("station").isNotNull() & F.col("year").isNotNull()
    )
    gathered = entries.groupBy("station", "year").agg(F.collect_list(F.struct("measurement", "values")).alias("_all"))

    def pairs(name: str, left: str, right: str, how: str) -> Column:
        def of(measure: str) -> Column:
            return F.filter("_all", lambda e: e["measurement"] == measure)

        def combined(x: Column, y: Column) -> Column:
            same = F.coalesce(F.size(x) == F.size(y), F.lit(False))
            message = F.lit(f"a vector of {left} and one of {right} are not of equal length")
            return F.when(same, F.zip_with(x, y, STEPS[how])).otherwise(F.raise_error(message).cast("array<double>"))

        def against(x: Column) -> Column:
            return F.transform(
                of(right), lambda y: F.struct(F.lit(name).alias("measurement"), combined(x["values"], y["values"]).alias("values"))
            )

        return F.flatten(F.transform(of(left), against))

    found = F.concat(*[pairs(*w) for w in wanted])
    rows = gathered.select("station", "year", F.inline(found))
    return rows.select("station", "measurement", "year", "values")


def combine_measures(station_years: DataFrame, left: str, right: str, name: str, how: str) -> DataFrame:
    """One derived measure; several are cheaper together, by :func:`derive_measures`."""
    return derive_measures(station_years, [(name, left, right, how)])


def split_columns(df: DataFrame, array: str, count: int) -> DataFrame:
    """Array column replaced by scalar columns <name>1 .. <name><count>."""
    kept = [c for c in df.columns if c != array]
    return df.select(*kept, *[F.col(array).getItem(i).alias(f"{array}{i + 1}") for i in range(count)])
