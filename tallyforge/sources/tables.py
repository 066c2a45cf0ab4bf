"""Table sources with declared schemas, and result sinks."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

USER_GROUPS = "user_id string, group_id int"
STATIONS = (
    "station string, "
    "measurements array<struct<measurement: string, year: int, values: array<double>>>"
)
STATION_YEARS = "station string, measurement string, year int, values array<double>"
MEASURE_STATS = (
    "measurement string, n bigint, mean double, std double, "
    "low1000 double, low100 double, high100 double, high1000 double"
)
DAY_PROFILE = "measurement string, day int, mean double, var double, ne bigint"
EIGENPAIRS = "measurement string, rank int, eigval double, eigvec array<double>"


def read_table(spark: SparkSession, path: str, schema: str, fmt: str = "parquet") -> DataFrame:
    """Table of a declared schema; 'json' and 'csv' work as well as 'parquet'."""
    return spark.read.schema(schema).format(fmt).load(path)


TASKS_PER_CORE = 4


def spread(table: DataFrame, passes: int = 1) -> DataFrame:
    """A freshly read table of few file splits, dealt out to a few tasks per core.

    For jobs that multiply rows or run long per row: small tasks also let the combining before an
    exchange stay in memory.  Large inputs have more splits than that and pass untouched, so what
    is moved never exceeds a few splits per core.  A job of several ``passes``, which would move the
    table in each, takes it untouched as soon as it has a file for every core.
    """
    cores = table.sparkSession.sparkContext.defaultParallelism
    tasks = cores * TASKS_PER_CORE
    if table.rdd.getNumPartitions() >= tasks or (passes > 1 and len(table.inputFiles()) >= cores):
        return table
    return table.repartition(tasks)


def local_table(spark: SparkSession, rows: Iterable[Sequence], schema: str) -> DataFrame:
    """Small literal rows (lookups, fixtures) as a table."""
    return spark.createDataFrame(list(rows), schema)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    df.write.mode(mode).format(fmt).save(path)


def checked_schema(df: DataFrame, schema: str) -> DataFrame:
    """``df`` with the columns of ``schema`` in its order; an error where names or types differ."""
    wanted = T.StructType.fromDDL(schema)
    have = {f.name: f.dataType for f in df.schema.fields}
    if have != {f.name: f.dataType for f in wanted.fields}:
        raise ValueError(f"expected {schema}, got {df.schema.simpleString()}")
    return df.select(*[f"`{f.name}`" for f in wanted.fields])


def store_partitions(df: DataFrame, path: str, schema: str, by: str = "measurement") -> None:
    """Write a statistics table, checked against its schema, in one partition per value of ``by``.

    Partitions of values that ``df`` holds are replaced, others stay: statistics of one measure can be
    renewed without touching the rest.
    """
    rows = checked_schema(df, schema)
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)


def read_stored(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A table of :func:`store_partitions` in the order of its schema; an error if the files hold another one."""
    wanted = T.StructType.fromDDL(schema)
    found = spark.read.parquet(path).schema
    # Partition values are told from folder names: their type is the schema's.
    kinds = {f.name: f.dataType for f in found.fields}
    stored = spark.read.schema(schema).parquet(path)
    for field in wanted.fields[1:]:
        if kinds.get(field.name) != field.dataType:
            raise ValueError(f"expected {schema}, found {found.simpleString()}")
    return stored.select(*[f"`{f.name}`" for f in wanted.fields])


def ranked(top: DataFrame, order: Sequence, name: str = "rank") -> DataFrame:
    """Adds 1, 2, 3... in ``order``.  For a limited report only: it numbers in one task."""
    return top.withColumn(name, F.row_number().over(Window.orderBy(*order)))


def printed_score(value, digits: int = 4):
    """Number as report text with fixed decimals."""
    return F.format_string(f"%.{digits}f", value)
