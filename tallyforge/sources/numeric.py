"""Headerless numeric CSV and the named columns of the two classification data sets."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

# Column names of the forest-cover file; a number expands to that many columns.
COVER_COLUMNS = [
    "Elevation",
    "Aspect",
    "Slope",
    "Horizontal_Distance_To_Hydrology",
    "Vertical_Distance_To_Hydrology",
    "Horizontal_Distance_To_Roadways",
    "Hillshade_9am",
    "Hillshade_Noon",
    "Hillshade_3pm",
    "Horizontal_Distance_To_Fire_Points",
    ("WA", 4),
    ("ST", 40),
    "Cover_Type",
]
# Names of the seven cover types.
COVER_NAMES = [
    (1.0, "Spruce/Fir"),
    (2.0, "Lodgepole Pine"),
    (3.0, "Ponderosa Pine"),
    (4.0, "Cottonwood/Willow"),
    (5.0, "Aspen"),
    (6.0, "Douglas-fir"),
    (7.0, "Krummholz"),
]
# Feature names of the particle-collision file, label first.
HIGGS_COLUMNS = [
    "label",
    "lepton pT", "lepton eta", "lepton phi",
    "missing energy magnitude", "missing energy phi",
    "jet 1 pt", "jet 1 eta", "jet 1 phi", "jet 1 b-tag",
    "jet 2 pt", "jet 2 eta", "jet 2 phi", "jet 2 b-tag",
    "jet 3 pt", "jet 3 eta", "jet 3 phi", "jet 3 b-tag",
    "jet 4 pt", "jet 4 eta", "jet 4 phi", "jet 4 b-tag",
    "m_jj", "m_jjj", "m_lv", "m_jlv", "m_bb", "m_wbb", "m_wwbb",
]


def expand_columns(columns: Sequence[str | tuple[str, int]]) -> list[str]:
    """Plain names as they are; (prefix, count) becomes prefix_0 .. prefix_<count-1>."""
    names: list[str] = []
    for column in columns:
        if isinstance(column, str):
            names.append(column)
        else:
            prefix, count = column
            names.extend(f"{prefix}_{i}" for i in range(count))
    return names


def double_schema(names: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(name, T.DoubleType()) for name in names])


def read_numeric_csv(
    spark: SparkSession, path: str, names: Sequence[str], mode: str = "FAILFAST"
) -> DataFrame:
    """All-double CSV without header (plain or gzip).  A bad or empty cell fails the job, or
    drops its row if ``mode`` is 'DROPMALFORMED'.

    The check reads every column, so that which rows count as bad does not depend on the columns
    a query happens to use.
    """
    table = (
        spark.read.schema(double_schema(names))
        .option("mode", mode)
        .option("ignoreLeadingWhiteSpace", True)
        .option("ignoreTrailingWhiteSpace", True)
        .csv(path)
    )
    complete = reduce(and_, (F.col(f"`{name}`").isNotNull() for name in names))
    if mode == "DROPMALFORMED":
        return table.where(complete)
    return table.where(F.when(complete, True).otherwise(F.raise_error(F.lit("empty cell")).cast("boolean")))


def read_checked_csv(spark: SparkSession, path: str, names: Sequence[str]) -> DataFrame:
    """All columns as in :func:`read_numeric_csv`, and ``file, reason, record``: bad rows are kept, with why.

    ``reason`` is null for a sound row, 'malformed' for a cell that is no number or a wrong number of
    cells (then ``record`` holds the line), 'empty cell' otherwise.  One read serves the sound rows and the report.
    """
    schema = T.StructType([*double_schema(names).fields, T.StructField("_record", T.StringType())])
    table = (
        spark.read.schema(schema)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_record")
        .option("ignoreLeadingWhiteSpace", True)
        .option("ignoreTrailingWhiteSpace", True)
        .csv(path)
    )
    complete = reduce(and_, (F.col(f"`{name}`").isNotNull() for name in names))
    reason = F.when(F.col("_record").isNotNull(), "malformed").when(~complete, "empty cell")
    return table.select(
        *[f"`{name}`" for name in names], F.col("_metadata.file_path").alias("file"), reason.alias("reason"),
        F.col("_record").alias("record"),
    )


def read_cover(spark: SparkSession, path: str, mode: str = "FAILFAST") -> DataFrame:
    return read_numeric_csv(spark, path, expand_columns(COVER_COLUMNS), mode)


def read_higgs(spark: SparkSession, path: str, mode: str = "FAILFAST") -> DataFrame:
    return read_numeric_csv(spark, path, HIGGS_COLUMNS, mode)


def cover_names(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(COVER_NAMES, "label double, name string")


def split_delimited(line: str, separator: str = ",") -> Column:
    """Array of trimmed fields of a delimited text column."""
    return F.transform(F.split(F.col(line), separator), lambda field: F.trim(field))
