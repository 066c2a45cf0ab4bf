"""Text sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

PARAGRAPH_BREAK = "\r\n\r\n"


def read_paragraphs(spark: SparkSession, path: str, separator: str = PARAGRAPH_BREAK) -> DataFrame:
    """``value string``: one row per record of a text file cut at ``separator``."""
    return spark.read.option("lineSep", separator).text(path)


def read_manifest(spark: SparkSession, manifest: str) -> list[str]:
    """Paths named in a manifest file, one per line; blank lines ignored."""
    lines = spark.read.text(manifest).toLocalIterator()
    return [line.value.strip() for line in lines if line.value.strip()]


def read_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``value string``: the lines of all ``paths`` as one dataset."""
    return spark.read.text(paths)
