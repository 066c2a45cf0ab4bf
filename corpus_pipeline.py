"""A corpus pipeline of the operators in tallyforge.llm: each stage's Parquet is the next one's input.

Low-quality documents go, one document of each near-duplicate group stays, personal data is replaced,
sources are put in a mixed order (the order of the written rows), and the result is packed into
batches, which fill up in that order.  Stages keep all columns they get, so extra ones pass through
to the last; a table without documents passes through empty.
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession, functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tallyforge.llm import mixing, neardup, packing, pii, quality  # noqa: E402
from tallyforge.llm.common import shared_folder  # noqa: E402


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the threshold table."""
    return quality.keep(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one of smallest id, of each group alike to 80 percent of their 5-word shingles."""
    return neardup.keep_one(docs, width=5, percent=80)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data in their texts replaced by its kind; n_chars follows the text."""
    return pii.redact(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order that mixes the sources to their target weights."""
    return mixing.interleave(docs)


def length_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bucket, batch and position of every piece, batches filled in the order of the mix."""
    tokens = F.size(quality.words_of(F.col("text")))
    return packing.pack(docs, tokens, file_order=packing.written_order(docs))


STAGES = [
    ("quality rules", quality_rules),
    ("near-duplicates", near_duplicates),
    ("personal data", personal_data),
    ("source mix", source_mix),
    ("length packing", length_packing),
]

# Personal data is found by a model trained on the corpus, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in turn over ``documents``; each result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = shared_folder(spark)
    for number, (_, stage) in enumerate(STAGES):
        path = f"{folder}/{number}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
