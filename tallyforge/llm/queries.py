"""Registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyforge.llm import alignment, fingerprint, mixing, neardup, negatives, packing, pii, quality, secrets, sharding, toxicity, urls, warc

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard of every document, by its id."""
    return sharding.place(table(spark, sf_dir, "documents").select("doc_id", "source"), "doc_id")


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write every page as a WARC record, then read all archives back through the index."""
    folder, index = warc.write_archives(table(spark, sf_dir, "pages"))
    return warc.read_records(folder, index, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule or trees' verdict of every page's URL."""
    return urls.judge(table(spark, sf_dir, "pages"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document's text."""
    return quality.report(table(spark, sf_dir, "documents"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bucket, batch and position of every document's pieces; a token is a word here."""
    return packing.pack(table(spark, sf_dir, "documents"), F.size(quality.words_of(F.col("text"))))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slot of every document in the mix of sources."""
    return mixing.mix(table(spark, sf_dir, "documents"))


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 3-word shingles are alike to 85 percent."""
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), width=3, percent=85)


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint of every document and of its edited text, and their likeness."""
    return fingerprint.compare_edited(table(spark, sf_dir, "documents"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document's text."""
    return pii.report(table(spark, sf_dir, "documents"))


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every secret-like run in every document's text."""
    return secrets.scan(table(spark, sf_dir, "documents"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector, a seventh of the labels moved on by one."""
    rows = table(spark, sf_dir, "embeddings")
    rows = rows.withColumn("vector", negatives.integer_vector(F.col("embedding")))
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(rows, F.col("vec_id") % 100 == 0, label=moved)


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from the labelled ones that are not held out."""
    return toxicity.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links of two tokenizers over every document's text."""
    return alignment.report(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_sharding": op1_sharding,
    "op2_warc": op2_warc,
    "op3_url_filter": op3_url_filter,
    "op4_quality": op4_quality,
    "op5_secrets": op5_secrets,
    "op6_pii": op6_pii,
    "op7_packing": op7_packing,
    "op8_mixing": op8_mixing,
    "op9_fingerprints": op9_fingerprints,
    "op10_near_duplicates": op10_near_duplicates,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_toxicity": op12_toxicity,
    "op13_alignment": op13_alignment,
}
