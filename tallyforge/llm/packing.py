"""Packing by length: buckets with the least padding, and batches of a token budget inside each bucket.

The global histogram of lengths decides the buckets: dynamic programming over it finds the
boundaries for which padding every piece to its bucket's boundary wastes the fewest tokens.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, functions as F

from tallyforge.llm.common import digest_block, ranked, shuffle_partitions, stored

# A text of more tokens is cut into pieces of this length and a rest; it also bounds the histogram.
MAX_TOKENS = 2048
TOKEN_BUDGET = 16_384
BUCKETS = 8


def bucket_boundaries(lengths: Sequence[int], counts: Sequence[int], buckets: int = BUCKETS) -> list[int]:
    """Ascending upper lengths of at most ``buckets`` buckets with the least total padding.

    ``lengths`` ascending and distinct.  ``best[j]`` is the least padded size of the first j lengths
    in the buckets used so far; a further bucket that ends at length j begins after some i < j.
    Among equally good boundaries the lowest are taken.
    """
    if not len(lengths):
        return []
    ends = np.asarray(lengths, dtype=np.int64)
    upto = np.concatenate([[0], np.cumsum(np.asarray(counts, dtype=np.int64))])
    best = ends * upto[1:]
    came_from = []
    for _ in range(min(buckets, len(ends)) - 1):
        # A bucket before is never empty, so the next one begins after the first length at least.
        size = np.full(len(ends), np.iinfo(np.int64).max)
        start = np.zeros(len(ends), dtype=np.int64)
        for j in range(1 + len(came_from), len(ends)):
            low = len(came_from)
            options = best[low:j] + ends[j] * (upto[j + 1] - upto[low + 1 : j + 1])
            start[j] = low + int(options.argmin())
            size[j] = options[start[j] - low]
        came_from.append(start)
        best = size
    at, chosen = len(ends) - 1, [int(ends[-1])]
    for start in reversed(came_from):
        at = int(start[at])
        chosen.append(int(ends[at]))
    return chosen[::-1]


def pieces(docs: DataFrame, doc_id: str, tokens: Column, max_tokens: int, order: Sequence[Column] = ()) -> DataFrame:
    """``doc_id, piece, n_tokens`` (and ``_o0, _o1, ...`` for ``order``): nothing is cut off."""
    carried = [column.alias(f"_o{i}") for i, column in enumerate(order)]
    counted = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), tokens.cast("long").alias("all"), *carried)
    last = F.greatest(F.ceil(F.col("all") / max_tokens) - 1, F.lit(0))
    names = [f"_o{i}" for i in range(len(carried))]
    return (
        counted.withColumn("all", F.coalesce("all", F.lit(0)))
        .select("*", F.explode(F.sequence(F.lit(0).cast("long"), last.cast("long"))).alias("piece"))
        .select(
            "doc_id",
            "piece",
            F.least(F.col("all") - F.col("piece") * max_tokens, F.lit(max_tokens)).cast("long").alias("n_tokens"),
            *names,
        )
    )


def pack(
    docs: DataFrame,
    tokens: Column,
    doc_id: str = "doc_id",
    max_tokens: int = MAX_TOKENS,
    budget: int = TOKEN_BUDGET,
    buckets: int = BUCKETS,
    file_order: tuple[Column, Column] | None = None,
) -> DataFrame:
    """``doc_id, piece, n_tokens, bucket, bucket_length, batch, position, padding`` per piece.

    A batch (numbered within its bucket) holds as many rows as ``budget`` allows at the bucket's
    length, at least one; only the last of a bucket may hold fewer.  Pieces fill batches in the order
    of their ids' md5, or by ``file_order`` (a number and a place within it) if rows should keep an
    order they already have.  A text without tokens, or null, is one piece of 0 tokens and is padded
    like one of 1; rows that repeat an id are pieces of their own; an empty table gives no batches;
    columns that are not named are not read.

    Only the histogram, at most ``max_tokens`` rows, comes to the driver.  Ranks in a bucket come from
    ranks inside blocks and the counts before a block, so no task holds a bucket.
    """
    blocks = 4 * shuffle_partitions(docs.sparkSession)
    cut = stored(pieces(docs, doc_id, tokens, max_tokens, file_order or ()))
    length = F.greatest(F.col("n_tokens"), F.lit(1))
    histogram = cut.groupBy(length.alias("length")).count().orderBy("length").collect()
    ends = bucket_boundaries([r["length"] for r in histogram], [r["count"] for r in histogram], buckets)
    bucket, rows_per_batch, bucket_length = F.lit(None).cast("int"), F.lit(1), F.lit(None).cast("long")
    for number, end in reversed(list(enumerate(ends))):
        bucket = F.when(length <= end, number).otherwise(bucket)
        bucket_length = F.when(length <= end, F.lit(end).cast("long")).otherwise(bucket_length)
        rows_per_batch = F.when(length <= end, max(1, budget // end)).otherwise(rows_per_batch)
    placed = cut.withColumn("bucket", bucket)
    if file_order:
        # A file written in order is a block already.
        block, order = F.col("_o0"), ["_o1", "piece"]
    else:
        block = digest_block(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), blocks)
        order = [F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), "doc_id", "piece", "n_tokens"]
    numbered = ranked(placed.withColumn("_block", block), ["bucket"], "_block", order, "_rank", blocks)
    return numbered.select(
        "doc_id",
        "piece",
        "n_tokens",
        "bucket",
        bucket_length.alias("bucket_length"),
        F.floor(F.col("_rank") / rows_per_batch).alias("batch"),
        (F.col("_rank") % rows_per_batch).cast("long").alias("position"),
        (bucket_length - F.col("n_tokens")).alias("padding"),
    )


def written_order(docs: DataFrame) -> tuple[Column, Column] | None:
    """Number of the file and place in it of every row of a Parquet table as read; None for other tables."""
    try:
        docs.select("_metadata.file_name", "_metadata.row_index")
    except AnalysisException:
        return None
    number = F.regexp_extract(F.col("_metadata.file_name"), r"part-(\d+)", 1)
    return F.coalesce(number.try_cast("int"), F.lit(0)), F.col("_metadata.row_index")
