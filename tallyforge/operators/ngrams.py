"""Most frequent n-grams of a corpus."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyforge.functions.text import explode_ngrams, place_ngrams, placed_words
from tallyforge.session import materialise

# Slots that the n-grams of a size are hashed to when only the most frequent are wanted: 2 ** 17.
SLOT_BITS = 17
# Share of the slots, the fullest ones, whose n-grams are counted first.
FIRST = 1 / 64
# Passes over the texts that this takes at most.
PASSES = 3


def count_ngrams(
    df: DataFrame,
    text: str,
    sizes: Sequence[int],
    punct: str = "space",
    ascii_only: bool = False,
    tasks: int | None = None,
) -> DataFrame:
    """``n, ngram, count`` of every n-gram.  One scan for all sizes; frequent n-grams are summed
    before the shuffle, so no n-gram is a hot key.

    A task makes up to ``len(sizes)`` n-grams per word.  Where splits are large, ``tasks`` deals
    the texts out first; some 20 MB of text per task keep the summing in memory, which is worth
    more than the move of the texts.
    """
    if tasks is not None:
        df = df.select(text).repartition(tasks)
    grams = explode_ngrams(df, text, sizes, punct, ascii_only)
    return grams.groupBy("n", "ngram").agg(F.count(F.lit(1)).alias("count"))


def _best(counts: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("n").orderBy(F.desc("count"), F.asc("ngram"))
    ranked = counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("n", "rank", "count", "ngram")


def _slotted(
    df: DataFrame,
    text: str,
    sizes: Sequence[int],
    slot_bits: int,
    punct: str = "space",
    ascii_only: bool = False,
    tasks: int | None = None,
) -> DataFrame:
    """Every n-gram by its place, with the slot its hash falls into."""
    if tasks is not None:
        df = df.select(text).repartition(tasks)
    within = F.xxhash64(placed_words()).bitwiseAND(F.lit((1 << slot_bits) - 1))
    slot = F.shiftleft(F.col("n").cast("long"), slot_bits).bitwiseOR(within)
    return place_ngrams(df, text, sizes, punct, ascii_only).withColumn("slot", slot)


def _counts_in(slots: DataFrame, slotted: DataFrame) -> DataFrame:
    """Exact counts of the n-grams of some slots; only their texts are built and moved."""
    chosen = slotted.join(F.broadcast(slots.select("slot")), "slot", "left_semi")
    grams = chosen.select("n", F.array_join(placed_words(), " ").alias("ngram"))
    return grams.groupBy("n", "ngram").agg(F.count(F.lit(1)).alias("count"))


def _at_least(bounds: dict[int, int]) -> Column:
    by_size = F.create_map(*[F.lit(x) for pair in bounds.items() for x in pair])
    return F.col("load") >= by_size[F.col("n")]


def _narrowed(
    df: DataFrame, text: str, sizes: Sequence[int], k: int, slot_bits: int = SLOT_BITS, **options
) -> tuple[DataFrame, DataFrame, bool]:
    """The best ``k`` n-grams per size of the fullest slots; the counts of all n-grams that can be
    among the best ``k`` of the corpus, not computed yet; whether the two lead to the same best.

    No n-gram is more frequent than its slot is full.  What is moved first are the numbers of
    n-grams per slot, whose rows the number of slots bounds.  The ``k``-th best count in the fullest
    slots is one that the ``k``-th best of all reaches, so slots with fewer n-grams hold none of
    them: exact, however the n-grams are spread.  If they are spread so evenly that the ``k``-th is
    no more frequent than an average slot is full, few slots go and most n-grams move.
    """
    slotted = _slotted(df, text, sizes, slot_bits, **options)
    loads = slotted.groupBy("slot").agg(F.count(F.lit(1)).alias("load"))
    loads = materialise(loads.withColumn("n", F.shiftright("slot", slot_bits).cast("int")))
    none = {n: 0 for n in sizes}
    full = loads.groupBy("n").agg(F.percentile_approx("load", 1 - FIRST).alias("bound")).collect()
    fullest = _at_least(none | {r.n: r.bound for r in full})
    found = materialise(_best(_counts_in(loads.where(fullest), slotted), k))
    floors = none | {r.n: r["count"] for r in found.where(F.col("rank") == k).collect()}
    rest = loads.where(~fullest).groupBy("n").agg(F.max("load").alias("load")).collect()
    possible = loads.where(_at_least(floors))
    return found, _counts_in(possible, slotted), all(r.load < floors[r.n] for r in rest)


def top_ngrams(
    df: DataFrame, text: str, sizes: Sequence[int] = (1, 2, 3, 4, 5), k: int = 5, **options
) -> DataFrame:
    """``n, rank, count, ngram``: the ``k`` most frequent per size, ties by n-gram ascending.

    Two passes over the texts where the most frequent stand out, else three; options are those of
    :func:`count_ngrams` and ``slot_bits``, of which 17 make half a million slots and some 40 MB
    per task for four sizes.  Every task keeps at most ``k`` rows per size before the last exchange.
    """
    found, counts, settled = _narrowed(df, text, sizes, k, **options)
    return found if settled else _best(counts, k)


def leading_ngrams(df: DataFrame, text: str, n: int, k: int, **options) -> DataFrame:
    """The first ``k`` rows of :func:`sorted_ngrams`, moving only n-grams that can be among them."""
    _, counts, _ = _narrowed(df, text, [n], k, **options)
    return counts.select("count", "ngram").orderBy(F.desc("count"), F.asc("ngram")).limit(k)


def sorted_ngrams(df: DataFrame, text: str, n: int, **options) -> DataFrame:
    """All n-grams of one size by falling count; :func:`leading_ngrams` for the first of them."""
    counts = count_ngrams(df, text, [n], **options)
    return counts.select("count", "ngram").orderBy(F.desc("count"), F.asc("ngram"))
