"""Sentence, word and n-gram expressions, all built-in (no Python worker)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

# The 32 ASCII punctuation characters, and the six ASCII blanks.
PUNCTUATION = r"!-/:-@\[-`{-~"
BLANKS = r"\t\n\x0B\f\r "


def sentences(text: Column) -> Column:
    """Array of sentences: the text cut at every full stop followed by a space."""
    return F.split(text, r"\. ")


def lower_case(text: Column, ascii_only: bool = False) -> Column:
    """Lower case of the whole text, or of A-Z only."""
    if ascii_only:
        return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.lower(text)


def words(sentence: Column, punct: str = "space", ascii_only: bool = False) -> Column:
    """Non-empty lower-case words.  ``punct`` says what punctuation becomes: 'space' or 'delete'."""
    text = lower_case(sentence, ascii_only)
    if punct == "space":
        parts = F.split(text, f"[{PUNCTUATION}{BLANKS}]+")
    elif punct == "delete":
        parts = F.split(F.regexp_replace(text, f"[{PUNCTUATION}]+", ""), f"[{BLANKS}]+")
    else:
        raise ValueError("punct is 'space' or 'delete'")
    return F.array_remove(parts, "")


def ngrams(word_array: Column, n: int) -> Column:
    """Array of the n-grams of one word array (each an array of n words); empty if too short."""
    starts = F.sequence(F.lit(1), F.size(word_array) - n + 1)
    grams = F.transform(starts, lambda i: F.slice(word_array, i, n))
    return F.when(F.size(word_array) >= n, grams).otherwise(F.array().cast("array<array<string>>"))


def place_ngrams(
    df: DataFrame,
    text: str,
    sizes: Sequence[int],
    punct: str = "space",
    ascii_only: bool = False,
) -> DataFrame:
    """Rows (words, pos, n) for every n-gram of every sentence: its sentence, start and size.
    :func:`placed_words` gives the words."""
    sizes = sorted(set(sizes))
    at = _words_at(df, text, punct, ascii_only)
    if len(sizes) == 1:
        n = F.lit(sizes[0])
        placed = at.select("words", "pos", n.alias("n"))
    else:
        placed = at.select("words", "pos", F.explode(F.array(*map(F.lit, sizes))).alias("n"))
    return placed.where(F.col("pos") + F.col("n") <= F.size("words"))


def placed_words() -> Column:
    """Array of the words of a row of :func:`place_ngrams`."""
    return F.slice(F.col("words"), F.col("pos") + 1, F.col("n"))


def explode_ngrams(
    df: DataFrame,
    text: str,
    sizes: Sequence[int],
    punct: str = "space",
    ascii_only: bool = False,
) -> DataFrame:
    """Rows (n, ngram) for every n-gram of every sentence, for all ``sizes`` in one pass.

    Row-wise form of :func:`ngrams`: explode, slice and join stay inside generated code, and no
    array of arrays is built for a long sentence.
    """
    if set(sizes) == {1}:
        found = _words_at(df, text, punct, ascii_only).where(F.col("word").isNotNull())
        return found.select(F.lit(1).alias("n"), F.col("word").alias("ngram"))
    placed = place_ngrams(df, text, sizes, punct, ascii_only)
    return placed.select("n", F.array_join(placed_words(), " ").alias("ngram"))


def _words_at(df: DataFrame, text: str, punct: str, ascii_only: bool) -> DataFrame:
    # The outer forms keep the optimiser from putting a "size > 0" filter, and with it a second
    # evaluation of the split, under the generator; rows without words go with the filters after.
    in_sentences = df.select(F.explode_outer(sentences(F.col(text))).alias("sentence"))
    in_words = in_sentences.select(words(F.col("sentence"), punct, ascii_only).alias("words"))
    return in_words.select("words", F.posexplode_outer("words").alias("pos", "word"))
