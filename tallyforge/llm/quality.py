"""Quality rules: a table of thresholds compiled into one projection of built-in expressions."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

SPACE = r"\x20\x09-\x0D"
SYMBOLS = "[#*$%&|<>]"
# Fixed values of the base rules.
LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50
# Frequent short words of the four languages, lower case.
STOP_WORDS = (
    "a an and are as at be by for from in is it of on or that the this to was with "
    "au dans de des du en est et il la le les ne par pas pour que qui se sur un une "
    "als auf das dem den der des die ein eine für im in ist mit nicht sich und von zu "
    "al como con del el es la las los más no para por que se su un una y"
).split()


@dataclass(frozen=True)
class Rule:
    """A text passes if ``least <= ratio <= most`` (either may be open)."""

    ratio: str
    least: float | None = None
    most: float | None = None


# Ratios of a text's counts; a text without words has ratio 0 everywhere.
RATIOS: dict[str, Callable[[Column], Column]] = {
    "mean_word_length": lambda m: m["word_chars"] / m["n_words"],
    "symbols_per_word": lambda m: m["n_symbols"] / m["n_words"],
    "exclamations_per_word": lambda m: m["n_exclamations"] / m["n_words"],
    "stop_word_share": lambda m: m["n_stop_words"] / m["n_words"],
    "duplicate_line_share": lambda m: m["n_dup_lines"] / F.greatest(m["n_lines"], F.lit(1)),
    "ellipsis_line_share": lambda m: m["n_ellipsis_lines"] / F.greatest(m["n_lines"], F.lit(1)),
    "bullet_line_share": lambda m: m["n_bullet_lines"] / F.greatest(m["n_lines"], F.lit(1)),
}
RULES = (
    Rule("mean_word_length", 3, 10),
    Rule("symbols_per_word", most=0.1),
    Rule("exclamations_per_word", most=0.5),
    Rule("stop_word_share", least=0.05),
    Rule("duplicate_line_share", most=0.4),
    Rule("ellipsis_line_share", most=0.5),
    Rule("bullet_line_share", most=0.9),
)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once however often ``body`` uses it."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    """Maximal runs of characters other than U+0020 and U+0009 to U+000D; none for null."""
    flat = F.coalesce(text, F.lit(""))
    for space in "\n\t\r\x0b\x0c":
        flat = F.replace(flat, F.lit(space), F.lit(" "))
    # One plain character to split at needs no regular expression; only runs leave empty pieces.
    return let(
        F.btrim(flat),
        lambda line: F.when(F.length(line) == 0, F.array().cast("array<string>"))
        .when(F.contains(line, F.lit("  ")), F.filter(F.split(line, " "), lambda w: w != ""))
        .otherwise(F.split(line, " ")),
    )


def _covered(windows: Column, width: int) -> Column:
    """Number of words inside windows (hashes, one per start, ``width`` words each) that occur more than once."""
    placed = F.sort_array(F.transform(windows, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))

    def repeated(sorted_: Column) -> Column:
        marked = F.transform(
            sorted_,
            lambda e, k: F.when(
                F.coalesce(F.get(sorted_, k - 1)["x"] == e["x"], F.lit(False))
                | F.coalesce(F.get(sorted_, k + 1)["x"] == e["x"], F.lit(False)),
                e["i"],
            ),
        )
        return F.sort_array(F.filter(marked, lambda i: i.isNotNull()))

    return let(
        placed,
        lambda sorted_: F.aggregate(
            repeated(sorted_),
            F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
            lambda a, i: F.struct(
                (a["n"] + i + width - F.greatest(i, a["end"])).alias("n"), (i + width).alias("end")
            ),
            lambda a: a["n"],
        ),
    )


def repeated_words(words: Column, width: int = 3) -> Column:
    """Words inside ``width``-word windows that occur twice or more, the first time included."""
    windows = F.transform(
        F.slice(words, 1, F.greatest(F.size(words) - (width - 1), F.lit(0))),
        lambda x, i: F.xxhash64(x, *[F.get(words, i + k) for k in range(1, width)]),
    )
    # Windows are compared by 64-bit hashes.  Most short texts repeat nothing: a hash set tells, and
    # only the others are sorted.
    return let(
        windows,
        lambda v: F.when(F.size(F.array_distinct(v)) == F.size(v), 0).otherwise(_covered(v, width)),
    )


def measures(text: Column, stop_words: Sequence[str] = STOP_WORDS) -> Column:
    """All counts of a text as one struct of longs."""
    known = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(known, "\n"), lambda line: line.rlike(f"[^{SPACE}]"))
    stop = [w for w in dict.fromkeys(stop_words)]

    def struct(words: Column, kept: Column) -> Column:
        counts = {
            "n_words": F.size(words),
            "word_chars": F.length(F.array_join(words, "")),
            "n_symbols": F.length(known) - F.length(F.regexp_replace(known, SYMBOLS, "")),
            "n_dup_lines": F.size(kept) - F.size(F.array_distinct(kept)),
            "n_repeat_words": repeated_words(words),
            "n_lines": F.size(kept),
            "n_exclamations": F.length(known) - F.length(F.regexp_replace(known, "!", "")),
            "n_stop_words": F.size(
                F.filter(words, lambda w: F.lower(w).isin(stop))
            ),
            "n_ellipsis_lines": F.size(F.filter(kept, lambda line: line.endswith("...") | line.endswith("…"))),
            "n_bullet_lines": F.size(F.filter(kept, lambda line: line.rlike(f"^[{SPACE}]*[-*•]"))),
        }
        return F.struct(*[value.cast("long").alias(name) for name, value in counts.items()])

    return let(words_of(text), lambda words: let(lines, lambda kept: struct(words, kept)))


def passes(m: Column, rules: Sequence[Rule] = RULES) -> Column:
    """Whether counts ``m`` satisfy every row of the threshold table."""
    verdict = F.lit(True)
    for rule in rules:
        ratio = F.when(m["n_words"] == 0, F.lit(0.0)).otherwise(RATIOS[rule.ratio](m))
        if rule.least is not None:
            verdict = verdict & (ratio >= rule.least)
        if rule.most is not None:
            verdict = verdict & (ratio <= rule.most)
    return verdict


def judged(text: Column, rules: Sequence[Rule] = RULES) -> Column:
    """Counts and verdicts of a text as one struct: base rules first, then the threshold table."""

    def verdicts(m: Column) -> Column:
        failed = (m["n_words"] < LEAST_WORDS) | (
            100 * m["n_repeat_words"] > MOST_REPEATED_PERCENT * m["n_words"]
        )
        return F.struct(m.alias("counts"), failed.alias("base_failed"), (~failed & passes(m, rules)).alias("kept"))

    return let(measures(text), verdicts)


def report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """``doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept``.

    One projection, no exchange, whole texts.  A null or empty text has no words and fails the base
    rule; repeated rows are judged alike; columns other than the two named are not read.
    """
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), judged(F.col(f"`{text}`"), rules).alias("judged"))
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return rows.select(
        "doc_id", *[F.col(f"judged.counts.{c}").alias(c) for c in counts], "judged.base_failed", "judged.kept"
    )


def keep(docs: DataFrame, text: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """The rows of ``docs`` whose text passes, all columns as they are."""
    return docs.where(judged(F.col(f"`{text}`"), rules)["kept"])
