"""Byte escapes for text outside ASCII."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def escape_non_ascii(text: Column) -> Column:
    """Texts with any non-ASCII character become printable ASCII, byte by byte; others stay as is.

    In an escaped text, bytes outside the printable range read ``\\xNN``; tab, newline, return,
    backslash and single quote read as backslash pairs.
    """
    pairs = F.regexp_extract_all(F.hex(F.encode(text, "UTF-8")), F.lit(".."), F.lit(0))

    def shown(pair: Column) -> Column:
        return (
            F.when(pair == "09", F.lit("\\t"))
            .when(pair == "0A", F.lit("\\n"))
            .when(pair == "0D", F.lit("\\r"))
            .when(pair == "5C", F.lit("\\\\"))
            .when(pair == "27", F.lit("\\'"))
            .when(pair.between("20", "7E"), F.decode(F.unhex(pair), "UTF-8"))
            .otherwise(F.concat(F.lit("\\x"), F.lower(pair)))
        )

    escaped = F.array_join(F.transform(pairs, shown), "")
    return F.when(text.rlike(r"[^\x{00}-\x{7F}]"), escaped).otherwise(text)
