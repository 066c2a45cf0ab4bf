"""HTML character references, decoded with built-in expressions."""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column, functions as F

NUMBERED = r"&#[0-9]+;"
NAMED = r"&[A-Za-z0-9_]+;"


def _replace_each(text: Column, start: str, pattern: str, meaning) -> Column:
    """Cut the text into matches of ``pattern`` and the pieces between, and map the matches.

    Only texts that contain the first characters of a match are cut, and only pieces that begin
    with them are looked at.
    """
    pieces = F.regexp_extract_all(text, F.lit(f"{pattern}|[^&]+|&"), F.lit(0))
    mapped = F.transform(pieces, lambda p: F.when(p.startswith(start), meaning(p)).otherwise(p))
    return F.when(text.contains(start), F.array_join(mapped, "")).otherwise(text)


def _numbered(piece: Column) -> Column:
    digits = F.regexp_extract(piece, r"^&#0*([0-9]{1,7});$", 1)  # '' for any other piece
    code = digits.try_cast("int")
    valid = code.between(0, 0xD7FF) | code.between(0xE000, 0x10FFFF)
    shown = F.decode(F.unhex(F.lpad(F.hex(F.when(valid, code)), 8, "0")), "UTF-32")
    return F.coalesce(shown, piece)


def _named(piece: Column) -> Column:
    names = sorted(name for name in name2codepoint if name != "amp")
    table = F.create_map(*[F.lit(x) for n in names for x in (f"&{n};", chr(name2codepoint[n]))])
    known = F.when(F.length(piece) > 2, F.try_element_at(table, piece))
    return F.coalesce(known, piece)


def decode_entities(text: Column, decode_amp: bool = True) -> Column:
    """``&#NN;`` and ``&name;`` to their character, ``&amp;`` to the word "and" between blanks.

    Numbers are decoded before names.  Unknown names and impossible numbers stay as they are.
    The name table is the standard HTML 4 one.  Texts without an ampersand skip the work.
    """
    numbers_done = _replace_each(text, "&#", NUMBERED, _numbered)
    named = _replace_each(text, "&", NAMED, _named)
    both = _replace_each(numbers_done, "&", NAMED, _named)
    decoded = F.when(text.contains("&#"), both).otherwise(named)
    return F.replace(decoded, F.lit("&amp;"), F.lit(" and ")) if decode_amp else decoded
