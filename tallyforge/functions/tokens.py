"""Tokeniser for short informal messages: one ordered pattern, leftmost match, first class wins.

The pattern uses no look-around and no back-reference, so it means the same to any regular
expression engine with leftmost-first alternatives.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tallyforge.functions.entities import decode_entities
from tallyforge.functions.escape import escape_non_ascii as escape_text

# What separates tokens: the characters that count as white space in text.
SPACE = (
    r"\x{09}-\x{0D}\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
)
LETTER = r"\p{L}"
DIGIT = r"\p{Nd}"
NAME = r"\p{L}\p{N}_"  # letters, numbers, underscore in any script

# The characters an emoticon is made of, and those a URL may hold besides a-z and 0-9.
BROWS = "<>"
EYES = ":;=8"
NOSES = "'*-Oo"
MOUTHS = "()/:@DP[\\]dp{|}"
URL_SIGNS = "!$%&'()*+,-./:;<=>?@ABCDEFGHIJKLMNOPQRSTUVWXYZ[\\]^_"


def one_of(characters: str) -> str:
    """A bracket expression for exactly these characters."""
    return "[" + "".join("\\" + c if c in "[]\\^-" else c for c in characters) + "]"


def joined(piece: str, marks: str, least: int = 1) -> str:
    """``piece`` repeated with one or more of ``marks`` in between, ``least`` times or more after the first."""
    more = "*" if least == 0 else "+"
    return f"{piece}(?:{marks}+{piece}){more}"


FACE = [one_of(BROWS) + "?", one_of(EYES), one_of(NOSES) + "?", one_of(MOUTHS)]
EMOTICON = "".join(FACE) + "|" + "".join(reversed(FACE))
URL = f"[hH][tT][tT][pP][sS]?://[a-z0-9{one_of(URL_SIGNS)[1:]}+"

# A phone number is known by how many digits its run has, not by where its gaps are: 7 to 15 after a
# plus or an opening bracket.  Without such a mark it needs gaps between the last groups, of three and
# four digits, so that years, prices and counts stay what they are.
GAP = f"[-.(){SPACE}]"
MARKED = rf"[+(](?:{GAP}{{0,2}}{DIGIT}){{7,15}}"
GROUPED = rf"(?:{DIGIT}{GAP}{{1,2}})?(?:{DIGIT}{{3}}{GAP}{{1,2}}){{1,2}}{DIGIT}{{4}}"

CLASSES = {
    "phone": f"{MARKED}|{GROUPED}",
    "url": URL,
    "emoticon": EMOTICON,
    "tag": "<[^>]+>",
    "user": f"@[{NAME}]+",
    "topic": "#" + joined(f"[{NAME}]+", "['-]", 0),
    # Letters, at least three characters with the marks between them.
    "joined_word": f"{LETTER}{{3,}}(?:['_-]+{LETTER}+)*|{LETTER}{{1,2}}(?:['_-]+{LETTER}+)+",
    # Fractions, decimals, times and ratios, of any number of parts.
    "number": "[+-]?" + joined(f"{DIGIT}+", "[,./:]"),
    "word": f"[{NAME}]+",
    "ellipsis": rf"\.(?:[{SPACE}]*\.)+",
    "other": f"[^{SPACE}]",
}

TOKEN = "|".join(f"(?:{pattern})" for pattern in CLASSES.values())

# Which tokens keep their capitals: an emoticon as a whole, anything that contains a URL.
KEEP = {"emoticon": f"^(?:{EMOTICON})$", "url": URL}


def token_array(text: Column) -> Column:
    """Tokens of one text in order, case untouched."""
    return F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0))


def fold_case(token: Column, preserve_case_for: tuple[str, ...] = ("emoticon", "url")) -> Column:
    """Lower-case a token unless its class is protected."""
    lowered = F.lower(token)
    if not preserve_case_for:
        return lowered
    protected = F.lit(False)
    for name in preserve_case_for:
        protected = protected | token.rlike(KEEP[name])
    return F.when((token != lowered) & ~protected, lowered).otherwise(token)


def clean_text(text: Column, escape_non_ascii: bool = False, decode_amp: bool = True) -> Column:
    """Text as the tokeniser sees it: entities decoded, optionally non-ASCII text escaped first."""
    if escape_non_ascii:
        text = escape_text(text)
    return decode_entities(text, decode_amp)


def tokenize(
    text: Column,
    preserve_case: bool = False,
    preserve_case_for: tuple[str, ...] = ("emoticon", "url"),
    escape_non_ascii: bool = False,
    decode_amp: bool = True,
) -> Column:
    """Array of tokens of one text."""
    tokens = token_array(clean_text(text, escape_non_ascii, decode_amp))
    if preserve_case:
        return tokens
    return F.transform(tokens, lambda t: fold_case(t, preserve_case_for))


def explode_tokens(
    df: DataFrame,
    keys: list[str],
    text: str,
    preserve_case: bool = False,
    preserve_case_for: tuple[str, ...] = ("emoticon", "url"),
    escape_non_ascii: bool = False,
    decode_amp: bool = True,
) -> DataFrame:
    """Rows (keys..., token).  Same tokens as :func:`tokenize`; case folding runs per row in
    generated code instead of inside an array lambda."""
    raw = escape_text(F.col(text)) if escape_non_ascii else F.col(text)
    raws = df.select(*keys, raw.alias("_raw"))
    texts = raws.select(*keys, decode_entities(F.col("_raw"), decode_amp).alias("_text"))
    # Each step is a column of its own: decoding refers to its input several times, and array
    # lambdas, which it needs, would take the whole generator out of generated code.
    # explode_outer, because an inner explode makes the optimiser run the pattern twice per text,
    # once for a "has any token" filter.
    rows = texts.select(*keys, F.explode_outer(token_array(F.col("_text"))).alias("token"))
    rows = rows.where(F.col("token").isNotNull())
    if preserve_case:
        return rows
    return rows.withColumn("token", fold_case(F.col("token"), preserve_case_for))
