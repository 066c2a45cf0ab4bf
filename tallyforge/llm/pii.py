"""Personal data by weak supervision: labelers vote on candidate spans, their reliabilities are
estimated without labels, and a classifier trained on the result decides.

Base spans (e-mail, IP, card, phone by pattern and check) always count.  Candidates are all pattern
matches, checked or not, and tighter matches inside runs that the base patterns swallow whole, such as
two card numbers side by side.  Labelers (pattern, check, gazetteer, cue words, surroundings) vote yes,
no or nothing on each.  Expectation-maximisation over the vote patterns of the whole corpus gives each
labeler's reliability and each candidate's probability; logistic regression on the candidates' features
learns from these and scores the candidates outside base spans.

Built-in expressions find the spans; what comes to the driver are counts of vote patterns, of which
there is a fixed number.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, functions as F

from tallyforge.llm.common import stored
from tallyforge.llm.quality import let

# The base kinds in their order, as possessive forms of the given patterns that match the
# same texts in linear time (a run is tried from its start only, or from where the last match ended).
KINDS = ("email", "ip", "card", "phone")
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # A run is whole from its first digit; fewer than 13 digits can be no card.
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?+[0-9]){12,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# A text without this cannot hold the kind.
NEEDS = {"email": "@", "ip": ".", "card": None, "phone": "+"}
# Tighter forms, tried inside runs that the base patterns take whole and their check turns down (for an IP,
# past the start of a dotted run); they only add spans, where the classifier accepts them.
TIGHT = {
    "ip": r"(?<=[0-9]\.)(?:(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])(?:\.(?!$)|(?![0-9.]))){4}(?<=[0-9])",
    "card": r"(?<![0-9A-Za-z])(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{4,5})(?![0-9A-Za-z])",
    "phone": r"\+[0-9]{1,3}[ -]?\(?[0-9]{2,4}\)?[ -]?[0-9]{3,4}[ -]?[0-9]{3,4}(?![0-9])",
}
TOP_DOMAINS = "com org net edu gov info io de fr es uk eu us ch at it nl".split()
CUES = {
    "email": "mail email e-mail contact write kontakt correo courriel",
    "ip": "ip address host server client addr",
    "card": "card visa mastercard amex credit karte carte tarjeta",
    "phone": "phone tel call fax mobile telefon téléphone teléfono",
}
COUNTER_CUES = "version release build isbn issn sha md5 token key hash id order invoice section chapter"
LABELERS = ("pattern", "check", "gazetteer", "cue", "surroundings")
CONTEXT = 24
# Code points of a piece of text in which a match's surroundings are looked up; no less than CONTEXT.
PIECE = 512
SETTLED = 1e-9
THRESHOLD = 0.5
# Characters handled at once where positions are summed up: linear time for any number of matches.
CHUNK = 256


def _running(pieces: Column) -> Column:
    """Sum of ``gap + len`` before each element, plus its ``gap``: where each match starts."""

    def total(part: Column) -> Column:
        return F.aggregate(part, F.lit(0).cast("long"), lambda t, x: t + x["gap"] + x["len"])

    chunks = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(pieces) - 1) / CHUNK).cast("int")),
        lambda c: F.slice(pieces, c * CHUNK + 1, F.lit(CHUNK)),
    )

    def placed(parts: Column) -> Column:
        sums = F.transform(parts, total)
        return let(
            sums,
            lambda s: F.flatten(
                F.transform(
                    parts,
                    lambda part, c: let(
                        F.aggregate(F.slice(s, F.lit(1), c), F.lit(0).cast("long"), lambda t, x: t + x),
                        lambda base: F.transform(part, lambda x, i: base + total(F.slice(part, F.lit(1), i)) + x["gap"]),
                    ),
                )
            ),
        )

    return let(chunks, placed)


def matches(text: Column, pattern: str, needs: str | None = None) -> Column:
    """All matches from left to right as ``start, end, match`` in code points, end exclusive."""
    nothing = F.array().cast("array<struct<start:long,end:long,match:string>>")

    def spans(found: Column) -> Column:
        between = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found))
        pieces = F.zip_with(
            between,
            found,
            lambda gap, m: F.struct(
                F.length(gap).cast("long").alias("gap"), F.length(m).cast("long").alias("len"), m.alias("match")
            ),
        )
        return let(
            pieces,
            lambda p: F.zip_with(
                _running(p),
                p,
                lambda start, x: F.struct(
                    start.alias("start"), (start + x["len"]).alias("end"), x["match"].alias("match")
                ),
            ),
        )

    found = let(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        lambda m: F.when(F.size(m) == 0, nothing).otherwise(spans(m)),
    )
    may = F.contains(text, F.lit(needs)) if needs else text.rlike("[0-9]")
    return F.when(may, found).otherwise(nothing)


def digits_of(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the check digit of a number fits."""
    numbers = F.transform(F.split(F.reverse(digits), ""), lambda d: F.try_to_number(d, F.lit("9")).cast("int"))
    doubled = F.transform(
        numbers, lambda d, i: F.when(i % 2 == 0, d).when(d > 4, 2 * d - 9).otherwise(2 * d)
    )
    return F.aggregate(doubled, F.lit(0), lambda t, d: t + F.coalesce(d, F.lit(0))) % 10 == 0


def _checked(kind: str) -> Callable[[Column], Column]:
    """The base check of a kind's match."""
    if kind == "email":
        return lambda m: F.lit(True)
    if kind == "ip":
        return lambda m: F.forall(
            F.split(m, r"\."), lambda part: let(
                F.regexp_replace(part, "^0+(?=[0-9])", ""),
                lambda p: (F.length(p) <= 3) & (F.lpad(p, 3, "0") <= "255"),
            )
        )
    if kind == "card":
        return lambda m: let(
            digits_of(m), lambda d: F.when(F.length(d).between(13, 19), luhn(d)).otherwise(F.lit(False))
        )
    return lambda m: F.length(digits_of(m)).between(9, 15)


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, 1).when(no, -1).otherwise(0).cast("tinyint")


def _before(pieces: Column, place: Column, count: int) -> Column:
    """Up to ``count`` (at most PIECE) code points before ``place`` in a text cut into ``pieces``.

    A substring of a long text is found by walking from its start; in two pieces the walk is short, so
    the time for all matches is proportional to the text.
    """
    at = F.floor(place / PIECE).cast("int")
    near = F.concat(F.coalesce(F.get(pieces, at - 1), F.lit("")), F.coalesce(F.get(pieces, at), F.lit("")))
    upto = (place - F.greatest(at - 1, F.lit(0)) * PIECE).cast("int")
    return F.substring(near, F.greatest(upto - count + 1, F.lit(1)), F.least(upto, F.lit(count)))


def _after(pieces: Column, place: Column) -> Column:
    """The code point at ``place``; nothing at the text's end."""
    piece = F.coalesce(F.get(pieces, F.floor(place / PIECE).cast("int")), F.lit(""))
    return F.substring(piece, (place % PIECE + 1).cast("int"), F.lit(1))


def _votes(kind: str, pieces: Column, span: Column, base: bool) -> Column:
    """Votes of the labelers and the number of digits (at most 20), as a struct."""
    match = span["match"]
    before = F.lower(_before(pieces, span["start"], CONTEXT))
    neighbours = F.concat(_before(pieces, span["start"], 1), _after(pieces, span["end"]))
    ok = _checked(kind)(match)
    if kind == "email":
        known = F.lower(F.substring_index(match, ".", -1)).isin(TOP_DOMAINS)
        unknown = ~known
    elif kind == "ip":
        known = ~match.rlike(r"^(0|255)\.") & match.rlike(r"[0-9]{2}")
        unknown = match.rlike(r"^(0|255)\.|^[0-9](\.[0-9]){3}$")
    elif kind == "card":
        known, unknown = digits_of(match).rlike("^[3-6]"), digits_of(match).rlike("^[0189]")
    else:
        known, unknown = match.rlike(r"^\+(1|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|7|8[1246]|9[0-58])"), match.rlike(r"^\+0")
    cues = "|".join(CUES[kind].split())
    return F.struct(
        _vote(F.lit(base), F.lit(False)).alias("pattern"),
        _vote(ok, ~ok).alias("check"),
        _vote(known, unknown).alias("gazetteer"),
        _vote(
            before.rlike(rf"\b({cues})\b"), before.rlike(rf"\b({'|'.join(COUNTER_CUES.split())})\b")
        ).alias("cue"),
        _vote(neighbours.rlike(r"^[\s.,;:()\[\]|!?]*$"), neighbours.rlike(r"[A-Za-z0-9\"'=_/]")).alias("surroundings"),
        F.least(F.length(digits_of(match)), F.lit(20)).cast("int").alias("digits"),
    )


_SPAN = "struct<kind:int,start:long,end:long,base:boolean,votes:struct<" + ",".join(
    f"{name}:tinyint" for name in LABELERS
) + ",digits:int>>"


def candidates(text: Column) -> Column:
    """Candidate spans of a text: ``kind`` (its number), ``start, end, base, votes``; ``base`` marks base spans."""

    pieces = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))

    def voted(kind: str, found: Column, cut: Column, is_base: bool) -> Column:
        return F.transform(
            found,
            lambda s: F.struct(
                F.lit(KINDS.index(kind)).alias("kind"),
                s["start"].alias("start"),
                s["end"].alias("end"),
                (_checked(kind)(s["match"]) & F.lit(is_base)).alias("base"),
                _votes(kind, cut, s, is_base).alias("votes"),
            ).cast(_SPAN),
        )

    def inside(kind: str, found: Column, cut: Column) -> Column:
        """Tight matches in each turned-down run, seen with the code point on either side."""

        def of_run(run: Column) -> Column:
            left, right = _before(cut, run["start"], 1), _after(cut, run["end"])
            seen = matches(F.concat(left, run["match"], right), TIGHT[kind], NEEDS[kind])
            offset = run["start"] - F.length(left)
            return F.transform(
                seen,
                lambda s: F.struct(
                    (s["start"] + offset).alias("start"), (s["end"] + offset).alias("end"), s["match"].alias("match")
                ),
            )

        return F.flatten(F.transform(F.filter(found, lambda s: ~_checked(kind)(s["match"])), of_run))

    def of(kind: str) -> Column:
        def judged(found: Column) -> Column:
            def in_pieces(cut: Column) -> Column:
                parts = [voted(kind, found, cut, True)]
                if kind in ("card", "phone"):
                    parts.append(let(inside(kind, found, cut), lambda more: voted(kind, more, cut, False)))
                elif kind in TIGHT:
                    more = F.when(F.size(found) > 0, matches(text, TIGHT[kind], NEEDS[kind])).otherwise(
                        F.array().cast("array<struct<start:long,end:long,match:string>>")
                    )
                    parts.append(let(more, lambda m: voted(kind, m, cut, False)))
                return F.concat(*parts)

            # The text is cut only where something is found.
            none = F.array().cast("array<string>")
            return let(F.when(F.size(found) > 0, pieces).otherwise(none), in_pieces)

        return let(matches(text, PATTERNS[kind], NEEDS[kind]), judged)

    return F.concat(*[of(kind) for kind in KINDS])


@dataclass
class SpanModel:
    """Reliability of each labeler, share of true candidates per kind, and the classifier's weights."""

    reliability: dict[str, float]
    prior: dict[str, float]
    weights: list[float]
    intercept: float

    def score(self, span: Column) -> Column:
        """Probability that a candidate is personal data."""
        total = F.lit(self.intercept)
        for weight, feature in zip(self.weights, _features(span), strict=True):
            total = total + F.lit(weight) * feature
        return 1 / (1 + F.exp(-total))


def _features(span: Column) -> list[Column]:
    """Features of a candidate: votes, each kind, and the number of digits by kind."""
    votes = [span["votes"][name].cast("double") for name in LABELERS]
    kinds = [(span["kind"] == k).cast("double") for k in range(len(KINDS))]
    fits = (
        F.when(span["kind"] == KINDS.index("card"), span["votes"]["digits"].between(13, 19))
        .when(span["kind"] == KINDS.index("phone"), span["votes"]["digits"].between(9, 15))
        .otherwise(True)
    )
    return [*votes, *kinds, fits.cast("double")]


def reliabilities(patterns: list[tuple[int, tuple[int, ...], int]]) -> tuple[list[float], list[float]]:
    """Expectation-maximisation over ``(kind, votes, count)``: each labeler's share of right votes and
    each kind's share of true candidates.  Ends when no estimate moves any more: every round raises the
    likelihood, by less and less.
    """
    right, prior = [0.7] * len(LABELERS), [0.5] * len(KINDS)
    while True:
        agree, cast = [1.0] * len(LABELERS), [1.5] * len(LABELERS)
        true, all_ = [1.0] * len(KINDS), [2.0] * len(KINDS)
        for kind, votes, count in patterns:
            p = posterior(right, prior, kind, votes)
            true[kind] += count * p
            all_[kind] += count
            for labeler, vote in enumerate(votes):
                if vote:
                    agree[labeler] += count * (p if vote > 0 else 1 - p)
                    cast[labeler] += count
        # A labeler worse than chance would turn the meaning of the classes round.
        moved = [min(max(a / c, 0.5), 0.999) for a, c in zip(agree, cast, strict=True)]
        shares = [min(max(t / a, 0.001), 0.999) for t, a in zip(true, all_, strict=True)]
        change = max(abs(x - y) for x, y in zip(moved + shares, right + prior, strict=True))
        right, prior = moved, shares
        if change < SETTLED:
            return right, prior


def posterior(right: list[float], prior: list[float], kind: int, votes: tuple[int, ...]) -> float:
    odds = math.log(prior[kind] / (1 - prior[kind]))
    odds += sum(v * math.log(r / (1 - r)) for v, r in zip(votes, right, strict=True))
    return 1 / (1 + math.exp(-odds))


def train(docs: DataFrame, text: str = "text") -> SpanModel | None:
    """Model of the candidates in all texts of ``docs``; None if there are none."""
    spans = docs.select(F.explode(candidates(F.coalesce(F.col(f"`{text}`"), F.lit("")))).alias("span"))
    # Kinds, votes and digits have finitely many values: the counts are a small table at any size.
    counted = stored(spans.groupBy("span.kind", "span.votes").count())
    votes = [F.col(f"votes.{name}").alias(name) for name in LABELERS]
    rows = counted.groupBy("kind", *votes).agg(F.sum("count").alias("n")).collect()
    if not rows:
        return None
    patterns = sorted((r["kind"], tuple(r[name] for name in LABELERS), r["n"]) for r in rows)
    right, prior = reliabilities(patterns)
    odds = F.lit(0.0)
    for k, share in enumerate(prior):
        odds = F.when(F.col("kind") == k, math.log(share / (1 - share))).otherwise(odds)
    for name, r in zip(LABELERS, right, strict=True):
        odds = odds + F.col(f"votes.{name}") * math.log(r / (1 - r))
    probability = 1 / (1 + F.exp(-odds))
    vector = array_to_vector(F.array(*_features(F.struct("kind", "votes"))))
    soft = counted.select(
        vector.alias("features"),
        F.explode(
            F.array(
                F.struct(F.lit(1.0).alias("label"), (F.col("count") * probability).alias("weight")),
                F.struct(F.lit(0.0).alias("label"), (F.col("count") * (1 - probability)).alias("weight")),
            )
        ).alias("target"),
    ).select("features", "target.label", "target.weight")
    fitted = LogisticRegression(weightCol="weight", regParam=0.001, maxIter=100).fit(stored(soft.coalesce(1)))
    return SpanModel(
        dict(zip(LABELERS, right, strict=True)),
        dict(zip(KINDS, prior, strict=True)),
        [float(w) for w in fitted.coefficients],
        float(fitted.intercept),
    )


def spans(text: Column, model: SpanModel | None) -> Column:
    """``base`` and ``all``: sorted arrays of ``kind, start, end``; ``all`` holds the added spans too."""

    def bare(found: Column) -> Column:
        return F.sort_array(
            F.array_distinct(F.transform(found, lambda s: F.struct(s["kind"], s["start"], s["end"])))
        )

    def split(found: Column) -> Column:
        base = F.filter(found, lambda s: s["base"])
        if model is None:
            return F.struct(bare(base).alias("base"), bare(base).alias("all"))

        def chosen(sure: Column) -> Column:
            added = F.filter(
                found,
                lambda s: ~s["base"]
                & (s["votes"]["check"] > 0)
                & (model.score(s) >= THRESHOLD)
                & ~F.exists(sure, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])),
            )
            return F.struct(bare(sure).alias("base"), bare(F.concat(sure, added)).alias("all"))

        return let(base, chosen)

    return let(candidates(F.coalesce(text, F.lit(""))), split)


def _is_kind(number: int) -> Callable[[Column], Column]:
    return lambda s: s["kind"] == number


def _joined(found: Column) -> Column:
    names = F.array(*[F.lit(kind) for kind in KINDS])
    return F.array_join(
        F.transform(
            found,
            lambda s: F.concat_ws(
                ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")
            ),
        ),
        ",",
    )


def report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans`` of every document.

    The model is trained on all texts of ``docs`` first.  A null or empty text has no spans; repeated
    rows get the same spans each; a table without candidates has base spans only, and so none.
    Columns not named are not read.  No rows are exchanged but counts of vote patterns.
    """
    named = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text")
    )
    model = train(named)
    found = named.select("doc_id", F.explode(F.array(spans(F.col("text"), model))).alias("found"))
    counts = [
        F.size(F.filter(F.col("found.base"), _is_kind(k))).cast("long").alias(f"n_{kind}")
        for k, kind in enumerate(KINDS)
    ]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(_joined(F.col("found.base")), 256).alias("base_sha256"),
        _joined(F.col("found.all")).alias("spans"),
    )


def redacted(text: Column, found: Column) -> Column:
    """``text`` with each span replaced by its kind in brackets; overlapping spans by the first one's."""
    names = F.array(*[F.lit(f"[{kind.upper()}]") for kind in KINDS])
    by_place = F.sort_array(F.transform(found, lambda s: F.struct(s["start"], s["end"], s["kind"])))
    folded = F.aggregate(
        by_place,
        F.struct(F.lit(0).cast("long").alias("end"), F.lit("").alias("out")),
        lambda a, s: F.struct(
            F.greatest(a["end"], s["end"]).alias("end"),
            F.when(
                s["start"] >= a["end"],
                F.concat(a["out"], F.substring(text, a["end"] + 1, s["start"] - a["end"]), F.get(names, s["kind"])),
            ).otherwise(a["out"]).alias("out"),
        ),
        lambda a: F.concat(a["out"], F.substring(text, a["end"] + 1, F.length(text))),
    )
    return F.when(F.size(found) == 0, text).otherwise(folded)


def redact(docs: DataFrame, text: str = "text", n_chars: str | None = "n_chars") -> DataFrame:
    """``docs`` with personal data in ``text`` replaced, and ``n_chars`` (if a column) made to fit.

    Rows without personal data stay as they are, null texts too; other columns are not touched.
    """
    model = train(docs, text)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    found = docs.select(row.alias("row"), F.explode(F.array(spans(F.col(f"`{text}`"), model)["all"])).alias("found"))
    cleaned = redacted(F.col("row")[text], F.col("found"))
    held = F.size("found") > 0
    columns = []
    for name in docs.columns:
        value = F.col("row")[name]
        if name == text:
            value = F.when(held, F.col("cleaned")).otherwise(value)
        elif name == n_chars:
            value = F.when(held, F.length("cleaned").cast(docs.schema[name].dataType)).otherwise(value)
        columns.append(value.alias(name))
    return found.select("*", F.explode(F.array(cleaned)).alias("cleaned")).select(*columns)
