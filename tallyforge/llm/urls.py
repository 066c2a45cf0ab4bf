"""URL filtering: rules by host and path first, gradient-boosted trees on lexical features for the rest."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tallyforge.llm.common import stored

ALLOW, BLOCK = "allow", "block"
# The given rules: what to do, host, path.
RULES = (
    (ALLOW, "org", "/"),
    (BLOCK, "example.org", "/es/"),
    (BLOCK, "example.org", "/en/1"),
    (ALLOW, "com", "/fr/"),
    (BLOCK, "com", "/de/"),
)
# Labelled URLs the trees are fitted on, at most: the smallest by hash, whatever the table's size.
TRAINING_ROWS = 10_000
ITERATIONS, DEPTH, RATE, SEED = 15, 4, 0.3, 11

LEXICAL = (
    "url_length", "host_length", "path_length", "depth", "host_labels", "digit_ratio", "letter_ratio",
    "symbol_ratio", "entropy", "parameters", "longest_token", "has_fragment", "first_segment_length",
)
SUFFIX = ("suffix_pages", "suffix_block_rate", "top_pages", "top_block_rate", "section_pages", "section_block_rate")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _after_scheme(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host_of(url: Column) -> Column:
    """From the first ``://`` to the next ``/``, ``?``, ``#`` or the end; A-Z lower-cased; else empty."""
    host = F.regexp_extract(_after_scheme(url), "^[^/?#]*", 0)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host, to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(_after_scheme(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """The longest fitting rule as ``host + path`` and its verdict; both null where none fits."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for action, rule_host, rule_path in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        rule = F.when(fits, rule_host + rule_path).otherwise(rule)
        verdict = F.when(fits, action).otherwise(verdict)
    return rule, verdict


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def lexical(urls: pd.Series, hosts: pd.Series, paths: pd.Series) -> pd.Series:
    """The features of LEXICAL, in that order."""
    out = []
    for url, host, path in zip(urls, hosts, paths, strict=True):
        url = url or ""
        raw = np.frombuffer(url.encode(), dtype=np.uint8)
        size = max(len(raw), 1)
        counts = np.bincount(raw, minlength=256)
        shares = counts[counts > 0] / size
        digits = counts[48:58].sum()
        letters = counts[65:91].sum() + counts[97:123].sum()
        query = url.partition("#")[0].partition("?")[2]
        segments = [s for s in path.split("/") if s]
        words = url.replace("/", " ").replace(".", " ").replace("-", " ").replace("?", " ").split()
        out.append(
            [
                float(len(url)),
                float(len(host)),
                float(len(path)),
                float(len(segments)),
                float(host.count(".") + 1 if host else 0),
                digits / size,
                letters / size,
                (len(raw) - digits - letters) / size,
                float(-(shares * np.log2(shares)).sum()),
                float(query.count("&") + 1 if query else 0),
                float(max(map(len, words), default=0)),
                float("#" in url),
                float(len(segments[0]) if segments else 0),
            ]
        )
    return pd.Series(out)


def _statistics(rows: DataFrame, key: str, prefix: str) -> DataFrame:
    """Pages, labelled pages and blocked pages per value of ``key``, over all rows."""
    return rows.groupBy(key).agg(
        F.count(F.lit(1)).alias(f"{prefix}_n"),
        F.count("label").alias(f"{prefix}_labelled"),
        F.coalesce(F.sum("label"), F.lit(0.0)).alias(f"{prefix}_blocked"),
    )


def features(rows: DataFrame) -> DataFrame:
    """``rows`` (``url, host, path, label``, label null where unknown) with the array ``features``.

    Suffix statistics come from all rows: how many pages share the host's last two labels, its last
    label, and these with the first path segment, and the share of blocked ones among the labelled.
    A labelled row does not count itself.  Counts are combined before they move; a suffix that a
    third of the pages share is one row of the joined side and is split by the adaptive join.
    """
    last_two = F.regexp_extract("host", r"([^.]*\.)?[^.]*$", 0)
    top = F.substring_index("host", ".", -1)
    section = F.concat_ws("/", last_two, F.regexp_extract("path", "^/([^/]*)", 1))
    keyed = rows.select("*", last_two.alias("suffix"), top.alias("top"), section.alias("section"))
    own, blocked = F.when(F.col("label").isNotNull(), 1).otherwise(0), F.coalesce("label", F.lit(0.0))
    numbers = []
    joined = keyed
    for key in ("suffix", "top", "section"):
        joined = joined.join(_statistics(keyed, key, key), key)
        numbers += [
            F.log1p(F.col(f"{key}_n").cast("double")),
            (F.col(f"{key}_blocked") - blocked + 0.5) / (F.col(f"{key}_labelled") - own + 1),
        ]
    vector = F.concat(lexical("url", "host", "path"), F.array(*numbers))
    return joined.select(*[F.col(f"`{c}`") for c in rows.columns], vector.alias("features"))


@dataclass
class UrlModel:
    """Fitted trees, or one verdict for all where the labels hold fewer than two kinds."""

    trees: GBTClassificationModel | None
    constant: str

    def verdicts(self, rows: DataFrame) -> DataFrame:
        """``rows`` (with ``features``) plus ``method_verdict`` and ``block_score``."""
        if self.trees is None:
            return rows.select(
                "*",
                F.lit(self.constant).alias("method_verdict"),
                F.lit(float(self.constant == BLOCK)).alias("block_score"),
            )
        scored = self.trees.transform(rows.withColumn("vector", array_to_vector("features")))
        return scored.select(
            *[F.col(f"`{c}`") for c in rows.columns],
            F.when(F.col("prediction") == 1, BLOCK).otherwise(ALLOW).alias("method_verdict"),
            F.round(vector_to_array("probability")[1], 6).alias("block_score"),
        )


def train(rows: DataFrame, training_rows: int = TRAINING_ROWS) -> UrlModel:
    """Fit on labelled rows with ``features``: all of them, or the ``training_rows`` of smallest URL hash."""
    order = [F.xxhash64("url"), F.col("url")]
    labelled = rows.where(F.col("label").isNotNull()).orderBy(*order).limit(training_rows)
    # One part: the sample's size is bounded, and small tasks would only cost their start.
    sample = stored(labelled.select(array_to_vector("features").alias("vector"), "label").coalesce(1))
    kinds = [row["label"] for row in sample.groupBy("label").count().orderBy("label").collect()]
    if len(kinds) < 2:
        return UrlModel(None, BLOCK if kinds == [1.0] else ALLOW)
    learner = GBTClassifier(
        featuresCol="vector", labelCol="label", maxIter=ITERATIONS, maxDepth=DEPTH, stepSize=RATE, seed=SEED
    )
    return UrlModel(learner.fit(sample), ALLOW)


def judge(
    pages: DataFrame,
    page_id: str = "page_id",
    url: str = "url",
    rules: Sequence[tuple[str, str, str]] = RULES,
    labels: Column | None = None,
    training_rows: int = TRAINING_ROWS,
) -> DataFrame:
    """``page_id, host, path, rule, verdict, block_score`` of every page.

    A page with a rule gets the rule's verdict, any other one the trees' verdict.  The labelled URLs
    are those that a rule decides, or those where ``labels`` (1.0 block, 0.0 allow) is not null.
    A null URL, or one without ``://``, has empty host and path and is judged by the trees as an
    empty text.  Repeated rows get the same verdict each; without labels of both kinds every other
    page is allowed (blocked, if all labels block).  Columns other than those named are not read.
    """
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    rows = pages.select(
        F.col(f"`{page_id}`").alias("page_id"),
        F.col(f"`{url}`").cast("string").alias("url"),
        *([] if labels is None else [labels.cast("double").alias("label")]),
    ).select("*", host.alias("host"), path.alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    rows = rows.select("*", rule.alias("rule"), verdict.alias("rule_verdict"))
    if labels is None:
        rows = rows.withColumn("label", (F.col("rule_verdict") == BLOCK).cast("double"))
    described = features(rows)
    scored = train(described, training_rows).verdicts(described)
    return scored.select(
        "page_id",
        "host",
        "path",
        "rule",
        F.coalesce("rule_verdict", "method_verdict").alias("verdict"),
        "block_score",
    )


def held_out_accuracy(labelled: DataFrame, share: float = 0.3) -> float:
    """Share of right verdicts on labelled URLs the trees did not see (chosen by the URL's hash).

    ``labelled``: ``url, label``.
    """
    rows = labelled.select("url", F.col("label").cast("double").alias("truth")).select(
        "url", "truth", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")
    )
    held = F.pmod(F.xxhash64("url", F.lit(SEED)), F.lit(1000)) < int(share * 1000)
    described = features(rows.withColumn("label", F.when(~held, F.col("truth"))))
    judged = train(described).verdicts(described).where(held)
    right = (F.col("method_verdict") == BLOCK).cast("double") == F.col("truth")
    return judged.agg(F.avg(right.cast("double"))).first()[0]
