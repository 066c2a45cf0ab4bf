"""Secret scanning: candidates by pattern, false positives removed by a random forest.

Candidates are long runs of key-like characters, and whatever is assigned to a name with a secret's
word or quoted after one, of any length and characters.  Their features: length, how usual their character
transitions are in the corpus, how much of them dictionary words cover, the path they come from and the
words next to them.  The forest is trained on labelled findings.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from tallyforge.llm.common import stored

# Fixed choices of the scan.
CANDIDATE = r"[A-Za-z0-9+/_=-]{16,}"
SECRET_WORDS = "token secret password passwd pwd api apikey api_key key auth bearer credential private access".split()
DIGEST_WORDS = "sha sha1 sha256 md5 checksum digest commit uuid guid hash etag version".split()
TEST_WORDS = "test tests example examples sample samples fixture fixtures mock doc docs demo".split()
NEIGHBOURHOOD = 40
# Share of a bare run that dictionary words must cover before its form counts as no secret.
WORDY = 0.8
# Labelled findings the forest is fitted on, at most (the smallest by hash), and its size.
TRAINING_ROWS = 10_000
TREES, DEPTH, SEED = 24, 6, 17
# A word is in the dictionary if this share of all texts hold it; so its size is at most the mean
# number of different words of a text divided by this share, whatever the number of texts.  Runs of
# letters longer than a word ever is are no words; candidates are described whole at any length.
DICTIONARY_SHARE = 0.002
SHORTEST_WORD, LONGEST_WORD = 3, 24

_NAME = re.compile(rf"(?:{'|'.join(SECRET_WORDS)})[a-z0-9_]*", re.IGNORECASE)
# In quotes to their end on the same line, escapes included; else up to a space or quote.
_QUOTED = "|".join(rf"{q}(?P<{n}>(?:[^{q}\\\n]|\\[^\n])+){q}" for n, q in (("double", '"'), ("single", "'"), ("back", "`")))
_ASSIGNED = re.compile(rf"[\"'`\])]*\s*(?::=|=>|[=:]+)\s*(?:{_QUOTED}|[\"'`]?(?P<bare>[^\s\"'`]*[^\s\"'`,;]))")
# Not from the quote that ends a quoted name.
_QUOTED_AFTER = re.compile(rf"(?![\"'`]\s*[=:])[^\n\"'`]{{0,{NEIGHBOURHOOD}}}(?:{_QUOTED})")

# Classes of characters for transitions: a-z, digits, everything else.
CLASSES = 28
_CLASS = np.full(256, CLASSES - 1, dtype=np.int64)
for _letter in range(26):
    _CLASS[97 + _letter] = _CLASS[65 + _letter] = _letter
_CLASS[48:58] = 26

FEATURES = (
    "length", "transition", "transition_low", "dictionary", "digit_share", "upper_share", "hex_share", "distinct_share",
    "class_changes", "path_depth", "path_length", "path_is_test", "secret_word_near", "digest_word_near", "assigned",
    "quoted", "alone",
)


def _statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial counts: transitions (``kind`` 0), texts per word (1) and texts (2)."""
    for batch in batches:
        pairs = np.zeros(CLASSES * CLASSES, dtype=np.int64)
        words: Counter[str] = Counter()
        texts = 0
        for value in batch.column(0):
            text = value.as_py() or ""
            texts += 1
            classes = _CLASS[np.frombuffer(text.encode(), dtype=np.uint8)]
            pairs += np.bincount(classes[:-1] * CLASSES + classes[1:], minlength=CLASSES * CLASSES)
            words.update({w for w in re.findall(r"[a-z]+", text.lower()) if SHORTEST_WORD <= len(w) <= LONGEST_WORD})
        held = np.nonzero(pairs)[0]
        keys = [*map(str, held), *words, ""]
        kinds = [0] * len(held) + [1] * len(words) + [2]
        counts = [*pairs[held].tolist(), *words.values(), texts]
        yield pa.RecordBatch.from_arrays([pa.array(kinds, pa.int32()), pa.array(keys), pa.array(counts, pa.int64())],
                                         names=["kind", "key", "n"])


def corpus_statistics(docs: DataFrame, text: str = "text") -> tuple[np.ndarray, set[str]]:
    """Log-probabilities of transitions and the dictionary, from all texts of ``docs``.

    Counts are combined in the tasks and by a shuffle; to the driver come the transitions, of which
    there are ``CLASSES`` squared, and the words above the share.
    """
    counts = stored(
        docs.select(F.col(f"`{text}`").cast("string").alias("text"))
        .mapInArrow(_statistics, "kind int, key string, n long")
        .groupBy("kind", "key")
        .agg(F.sum("n").alias("n"))
    )
    texts = counts.where("kind = 2").agg(F.sum("n")).first()[0] or 0
    pairs = np.ones((CLASSES, CLASSES))
    for row in counts.where("kind = 0").collect():
        pairs[divmod(int(row["key"]), CLASSES)] += row["n"]
    usual = counts.where("kind = 1").where(F.col("n") >= max(1.0, DICTIONARY_SHARE * texts)).select("key")
    return np.log(pairs / pairs.sum(axis=1, keepdims=True)), {row["key"] for row in usual.collect()}


def covered(word: str, dictionary: set[str], longest: int) -> float:
    """Share of the characters that dictionary words cover, longest first from the left.

    Dictionary words have at most ``LONGEST_WORD`` letters, so the time is proportional to ``word``.
    """
    low, at, held = word.lower(), 0, 0
    while at < len(low):
        for size in range(min(longest, LONGEST_WORD, len(low) - at), SHORTEST_WORD - 1, -1):
            if low[at : at + size] in dictionary:
                held += size
                at += size
                break
        else:
            at += 1
    return held / max(len(low), 1)


def describe(
    found: str, before: str, after: str, path: str, transitions: np.ndarray, dictionary: set[str], longest: int
) -> list[float]:
    """The features of FEATURES, in that order."""
    raw = np.frombuffer(found.encode(), dtype=np.uint8)
    classes = _CLASS[raw]
    # A single character has no transition: the mean one stands for it.
    steps = transitions[classes[:-1], classes[1:]] if len(raw) > 1 else np.array([transitions.mean()])
    kinds = np.where(classes < 26, np.where(raw < 97, 1, 0), np.where(classes == 26, 2, 3))
    near = set(re.findall(r"[a-z0-9_]+", before.lower())[-4:])
    parts = [p for p in re.split(r"[/\\._-]+", path.lower()) if p]
    size = len(found)
    return [
        float(size),
        float(steps.mean()),
        float(np.percentile(steps, 10)),
        covered(found, dictionary, longest),
        float((kinds == 2).mean()),
        float((kinds == 1).mean()),
        sum(c in "0123456789abcdefABCDEF" for c in found) / size,
        len(set(found)) / size,
        float((kinds[1:] != kinds[:-1]).mean()) if len(raw) > 1 else 0.0,
        float(path.count("/")),
        float(len(path)),
        float(any(p in TEST_WORDS for p in parts)),
        float(any(w in SECRET_WORDS for w in near)),
        float(any(w in DIGEST_WORDS for w in near)),
        float(bool(re.search(r"[=:]\s*[\"'`]?$", before))),
        float(before[-1:] in ("'", '"', "`") and after[:1] in ("'", '"', "`")),
        float((not before or before[-1].isspace()) and (not after or after[0].isspace())),
    ]


def spans(text: str) -> list[tuple[int, int]]:
    """Starts and ends of the candidates in ``text``, each once; a value may hold a long run, and both are given."""
    found = {match.span() for match in re.finditer(CANDIDATE, text)}
    for name in _NAME.finditer(text):
        for pattern in (_ASSIGNED, _QUOTED_AFTER):
            if value := pattern.match(text, name.end()):
                found.add(value.span(value.lastgroup))
    return sorted(found)


_FOUND = "doc_id long, start long, length long, secret string, before string, after string, features array<double>"


def _scan(transitions: np.ndarray, dictionary):
    schema = pa.schema(
        [
            ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("secret", pa.string()),
            ("before", pa.string()), ("after", pa.string()), ("features", pa.list_(pa.float64())),
        ]
    )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = dictionary.value
        longest = max(map(len, words), default=0)
        for batch in batches:
            rows = []
            for doc_id, text, path in zip(*batch.to_pydict().values(), strict=True):
                text = text or ""
                for start, end in spans(text):
                    secret, before, after = text[start:end], text[max(0, start - NEIGHBOURHOOD) : start], text[end : end + NEIGHBOURHOOD]
                    features = describe(secret, before, after, path or "", transitions, words, longest)
                    rows.append((doc_id, start, end - start, secret, before, after, features))
            names = [f.name for f in schema]
            yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in rows], schema=schema)

    return scan


def candidates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str | None = "source") -> DataFrame:
    """``doc_id, start, length, secret, before, after, features`` of every candidate in every whole text."""
    transitions, dictionary = corpus_statistics(docs, text)
    shipped = docs.sparkSession.sparkContext.broadcast(dictionary)
    rows = docs.select(
        F.col(f"`{doc_id}`").cast("long").alias("doc_id"),
        F.col(f"`{text}`").cast("string").alias("text"),
        (F.col(f"`{path}`").cast("string") if path else F.lit("")).alias("path"),
    )
    return stored(rows.mapInArrow(_scan(transitions, shipped), _FOUND))


def labelled_by_form(found: DataFrame) -> Column:
    """Label of a finding whose form leaves no doubt, else null.

    1: quoted, and assigned to a name with a secret's word (``auth_2``, not ``author``); 0: neither quoted
    nor assigned, with no such word before it, and covered by dictionary words.  A bare run of other
    characters may be a key, and has no label.
    """
    names = "|".join(SECRET_WORDS)
    sure = F.col("before").rlike(rf"(?i)({names})s?([0-9_][a-z0-9_]*)?\s*[=:]\s*[\"'`]$") & F.col("after").rlike("^[\"'`]")
    never = ~F.col("before").rlike(rf"(?i)\b({names})\b|[=:]\s*[\"'`]?$") & ~F.col("after").rlike("^[\"'`]")
    wordy = F.col("features")[FEATURES.index("dictionary")] >= WORDY
    return F.when(sure, 1.0).when(never & wordy, 0.0)


def train(found: DataFrame, label: Column, training_rows: int = TRAINING_ROWS) -> RandomForestClassificationModel | float:
    """The forest, fitted on labelled findings; the only label, or 0, where there are not two kinds."""
    order = [F.xxhash64("secret", "doc_id", "start"), "doc_id", "start"]
    rows = found.select("*", label.cast("double").alias("label")).where("label is not null")
    sample = stored(
        rows.orderBy(*order).limit(training_rows).select(array_to_vector("features").alias("vector"), "label").coalesce(1)
    )
    kinds = [row["label"] for row in sample.select("label").distinct().collect()]
    if len(kinds) < 2:
        return kinds[0] if kinds else 0.0
    learner = RandomForestClassifier(
        featuresCol="vector", labelCol="label", numTrees=TREES, maxDepth=DEPTH, seed=SEED
    )
    return learner.fit(sample)


def judged(found: DataFrame, model: RandomForestClassificationModel | float) -> DataFrame:
    """``found`` with ``score`` and ``is_secret``."""
    if isinstance(model, float):
        return found.select("*", F.lit(model).alias("score"), F.lit(model >= 0.5).alias("is_secret"))
    scored = model.transform(found.withColumn("vector", array_to_vector("features")))
    score = vector_to_array("probability")[1]
    return scored.select(*found.columns, F.round(score, 6).alias("score"), (score >= 0.5).alias("is_secret"))


def scan(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    path: str | None = "source",
    label: Column | None = None,
    training_rows: int = TRAINING_ROWS,
) -> DataFrame:
    """``doc_id, start, length, secret_sha256, score, is_secret`` of every candidate.

    Candidates are runs of CANDIDATE, and values of any length and characters that are assigned to a
    name with a word of SECRET_WORDS, or quoted within NEIGHBOURHOOD characters after one on its line;
    a quoted value ends on its line.  Where a value holds a run, both are given.

    ``label`` (1.0, 0.0 or null, over the columns of ``candidates``) gives the labelled findings; by
    default those whose form leaves no doubt.  A null or empty text has no candidates; repeated rows
    give their findings each; without labels of two kinds all findings get the only label, or none is
    a secret.  Starts and lengths count code points; columns not named are not read.
    """
    found = candidates(docs, doc_id, text, path)
    model = train(found, labelled_by_form(found) if label is None else label, training_rows)
    return judged(found, model).select(
        "doc_id", "start", "length", F.sha2("secret", 256).alias("secret_sha256"), "score", "is_secret"
    )


def held_out_accuracy(found: DataFrame, label: Column, share: float = 0.3) -> float:
    """Share of right verdicts on labelled findings the forest did not see (chosen by the secret's hash)."""
    held = F.pmod(F.xxhash64("secret", F.lit(SEED)), F.lit(1000)) < int(share * 1000)
    rows = found.withColumn("truth", label)
    model = train(rows, F.when(~held, F.col("truth")))
    right = (F.col("truth") >= 0.5) == F.col("is_secret")
    return judged(rows.where(held & F.col("truth").isNotNull()), model).agg(F.avg(right.cast("double"))).first()[0]
