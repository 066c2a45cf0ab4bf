"""Toxicity by compression distance: which of two zstandard dictionaries makes a text's windows shorter.

Training looks at a bounded sample of labelled rows (``TRAINING_ROWS`` of each class, of least hash; their
whole texts).  Shingles of ``SHINGLE`` characters inside words are counted by class over the larger part
of it, in different contexts of three words, so that copies of a text count once.  Each class's dictionary holds words that cover, most frequent first, the shingles
standing out for that class (log-odds at least ``LEAST_ODDS``, and root of the likelihood ratio ``STANDS_OUT``), and behind them
both hold the same words covering the commonest shingles, so that what any text has in common costs the
same under either.  A text is cut into windows of ``WINDOW`` words; a window's distance is its compressed length with
the ordinary dictionary less that with the toxic one.  Shares of windows past several distances, their
mean and their number are calibrated by a logistic regression on the part that the dictionaries have not seen, weighted to the
classes' shares among all labelled rows.  Scores come from the text alone.

Defined cases: null, empty and wordless texts have no windows and get the score of that; a null id is not
held out; an id labelled more than once is toxic if any label says so; null labels and labels of other
ids are not read; rows that share an id train by one of their texts; repeated rows are each scored.  With
no labelled text of one class every score is the toxic share of the labels (0 without any).  Windows are of
whole texts, a word longer than ``LONGEST`` characters is cut into several; extra columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, functions as F

from tallyforge.llm.common import sent, stored

TRAINING_ROWS = 6000
CALIBRATION_PART = 3  # one of so many parts of the sample
SHINGLE = 6
STANDS_OUT, LEAST_ODDS = 5.0, 1.5
COMMON_SHINGLES = 6000
CANDIDATE_WORDS = 50_000
OWN_SHINGLES = 4000
COVER = 6
WINDOW = 6
LONGEST = 40
DISTANCES = (1, 2, 3, 4, 5, 6, 8, 10)
# The matcher does not look for matches in an input's last bytes: these follow every window.
TAIL = b"0123456789"

_WORDS = re.compile(rf"[^\W\d_]{{1,{LONGEST}}}")


def words(text: str | None) -> list[str]:
    """Runs of letters, lower-cased."""
    return _WORDS.findall(text.lower()) if text else []


def shingles(word: str) -> set[str]:
    whole = f" {word} "
    return {whole[i : i + SHINGLE] for i in range(max(1, len(whole) - SHINGLE + 1))}


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from training."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def covering(candidates: Iterable[str], wanted: set[str], times: int) -> list[str]:
    """Words, in their order, that hold a wanted shingle which fewer than ``times`` words before hold."""
    held: Counter[str] = Counter()
    out = []
    for word in candidates:
        new = [s for s in shingles(word) if s in wanted and held[s] < times]
        if new:
            out.append(word)
            held.update(new)
    return out


@dataclass
class Dictionaries:
    """What both compressors are given; of equal length, so that offsets cost the same."""

    toxic: bytes
    ordinary: bytes


class Measurer:
    """Compressed lengths of a text's windows under both dictionaries; one per task."""

    def __init__(self, given: Dictionaries):
        import zstandard

        settings = zstandard.ZstdCompressionParameters(
            compression_level=3, min_match=5, strategy=zstandard.STRATEGY_LAZY2, window_log=17, hash_log=17, chain_log=16,
            search_log=6, write_content_size=0, write_checksum=0, write_dict_id=0,
        )
        self.compressors = [
            zstandard.ZstdCompressor(
                dict_data=zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT),
                compression_params=settings,
            )
            for content in (given.ordinary, given.toxic)
        ]

    def distances(self, text: str | None) -> np.ndarray:
        found = words(text)
        ordinary, toxic = (c.compress for c in self.compressors)
        out = np.empty(-(-len(found) // WINDOW))
        for n in range(len(out)):
            window = f" {' '.join(found[n * WINDOW : (n + 1) * WINDOW])} ".encode() + TAIL
            out[n] = len(ordinary(window)) - len(toxic(window))
        return out

    def features(self, text: str | None) -> list[float]:
        far = self.distances(text)
        n = len(far)
        shares = [math.log((np.count_nonzero(far >= t) + 0.05) / (n + 5)) for t in DISTANCES]
        return [float(far.mean()) if n else 0.0, *shares, 1 / math.sqrt(n + 1)]


@dataclass
class ToxicityModel:
    dictionaries: Dictionaries | None
    weights: list[float]
    intercept: float

    def score(self, features: list[float]) -> float:
        z = self.intercept + sum(w * x for w, x in zip(self.weights, features, strict=True))
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, z))))


def constant(share: float) -> ToxicityModel:
    return ToxicityModel(None, [], share)


def training_sample(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, toxic: str, rows: int) -> tuple[DataFrame, list[int]]:
    """Stored ``doc_id, text, toxic, part`` of at most ``rows`` labelled ids a class, and the classes' sizes.

    The ids are chosen among the labels, so the documents are only scanned for them, not shuffled.
    """
    known = (
        labels.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(toxic).cast("int").alias("toxic"))
        .where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
        .withColumn("draw", F.xxhash64("doc_id"))
    )
    known = stored(known)
    sizes = dict(known.groupBy("toxic").count().collect())
    drawn = None
    for kind in (0, 1):
        some = known.where(F.col("toxic") == kind).orderBy("draw", "doc_id").limit(rows)
        drawn = some if drawn is None else drawn.unionByName(some)
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).where(F.length("text") > 0)
    # At most two times ``rows`` ids are broadcast.
    sample = texts.join(F.broadcast(drawn), "doc_id").groupBy("doc_id", "toxic", "draw").agg(
        F.min_by("text", F.xxhash64("text")).alias("text")
    )
    part = F.pmod(F.xxhash64("draw"), F.lit(CALIBRATION_PART)).cast("int")
    return stored(sample.select("doc_id", "text", "toxic", part.alias("part"))), [sizes.get(0, 0), sizes.get(1, 0)]


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every word of a text with a hash of the word and its neighbours."""
    for batch in batches:
        found: set[tuple[int, str, int]] = set()
        for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            own = ["", *words(text), ""]
            for before, word, after in zip(own, own[1:], own[2:], strict=False):
                place = xxhash.xxh64_intdigest(f"{before} {word} {after}") - 2**63
                found.add((toxic, word, place))
        columns = list(zip(*found, strict=True)) if found else [[], [], []]
        yield pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.string()), pa.array(columns[2], pa.int64())],
            names=["toxic", "word", "place"],
        )


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of the shingles inside words."""
    for batch in batches:
        counts: list[Counter] = [Counter(), Counter()]
        for word, ordinary, toxic in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            for piece in shingles(word):
                counts[0][piece] += ordinary
                counts[1][piece] += toxic
        keys = list(counts[0])
        yield pa.RecordBatch.from_pydict(
            {"piece": pa.array(keys, pa.string()), **{n: pa.array([c[k] for k in keys], pa.int64()) for n, c in zip(("ordinary", "toxic"), counts)}}
        )


def dictionaries(sample: DataFrame) -> Dictionaries:
    """Both dictionaries of ``text, toxic`` rows.

    What is counted are different contexts, a word between its neighbours, so that copies of a text, however
    many, count once.
    """
    places = sample.select("text", "toxic").mapInArrow(_contexts, "toxic int, word string, place long").distinct()
    counted = stored(
        places.groupBy("word").agg(F.count_if(F.col("toxic") == 0).alias("ordinary"), F.count_if(F.col("toxic") == 1).alias("toxic"))
    )
    sums = counted.agg(F.sum("ordinary").alias("ordinary"), F.sum("toxic").alias("toxic")).first()
    n0, n1 = (float(sums[k] or 0) for k in ("ordinary", "toxic"))
    a, b = F.col("toxic") + 0.5, F.col("ordinary") + 0.5
    odds = F.log(a / (F.lit(n1 + 1) - a)) - F.log(b / (F.lit(n0 + 1) - b))
    parts = counted.select("word", "ordinary", "toxic").mapInArrow(_pieces, "piece string, ordinary long, toxic long")
    totals = parts.groupBy("piece").agg(F.sum("ordinary").alias("ordinary"), F.sum("toxic").alias("toxic"))
    both = F.col("ordinary") + F.col("toxic")

    def surprise(seen: str, share: float) -> Column:
        return F.when(F.col(seen) > 0, F.col(seen) * F.log(F.col(seen) / (both * max(share, 1e-300)))).otherwise(0.0)

    ratio = 2 * (surprise("ordinary", n0 / max(n0 + n1, 1.0)) + surprise("toxic", n1 / max(n0 + n1, 1.0)))
    pieces = stored(totals.withColumn("odds", odds).withColumn("z", F.signum("odds") * F.sqrt(F.greatest(ratio, F.lit(0.0)))))

    def first(df: DataFrame, order: Column, name: str, count: int) -> list[str]:
        return [r[name] for r in df.orderBy(order, name).select(name).limit(count).collect()]

    own = [
        set(
            first(
                pieces.where((sign * F.col("z") >= STANDS_OUT) & (sign * F.col("odds") >= LEAST_ODDS)),
                F.desc(sign * F.col("z")), "piece", OWN_SHINGLES,
            )
        )
        for sign in (-1, 1)
    ]
    common = set(first(pieces.where(F.col("odds") < LEAST_ODDS), F.desc("ordinary"), "piece", COMMON_SHINGLES))
    shares = [F.col("ordinary") / max(n0, 1.0), F.col("toxic") / max(n1, 1.0)]
    listed = [first(counted.where(shares[k] > shares[1 - k]), F.desc(shares[k]), "word", CANDIDATE_WORDS) for k in (0, 1)]
    usual = first(counted, F.desc("ordinary"), "word", CANDIDATE_WORDS)
    base = covering((w for w in usual if not shingles(w) & own[1]), common, 1)
    ordinary, toxic = (f" {' '.join(covering(listed[k], own[k], COVER) + base)} ".encode() for k in (0, 1))
    size = max(len(ordinary), len(toxic), 8)
    return Dictionaries(toxic.rjust(size, b"~"), ordinary.rjust(size, b"~"))


def _features(given: Dictionaries, place: int):
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        measurer = Measurer(given)
        for batch in batches:
            found = [measurer.features(t) for t in batch.column(place).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(found, pa.list_(pa.float64()))], names=[*batch.schema.names, "features"]
            )

    return measure


def train(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", toxic: str = "toxic", rows: int = TRAINING_ROWS
) -> ToxicityModel:
    """Dictionaries and calibration from the labelled rows that are not held out."""
    sample, sizes = training_sample(docs, labels, doc_id, text, toxic, rows)
    share = sizes[1] / max(1, sum(sizes))
    found = {(r["toxic"], r["seen"]): r["count"] for r in sample.groupBy("toxic", (F.col("part") > 0).alias("seen")).count().collect()}
    if any((kind, seen) not in found for kind in (0, 1) for seen in (True, False)):
        return constant(share)
    given = dictionaries(sample.where("part > 0"))
    rest = sample.where("part = 0").select("text", "toxic")
    measured = stored(rest.mapInArrow(_features(given, 0), "text string, toxic int, features array<double>").drop("text"))
    weight = F.when(F.col("toxic") == 1, share / found[1, False]).otherwise((1 - share) / found[0, False])
    count = found[0, False] + found[1, False]
    fitted = LogisticRegression(maxIter=100, regParam=1e-3, weightCol="weight", labelCol="toxic").fit(
        measured.select(
            F.col("toxic").cast("double").alias("toxic"), array_to_vector("features").alias("features"), (weight * count).alias("weight")
        ).coalesce(1)
    )
    return ToxicityModel(given, fitted.coefficients.toArray().tolist(), float(fitted.intercept))


def score(docs: DataFrame, model: ToxicityModel, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row."""
    named = docs.select(F.col(doc_id).alias("doc_id"), held_out(F.col(doc_id)).alias("held_out"), F.col(text).alias("text"))
    kind = named.schema["doc_id"].dataType.simpleString()
    if model.dictionaries is None:
        return named.drop("text").withColumn("score", F.lit(model.intercept)).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
    shipped = sent(docs.sparkSession, model)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        measurer = Measurer(shipped().dictionaries)
        for batch in batches:
            scores = [shipped().score(measurer.features(t)) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(scores, pa.float64()), pa.array([int(s >= 0.5) for s in scores], pa.int32())],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    return named.mapInArrow(judge, f"doc_id {kind}, held_out boolean, score double, predicted int")


def judge(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", toxic: str = "toxic") -> DataFrame:
    """Every document scored by a model trained on the labelled ones that are not held out."""
    return score(docs, train(docs, labels, doc_id, text, toxic), doc_id, text)
