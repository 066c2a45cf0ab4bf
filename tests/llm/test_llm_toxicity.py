"""Compression-distance toxicity: held-out accuracy, windows against plain compression, awkward rows."""

import zlib

import numpy as np
import pytest
import zstandard
from plain import DOCUMENTS, awkward
from pyspark.sql import functions as F

from tallyforge.llm import toxicity

INSULTS = ["blockhead", "nitwitted", "dunderpate", "clodhopper"]
SYLLABLES = "ba re ti mo nu ka le so vi da pe ru".split()


def texts(n, seed, toxic_share=0.3, length=150):
    """Random words of syllables; toxic texts have an insult every thirty words or so."""
    rng = np.random.default_rng(seed)
    out = []
    for i in range(n):
        toxic = rng.random() < toxic_share
        own = ["".join(rng.choice(SYLLABLES, rng.integers(1, 5))) for _ in range(length)]
        if toxic:
            for place in rng.integers(0, length, length // 30 + 1):
                own[place] = str(rng.choice(INSULTS)).capitalize() + "!"
        out.append((i, " ".join(own), int(toxic)))
    return out


@pytest.fixture(scope="module")
def corpus(spark):
    rows = texts(700, 4)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, x) for i, _, x in rows if i % 10], "doc_id long, toxic int")
    return rows, docs, labels


@pytest.fixture(scope="module")
def model(corpus):
    return toxicity.train(corpus[1], corpus[2])


def test_held_out_accuracy(corpus, model):
    rows, docs, _ = corpus
    got = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    assert len(got) == len(rows)
    held = [i for i, _, _ in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    assert {i for i, r in got.items() if r.held_out} == set(held)
    right = [got[i].predicted == x for i, _, x in rows if i in set(held)]
    assert np.mean(right) >= 0.95 and len(held) > 100
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())


def test_windows_against_plain_compression(corpus, model):
    """Every window's distance is what two fresh compressors give for it."""
    given = model.dictionaries
    measurer = toxicity.Measurer(given)
    assert len(given.toxic) == len(given.ordinary)
    for _, text, _ in corpus[0][:5]:
        own = text.lower().replace("!", "").split()
        lengths = []
        for content in (given.ordinary, given.toxic):
            settings = zstandard.ZstdCompressionParameters(
                compression_level=3, min_match=5, strategy=zstandard.STRATEGY_LAZY2, window_log=17, hash_log=17, chain_log=16,
                search_log=6, write_content_size=0, write_checksum=0, write_dict_id=0,
            )
            one = zstandard.ZstdCompressor(
                dict_data=zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT), compression_params=settings
            )
            lengths.append([len(one.compress((" " + " ".join(own[i : i + 6]) + " ").encode() + toxicity.TAIL)) for i in range(0, len(own), 6)])
        assert measurer.distances(text).tolist() == (np.array(lengths[0]) - np.array(lengths[1])).tolist()
        far = measurer.distances(text)
        assert measurer.features(text)[1] == pytest.approx(np.log(((far >= 1).sum() + 0.05) / (len(far) + 5)))


def test_held_out_labels_are_not_read(spark, corpus, model):
    """Turning every held-out label, and adding labels of unknown ids, changes no score."""
    rows, docs, labels = corpus
    turned = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = toxicity.train(docs, turned.unionByName(spark.createDataFrame([(None, 1), (1, None), (2, 7)], "doc_id long, toxic int")))
    assert again == model


def test_awkward_rows(spark, model, corpus):
    docs = spark.createDataFrame(awkward(), DOCUMENTS).withColumn("score", F.lit("clash")).withColumn("toxic", F.lit("clash"))
    got = toxicity.score(docs, model).collect()
    assert len(got) == len(awkward())
    blank = {r.score for r in got if r.doc_id in (4, 5, 6)}
    assert len(blank) == 1 and blank.pop() < 0.5
    assert [r.held_out for r in got if r.doc_id is None] == [False, False]
    assert len({r.score for r in got if r.doc_id == 2}) == 1
    empty = spark.createDataFrame([], DOCUMENTS)
    assert toxicity.score(empty, model).collect() == []
    assert toxicity.judge(empty, corpus[2]).collect() == []
    ones = spark.createDataFrame([(i, 1) for i in range(8)], "doc_id long, toxic int")
    assert {r.score for r in toxicity.judge(docs, ones).collect()} == {1.0}
    assert {r.score for r in toxicity.judge(docs, ones.limit(0)).collect()} == {0.0}


def test_very_long_text(spark, model):
    """Whole texts: an insult at the end of two megabytes counts among its windows."""
    measurer = toxicity.Measurer(model.dictionaries)
    long_text = "ba re ti mo nu ka " * 120_000
    plain_far, far = measurer.distances(long_text), measurer.distances(long_text + " blockhead nitwitted blockhead")
    assert len(far) == len(plain_far) + 1 and far[-1] >= 5 and (far[:-1] == plain_far).all()
    assert len(measurer.distances("x" * 100_000)) == -(-100_000 // toxicity.LONGEST) // toxicity.WINDOW + 1


def test_given_table(spark):
    """Held-out documents of the larger table: most toxic ones are found, nearly all others left alone."""
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{n}.parquet") for n in ("documents", "labels"))
    truth = dict(labels.select("doc_id", "toxic").collect())
    held = docs.where(toxicity.held_out(F.col("doc_id"))).join(labels.select("doc_id"), "doc_id")
    got = toxicity.score(held, toxicity.train(docs, labels)).collect()
    found = [r.predicted for r in got if truth[r.doc_id]]
    others = [r.predicted for r in got if not truth[r.doc_id]]
    assert len(found) > 50 and np.mean(found) > 0.6 and np.mean(others) < 0.03
