"""The pipeline stage by stage against plain versions, and over awkward and empty tables."""

import pytest
from plain import DOCUMENTS, awkward, base_spans, near_duplicates, quality as plain_quality, words_of
from pyspark.sql import functions as F

import corpus_pipeline
from tallyforge.llm import mixing, packing
from tallyforge.llm.common import shared_folder


@pytest.fixture(scope="module")
def results(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder, out = shared_folder(spark), [docs]
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, out[-1], sf_dir).write.parquet(f"{folder}/{number}")
        out.append(spark.read.parquet(f"{folder}/{number}"))
    return out


def ids(df):
    return [r.doc_id for r in df.select("doc_id").collect()]


def test_stages(results):
    docs, good, single, private, mixed, packed = results
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality rules", "near-duplicates", "personal data", "source mix", "length packing"]
    assert all(df.columns == docs.columns for df in (good, single, private, mixed))

    texts = {r.doc_id: r for r in docs.collect()}
    kept = set(ids(good))
    assert all(plain_quality(t.text)[5] for d, t in texts.items() if d not in kept and plain_quality(t.text)[2] == 0 and "!" not in t.text)
    assert not any(plain_quality(texts[d].text)[5] for d in kept)

    plain = near_duplicates([(d, texts[d].text) for d in kept], 5, 80)
    assert sorted(ids(single)) == [d for d, *_, keep in plain if keep]

    for r in private.collect():
        before = texts[r.doc_id].text
        spans = base_spans(before)
        assert (r.text == before) or spans or "[CARD]" in r.text or "[PHONE]" in r.text
        for _, start, end in spans:
            assert before[start:end] not in r.text
        assert r.n_chars == len(r.text)

    assert sorted(ids(mixed)) == sorted(ids(single))
    order = [(r.slot, r.place, r.doc_id) for r in mixing.mix(private).collect()]
    file, place = packing.written_order(mixed)
    written = mixed.select("doc_id", file.alias("f"), place.alias("p")).orderBy("f", "p").collect()
    assert [r.doc_id for r in written] == [d for *_, d in sorted(order)]

    pieces = packed.orderBy("bucket", "batch", "position").collect()
    at = {r.doc_id: i for i, r in enumerate(written)}
    for bucket in {r.bucket for r in pieces}:
        places = [(at[r.doc_id], r.piece) for r in pieces if r.bucket == bucket]
        assert places == sorted(places)
    total = {}
    for r in pieces:
        total[r.doc_id] = total.get(r.doc_id, 0) + r.n_tokens
    assert total == {r.doc_id: len(words_of(r.text)) for r in mixed.collect()}


def test_run_is_the_stages(spark, sf_dir, results):
    assert sorted(map(tuple, corpus_pipeline.run(spark, sf_dir).collect())) == sorted(map(tuple, results[-1].collect()))


def test_awkward_and_empty_tables(spark, sf_dir):
    for rows in (awkward(), []):
        docs = spark.createDataFrame(rows, DOCUMENTS).withColumn("slot", F.lit(1)).withColumn("kept", F.lit(None).cast("int"))
        folder = shared_folder(spark)
        for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, docs, sf_dir)
            if number < len(corpus_pipeline.STAGES) - 1:
                assert out.columns == docs.columns
            out.write.parquet(f"{folder}/{number}")
            docs = spark.read.parquet(f"{folder}/{number}")
        found = set(ids(docs))
        assert (1 in found and not found & {2, 3, 4, 5, 6, 11}) if rows else not found
