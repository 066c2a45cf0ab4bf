"""Cross-tokenizer alignment against plain set intersection of token ends."""

import hashlib
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from plain import DOCUMENTS, awkward, text_of
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallyforge.llm import alignment

TEXTS = [
    "<|endoftext|> and <s> </s> <unk> in a text", "a▁b", "<0x41> tab\there\r\n\nnew", "日本語のテキスト 🙂🙃 é ö ß", "x" * 5000,
    " " * 3000 + "end", "\n" * 400, "0123456789" * 300, "\u0000 nul", "don't we'll I'd", "  two  blanks  ", "ﬁ ligature ½ Ⅷ",
    "́́ combining", "нет да", "a" * 255 + " " + "b" * 256, "ab" * 20_000,
]


@pytest.fixture(scope="module")
def vocabularies():
    return alignment.load()


def plain(rows):
    """Contract columns by encoding each text with the tokenizers' own libraries."""
    first = Tokenizer.from_file(f"{alignment.TOKENIZERS}/byte_bpe_50k.json")
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=f"{alignment.TOKENIZERS}/piece_bpe_32k.model")
    v = alignment.load()
    found, counts = [], Counter()
    for key, text in rows:
        a = first.encode(" " + text, add_special_tokens=False).ids if text else []
        b = second.encode(text) if text else []
        whole = (" " + text).encode() if text else b""
        if not text or b"".join(v.a_bytes[i] for i in a) != whole or b"".join(v.b_bytes[i] for i in b) != whole:
            found.append((key, 0, 0, [], ""))
            continue
        a_ends, b_ends = (np.cumsum([len(t[i]) for i in x]).tolist() for t, x in ((v.a_bytes, a), (v.b_bytes, b)))
        at_a, at_b = ({e: i for i, e in enumerate(ends)} for ends in (a_ends, b_ends))
        both = sorted(at_a.keys() & at_b.keys())
        groups, i, j = [], 0, 0
        for end in both:
            k, m = at_a[end] + 1, at_b[end] + 1
            groups.append(",".join(map(str, a[i:k])) + "|" + ",".join(map(str, b[j:m])))
            i, j = k, m
        links = [(a[at_a[e]], b[at_b[e]]) for e in both]
        counts.update(links)
        found.append((key, len(a), len(b), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    best = {}
    for (_, y), n in counts.items():
        best[y] = max(best.get(y, 0), n)
    return sorted(
        (
            (k, na, nb, len(ls), len(ls), sum(counts[x] == best[x[1]] for x in ls), sum(counts[x] for x in ls), sha)
            for k, na, nb, ls, sha in found
        ),
        key=str,
    )


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_against_plain(spark, vocabularies):
    rows = [(r[0], r[1]) for r in awkward()] + [(100 + i, t) for i, t in enumerate(TEXTS)] + [(200, text_of(3, 30_000))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert rows_of(alignment.report(docs, vocabularies)) == plain(rows)


def test_given_table_against_plain(spark, sf_dir, vocabularies):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = rows_of(alignment.report(docs, vocabularies))
    assert got == plain(rows)
    assert sum(r[3] for r in got) > 0


def test_all_shared_ends_are_cut():
    """Random ends, with long stretches that share none."""
    rng = np.random.default_rng(5)
    for density in (0.02, 0.3, 0.9):
        a = np.unique(rng.integers(1, 40_000, 4000))
        b = np.unique(np.concatenate((a[rng.random(len(a)) < density], rng.integers(1, 40_000, 3000), a[-1:])))
        b = b[b <= a[-1]]
        lasts = np.unique(np.concatenate((np.flatnonzero(np.isin(a, b))[::50], [len(a) - 1])))
        firsts = np.concatenate(([0], lasts[:-1] + 1))
        cuts = alignment.shared_cuts(a, b, firsts, lasts)
        assert a[cuts].tolist() == np.intersect1d(a, b).tolist()
    none = alignment.shared_cuts(np.array([3, 5, 9]), np.array([2, 4, 9]), np.array([0]), np.array([2]))
    assert none.tolist() == [2]


def test_ids_and_cuts(spark, vocabularies):
    docs = spark.createDataFrame(awkward(), DOCUMENTS).withColumn("a_ids", F.lit("clash")).withColumn("n_a", F.lit(1))
    rows = alignment.align(docs, vocabularies).collect()
    assert len(rows) == len(awkward()) and rows[0].n_a == 1
    for r in rows:
        assert len(r.a_cuts) == len(r.b_cuts)
        if not r.text:
            assert r.a_ids == [] and r.a_cuts == []
            continue
        assert (r.a_cuts[-1], r.b_cuts[-1]) == (len(r.a_ids), len(r.b_ids))
        for sa, ea, sb, eb in zip([0, *r.a_cuts], r.a_cuts, [0, *r.b_cuts], r.b_cuts, strict=False):
            assert b"".join(vocabularies.a_bytes[i] for i in r.a_ids[sa:ea]) == b"".join(
                vocabularies.b_bytes[i] for i in r.b_ids[sb:eb]
            )


def test_empty_table_and_bound(spark, vocabularies):
    empty = spark.createDataFrame([], DOCUMENTS)
    assert alignment.report(empty, vocabularies).collect() == []
    assert alignment.align(empty, vocabularies).collect() == []
    blank = spark.createDataFrame([(1, None), (None, ""), (2, "▁")], "doc_id long, text string").coalesce(1)
    assert {tuple(r)[1:] for r in alignment.report(blank, vocabularies).collect()} == {(0, 0, 0, 0, 0, 0, "")}
    assert vocabularies.pair_bound < 2_000_000 and vocabularies.in_rank_order
