import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tallyforge.functions import text as text_
from tallyforge.functions import tokens
from tallyforge.functions.entities import decode_entities
from tallyforge.functions.escape import escape_non_ascii
from tallyforge.operators import ngrams
from tallyforge.sources import corpus


def one(spark, column, value):
    return spark.createDataFrame([(value,)], "t string").select(column.alias("x")).first().x


@pytest.fixture(scope="module")
def corpus_df(spark):
    texts = [
        "",  # empty record
        "... --- !!!",  # punctuation only
        "a -- b. a b",
        "A   b  c. ÉTÉ “q”",
        "x y x y",
    ]
    return spark.createDataFrame([(t,) for t in texts], "text string")


def test_words(spark):
    w = lambda v, **o: one(spark, text_.words(F.col("t"), **o), v)
    assert w("") == [] and w("  \t ") == [] and w("--- !") == []
    assert w("a -- b") == ["a", "b"]
    assert w("a -- b", punct="delete") == ["a", "b"]
    assert w("don't e-mail") == ["don", "t", "e", "mail"]
    assert w("don't e-mail", punct="delete") == ["dont", "email"]
    assert w("ÉTÉ “Q”") == ["été", "“q”"]
    assert w("ÉTÉ Q", ascii_only=True) == ["ÉtÉ".replace("t", "t"), "q"]
    with pytest.raises(ValueError):
        text_.words(F.col("t"), punct="other")


def test_ngram_arrays(spark):
    grams = lambda v, n: one(spark, text_.ngrams(F.split("t", " "), n), v)
    assert grams("a b c", 2) == [["a", "b"], ["b", "c"]]
    assert grams("a b", 3) == []


def test_ngrams_stay_inside_a_sentence(spark, corpus_df):
    counts = {(r.n, r.ngram): r["count"] for r in ngrams.count_ngrams(corpus_df, "text", [1, 2]).collect()}
    assert counts[(1, "a")] == 3 and counts[(1, "b")] == 3 and counts[(2, "a b")] == 3
    assert (2, "b a") not in counts
    assert (1, "") not in counts
    assert counts[(2, "x y")] == 2 and counts[(2, "y x")] == 1


@pytest.mark.parametrize("n", [1, 2, 3, 5])
def test_single_size_equals_all_sizes(spark, corpus_df, n):
    alone = rows(ngrams.count_ngrams(corpus_df, "text", [n]))
    together = rows(ngrams.count_ngrams(corpus_df, "text", [1, 2, 3, 4, 5]).where(F.col("n") == n))
    assert alone == together


def test_ties_by_ngram(spark, corpus_df):
    top = ngrams.top_ngrams(corpus_df, "text", [1], k=3).orderBy("rank").collect()
    assert [(r["count"], r.ngram) for r in top] == [(3, "a"), (3, "b"), (2, "x")]
    assert [r.ngram for r in ngrams.sorted_ngrams(corpus_df, "text", 1).limit(3).collect()] == ["a", "b", "x"]


def test_few_repeated_ngrams(spark):
    """Sizes without k repeated n-grams still get their k, or all there are."""
    df = spark.createDataFrame([("a a b c",), ("d e",)], "text string")
    top = [tuple(r) for r in ngrams.top_ngrams(df, "text", [1, 2, 5], k=2).orderBy("n", "rank").collect()]
    assert top == [(1, 1, 2, "a"), (1, 2, 1, "b"), (2, 1, 1, "a a"), (2, 2, 1, "a b")]
    dealt = ngrams.count_ngrams(df, "text", [1], tasks=3)
    assert rows(dealt) == rows(ngrams.count_ngrams(df, "text", [1]))


def test_only_leading_ngrams_are_moved(spark, monkeypatch):
    """Of 270 repeated n-grams of a size, only those of the 20 frequent words are counted by text."""
    rare = " ".join(f"w{i}" for i in range(250))
    frequent = " ".join(f"f{i:02}" for i in range(20))
    df = spark.createDataFrame([(rare,)] * 2 + [(frequent,)] * 50, "text string")
    counted, best = [], ngrams._best
    monkeypatch.setattr(ngrams, "_best", lambda counts, k: counted.append(counts.count()) or best(counts, k))
    top = rows(ngrams.top_ngrams(df, "text", k=2))
    assert top[:2] == [(1, 1, 50, "f00"), (1, 2, 50, "f01")] and len(top) == 10
    assert sum(counted) < 5 * 25
    text = ngrams.leading_ngrams(df, "text", 2, 2)._jdf.queryExecution().executedPlan().toString()
    assert "LeftSemi" in text and text.count("split(lower") == 1


def test_leading_ngrams_however_they_share_slots(spark):
    """Skewed, even and single n-grams, in many slots and in two: the same as counting all."""
    draw = random.Random(3)
    skewed = [" ".join(f"v{int(draw.paretovariate(0.7)) % 90}" for _ in range(30)) + ". a b" for _ in range(40)]
    even = [" ".join(f"e{(i * 7 + j) % 60}" for j in range(12)) for i in range(60)]
    single = [f"s{i} t{i} u{i}" for i in range(300)]
    for texts in (skewed, even, single, ["", "..."]):
        df = spark.createDataFrame([(t,) for t in texts], "text string")
        all_counts = [tuple(r) for r in ngrams.count_ngrams(df, "text", [1, 2, 3]).collect()]
        order = {n: sorted(((-c, g) for m, g, c in all_counts if m == n)) for n in (1, 2, 3)}
        wanted = [(n, i + 1, -c, g) for n in order for i, (c, g) in enumerate(order[n][:4])]
        for slot_bits in (1, 6, 17):
            top = ngrams.top_ngrams(df, "text", [3, 1, 2], k=4, slot_bits=slot_bits)
            assert sorted(map(tuple, top.collect())) == wanted, slot_bits
        first = ngrams.leading_ngrams(df, "text", 2, 7, slot_bits=6).collect()
        assert [(-r["count"], r.ngram) for r in first] == order[2][:7]


def test_paragraphs_and_manifest(spark, tmp_path):
    (tmp_path / "book.txt").write_bytes(b"one\r\ntwo\r\n\r\nthree\r\n\r\n\r\n\r\nfour")
    found = [r.value for r in corpus.read_paragraphs(spark, str(tmp_path / "book.txt")).collect()]
    assert found == ["one\r\ntwo", "three", "", "four"]
    for name in ("a", "b"):
        (tmp_path / name).write_text(f"{name}1\n{name}2\n")
    (tmp_path / "list").write_text(f"{tmp_path}/a\n\n{tmp_path}/b  \n\n")
    paths = corpus.read_manifest(spark, str(tmp_path / "list"))
    assert rows(corpus.read_lines(spark, paths)) == [("a1",), ("a2",), ("b1",), ("b2",)]


CASES = [
    ("call +1 (555) 123-4567 now", ["call", "+1 (555) 123-4567", "now"]),
    ("see HTTP://Ex.com/A?b=C&d#frag", ["see", "HTTP://Ex.com/A?b=C&d", "#frag"]),
    (":-D =P (: XD", [":-D", "=P", "(:", "xd"]),
    ("<b>Bold</b> <A HREF='http://X.y/Z'>", ["<b>", "bold", "</b>", "<A HREF='http://X.y/Z'>"]),
    ("@User_1 ##Tag #a #a-b' 5#", ["@user_1", "#", "#tag", "#a", "#a-b", "'", "5", "#"]),
    ("Don't e-mail x-", ["don't", "e-mail", "x", "-"]),
    ("1/2 3.14 10:30 -5,2 1,234.56 3-4", ["1/2", "3.14", "10:30", "-5,2", "1,234.56", "3", "-", "4"]),
    ("555 123 4567, 123-4567 +49.30.1234567", ["555 123 4567", ",", "123-4567", "+49.30.1234567"]),
    ("2024-2025 5551234 (12) 1-2", ["2024", "-", "2025", "5551234", "(", "12", ")", "1", "-", "2"]),
    ("abc1 ab1 a_b _a ' x", ["abc", "1", "ab1", "a_b", "_a", "'", "x"]),
    ("wait... . . hi § .", ["wait", "... . .", "hi", "§", "."]),
    ("Étion l’été ÉCOLE's", ["étion", "l", "’", "été", "école's"]),
    ("ok 🎉 fine", ["ok", "🎉", "fine"]),
    ("", []),
]


@pytest.mark.parametrize("value,expected", CASES)
def test_tokens(spark, value, expected):
    assert one(spark, tokens.tokenize(F.col("t")), value) == expected


def test_token_case_options(spark):
    t = F.col("t")
    value = ":D http://A.b/C Word"
    assert one(spark, tokens.tokenize(t, preserve_case=True), value) == [":D", "http://A.b/C", "Word"]
    assert one(spark, tokens.tokenize(t, preserve_case_for=()), value) == [":d", "http://a.b/c", "word"]
    assert one(spark, tokens.tokenize(t, preserve_case_for=("emoticon",)), value)[1] == "http://a.b/c"


def test_token_rows_equal_token_arrays(spark):
    texts = spark.createDataFrame([(i, v) for i, (v, _) in enumerate(CASES)], "i int, t string")
    by_row = tokens.explode_tokens(texts, ["i"], "t")
    by_array = texts.select("i", F.explode(tokens.tokenize(F.col("t"))).alias("token"))
    assert rows(by_row) == rows(by_array)
    escaped = tokens.explode_tokens(texts, ["i"], "t", escape_non_ascii=True)
    by_array = texts.select("i", F.explode(tokens.tokenize(F.col("t"), escape_non_ascii=True)).alias("token"))
    assert rows(escaped) == rows(by_array)


def test_entities(spark):
    d = lambda v, **o: one(spark, decode_entities(F.col("t"), **o), v)
    assert d("caf&#233; &eacute; &#8364; &#128512;") == "café é € 😀"
    assert d("a&amp;b") == "a and b" and d("a&amp;b &lt;") == "a and b <"
    assert d("a&amp;b", decode_amp=False) == "a&amp;b"
    assert d("&unknown; &lt &; & &#x41;") == "&unknown; &lt &; & &#x41;"
    assert d("&#38;lt; &#0065;") == "< A"  # numbers first, then names
    assert d("&#55296; &#1114112; &#99999999999999999999;") == "&#55296; &#1114112; &#99999999999999999999;"
    assert d("plain") == "plain"


def test_escape(spark):
    e = lambda v: one(spark, escape_non_ascii(F.col("t")), v)
    assert e("plain 'text'\n") == "plain 'text'\n"
    assert e("é'\n\\…") == "\\xc3\\xa9\\'\\n\\\\\\xe2\\x80\\xa6"
    got = one(spark, tokens.tokenize(F.col("t"), escape_non_ascii=True), "ok…")
    assert got == ["ok", "\\", "xe2", "\\", "x80", "\\", "xa6"]
