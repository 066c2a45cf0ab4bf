"""Awkward rows, empty tables and clashing columns through every operator, against plain versions."""

import time

import pytest
from plain import (
    DOCUMENTS, awkward, base_spans, host_and_path, near_duplicates, quality as plain_quality, rule, sha256, span_text, text_of,
)
from pyspark.sql import functions as F

from tallyforge.llm import fingerprint, mixing, neardup, packing, pii, quality, secrets, sharding, urls, warc


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(awkward(), DOCUMENTS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCUMENTS)


PAGES = "page_id long, url string, html string"
PAGE_ROWS = [
    (1, "http://A.Example.ORG/es/x?y#z", "<p>same</p>"),
    (2, None, "<p>same</p>"),
    (2, None, "<p>same</p>"),
    (3, "no scheme", None),
    (4, "https://shop.com/de/1", ""),
    (None, "http://x.com/fr/1", "<p>same</p>"),
    (5, "http://example.org/en/12#top", "line\r\n\r\nWARC/1.1 in a payload\r\n\r\n"),
    (6, "http://example.org", "é🙂" * 1000),
    (7, "ftp://net.example.net?a=1&b=2", None),
    (8, "http://com/fr/", "x"),
    (9, "http://notorg/", "x" * 70_000),
    (10, "a://b.com/fr/://c.org/", "last"),
]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame(PAGE_ROWS, PAGES)


def clashing(df, names):
    """``df`` with extra columns of the names an operator uses itself."""
    return df.select("*", *[F.lit("clash").alias(n) for n in names if n not in df.columns])


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((x is not None, str(type(x)), x) for x in map(str, r)))


def test_sharding(docs, empty):
    placed = sharding.place(docs, "doc_id")
    got = [(r.doc_id, r.slot, r.shard) for r in placed.collect()]
    owner = sharding.fill_table(sharding.SHARDS)
    assert len(got) == len(awkward())
    assert all(sharding.SHARDS[owner[slot]] == shard for _, slot, shard in got)
    assert len({s for d, s, _ in got if d == 2}) == 1 and len({s for d, s, _ in got if d is None}) == 1
    assert sharding.place(empty, "doc_id").collect() == []
    again = sharding.place(clashing(docs, ["slot", "shard", "owner"]), "doc_id")
    assert "owner" in again.columns and again.columns.count("slot") == 1
    assert sorted(map(str, again.select("doc_id", "slot", "shard").collect())) == sorted(
        map(str, placed.select("doc_id", "slot", "shard").collect())
    )


def expected_records():
    largest = {}
    for page, _, html in PAGE_ROWS:
        key = html or ""
        if page is not None and (largest.get(key) is None or page > largest[key]):
            largest[key] = page
        largest.setdefault(key, None)
    out = []
    for page, _, html in PAGE_ROWS:
        payload = (html or "").encode()
        first = largest[html or ""]
        out.append(
            (page, len(payload), warc.base32_sha1(payload), "response" if page == first else "revisit", None if page == first else first)
        )
    return sorted(out, key=str)


def test_warc(spark, pages):
    for table in (pages, clashing(pages, ["digest", "payload", "record_type", "refers_to", "n"])):
        folder, index = warc.write_archives(table)
        got = warc.read_records(folder, index)
        asked = got.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
        assert sorted(map(tuple, asked.collect()), key=str) == expected_records()
    payloads = {r.page_id: bytes(r.payload) for r in got.where("record_type = 'response'").collect()}
    for page, _, html in PAGE_ROWS:
        if page in payloads:
            assert payloads[page] == (html or "").encode()
    some = warc.read_records(folder, index, where=F.col("url").contains("example.org"), gap_bytes=0, read_bytes=1)
    assert sorted(r.page_id for r in some.collect()) == [5, 6]
    folder, index = warc.write_archives(spark.createDataFrame([], PAGES))
    assert warc.read_records(folder, index).collect() == []


def test_warc_files_end_and_small_payloads(pages):
    folder, index = warc.write_archives(pages.coalesce(1), file_bytes=1, least_bytes=12)
    assert index.select("file").distinct().count() == len(PAGE_ROWS)
    kinds = [r.record_type for r in warc.read_records(folder, index).collect()]
    assert kinds == ["response"] * len(PAGE_ROWS)


def test_urls(spark, pages):
    got = urls.judge(clashing(pages, ["host", "path", "rule", "label", "suffix", "features", "vector"]))
    by = {}
    for r in got.collect():
        by.setdefault(r.page_id, []).append(r)
    for page, url, _ in PAGE_ROWS:
        host, path = host_and_path(url)
        fits, verdict = rule(host, path, urls.RULES)
        for r in by[page]:
            assert (r.host, r.path, r.rule) == (host, path, fits)
            assert r.verdict == verdict if verdict else r.verdict in ("allow", "block")
    assert sum(map(len, by.values())) == len(PAGE_ROWS)
    assert urls.judge(spark.createDataFrame([], PAGES)).collect() == []
    unlabelled = spark.createDataFrame([(1, "http://x.net/", ""), (2, None, "")], PAGES)
    assert [r.verdict for r in urls.judge(unlabelled).collect()] == ["allow", "allow"]


def test_url_accuracy(spark, sf_dir):
    pages = spark.read.parquet(sf_dir.replace("sf0.001", "sf0.1") + "/pages.parquet")
    _, verdict = urls.rule_of(urls.host_of(F.col("url")), urls.path_of(F.col("url")))
    labelled = pages.select("url", verdict.alias("v")).where("v is not null")
    accuracy = urls.held_out_accuracy(labelled.select("url", (F.col("v") == "block").cast("double").alias("label")))
    assert accuracy > 0.9


def test_quality(docs, empty):
    got = rows(quality.report(clashing(docs, ["counts", "judged", "kept", "n_words"])))
    want = [(d, *plain_quality(t)) for d, t, *_ in awkward()]
    assert sorted((r[:7] for r in got), key=str) == sorted(want, key=str)
    assert all(not r[7] for r in got if r[6])
    assert quality.report(empty).collect() == [] and quality.keep(empty).collect() == []
    kept = quality.keep(clashing(docs, ["judged", "kept"]))
    assert kept.columns == [*docs.columns, "judged", "kept"]
    assert {1, 2, 3} <= {r.doc_id for r in kept.collect()}


def test_quality_rejects_each_kind_of_junk(spark):
    clean = " ".join(f"{a} fox{i} {b}" for i, (a, b) in enumerate([("the", "river"), ("of", "wood")] * 30))
    junk = {
        "symbols": " ".join(w + "###" for w in clean.split()),
        "no stop words": " ".join(f"zq{i}xv" for i in range(80)),
        "shouts": " ".join(f"{w}{i}!!" for i, w in enumerate(clean.split())),
        "long words": " ".join("abcdefghijklmnop" + str(i) for i in range(80)),
    }
    table = spark.createDataFrame([("clean", clean), *junk.items()], "doc_id string, text string")
    assert {r.doc_id for r in quality.report(table).where("kept").collect()} == {"clean"}


def test_secrets(docs, empty):
    found = secrets.scan(clashing(docs, ["start", "length", "secret", "features", "score", "label", "path"])).collect()
    token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"
    assert (13, 9, 40, sha256(token)) in {(r.doc_id, r.start, r.length, r.secret_sha256) for r in found}
    assert [r.length for r in found if r.doc_id == 9] == [16]
    assert secrets.scan(empty).collect() == []


def test_short_punctuated_and_bare_secrets(spark):
    key = "Zk8Qw3Xv91LmPq7TrY2sBn5C"
    texts = [
        'password = "S3cret!pass9"', "pwd='abcd1234efgh'", "the password is 'x!1' now", 'api_key: a.b@c$d, and', '{"token": "q"}',
        'secret = "a \\"b\\" c"', f"we lost {key} in the river", "internationalisation", 'author = "Jane"',
        'password: str = "p.w"', 'password = "open',
    ]
    wanted = ["S3cret!pass9", "abcd1234efgh", "x!1", "a.b@c$d", "q", 'a \\"b\\" c', key, "internationalisation", "Jane", "p.w", "open"]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = secrets.candidates(table, path=None)
    by = {(r.doc_id, r.secret): r for r in found.select("*", secrets.labelled_by_form(found).alias("label")).collect()}
    assert set(enumerate(wanted)) <= set(by)
    assert all(texts[d][r.start : r.start + r.length] == s for (d, s), r in by.items())
    assert [by[d, wanted[d]].label for d in (0, 1, 6, 7, 8)] == [1.0, 1.0, None, 0.0, None]
    got = {(r.doc_id, r.secret_sha256) for r in secrets.scan(table, path=None).where("is_secret").collect()}
    assert {(d, sha256(wanted[d])) for d in (0, 1)} <= got


def test_secret_accuracy(spark, sf_dir):
    docs = spark.read.parquet(sf_dir.replace("sf0.001", "sf0.1") + "/documents.parquet")
    found = secrets.candidates(docs)
    assert secrets.held_out_accuracy(found, secrets.labelled_by_form(found)) > 0.95


def test_pii(docs, empty):
    got = pii.report(clashing(docs, ["found", "spans", "kind", "base", "span", "votes"])).collect()
    want = sorted(
        ((d, [s[0] for s in base_spans(t)].count("email"), span_text(base_spans(t))) for d, t, *_ in awkward()), key=str
    )
    by = sorted(((r.doc_id, r.n_email, r.base_sha256, r.spans) for r in got), key=lambda r: str(r[:2]))
    assert sorted((d, n, h) for d, n, h, _ in by if d is not None) == sorted(
        (d, n, sha256(s)) for d, n, s in want if d is not None
    )
    assert all(set(s.split(",")) <= set(r[3].split(",")) for r in by for d, _, s in want if d == r[0] and s)
    assert pii.report(empty).collect() == [] and pii.redact(empty).collect() == []


def test_pii_positions_of_many_matches(spark):
    text = "é " + " ".join(f"🙂 u{i}@h{i}.org" for i in range(700)) + " " + "9" * 5000 + " " + "a" * 5000 + "@"
    report = pii.report(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert report.base_sha256 == sha256(span_text(base_spans(text))) and report.n_email == 700


def test_very_long_candidates_and_tables_of_numbers(spark):
    """Time in proportion to the text: a long run beside a long word, and megabytes of numbers and of cards."""
    started = time.perf_counter()
    word = "abcdefgh" * 1000
    table = spark.createDataFrame([(1, f"{word} token = \"{'Zk8Qw3Xv' * 1000}\""), (2, word)], "doc_id long, text string")
    assert {r.length for r in secrets.scan(table, path=None).collect()} >= {8000}
    assert time.perf_counter() - started < 30
    for text, count in (("12 34.56 7890 " * 75_000, 0), ("4539578763621486, " * 10_000, 10_000)):
        docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
        started = time.perf_counter()
        got = pii.report(docs).first()
        assert got.n_card == count and time.perf_counter() - started < 40


def plain_context(text, start, end):
    return text[max(0, start - pii.CONTEXT) : start].lower(), text[start - 1 : start] + text[end : end + 1]


def test_context_in_pieces(spark):
    """Surroundings near the borders of pieces, at both ends of a text, with code points beyond the basic plane."""
    text = "".join(f"🙂{'x' * (i % 7)} card {i % 10} \t" for i in range(300)) + "end"
    places = [0, 1, 5, pii.CONTEXT, pii.PIECE - 1, pii.PIECE, pii.PIECE + 1, 2 * pii.PIECE, 3 * pii.PIECE + 2, len(text)]
    pieces = F.regexp_extract_all("text", F.lit(f"(?s).{{1,{pii.PIECE}}}"), F.lit(0))
    df = spark.createDataFrame([(text, p) for p in places], "text string, p long")
    got = df.select("p", pii._before(pieces, F.col("p"), pii.CONTEXT).alias("b")).collect()
    assert {r.p: r.b for r in got} == {p: text[max(0, p - pii.CONTEXT) : p] for p in places}


@pytest.mark.parametrize(
    ("text", "span"),
    [
        ("credit card 3782 822463 10005 12345", "card:12:29"),
        ("card 4539578763621486-9999", "card:5:21"),
        ("server address 999.10.0.0.1 here", "ip:19:27"),
        ("server address 1.2.3.4 here", "ip:15:22"),
        ("version 999.999.999.999", None),
    ],
)
def test_spans_inside_swallowed_runs(spark, text, span):
    """Other groupings, and addresses inside runs that fail their check, are candidates with the right place."""
    found = spark.createDataFrame([(text,)], "text string").select(F.explode(pii.candidates(F.col("text"))).alias("s")).collect()
    passed = {f"{pii.KINDS[r.s.kind]}:{r.s.start}:{r.s.end}" for r in found if r.s.votes.check > 0}
    assert (span in passed) if span else not passed


def test_pii_redaction(docs):
    clean = pii.redact(clashing(docs, ["row", "found", "cleaned"]))
    assert clean.columns == [*docs.columns, "row", "found", "cleaned"]
    by = {r.doc_id: r for r in clean.collect()}
    assert by[12].text.endswith("[EMAIL].") and by[12].n_chars == len(by[12].text)
    assert by[9].text.startswith("[EMAIL] ") and "190." not in by[9].text
    assert by[4].text is None and by[7].text == "two words" and by[3].n_chars is None


def test_packing(docs, empty):
    tokens = F.size(quality.words_of(F.col("text")))
    got = packing.pack(clashing(docs, ["piece", "all", "bucket", "_rank", "batch"]), tokens, max_tokens=64, budget=256, buckets=3).collect()
    want = [max(1, -(-len((t or "").split(None)) // 64)) for *_, t in ((r[0], r[1]) for r in awkward())]
    assert len(got) == sum(want)
    batches = {}
    for r in got:
        assert r.n_tokens <= r.bucket_length and r.padding == r.bucket_length - r.n_tokens
        batches.setdefault((r.bucket, r.batch), []).append(r)
    for (bucket, batch), members in batches.items():
        most = max(1, 256 // members[0].bucket_length)
        assert sorted(r.position for r in members) == list(range(len(members)))
        last = max(b for k, b in batches if k == bucket)
        assert len(members) == most if batch < last else len(members) <= most
    assert packing.pack(empty, tokens).collect() == []


def test_mixing(docs, empty):
    got = mixing.mix(clashing(docs, ["pool", "block", "slot", "phases", "carried"])).collect()
    assert len(got) == len(awkward())
    assert {r.pool for r in got if r.source in (None, "", "unknown")} == {"*"}
    assert len({(r.slot, r.place) for r in got}) == len(got)
    assert all(r.release <= r.slot < r.deadline for r in got)
    assert mixing.mix(empty).collect() == []
    mixed = mixing.interleave(clashing(docs, ["slot", "place"]))
    assert mixed.columns == [*docs.columns, "slot", "place"] and mixed.count() == len(awkward())


def test_fingerprints(docs, empty):
    got = fingerprint.compare_edited(clashing(docs, ["print", "edited", "part", "to", "guest"])).collect()
    order = sorted(awkward(), key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    want = []
    for i, (d, t, *_) in enumerate(order):
        t, following = t or "", order[(i + 1) % len(order)][1] or ""
        third = len(t) // 3
        want.append((d, len(t), sha256(t[: len(t) - third] + following[:third])))
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in got), key=str) == sorted(want, key=str)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, r)
    assert by[1].fingerprint == by[2].fingerprint and by[4].fingerprint == by[5].fingerprint
    assert by[1].fingerprint != by[3].fingerprint
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    assert fingerprint.compare_edited(empty).collect() == []


def test_next_row_over_many_ranges(spark):
    ids = [i * i for i in range(200)] + [5] * 30
    table = spark.createDataFrame([(i, f"t{i}") for i in ids], "doc_id long, text string")
    got = fingerprint.with_next(table, {"size": F.length("text")}, blocks=37).collect()
    order = sorted(ids, reverse=True)
    want = [(f"t{d}", f"t{order[(i + 1) % len(order)]}") for i, d in enumerate(order)]
    assert sorted((r.text, r.next_text) for r in got) == sorted(want)


@pytest.mark.parametrize(("width", "percent"), [(3, 85), (5, 80)])
def test_near_duplicates(docs, empty, width, percent):
    table = docs.where("doc_id is not null").dropDuplicates(["doc_id"])
    got = rows(neardup.near_duplicates(clashing(table, ["set_key", "signature", "node", "component_id"]), width=width, percent=percent))
    plain = near_duplicates([(d, t) for d, t in {r[0]: r[1] for r in awkward() if r[0] is not None}.items()], width, percent)
    assert sorted(got) == plain
    assert neardup.near_duplicates(empty).collect() == [] and neardup.keep_one(empty).collect() == []


def test_near_duplicates_of_null_and_repeated_ids(docs):
    got = neardup.near_duplicates(docs, width=3, percent=85).collect()
    assert len(got) == len(awkward())
    nulls = sorted((r.n_shingles, r.component_id, r.kept) for r in got if r.doc_id is None)
    assert [k for *_, k in nulls] == [True, False] and nulls[1][1] == 1
    kept = neardup.keep_one(clashing(docs, ["_id", "_text", "_rows"]), width=3, percent=85)
    assert kept.columns == [*docs.columns, "_id", "_text", "_rows"]
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(1) == 1 and ids.count(2) == 0 and ids.count(None) == 1 and {4, 5, 6, 7} <= set(ids)


def test_keep_one_judges_each_text_of_null_and_repeated_ids(spark, docs):
    survivors = {r.text for r in neardup.keep_one(docs, width=3, percent=85).collect() if r.doc_id is None}
    assert survivors == {text_of(2, 80)}
    a, b, c, d = (text_of(seed, 100) for seed in (1, 2, 3, 6))
    near = lambda t: t + " and more"
    table = [
        (1, a), (5, b), (5, a), (5, near(a)), (9, b), (6, c), (6, near(c)), (7, near(d)), (None, d), (None, near(b)),
        *[(None, text_of(8, n)) for n in (100, 101, 102)], *[(None, "alone " + text_of(9, 90))] * 3, (None, None), (None, ""),
    ]
    for part in (1, 5):
        got = neardup.keep_one(spark.createDataFrame(table, "doc_id long, text string").repartition(part), width=3, percent=85).collect()
        by = sorted((str(r.doc_id), r.text or "") for r in got)
        assert [t for i, t in by if i == "5"] == [b] and [i for i, t in by if i in "19"] == ["1"]
        assert len([i for i, _ in by if i == "6"]) == 1 and ("7", near(d)) in by
        nulls = [t for i, t in by if i == "None"]
        assert len(nulls) == 3 and nulls[0] == "" and nulls[1] == "alone " + text_of(9, 90)
        assert nulls[2] in {text_of(8, n) for n in (100, 101, 102)}
