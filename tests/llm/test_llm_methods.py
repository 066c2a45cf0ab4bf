"""What the methods promise: balance, optimality, deviation, algebra, and whole groups of near copies."""

import random
from itertools import combinations

import numpy as np
import pytest
from plain import near_duplicates, text_of
from pyspark.sql import functions as F

from tallyforge.llm import fingerprint, mixing, neardup, packing, pii, sharding
from tallyforge.llm.components import components


def test_table_is_balanced_and_stable():
    names = [f"s{i}" for i in range(20)]
    table = sharding.fill_table(names, 2003)
    sizes = [table.count(i) for i in range(20)]
    assert max(sizes) - min(sizes) <= 1
    fewer = sharding.fill_table(names[:-1], 2003)
    moved = sum(a != b for a, b in zip(table, fewer, strict=True) if a != 19)
    assert moved < 0.1 * 2003
    heavy = sharding.fill_table(names, 2003, [3] + [1] * 19)
    assert abs(heavy.count(0) / 2003 - 3 / 22) < 0.01
    with pytest.raises(ValueError):
        sharding.fill_table(names, 2004)


def test_hot_key_is_spread(spark):
    rows = spark.range(4000).select(F.lit("hot").alias("k"), F.col("id"))
    spread = sharding.place(rows, "k", spread_by="id", spread=64)
    assert spread.select("slot").distinct().count() > 40
    assert sharding.shares(sharding.place(rows, "k")).count() == 1


def test_boundaries_are_optimal():
    rng = random.Random(3)
    for _ in range(40):
        lengths = sorted(rng.sample(range(1, 60), rng.randint(1, 9)))
        counts = [rng.randint(1, 20) for _ in lengths]
        k = rng.randint(1, 5)

        def padded(ends):
            return sum(c * min(e for e in ends if e >= n) for n, c in zip(lengths, counts, strict=True))

        k_used = min(k, len(lengths))
        best = min(padded((*inner, lengths[-1])) for inner in combinations(lengths[:-1], k_used - 1))
        assert padded(packing.bucket_boundaries(lengths, counts, k)) == best
    assert packing.bucket_boundaries([], [], 3) == []


def test_mix_deviates_by_less_than_a_block():
    units = {"a": 50, "b": 30, "c": 13, "d": 6, "e": 1}
    slots = mixing.one_period(units)
    owner = {slot: name for name, found in slots.items() for slot in found}
    assert sorted(owner) == list(range(100))
    had = dict.fromkeys(units, 0)
    for t in range(100):
        had[owner[t]] += 1
        assert all(abs(had[n] - (t + 1) * u / 100) < 1 for n, u in units.items())


def test_phases_take_every_block_once():
    units = {"a": 5, "b": 3, "c": 2}
    blocks = {"a": 7, "b": 40, "c": 1}
    plan = mixing.phases(units, blocks)
    taken = []
    for name, phases in plan.items():
        at = 0
        for p in phases:
            assert p["first"] == at
            for k in range(p["beyond"] - p["first"]):
                taken.append(p["slot0"] + k // p["units"] * p["period"] + p["slots"][k % p["units"]])
            at = p["beyond"]
        assert at == blocks[name]
    assert sorted(taken) == list(range(48))


def test_multiset_hash_adds_and_subtracts(spark):
    table = spark.createDataFrame([(["a", "b", "b", "c"], ["b", "c"], ["c", "b", "a", "b"])], "x array<string>, y array<string>, z array<string>")
    x, y, z = (fingerprint.of_paragraphs(F.col(c)) for c in "xyz")
    rest = fingerprint.of_paragraphs(F.array(F.lit("a"), F.lit("b")))
    row = table.select(
        (x == z).alias("order"),
        (fingerprint.deleted(x, y) == rest).alias("deleted"),
        (fingerprint.inserted(rest, y) == x).alias("inserted"),
        (x == y).alias("other"),
        fingerprint.likeness(x, z).alias("same"),
    ).first()
    assert (row.order, row.deleted, row.inserted, row.other, row.same) == (True, True, True, False, 1.0)


def test_likeness_follows_shared_paragraphs(spark):
    lines = [f"line {i}" for i in range(300)]
    rows = [(share, lines[:200], lines[200 - share : 400 - share]) for share in (0, 100, 150, 200)]
    table = spark.createDataFrame(rows, "shared long, x array<string>, y array<string>").select(
        "shared",
        fingerprint.likeness(
            fingerprint.of_paragraphs(F.col("x")), fingerprint.of_paragraphs(F.col("y"))
        ).alias("near"),
    )
    for r in table.collect():
        true = len(set(rows[0][1]) & set(dict((s, y) for s, _, y in rows)[r.shared]))
        union = 200 + len(dict((s, y) for s, _, y in rows)[r.shared]) - true
        assert abs(r.near - true / union) < 0.25


def test_reliabilities_tell_good_labelers_from_bad():
    rng = random.Random(5)
    true_rates = [0.95, 0.9, 0.85, 0.6, 0.55]
    counts = {}
    for _ in range(20_000):
        truth = rng.random() < 0.4
        votes = tuple((1 if truth else -1) * (1 if rng.random() < r else -1) for r in true_rates)
        counts[votes] = counts.get(votes, 0) + 1
    right, prior = pii.reliabilities([(0, v, n) for v, n in sorted(counts.items())])
    assert np.allclose(right, true_rates, atol=0.03) and abs(prior[0] - 0.4) < 0.03


def test_pruning_bounds_are_posterior_probabilities():
    needed = neardup.least_matches(85, 1e-6)
    assert needed == sorted(needed) and needed[-1] < 0.8 * neardup.HASHES
    rng = np.random.default_rng(1)
    similarity = rng.beta(1 + needed[0] - 1, 1 + neardup.BATCH - (needed[0] - 1), 200_000)
    assert (similarity >= 0.85).mean() < 1e-4


def test_components_of_chains_stars_and_rings(spark):
    links = [(i, i + 1) for i in range(100, 164)] + [(7, i) for i in range(200, 300)] + [(400, 402), (402, 401), (401, 400), (5, 5)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(got[i] == 100 for i in range(100, 165)) and all(got[i] == 7 for i in range(200, 300))
    assert got[402] == got[401] == 400 and 5 not in got
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_large_groups_of_near_copies(spark, monkeypatch):
    """Groups around the threshold: chains of links through members that are not alike themselves."""
    monkeypatch.setattr(neardup, "CHUNK", 16)
    rng = random.Random(11)
    docs, vocabulary = [], [f"w{i}" for i in range(500)]
    for group in range(6):
        base = [rng.choice(vocabulary) for _ in range(90 + 20 * group)]
        for _ in range(45):
            copy = list(base)
            for _ in range(rng.randint(0, 7)):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            docs.append(" ".join(copy))
        drift = list(base)
        for _ in range(25):
            drift[rng.randrange(len(drift))] = rng.choice(vocabulary)
            docs.append(" ".join(drift))
    docs += [text_of(i, 90) for i in range(60)] + [docs[3]] * 50
    rng.shuffle(docs)
    rows = list(enumerate(docs))
    table = spark.createDataFrame(rows, "doc_id long, text string")
    for width, percent in ((3, 85), (5, 80)):
        got = sorted(tuple(r) for r in neardup.near_duplicates(table, width=width, percent=percent).collect())
        assert got == near_duplicates(rows, width, percent)
