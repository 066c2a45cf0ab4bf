"""Near-duplicate documents by MinHash, with sequential Bayesian verification.

1. A text becomes the set of its word shingles, and the set a signature of minima.  Documents of
   equal sets form a class, represented by its smallest id; only representatives go on.
2. Representatives that agree in a whole band of the signature share a bucket.
3. Each is compared with its buckets' smallest members, and the best guess is verified on full sets;
   the links found join most of a group without looking at all its pairs.
4. Only in buckets that still hold several components, pairs across components are compared.
   Signatures are read batch by batch; a pair is dropped as soon as the posterior probability that it
   reaches the threshold falls below the chosen miss probability.  Survivors are verified exactly.

So what can be lost is a link whose signatures agree in no band (5e-11 at a similarity of 0.85) or
whose agreement is that unlikely (``MISS``).  Everything else is decided on full sets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tallyforge.llm.common import stored
from tallyforge.llm.components import components

HASHES, ROWS, BATCH = 128, 4, 32
BANDS = HASHES // ROWS
MISS = 1e-6
# Members of a bucket that meet in one task: a larger bucket is cut into chunks, each pair of chunks a task's group.
CHUNK = 512

_MIX = np.uint64(0x9E3779B97F4A7C15)
_DRAWS = np.random.default_rng(20240229)
_FACTORS = _DRAWS.integers(0, 2**63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _DRAWS.integers(0, 2**63, HASHES, dtype=np.uint64)


def shingles(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's ``width``-word shingles, A-Z lower-cased.

    Bytes are split at U+0020 and U+0009 to U+000D.  A text of fewer words is one shingle.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    known: dict[bytes, int] = {}
    hashed = []
    for word in words:
        value = known.get(word)
        if value is None:
            value = known[word] = xxhash.xxh3_64_intdigest(word)
        hashed.append(value)
    each = np.array(hashed, dtype=np.uint64)
    span = min(width, len(words))
    found = each[: len(each) - span + 1].copy()
    for k in range(1, span):
        found ^= found >> np.uint64(29)
        found *= _MIX
        found += each[k : len(each) - span + 1 + k]
    found ^= found >> np.uint64(32)
    found *= _MIX
    if span < width:
        found += np.uint64(span)
    return np.unique(found)


def signature(found: np.ndarray) -> np.ndarray:
    """Minima of ``HASHES`` linear hashes over the shingles (upper halves)."""
    least = np.full(HASHES, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(found), 2048):
        part = found[at : at + 2048, None] * _FACTORS + _SHIFTS
        np.minimum(least, part.min(axis=0), out=least)
    return (least >> np.uint64(32)).astype(">u4")


def least_matches(percent: int, miss: float = MISS) -> list[int]:
    """For each number of compared batches the fewest matches at which a pair may still be a link.

    With a uniform prior, the posterior of the similarity after m matches in n is Beta(m + 1,
    n - m + 1); that it reaches t has the probability that a binomial of n + 1 trials at t is at most m.
    """
    t, needed = percent / 100, []
    for n in range(BATCH, HASHES + 1, BATCH):
        below, m = 0.0, -1
        while below < miss:
            m += 1
            below += comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
        needed.append(m)
    return needed


def _describe(width: int):
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("set_key", pa.binary()), ("signature", pa.binary())]
    )

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, keys, signatures = [], [], []
            for text in batch.column(1):
                found = shingles(text.as_py(), width)
                sizes.append(len(found))
                keys.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest() if len(found) else None)
                signatures.append(signature(found).tobytes() if len(found) else None)
            columns = [batch.column(0), pa.array(sizes), pa.array(keys, pa.binary()), pa.array(signatures, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return describe


def similar(one: frozenset, other: frozenset, percent: int) -> bool:
    """Whether 100 * |intersection| >= percent * |union|."""
    if 100 * min(len(one), len(other)) < percent * max(len(one), len(other)):
        return False
    common = len(one & other)
    return 100 * common >= percent * (len(one) + len(other) - common)


def _verify_pairs(width: int, percent: int):
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pydict()
            sets = [
                tuple(frozenset(shingles(text, width).tolist()) for text in pair)
                for pair in zip(rows["text_a"], rows["text_b"], strict=True)
            ]
            linked = pa.array([similar(*pair, percent) for pair in sets], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(linked)

    return verify


def _groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, list[tuple]]]:
    """Runs of equal first ``keys`` columns in sorted batches, across their borders."""
    current, run = None, []
    for batch in batches:
        for row in zip(*batch.to_pydict().values(), strict=True):
            if row[:keys] != current:
                if run:
                    yield current, run
                current, run = row[:keys], []
            run.append(row[keys:])
    if run:
        yield current, run


_SURVIVORS = pa.schema(
    [
        ("band", pa.int32()), ("bucket", pa.int64()), ("low", pa.int32()), ("high", pa.int32()),
        ("node", pa.int64()), ("component", pa.int64()), ("partners", pa.list_(pa.int64())),
    ]
)


def _compare(percent: int, miss: float):
    """Pairs across components that survive the sequential comparison, as partner lists of a group's members."""
    needed = least_matches(percent, miss)

    def survivors(band: int, rows: list[tuple], apart: bool) -> dict[int, list[int]]:
        chunks = np.array([r[0] for r in rows])
        component = np.array([r[2] for r in rows])
        signatures = np.frombuffer(b"".join(r[3] for r in rows), dtype=">u4").reshape(-1, HASHES).astype(np.uint32)
        found: dict[int, list[int]] = {}
        for i in range(len(rows)):
            if apart:
                if chunks[i] != chunks.min():
                    continue
                others = np.nonzero((chunks != chunks[i]) & (component != component[i]))[0]
            else:
                others = i + 1 + np.nonzero(component[i + 1 :] != component[i])[0]
            matches = np.zeros(len(others), dtype=np.int64)
            for step, least in enumerate(needed):
                part = slice(step * BATCH, (step + 1) * BATCH)
                matches += (signatures[others, part] == signatures[i, part]).sum(axis=1)
                alive = matches >= least
                others, matches = others[alive], matches[alive]
                if not len(others):
                    break
            if not len(others):
                continue
            # A pair that agrees in several bands belongs to the first of them.
            agree = (signatures[others] == signatures[i]).reshape(-1, BANDS, ROWS).all(axis=2)
            others = others[agree.argmax(axis=1) == band]
            if len(others):
                found.setdefault(i, []).extend(others.tolist())
        return found

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[dict] = []
        for (band, bucket, low, high), rows in _groups(batches, 4):
            found = survivors(band, rows, low != high)
            for i in sorted({*found, *(j for js in found.values() for j in js)}):
                out.append(
                    {
                        "band": band, "bucket": bucket, "low": low, "high": high,
                        "node": rows[i][1], "component": rows[i][2],
                        "partners": [rows[j][1] for j in found.get(i, [])],
                    }
                )
            if len(out) >= 4096:
                yield pa.RecordBatch.from_pylist(out, schema=_SURVIVORS)
                out = []
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=_SURVIVORS)

    return compare


def _verify_groups(width: int, percent: int):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def links(rows: list[tuple]) -> list[dict]:
        sets: dict[int, list[frozenset]] = {}
        component = {}
        for node, own, _, text in rows:
            sets.setdefault(node, []).append(frozenset(shingles(text, width).tolist()))
            component[node] = own
        root = {c: c for c in component.values()}

        def find(c: int) -> int:
            while root[c] != c:
                root[c] = root[root[c]]
                c = root[c]
            return c

        out = []
        for node, own, partners, _ in rows:
            for other in partners:
                # What is connected already, here or before, needs no further link.
                one, two = find(own), find(component[other])
                if one != two and any(similar(x, y, percent) for x in sets[node] for y in sets[other]):
                    root[max(one, two)] = min(one, two)
                    out.append({"a": own, "b": component[other]})
        return out

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _groups(batches, 4):
            if out := links(rows):
                yield pa.RecordBatch.from_pylist(out, schema=schema)

    return verify


def _buckets(representatives: DataFrame) -> DataFrame:
    """``band, bucket, n, center, node``: the members of every bucket with more than one."""
    keys = [
        F.xxhash64(F.substring("signature", 4 * ROWS * band + 1, 4 * ROWS), F.lit(band)) for band in range(BANDS)
    ]
    banded = representatives.select("node", F.posexplode(F.array(*keys)).alias("band", "bucket"))
    shared = (
        banded.groupBy("band", "bucket")
        .agg(F.min("node").alias("center"), F.max("node").alias("last"), F.count(F.lit(1)).alias("n"))
        .where("center <> last")
        .drop("last")
    )
    return banded.join(shared, ["band", "bucket"])


def _first_links(members: DataFrame, signatures: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Verified links ``a, b`` of each node to that smallest member of its buckets that it is likest to."""
    pairs = members.where("center <> node").select("center", "node").distinct()
    ours = signatures.select("node", F.col("signature").alias("own"))
    theirs = signatures.select(F.col("node").alias("center"), F.col("signature").alias("its"))
    compared = pairs.join(ours, "node").join(theirs, "center")
    places = F.sequence(F.lit(0), F.lit(HASHES - 1))
    equal = F.size(
        F.filter(places, lambda i: F.substring("own", i * 4 + 1, F.lit(4)) == F.substring("its", i * 4 + 1, F.lit(4)))
    )
    best = compared.groupBy("node").agg(F.max_by("center", F.struct(equal, -F.col("center"))).alias("center"))
    text_a = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    text_b = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    wanted = best.select(F.col("center").alias("a"), F.col("node").alias("b"))
    both = wanted.join(text_b, "b").join(text_a, "a").select("a", "b", "text_a", "text_b")
    return both.mapInArrow(_verify_pairs(width, percent), "a long, b long")


def _links_between(
    members: DataFrame, labels: DataFrame, signatures: DataFrame, texts: DataFrame, width: int, percent: int, miss: float
) -> DataFrame:
    """Verified links ``a, b`` between components that share a bucket."""
    named = members.select("band", "bucket", "n", "node").join(labels, "node", "left")
    named = stored(named.withColumn("component", F.coalesce("component", "node")))
    open_ = (
        named.groupBy("band", "bucket")
        .agg(F.min("component").alias("least"), F.max("component").alias("most"))
        .where("least <> most")
        .select("band", "bucket")
    )
    chunks = F.ceil(F.col("n") / CHUNK).cast("int")
    own = F.pmod(F.xxhash64("node", F.lit(7)), F.col("chunks")).cast("int")
    dealt = (
        named.join(open_, ["band", "bucket"])
        .select("*", chunks.alias("chunks"))
        .select("*", own.alias("chunk"))
        .select("*", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other"))
        .select(
            "band", "bucket", F.least("chunk", "other").alias("low"), F.greatest("chunk", "other").alias("high"),
            "chunk", "node", "component",
        )
    )
    group = ["band", "bucket", "low", "high"]
    survivors = stored(
        dealt.join(signatures, "node")
        .select(*group, "chunk", "node", "component", "signature")
        .repartition(*group)
        .sortWithinPartitions(*group)
        .mapInArrow(
            _compare(percent, miss),
            "band int, bucket long, low int, high int, node long, component long, partners array<long>",
        )
    )
    return (
        survivors.join(texts, "node")
        .select(*group, "node", "component", "partners", "text")
        .repartition(*group)
        .sortWithinPartitions(*group)
        .mapInArrow(_verify_groups(width, percent), "a long, b long")
    )


def near_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    width: int = 5,
    percent: int = 80,
    miss: float = MISS,
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every document.

    Documents whose shingle sets have a similarity of at least ``percent`` / 100 are linked;
    ``component_id`` is the smallest id reachable.  A text without words, or null, has no shingles
    and is linked with nothing.  Rows that repeat an id are one document for links, each with the
    size of its own set.  A null id ranks below all others: copies with an id represent it, and among
    null ids only equal sets share their (null) component.  Columns not named are not read; an empty
    table gives no rows.

    Equal documents, however many, are one representative; the class is looked up by an adaptive join.
    A bucket is never gathered in one task: a combined minimum gives its smallest member, and where
    pairs are compared it is cut into chunks.  Nothing but whether links are left comes to the driver.
    """
    named = docs.select(
        F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text")
    )
    described = stored(
        named.mapInArrow(_describe(width), "doc_id long, n_shingles long, set_key binary, signature binary")
    )
    classes = (
        described.where("set_key is not null").groupBy("set_key").agg(F.min("doc_id").alias("node"))
    )
    signatures = stored(
        described.join(classes.where("node is not null").withColumnRenamed("node", "doc_id"), ["doc_id", "set_key"])
        .select(F.col("doc_id").alias("node"), "set_key", "signature")
        .dropDuplicates(["node", "set_key"])
        .drop("set_key")
    )
    members = stored(_buckets(signatures))
    candidates = members.select("node").distinct()
    texts = stored(
        named.withColumnRenamed("doc_id", "node").join(candidates, "node", "left_semi").select("node", "text")
    )
    near = signatures.join(candidates, "node", "left_semi")
    first = components(_first_links(members, near, texts, width, percent))
    between = components(_links_between(members, first, near, texts, width, percent, miss))
    # Links between components name components: what is not linked further keeps its own.
    later = between.select(F.col("node").alias("component"), F.col("component").alias("final"))
    nodes = classes.join(first, "node", "left").withColumn("component", F.coalesce("component", "node"))
    # Written, so that the last join can split a class that very many documents share.
    named_classes = stored(
        nodes.join(later, "component", "left").select(
            "set_key", F.coalesce("final", "component").alias("component_id")
        )
    )
    return (
        described.select("doc_id", "n_shingles", "set_key")
        .join(named_classes.withColumn("classed", F.lit(True)), "set_key", "left")
        .withColumn("component_id", F.when(F.col("classed"), F.col("component_id")).otherwise(F.col("doc_id")))
        .select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
    )


def keep_one(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 5, percent: int = 80, miss: float = MISS
) -> DataFrame:
    """One row of each group, that of the smallest id, all columns as they are.

    Where an id is null or repeated, each different text of it is a document of its own: null ids are
    searched too and rank below all others, and texts of one id rank by their SHA-256.  Of rows that
    repeat both id and text one stays, whichever; null counts as the empty text.
    """
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
        F.col(f"`{doc_id}`").cast("long").alias("_id"),
        F.col(f"`{text}`").cast("string").alias("_text"),
    )
    unclear = rows.groupBy("_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1 or _id is null")
    if not unclear.limit(1).count():
        kept = near_duplicates(docs, doc_id, text, width, percent, miss).where("kept")
        return rows.join(kept.select(F.col("doc_id").alias("_id")), "_id").select("_row.*")
    rows = rows.withColumn("_key", F.sha2(F.coalesce("_text", F.lit("")), 256))
    # Numbers rise with the order, and are written, so that all later steps see the same ones.
    numbered = stored(
        rows.select("_id", "_key", "_text")
        .dropDuplicates(["_id", "_key"])
        .orderBy(F.col("_id").asc_nulls_last(), "_key")
        .select("_id", "_key", "_text", F.monotonically_increasing_id().alias("_number"))
    )
    kept = near_duplicates(numbered, "_number", "_text", width, percent, miss).where("kept")
    chosen = numbered.join(kept.select(F.col("doc_id").alias("_number")), "_number").select("_id", "_key")
    same = rows["_id"].eqNullSafe(chosen["_id"]) & (rows["_key"] == chosen["_key"])
    return rows.join(chosen, same).select(rows["_id"], rows["_key"], "_row").dropDuplicates(["_id", "_key"]).select("_row.*")
