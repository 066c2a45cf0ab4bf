"""Tokens of two tokenizers over one text, aligned where both end, and how often their ids go together.

A text is encoded by a byte-level BPE (with a blank put before it) and by a piece BPE (which puts one
there itself).  Both give byte ranges of the same bytes.  Shared ends are found by divide and conquer:
the shared end nearest the middle of an interval is located by bisection, both halves are searched in
turn, and an interval without one inside is a group.  All intervals of one depth, over many texts, are
searched together in arrays, so Python steps grow with the depth, not with the tokens.

A link is a pair of tokens, one of each side, that end at the same byte; as tokens are never empty,
that is the last pair of every group.  Of two tokens that end together one is a suffix of the other, so
distinct id pairs are at most about the summed length of both vocabularies' tokens (``pair_bound``),
whatever the corpus: their counts are small enough to be shared with every task.

Texts without tokens, by definition: null, empty, or with bytes that a tokenizer does not give back.
Repeated rows, null ids and extra columns are kept as they are; an empty table gives an empty one.
Very long texts are encoded whole; texts are taken together up to ``CHUNK_CHARS`` only.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from tallyforge.llm.common import sent, stored

TOKENIZERS = "/opt/tokenizers"
CHUNK_CHARS = 1_000_000

# Fixed value: the public split pattern of byte-level BPE.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Letters whose class differs between Unicode versions, or runs that one pattern engine dislikes: such
# texts go through the tokenizer's own library, which gives the same ids more slowly.
UNUSUAL = re.compile(r"[^\x00-ɏ]|\S{256}|\s{256}")


def _byte_of_character() -> dict[str, int]:
    """Byte-level BPE writes bytes as characters: printable ones as themselves, the rest from 256 on."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


@dataclass
class Vocabularies:
    """Both tokenizers as their files' content, and the bytes of every id."""

    byte_bpe: str
    piece_bpe: bytes
    a_bytes: list[bytes]
    b_bytes: list[bytes]
    in_rank_order: bool

    @property
    def pair_bound(self) -> int:
        """No more distinct linked pairs than this: each is a token with one of its suffixes.

        A suffix may be two ids of the second vocabulary (a piece and a byte), one of the first.
        """
        return 2 * sum(map(len, self.a_bytes)) + sum(map(len, self.b_bytes))


def load(folder: str = TOKENIZERS, byte_bpe: str = "byte_bpe_50k.json", piece_bpe: str = "piece_bpe_32k.model") -> Vocabularies:
    """Read on the driver; tasks get the content, so executors need no files."""
    import sentencepiece

    with open(os.path.join(folder, byte_bpe), encoding="utf-8") as file:
        first = file.read()
    with open(os.path.join(folder, piece_bpe), "rb") as file:
        second = file.read()
    parsed = json.loads(first)
    number = _byte_of_character()
    vocabulary = parsed["model"]["vocab"]
    special = {t["content"]: t["id"] for t in parsed["added_tokens"]}
    a_bytes = [b""] * (max([*vocabulary.values(), *special.values()]) + 1)
    for token, i in vocabulary.items():
        a_bytes[i] = token.encode() if token in special else bytes(number[c] for c in token)
    for token, i in special.items():
        a_bytes[i] = token.encode()
    merges = [m if isinstance(m, list) else m.split(" ") for m in parsed["model"]["merges"]]
    in_order = (
        [vocabulary["".join(m)] for m in merges] == list(range(256, 256 + len(merges)))
        and parsed["normalizer"] is None
        and parsed["pre_tokenizer"]["type"] == "ByteLevel"
        and not parsed["pre_tokenizer"]["add_prefix_space"]
    )
    pieces = sentencepiece.SentencePieceProcessor(model_proto=second)
    b_bytes = []
    for i in range(pieces.get_piece_size()):
        piece = pieces.id_to_piece(i)
        b_bytes.append(bytes([int(piece[3:5], 16)]) if pieces.is_byte(i) else piece.replace("▁", " ").encode())
    return Vocabularies(first, second, a_bytes, b_bytes, in_order)


def encoders(v: Vocabularies):
    """Two functions from lists of texts to lists of ids, made once per task."""
    import sentencepiece
    import tiktoken
    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    own: list = []
    ranked = None
    if v.in_rank_order:
        # Merges in the order of their ids: the ids are the ranks, and any byte-pair library gives the same.
        special = {t["id"] for t in json.loads(v.byte_bpe)["added_tokens"]}
        ranks = {b: i for i, b in enumerate(v.a_bytes) if i not in special}
        ranked = tiktoken.Encoding("byte_bpe", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
    pieces = sentencepiece.SentencePieceProcessor(model_proto=v.piece_bpe)

    def first(text: str) -> list[int]:
        if ranked is not None and not UNUSUAL.search(text):
            return ranked.encode_ordinary(" " + text)
        if not own:
            own.append(Tokenizer.from_str(v.byte_bpe))
            own[0].encode_special_tokens = True
        return own[0].encode(" " + text, add_special_tokens=False).ids

    return (lambda texts: [first(t) for t in texts]), (lambda texts: pieces.encode(texts, num_threads=1))


def shared_cuts(a_ends: np.ndarray, b_ends: np.ndarray, firsts: np.ndarray, lasts: np.ndarray) -> np.ndarray:
    """Positions in ``a_ends`` of all ends found in ``b_ends``, by divide and conquer.

    Ends rise over all texts; ``firsts`` and ``lasts`` are each text's first and last position in
    ``a_ends``, the last being a shared end.  Around the middle of an interval, ever wider rings of
    positions are looked up by bisection until one is shared or the interval has no more.
    """
    found = [lasts]
    low, high = firsts, lasts  # searched: low <= position < high
    while len(low):
        inner = low < high
        low, high = low[inner], high[inner]
        if not len(low):
            break
        start = np.where(low > 0, a_ends[low - 1], 0)
        middle = np.searchsorted(a_ends, (start + a_ends[high]) // 2)
        middle = np.clip(middle, low, high - 1)
        cut = np.full(len(low), -1, dtype=np.int64)
        waiting = np.arange(len(low))
        reach = 0
        while len(waiting):
            steps = np.array([0]) if not reach else np.arange(reach // 4 + 1, reach + 1)
            offsets = steps if not reach else np.column_stack((-steps, steps)).ravel()
            at = middle[waiting, None] + offsets[None, :]
            inside = (at >= low[waiting, None]) & (at < high[waiting, None])
            ends = a_ends[np.where(inside, at, 0)]
            near = np.minimum(np.searchsorted(b_ends, ends), len(b_ends) - 1)
            shared = inside & (b_ends[near] == ends)
            hit = shared.any(axis=1)
            cut[waiting[hit]] = at[hit, shared[hit].argmax(axis=1)]
            waiting = waiting[~hit]
            # Rings go on only for intervals that reach beyond this one.
            beyond = (middle[waiting] - reach > low[waiting]) | (middle[waiting] + reach < high[waiting] - 1)
            waiting = waiting[beyond]
            reach = 4 * reach if reach else 2
        divided = cut >= 0
        low, high, cut = low[divided], high[divided], cut[divided]
        found.append(cut)
        low, high = np.concatenate((low, cut + 1)), np.concatenate((cut, high))
    return np.sort(np.concatenate(found))


def _chunks(texts: Sequence[str | None]) -> Iterator[range]:
    start, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text or "")
        if size >= CHUNK_CHARS:
            yield range(start, i + 1)
            start, size = i + 1, 0
    if start < len(texts):
        yield range(start, len(texts))


@dataclass
class Aligned:
    """Texts that have tokens, one after the other: ids, and where texts and groups end among them."""

    kept: np.ndarray  # places of these texts in what was given
    a: np.ndarray
    b: np.ndarray
    a_texts: np.ndarray  # tokens of all texts up to and with each
    b_texts: np.ndarray
    a_groups: np.ndarray  # tokens of all groups up to and with each
    b_groups: np.ndarray
    texts_groups: np.ndarray  # groups of all texts up to and with each


class Aligner:
    """Encodes and aligns lists of texts; one per task."""

    def __init__(self, v: Vocabularies):
        self.v = v
        self.first, self.second = encoders(v)
        self.a_lengths = np.array([len(t) for t in v.a_bytes], dtype=np.int64)
        self.b_lengths = np.array([len(t) for t in v.b_bytes], dtype=np.int64)
        self.names = np.array(
            [f"{i}{mark}" for n, marks in ((len(v.a_bytes), ",|"), (len(v.b_bytes), ",;")) for mark in marks for i in range(n)],
            dtype=object,
        )

    def __call__(self, texts: Sequence[str | None]) -> Aligned:
        filled = [(i, t) for i, t in enumerate(texts) if t]
        kept, a, b = [], [], []
        firsts = self.first([t for _, t in filled])
        seconds = self.second([t for _, t in filled])
        for (i, text), one, two in zip(filled, firsts, seconds, strict=True):
            whole = b" " + text.encode()
            if b"".join(map(self.v.a_bytes.__getitem__, one)) == whole == b"".join(map(self.v.b_bytes.__getitem__, two)):
                kept.append(i)
                a.append(np.array(one, dtype=np.int64))
                b.append(np.array(two, dtype=np.int64))
        none = np.zeros(0, dtype=np.int64)
        if not kept:
            return Aligned(none, none, none, none, none, none, none, none)
        a_texts, b_texts = np.cumsum([len(x) for x in a]), np.cumsum([len(x) for x in b])
        a, b = np.concatenate(a), np.concatenate(b)
        a_ends, b_ends = np.cumsum(self.a_lengths[a]), np.cumsum(self.b_lengths[b])
        cuts = shared_cuts(a_ends, b_ends, np.concatenate(([0], a_texts[:-1])), a_texts - 1)
        return Aligned(
            np.array(kept), a, b, a_texts, b_texts, cuts + 1, np.searchsorted(b_ends, a_ends[cuts]) + 1,
            np.searchsorted(cuts, a_texts - 1) + 1,
        )

    def written(self, x: Aligned) -> list[str]:
        """Each text's groups as ``a1,a2|b1;a3|b2,b3``."""
        if not len(x.kept):
            return []
        na, nb = len(self.v.a_bytes), len(self.v.b_bytes)
        a_marks, b_marks = x.a.copy(), 2 * na + x.b
        a_marks[x.a_groups - 1] += na
        b_marks[x.b_groups - 1] += nb
        group_of_a = np.repeat(np.arange(len(x.a_groups)), np.diff(x.a_groups, prepend=0))
        group_of_b = np.repeat(np.arange(len(x.b_groups)), np.diff(x.b_groups, prepend=0))
        marks = np.empty(len(x.a) + len(x.b), dtype=np.int64)
        marks[np.arange(len(x.a)) + np.concatenate(([0], x.b_groups))[group_of_a]] = a_marks
        marks[np.arange(len(x.b)) + x.a_groups[group_of_b]] = b_marks
        names, ends = self.names[marks], x.a_texts + x.b_texts
        return ["".join(names[s:e])[:-1] for s, e in zip([0, *ends[:-1]], ends, strict=True)]

    def pairs(self, x: Aligned) -> tuple[np.ndarray, np.ndarray]:
        """Linked pairs (``a * size of b + b``) in the order of the links, and the text of each."""
        codes = x.a[x.a_groups - 1] * len(self.v.b_bytes) + x.b[x.b_groups - 1]
        return codes, np.repeat(np.arange(len(x.kept)), np.diff(x.texts_groups, prepend=0))


def _lists(values: np.ndarray, ends: np.ndarray, kept: np.ndarray, rows: int, kind: pa.DataType) -> pa.Array:
    """A list per row; rows that are not kept have an empty one."""
    sizes = np.zeros(rows, dtype=np.int64)
    sizes[kept] = np.diff(ends, prepend=0)
    return pa.ListArray.from_arrays(
        pa.array(np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)), pa.array(values, type=kind)
    )


def align(docs: DataFrame, vocabularies: Vocabularies | None = None, text: str = "text") -> DataFrame:
    """``docs`` with ``a_ids, b_ids`` (token ids) and ``a_cuts, b_cuts`` (tokens up to each group's end).

    Group g holds the tokens from the cuts before it to its own; columns of these names are replaced.
    """
    shipped = sent(docs.sparkSession, vocabularies or load())
    new = ["a_ids", "b_ids", "a_cuts", "b_cuts"]
    rest = docs.drop(*new)
    place = rest.columns.index(text)
    schema = T.StructType([*rest.schema.fields, *[T.StructField(n, T.ArrayType(T.IntegerType(), False)) for n in new]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = None
        for batch in batches:
            aligner = aligner or Aligner(shipped())
            texts = batch.column(place).to_pylist()
            for part in _chunks(texts):
                x = aligner([texts[i] for i in part])
                n, whole = len(part), x.texts_groups
                before_a = np.repeat(np.concatenate(([0], x.a_texts))[: len(x.kept)], np.diff(whole, prepend=0))
                before_b = np.repeat(np.concatenate(([0], x.b_texts))[: len(x.kept)], np.diff(whole, prepend=0))
                lists = [(x.a, x.a_texts), (x.b, x.b_texts), (x.a_groups - before_a, whole), (x.b_groups - before_b, whole)]
                columns = batch.slice(part.start, n).columns + [_lists(v, e, x.kept, n, pa.int32()) for v, e in lists]
                yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names + new)

    return rest.mapInArrow(run, schema)


def _summaries(docs: DataFrame, vocabularies: Vocabularies, doc_id: str, text: str) -> DataFrame:
    """Counts and digest of every text, and its distinct linked pairs with how often each occurs in it."""
    shipped = sent(docs.sparkSession, vocabularies)
    schema = pa.schema(
        [
            ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
            ("groups_sha256", pa.string()), ("pairs", pa.list_(pa.int64())), ("times", pa.list_(pa.int32())),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = None
        for batch in batches:
            aligner = aligner or Aligner(shipped())
            texts = batch.column(1).to_pylist()
            for part in _chunks(texts):
                x = aligner([texts[i] for i in part])
                codes, owners = aligner.pairs(x)
                size = len(aligner.v.a_bytes) * len(aligner.v.b_bytes)
                keyed, times = np.unique(owners * size + codes, return_counts=True)
                ends = np.searchsorted(keyed, (np.arange(len(x.kept)) + 1) * size)
                n = len(part)
                counts = np.zeros((3, n), dtype=np.int64)
                for row, found in zip(counts, (x.a_texts, x.b_texts, x.texts_groups), strict=True):
                    row[x.kept] = np.diff(found, prepend=0)
                digests = [""] * n
                for i, groups in zip(x.kept, aligner.written(x), strict=True):
                    digests[i] = hashlib.sha256(groups.encode()).hexdigest()
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(part.start, n), *[pa.array(row) for row in counts], pa.array(digests, pa.string()),
                        _lists(keyed % size, ends, x.kept, n, pa.int64()), _lists(times, ends, x.kept, n, pa.int32()),
                    ],
                    schema=schema,
                )

    kinds = "doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string, pairs array<long>, times array<int>"
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, kinds)


def pair_counts(summaries: DataFrame) -> DataFrame:
    """``pair, links`` over the corpus."""
    each = summaries.select(F.explode(F.arrays_zip("pairs", "times")).alias("p"))
    return each.groupBy(F.col("p.pairs").alias("pair")).agg(F.sum(F.col("p.times").cast("long")).alias("links"))


def report(docs: DataFrame, vocabularies: Vocabularies | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``.

    A pair's count is the number of links that hold it in the whole table; a link is best if no pair
    with the same second id has a higher count.  Texts are encoded once: what the second look needs,
    each text's distinct pairs, is stored between.
    """
    vocabularies = vocabularies or load()
    each = stored(_summaries(docs, vocabularies, doc_id, text))
    counted = pair_counts(each).toArrow()
    pairs, links = (counted.column(c).to_numpy() for c in ("pair", "links"))
    if len(pairs) > vocabularies.pair_bound:
        raise RuntimeError(f"{len(pairs)} linked pairs, more than the vocabularies allow")
    order = np.argsort(pairs)
    pairs, links = pairs[order], links[order]
    second = pairs % len(vocabularies.b_bytes)
    highest = np.zeros(len(vocabularies.b_bytes), dtype=np.int64)
    np.maximum.at(highest, second, links)
    shipped = docs.sparkSession.sparkContext.broadcast((pairs, links, links == highest[second]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, count, best = shipped.value
        for batch in batches:
            held, times = batch.column(5), batch.column(6).flatten().to_numpy().astype(np.int64)
            at = np.searchsorted(known, held.flatten().to_numpy())
            ends = np.concatenate(([0], np.cumsum(held.value_lengths().to_numpy())))
            sums = [np.concatenate(([0], np.cumsum(times * w)))[ends] for w in (best[at], count[at])]
            columns = batch.columns
            yield pa.RecordBatch.from_arrays(
                [*columns[:4], columns[3], *[pa.array(np.diff(s)) for s in sums], columns[4]],
                names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"],
            )

    return each.mapInArrow(
        run, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    )
