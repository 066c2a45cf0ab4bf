"""Hard negatives by inner product: a cover tree over norm-augmented vectors bounds what is searched.

Vectors get one more component that brings all of them to one length M; for an anchor q (with a zero
there) the distance to a vector then says its inner product: |q - x|^2 = |q|^2 + M^2 - 2 q.x.  A cover
tree is fitted on a bounded sample (``SAMPLE`` rows of least hash; its levels halve by ``BASE``), every row
goes down it to a node, and each node's covering radii (of the rows at it, and of all rows below it)
are measured over all rows.  The triangle inequality turns a radius into bounds on the inner products
below a node, so that an anchor skips nodes outside its window; rows of the others are verified by
exact integer products, best node first, which raises what later nodes have to reach.

Rows are dealt in chunks of about ``CHUNK`` neighbours in the tree (a node with more rows, such as
copies, is split by a hash), anchors in blocks of about ``BLOCK``; a task joins one chunk with one
block's anchors that have to look there, never all of either.  First come the positives, then windows
under each positive's score.

Defined cases: rows with a null label, vector or component, or a component that is not finite, take no
part; rows equal in id, label and vector count once; a row with the anchor's id is no other row; a row
without an id is never an anchor and loses ties; a vector shorter than others counts as followed by
zeros; windows under a negative positive score are empty.  Extra columns are not read.  An empty table,
or one without anchors, gives an empty result.  Scores must fit a long.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tallyforge.llm.common import sent, stored

SAMPLE = 1024
BASE = 1.3
CHUNK = 4096
BLOCK = 1024
POSITIVES, NEGATIVES = 5, 5
LOW, HIGH = 80, 100

RESULT = (
    "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
)


def integer_vector(vector: Column, scale: int = 256) -> Column:
    """Each component as floor(scale * x); null where the vector, or any component, is null or not finite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == F.lit(math.inf)))
    whole = F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long"))
    return F.when(vector.isNotNull() & ~bad, whole)


@dataclass
class CoverTree:
    """Nodes in depth-first order; ``own`` and ``below`` are covering radii, known after measuring."""

    ids: list[int | None]
    labels: np.ndarray
    vectors: np.ndarray  # integers, of the sample
    lifted: np.ndarray  # the nodes' vectors with the extra component
    nodes: np.ndarray  # place of each node's vector in the sample
    parents: np.ndarray
    levels: np.ndarray
    longest: float  # M
    own: np.ndarray | None = None
    below: np.ndarray | None = None

    def children(self) -> list[np.ndarray]:
        order = np.argsort(self.parents, kind="stable")
        edges = np.searchsorted(self.parents[order], np.arange(len(self.nodes) + 1))
        return [order[a:b] for a, b in zip(edges[:-1], edges[1:], strict=True)]


def lift(vectors: np.ndarray, longest: float) -> np.ndarray:
    """``vectors`` with a component that makes each as long as the longest."""
    wide = vectors.astype(np.float64)
    return np.column_stack((wide, np.sqrt(np.maximum(longest**2 - (wide * wide).sum(axis=1), 0.0))))


def _distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    squares = (x * x).sum(axis=1)[:, None] + (y * y).sum(axis=1)[None, :] - 2.0 * (x @ y.T)
    return np.sqrt(np.maximum(squares, 0.0))


def fit(ids: list, labels: list[int], vectors: np.ndarray, longest: float, base: float = BASE) -> CoverTree:
    """Cover tree by insertion: a point goes under the nearest child that covers it, else it is a child."""
    lifted = lift(vectors, longest)
    first = np.unique(vectors, axis=0, return_index=True)[1] if vectors.shape[1] else np.array([0])
    order = np.sort(first)
    reach = _distances(lifted[order[:1]], lifted[order]).max()
    top = math.ceil(math.log(reach, base)) if reach > 1 else 1
    parent, level, under = {int(order[0]): -1}, {int(order[0]): top}, {int(order[0]): []}
    for point in map(int, order[1:]):
        node = int(order[0])
        while True:
            near = under[node]
            if near:
                far = _distances(lifted[point : point + 1], lifted[near])[0]
                covering = np.where(far <= base ** np.array([float(level[c]) for c in near]), far, np.inf)
                if np.isfinite(covering.min()):
                    node = near[int(covering.argmin())]
                    continue
            parent[point], level[point], under[point] = node, level[node] - 1, []
            under[node].append(point)
            break
    walk, stack = [], [int(order[0])]
    while stack:
        walk.append(stack.pop())
        stack.extend(reversed(under[walk[-1]]))
    place = {p: i for i, p in enumerate(walk)}
    return CoverTree(
        list(ids), np.array(labels, dtype=np.int64), vectors, lifted[walk], np.array(walk),
        np.array([place.get(parent[p], -1) for p in walk]), np.array([float(level[p]) for p in walk]), longest,
    )


def descend(tree: CoverTree, vectors: np.ndarray, base: float = BASE) -> tuple[np.ndarray, list[np.ndarray]]:
    """Node of every vector, and its distances to that node and, level by level, to the nodes above."""
    lifted, under = lift(vectors, tree.longest), tree.children()
    at = np.zeros(len(vectors), dtype=np.int64)
    path = [np.array([0.0])] * len(vectors)
    waiting = [(0, np.arange(len(vectors)), _distances(lifted, tree.lifted[:1]))]
    while waiting:
        node, rows, so_far = waiting.pop()
        stay = np.ones(len(rows), dtype=bool)
        if len(under[node]) and len(rows):
            far = _distances(lifted[rows], tree.lifted[under[node]])
            far[far > base ** tree.levels[under[node]][None, :]] = np.inf
            nearest, least = far.argmin(axis=1), far.min(axis=1)
            stay = ~np.isfinite(least)
            for child in np.unique(nearest[~stay]):
                go = ~stay & (nearest == child)
                waiting.append((under[node][child], rows[go], np.column_stack((least[go], so_far[go]))))
        at[rows[stay]] = node
        for row, found in zip(rows[stay], so_far[stay], strict=True):
            path[row] = found
    return at, path


def products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact integer inner products: in doubles as long as every partial sum is exact there."""
    if not (q.size and x.size):
        return np.zeros((len(q), len(x)), dtype=np.int64)
    if float(np.abs(q).max()) * float(np.abs(x).max()) * q.shape[1] < 2.0**53:
        return (q.astype(np.float64) @ x.T.astype(np.float64)).astype(np.int64)
    return q @ x.T


class Bounds:
    """Least and greatest inner product of each anchor with the rows at a node, or at and below it."""

    def __init__(self, tree: CoverTree, q: np.ndarray):
        wide = q.astype(np.float64)
        self.squares = (wide * wide).sum(axis=1)[:, None] + tree.longest**2
        to_nodes = products(q, tree.vectors[tree.nodes]).astype(np.float64)
        self.far = np.sqrt(np.maximum(self.squares - 2.0 * to_nodes, 0.0))
        # Rounding of the distances, generously.
        self.slack = 4e-6 * (1.0 + np.sqrt(self.squares))
        self.tree = tree

    def least(self, radius: np.ndarray) -> np.ndarray:
        return (self.squares - (self.far + radius + self.slack) ** 2) / 2.0

    def greatest(self, radius: np.ndarray) -> np.ndarray:
        return (self.squares - np.maximum(self.far - radius - self.slack, 0.0) ** 2) / 2.0

    def reached(self, inside) -> np.ndarray:
        """Anchors by nodes whose rows may lie in a window: down the tree, below reached nodes only.

        ``inside`` tells from greatest and least product whether a window is met.
        """
        open_ = inside(self.greatest(self.tree.below), self.least(self.tree.below))
        for node in range(1, len(self.tree.nodes)):
            open_[:, node] &= open_[:, self.tree.parents[node]]
        return open_ & (self.tree.own >= 0) & inside(self.greatest(self.tree.own), self.least(self.tree.own))


def _matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(len(flat), width)


def _ids(column) -> tuple[np.ndarray, np.ndarray]:
    """Ids, and whether each is missing."""
    return np.asarray(pc.fill_null(column, 0)), np.asarray(pc.is_null(column))


def _first(group: np.ndarray, score: np.ndarray, ids: np.ndarray, missing: np.ndarray, count: int) -> np.ndarray:
    """Places of the first ``count`` of each group: higher score, then smaller id, none last."""
    order = np.lexsort((ids, missing, -score, group))
    ranked = group[order]
    rank = np.arange(len(order)) - np.searchsorted(ranked, ranked)
    return order[rank < count]


def _sample_scores(tree: CoverTree, q: np.ndarray) -> np.ndarray:
    return products(q, tree.vectors)


def _kth(scores: np.ndarray, k: int) -> np.ndarray:
    """The k-th highest of each row, or the least long where there are fewer."""
    if scores.shape[1] < k:
        return np.full(len(scores), np.iinfo(np.int64).min)
    return np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k]


_NONE = np.iinfo(np.int64).min


def _positive_floor(tree: CoverTree, ids: np.ndarray, labels: np.ndarray, q: np.ndarray, k: int) -> np.ndarray:
    """What an anchor's k-th positive scores at least, by the sample alone."""
    sample_ids = np.array([i if i is not None else 0 for i in tree.ids], dtype=np.int64)
    other = (sample_ids[None, :] != ids[:, None]) | np.array([i is None for i in tree.ids])[None, :]
    mine = other & (tree.labels[None, :] == labels[:, None])
    return _kth(np.where(mine, _sample_scores(tree, q), _NONE), k)


def _windows(scores: list[list[int]], low: int, high: int, places: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest negative score under each positive; an empty window has least > greatest."""
    least = np.full((len(scores), places), 1, dtype=np.int64)
    greatest = np.zeros((len(scores), places), dtype=np.int64)
    for row, found in enumerate(scores):
        for place, p in enumerate(found):
            least[row, place], greatest[row, place] = -((-low * p) // 100), (high * p) // 100
    return least, greatest


class _Search:
    """What the tasks of one search need, sent once as a broadcast."""

    def __init__(self, tree: CoverTree, chunk_of: list[list[int]], positives: int, negatives: int, low: int, high: int):
        self.tree, self.chunk_of = tree, chunk_of
        self.positives, self.negatives, self.low, self.high = positives, negatives, low, high

    def floors(self, ids: np.ndarray, labels: np.ndarray, q: np.ndarray, scores: list[list[int]] | None):
        """Function of bounds that tells which windows are met, and the windows."""
        if scores is None:
            floor = _positive_floor(self.tree, ids, labels, q, self.positives)
            least, greatest = floor[:, None], np.full((len(q), 1), np.iinfo(np.int64).max)
        else:
            least, greatest = _windows(scores, self.low, self.high, self.positives)
            other = self.tree.labels[None, :] != labels[:, None]
            sample = np.where(other, _sample_scores(self.tree, q), _NONE)
            for place in range(self.positives):
                under = np.where(sample <= greatest[:, place, None], sample, _NONE)
                least[:, place] = np.maximum(least[:, place], _kth(under, self.negatives))

        def inside(high: np.ndarray, low: np.ndarray) -> np.ndarray:
            met = np.zeros(high.shape, dtype=bool)
            for place in range(least.shape[1]):
                there = least[:, place] <= greatest[:, place]
                met |= there[:, None] & (high >= least[:, place, None]) & (low <= greatest[:, place, None])
            return met

        return inside, least, greatest

    def visits(self, batch: pa.RecordBatch, with_scores: bool) -> list[list[int]]:
        """Chunks that each anchor of the batch has to look into."""
        ids, labels = _ids(batch.column(0))[0], batch.column(1).to_numpy()
        q = _matrix(batch.column(3), self.tree.vectors.shape[1])
        scores = [[p["score"] for p in ps] for ps in batch.column(4).to_pylist()] if with_scores else None
        met = Bounds(self.tree, q).reached(self.floors(ids, labels, q, scores)[0])
        return [sorted({c for node in np.flatnonzero(row) for c in self.chunk_of[node]}) for row in met]

    def verify(self, rows: pa.Table, anchors: pa.Table, with_scores: bool):
        """Exact scores of the rows of reached nodes with the anchors: (anchor, place, row, score) arrays."""
        d = self.tree.vectors.shape[1]
        x, (row_ids, row_missing) = _matrix(rows["vec"], d), _ids(rows["id"])
        row_labels, at = rows["label"].to_numpy(), rows["node"].to_numpy()
        q, (ids, _), labels = _matrix(anchors["vec"], d), _ids(anchors["id"]), anchors["label"].to_numpy()
        scores = [[p["score"] for p in ps] for ps in anchors["positives"].to_pylist()] if with_scores else None
        inside, least, greatest = self.floors(ids, labels, q, scores)
        bounds = Bounds(self.tree, q)
        met, ceiling = bounds.reached(inside), bounds.greatest(self.tree.own)
        floor, cap = least.min(axis=1), greatest.max(axis=1)
        best = np.full((len(q), self.positives), _NONE)
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        present = np.unique(at)
        order = np.argsort(at, kind="stable")
        edges = np.searchsorted(at[order], [present, present + 1])
        for n in np.argsort(-ceiling[:, present].max(axis=0, initial=-np.inf)):
            node = present[n]
            active = np.flatnonzero(met[:, node] & (ceiling[:, node] >= floor))
            if not len(active):
                continue
            members = order[edges[0][n] : edges[1][n]]
            score = products(q[active], x[members])
            same = row_labels[members][None, :] == labels[active, None]
            if with_scores:
                fits = ~same
            else:
                fits = same & ((row_ids[members][None, :] != ids[active, None]) | row_missing[members][None, :])
                top = np.concatenate((best[active], np.where(fits, score, _NONE)), axis=1)
                best[active] = -np.partition(-top, self.positives - 1, axis=1)[:, : self.positives]
                floor[active] = np.maximum(floor[active], best[active].min(axis=1))
            fits &= (score >= floor[active, None]) & (score <= cap[active, None])
            i, j = np.nonzero(fits)
            found.append((active[i], members[j], score[i, j]))
        if not found:
            none = np.zeros(0, dtype=np.int64)
            return none, none, none, none
        anchor, row, score = (np.concatenate(parts) for parts in zip(*found, strict=True))
        out = []
        for place in range(least.shape[1]):
            fit_here = np.flatnonzero((score >= np.maximum(least[anchor, place], floor[anchor] if not with_scores else _NONE)) & (score <= greatest[anchor, place]))
            count = self.negatives if with_scores else self.positives
            kept = fit_here[_first(anchor[fit_here], score[fit_here], row_ids[row[fit_here]], row_missing[row[fit_here]], count)]
            out.append((anchor[kept], np.full(len(kept), place), row[kept], score[kept]))
        return tuple(np.concatenate(parts) for parts in zip(*out, strict=True))


def _looked_up(rows: DataFrame, anchors: DataFrame, search, with_scores: bool) -> DataFrame:
    """``anchor_id, anchor_key, place, id, score``: the best of every chunk that an anchor looks into."""

    def where(batches):
        for whole in batches:
            for start in range(0, whole.num_rows, BLOCK):
                batch = whole.slice(start, BLOCK)
                chunks = search().visits(batch, with_scores)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(chunks, pa.list_(pa.int32()))], names=[*batch.schema.names, "chunks"]
                )

    columns = ["id", "label", "key", "vec", *(["positives"] if with_scores else []), "block"]
    kinds = {f.name: f.dataType.simpleString() for f in anchors.schema.fields}
    schema = ", ".join(f"{c} {kinds[c]}" for c in columns) + ", chunks array<int>"
    looking = stored(anchors.select(columns).mapInArrow(where, schema))
    looking = looking.select(F.explode("chunks").alias("chunk"), *columns)
    wanted = looking.select("chunk", F.col("block").alias("for_block")).distinct()
    held = rows.join(wanted, "chunk").select("chunk", "for_block", "id", "label", "node", "vec")
    out = pa.schema(
        [("anchor_id", pa.int64()), ("anchor_key", pa.int64()), ("place", pa.int32()), ("id", pa.int64()), ("score", pa.int64())]
    )

    def verified(left: pa.Table, right: pa.Table) -> pa.Table:
        anchor, place, row, score = search().verify(left, right, with_scores)
        return pa.table(
            [
                right["id"].take(pa.array(anchor)), right["key"].take(pa.array(anchor)), pa.array(place, pa.int32()),
                left["id"].take(pa.array(row)), pa.array(score, pa.int64()),
            ],
            schema=out,
        )

    grouped = held.groupBy("chunk", "for_block").cogroup(looking.groupBy("chunk", "block"))
    return grouped.applyInArrow(verified, "anchor_id long, anchor_key long, place int, id long, score long")


def _ranked(found: DataFrame, keys: list[str], rank: str, count: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return found.withColumn(rank, F.row_number().over(order)).where(F.col(rank) <= count)


def _empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], RESULT)


def mine(
    rows: DataFrame,
    is_anchor: Column,
    vec_id: str = "vec_id",
    label: Column | str = "label",
    vector: str = "vector",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    sample: int = SAMPLE,
) -> DataFrame:
    """Per anchor and positive the first ``negatives`` rows of other labels inside its window.

    ``vector`` holds integers (``integer_vector``), null for rows that take no part.  An anchor's
    positives are its first ``positives`` other rows of its label by inner product; a negative's
    score is from ``low`` to ``high`` percent of the positive's.  ``is_anchor`` is told from the columns
    of ``rows``.
    """
    spark = rows.sparkSession
    label = F.col(label) if isinstance(label, str) else label
    chosen = rows.select(
        F.col(vec_id).cast("long").alias("id"), label.cast("long").alias("label"), F.col(vector).alias("vec"),
        F.coalesce(is_anchor, F.lit(False)).alias("anchor"),
    )
    chosen = stored(chosen.where(F.col("label").isNotNull() & F.col("vec").isNotNull()).dropDuplicates())
    square = F.aggregate("vec", F.lit(0.0), lambda s, x: s + x.cast("double") * x)
    facts = chosen.agg(
        F.max(F.size("vec")).alias("d"), F.max(square).alias("square"), F.count_if("anchor").alias("anchors")
    ).first()
    if not facts["anchors"]:
        return _empty(spark)
    d, longest = facts["d"], math.sqrt(facts["square"])
    padding = F.array_repeat(F.lit(0).cast("long"), F.lit(d) - F.size("vec"))
    key = F.xxhash64("label", "vec")
    full = chosen.withColumn("vec", F.concat("vec", padding)).withColumn("key", key)
    kept = full.orderBy(F.xxhash64("key", "id"), "id").limit(sample).collect()
    shape = (len(kept), d)
    tree = fit(
        [r["id"] for r in kept], [r["label"] for r in kept],
        np.array([r["vec"] for r in kept], dtype=np.int64).reshape(shape), longest,
    )
    planted = sent(spark, tree)

    def deal(batches):
        for batch in batches:
            node, path = descend(planted(), _matrix(batch.column(batch.schema.get_field_index("vec")), d))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(node, pa.int32()), pa.array([p.tolist() for p in path], pa.list_(pa.float64()))],
                names=[*batch.schema.names, "node", "path"],
            )

    dealt = stored(
        full.mapInArrow(deal, "id long, label long, vec array<long>, anchor boolean, key long, node int, path array<double>")
    )
    deepest = 1 + max(_depths(tree))
    far = [F.max(F.get("path", F.lit(i))).alias(f"r{i}") for i in range(deepest)]
    counts = {r["node"]: r for r in dealt.groupBy("node").agg(F.count(F.lit(1)).alias("n"), *far).collect()}
    _measure(tree, counts, deepest)
    chunk_of = _chunk_nodes([counts[n]["n"] if n in counts else 0 for n in range(len(tree.nodes))])
    search = sent(spark, _Search(tree, chunk_of, positives, negatives, low, high))
    places = spark.createDataFrame([(n, c[0], len(c)) for n, c in enumerate(chunk_of) if c], "node int, chunk0 int, parts int")
    salt = F.pmod(F.xxhash64("id", "key"), F.col("parts")).cast("int")
    rows_ = (
        dealt.join(F.broadcast(places), "node")  # one row per node, at most ``sample``
        .withColumn("chunk", F.col("chunk0") + salt)
        .select("id", "label", "key", "node", "vec", "anchor", "chunk")
    )
    blocks = max(1, math.ceil(facts["anchors"] / BLOCK))
    anchors = rows_.where("anchor").withColumn("block", F.pmod(F.xxhash64("key", "id"), F.lit(blocks)).cast("int"))
    mine_ = ["anchor_id", "anchor_key"]
    chosen_positives = _ranked(_looked_up(rows_, anchors, search, False), mine_, "place_", positives)
    listed = stored(
        chosen_positives.groupBy(*mine_)
        .agg(F.sort_array(F.collect_list(F.struct(F.col("place_").alias("place"), "id", "score"))).alias("positives"))
        .select(F.col("anchor_id").alias("id"), F.col("anchor_key").alias("key"), "positives")
    )
    with_positives = anchors.join(listed, ["id", "key"])
    found = _ranked(_looked_up(rows_, with_positives, search, True), [*mine_, "place"], "rank", negatives)
    pairs = listed.select(
        F.col("id").alias("anchor_id"), F.col("key").alias("anchor_key"), F.explode("positives").alias("p")
    ).select(*mine_, (F.col("p.place") - 1).alias("place"), F.col("p.id").alias("positive_id"), F.col("p.score").alias("positive_score"))
    return found.join(pairs, [*mine_, "place"]).select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )


def _depths(tree: CoverTree) -> list[int]:
    depths: list[int] = []
    for parent in tree.parents:
        depths.append(depths[parent] + 1 if parent >= 0 else 0)
    return depths


def _measure(tree: CoverTree, counts: dict, deepest: int) -> None:
    """Covering radii of what is at each node (-1: nothing) and of all at and below it."""
    tree.own = np.full(len(tree.nodes), -1.0)
    tree.below = np.zeros(len(tree.nodes))
    for node, row in counts.items():
        tree.own[node] = row["r0"]
        above, step = node, 0
        while above >= 0:
            tree.below[above] = max(tree.below[above], row[f"r{step}"])
            above, step = tree.parents[above], step + 1


def _chunk_nodes(counts: list[int], chunk: int = CHUNK) -> list[list[int]]:
    """Chunks of every node, in depth-first order: small nodes share one, a large one has several."""
    out: list[list[int]] = []
    current, filled = 0, 0
    for n in counts:
        if not n:
            out.append([])
            continue
        if filled and filled + n > chunk:
            current, filled = current + 1, 0
        parts = max(1, math.ceil(n / chunk))
        out.append(list(range(current, current + parts)))
        if parts > 1:
            current, filled = current + parts, 0
        else:
            filled += n
    return out
