"""k-means++ with many runs at once.

Points stay in the tasks.  Per pass every task folds its points into one row per run (seeding) or
per run and centre (update); only those rows meet in an exchange, and only runs x centres vectors
come to the driver.  Nothing is chained from pass to pass, so there is no lineage to cut.
"""

from __future__ import annotations

import logging
import time
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.storagelevel import StorageLevel

from tallyforge.functions.draws import id_numbers, race
from tallyforge.functions.vectors import list_column, matrix

log = logging.getLogger(__name__)

LOG_EVERY = 5
TIE = 1e-9  # relative gap under which two distances are compared again without rounding loss


@dataclass
class ClusterRuns:
    """Centres of all runs, (runs, k, dim), and how they were reached."""

    centers: np.ndarray
    iterations: int = 0
    shift: float = 0.0
    shifts: list[float] = field(default_factory=list)
    converged: bool = False

    @property
    def runs(self) -> int:
        return self.centers.shape[0]

    @property
    def k(self) -> int:
        return self.centers.shape[1]


def points_of(df: DataFrame, identifier: str, *arrays: str) -> DataFrame:
    """``id string, v array<double>`` with the arrays put end to end."""
    v = F.concat(*[F.col(a).cast("array<double>") for a in arrays])
    return df.select(F.col(identifier).cast("string").alias("id"), v.alias("v"))


def _squares(difference: np.ndarray) -> np.ndarray:
    return np.einsum("...d,...d->...", difference, difference)


def nearest(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Index of the nearest centre per point and run, lowest index on ties.

    One matrix product for all runs; where the two best are closer than rounding can tell, the
    distances are taken again from plain differences.
    """
    runs, k, dim = centers.shape
    lengths = _squares(centers)
    reach = lengths[None] - 2.0 * (x @ centers.reshape(-1, dim).T).reshape(len(x), runs, k)
    best = reach.argmin(axis=2)
    if k == 1:
        return best
    two = np.partition(reach, 1, axis=2)
    scale = _squares(x)[:, None] + lengths.max(axis=1)[None]
    close = two[:, :, 1] - two[:, :, 0] <= TIE * scale
    for run in np.flatnonzero(close.any(axis=0)):
        at = np.flatnonzero(close[:, run])
        best[at, run] = _squares(x[at, None] - centers[run][None]).argmin(axis=1)
    return best


def _squared_to_chosen(x: np.ndarray, centers: np.ndarray, best: np.ndarray) -> np.ndarray:
    columns = [_squares(x - centers[r][best[:, r]]) for r in range(len(centers))]
    return np.column_stack(columns)


def seed_centers(
    points: DataFrame, k: int, runs: int, seed: int
) -> tuple[np.ndarray, list[tuple[int, int, str]]]:
    """Start centres of all runs: the first uniformly, each next with probability proportional to
    the squared distance to the nearest centre so far.

    A draw is the winner of a race run inside the tasks; a task passes on its best point per run.
    Returns the centres and the drawn (run, place, id).
    """
    numbered = points.select("id", "v", *[c.alias(f"h{i}") for i, c in enumerate(id_numbers(F.col("id")), 1)])
    chosen: list[list[np.ndarray]] = [[] for _ in range(runs)]
    drawn: list[tuple[int, int, str]] = []
    context = points.sparkSession.sparkContext
    for place in range(k):
        so_far = context.broadcast(np.array(chosen) if place else None)

        def first_to_arrive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            best: dict[int, tuple[float, str, np.ndarray]] = {}
            for batch in batches:
                if not len(batch):
                    continue
                x, ids = matrix(batch.column("v")), batch.column("id")
                h1, h2 = (batch.column(h).to_numpy() for h in ("h1", "h2"))
                weight = np.ones((len(x), runs))
                if so_far.value is not None:
                    at = nearest(x, so_far.value)
                    weight = _squared_to_chosen(x, so_far.value, at)
                for run in range(runs):
                    arrival = race(h1, h2, seed, run, place, weight[:, run])
                    low = arrival.min()
                    if not np.isfinite(low):
                        continue
                    name, row = min((ids[int(i)].as_py(), int(i)) for i in np.flatnonzero(arrival == low))
                    if run not in best or (low, name) < best[run][:2]:
                        best[run] = (float(low), name, x[row].copy())
            if best:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(list(best), pa.int32()),
                        pa.array([b[0] for b in best.values()]),
                        pa.array([b[1] for b in best.values()]),
                        list_column(np.vstack([b[2] for b in best.values()])),
                    ],
                    names=["run", "arrival", "id", "v"],
                )

        local = numbered.mapInArrow(first_to_arrive, "run int, arrival double, id string, v array<double>")
        won = F.min(F.struct("arrival", "id", "v")).alias("won")
        winners = {row.run: row.won for row in local.groupBy("run").agg(won).toLocalIterator()}
        so_far.unpersist()
        if len(winners) < runs:
            raise ValueError(f"fewer than {k} different points to start from")
        for run in range(runs):
            chosen[run].append(np.array(winners[run].v))
            drawn.append((run, place, winners[run].id))
    return np.array(chosen), drawn


def _fold(points: DataFrame, centers: np.ndarray) -> DataFrame:
    """``run, k, n, cost, total vector`` summed over all points."""
    shared = points.sparkSession.sparkContext.broadcast(centers)
    runs, k, dim = centers.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, cost, total = np.zeros((runs, k)), np.zeros((runs, k)), np.zeros((runs, k, dim))
        for batch in batches:
            x = matrix(batch.column("v"), dim)
            best = nearest(x, shared.value)
            squared = _squared_to_chosen(x, shared.value, best)
            for run in range(runs):
                member = best[:, run, None] == np.arange(k)
                n[run] += member.sum(axis=0)
                cost[run] += squared[:, run] @ member
                total[run] += member.T.astype(np.float64) @ x
        if n.any():
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(np.arange(runs, dtype=np.int32), k)),
                    pa.array(np.tile(np.arange(k, dtype=np.int32), runs)),
                    pa.array(n.ravel().astype(np.int64)),
                    pa.array(cost.ravel()),
                    list_column(total.reshape(-1, dim)),
                ],
                names=["run", "k", "n", "cost", "total"],
            )

    parts = points.select("v").mapInArrow(
        sums, "run int, k int, n long, cost double, total array<double>"
    )
    vector = vector_to_array(Summarizer.sum(array_to_vector("total")))
    return parts.groupBy("run", "k").agg(
        F.sum("n").alias("n"), F.sum("cost").alias("cost"), vector.alias("total")
    )


def update(points: DataFrame, centers: np.ndarray) -> np.ndarray:
    """One round for all runs: centres move to the mean of their points; a centre without points
    stays where it is."""
    moved = centers.copy()
    for row in _fold(points, centers).toLocalIterator():
        if row.n:
            moved[row.run, row.k] = np.array(row.total) / row.n
    return moved


def lloyd(
    points: DataFrame, centers: np.ndarray, tolerance: float = 0.1, max_iterations: int | None = None
) -> ClusterRuns:
    """Rounds until no run moves its centres by more than ``tolerance`` in sum.

    There is no limit unless one is given; where it ends the rounds early, ``converged`` stays False.
    """
    result = ClusterRuns(centers)
    started = time.time()
    while max_iterations is None or result.iterations < max_iterations:
        moved = update(points, result.centers)
        result.shift = float(np.sqrt(_squares(moved - result.centers)).sum(axis=1).max())
        result.shifts.append(result.shift)
        result.centers, result.iterations = moved, result.iterations + 1
        if result.iterations % LOG_EVERY == 0:
            log.info(
                "round %d: largest shift %.2f, %.2f s",
                result.iterations, result.shift, time.time() - started,
            )
            started = time.time()
        if result.shift <= tolerance:
            result.converged = True
            break
    return result


def kmeans(
    points: DataFrame,
    k: int = 5,
    runs: int = 25,
    seed: int = 60295531,
    tolerance: float = 0.1,
    max_iterations: int | None = None,
) -> ClusterRuns:
    """Seeding and rounds for ``runs`` independent starts; points are cached meanwhile."""
    cached = points.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        centers, _ = seed_centers(cached, k, runs, seed)
        return lloyd(cached, centers, tolerance, max_iterations)
    finally:
        cached.unpersist()


def centers_table(spark: SparkSession, result: ClusterRuns) -> DataFrame:
    """``run, k, center, converged``: whether the rounds ended by themselves."""
    rows = [
        (run, k, result.centers[run, k].tolist(), result.converged)
        for run in range(result.runs)
        for k in range(result.k)
    ]
    return spark.createDataFrame(rows, "run int, k int, center array<double>, converged boolean")


def assign(points: DataFrame, centers: np.ndarray) -> DataFrame:
    """``id, assigned array<int>, squared array<double>``: nearest centre of every run and the
    squared distance to it."""
    shared = points.sparkSession.sparkContext.broadcast(centers)

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column("v"), shared.value.shape[2])
            best = nearest(x, shared.value)
            squared = _squared_to_chosen(x, shared.value, best)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    list_column(best.astype(np.int32)),
                    list_column(squared),
                ],
                names=["id", "assigned", "squared"],
            )

    return points.select("id", "v").mapInArrow(
        label, "id string, assigned array<int>, squared array<double>"
    )


def cost_by_run(points: DataFrame, centers: np.ndarray) -> DataFrame:
    """``run, cost``: sum of squared distances to the nearest of the given centres."""
    return _fold(points, centers).groupBy("run").agg(F.sum("cost").alias("cost"))


def cost_summary(costs: DataFrame) -> DataFrame:
    """log2 of the largest, smallest and mean cost, and the best run (lowest on ties)."""
    return costs.agg(
        F.log2(F.max("cost")).alias("log2_max"),
        F.log2(F.min("cost")).alias("log2_min"),
        F.log2(F.avg("cost")).alias("log2_mean"),
        F.min(F.struct("cost", "run"))["run"].alias("best_run"),
    )


def best_centers(points: DataFrame, result: ClusterRuns) -> DataFrame:
    """``run, k, center, cost, converged`` of the run of lowest cost over ``points``, the lower run on ties."""
    costs = cost_by_run(points, result.centers)
    best = costs.agg(F.min(F.struct("cost", "run")).alias("best")).select("best.run", "best.cost")
    centers = centers_table(points.sparkSession, result)
    return centers.join(F.broadcast(best), "run").select("run", "k", "center", "cost", "converged")


def joint_entropy(assigned: DataFrame, runs: int) -> DataFrame:
    """``runs, entropy`` (bits) of the joint assignment by the first 1, 2, ... ``runs`` runs.

    Points are counted by full signature first, and prefixes are taken from the distinct
    signatures, so the step that multiplies rows by ``runs`` never sees the points.
    """
    signatures = assigned.groupBy("assigned").agg(F.count(F.lit(1)).alias("n"))
    prefixes = signatures.select("n", "assigned", F.explode(F.sequence(F.lit(1), F.lit(runs))).alias("runs"))
    counts = prefixes.groupBy("runs", F.slice("assigned", 1, F.col("runs")).alias("prefix")).agg(
        F.sum("n").alias("n")
    )
    n = F.col("n").cast("double")
    entropy = F.log2(F.sum(n)) - F.sum(n * F.log2(n)) / F.sum(n)
    return counts.groupBy("runs").agg(entropy.alias("entropy"))
