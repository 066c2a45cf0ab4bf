"""Boosted trees and random forests over a range of depths."""

from __future__ import annotations

import time
from collections.abc import Sequence
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import (
    GBTClassificationModel,
    GBTClassifier,
    RandomForestClassificationModel,
    RandomForestClassifier,
)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.storagelevel import StorageLevel

from tallyforge.joins import join_small, table_bytes
from tallyforge.session import ensure_checkpoint_dir

GBT_DEPTHS = (1, 3, 6, 10)
FOREST_DEPTHS = (1, 3, 6, 10, 15, 20)
DEEP = 10  # from here on, keeping each row's node beats walking the trees again
ERRORS = "model string, depth int, set string, n long, error double, seconds double"


def labelled(df: DataFrame, label: str, features: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """``label double, features vector`` and the kept columns."""
    rows = VectorAssembler(inputCols=list(features), outputCol="features").transform(df)
    return rows.select(F.col(label).cast("double").alias("label"), "features", *keep)


def nominal(df: DataFrame, column: str, values: Sequence, name: str | None = None) -> DataFrame:
    """Adds ``name`` (default ``<column>_index``): the place of the value in ``values``, marked as a category.

    The mark is column metadata, which :func:`labelled` hands on to the learners: no pass over the data to
    learn the categories, and the same numbers in every table.  A value that is not listed is a data error.
    """
    name = name or f"{column}_index"
    marked = {"ml_attr": {"type": "nominal", "name": name, "vals": [str(v) for v in values]}}
    place = F.array_position(F.array(*[F.lit(v) for v in values]), F.col(column))
    unknown = F.raise_error(F.concat(F.lit(f"no category of {column}: "), F.coalesce(F.col(column).cast("string"), F.lit("null"))))
    index = F.when(F.coalesce(place, F.lit(0)) > 0, (place - 1).cast("double")).otherwise(unknown.cast("double"))
    return df.withColumn(name, index).withMetadata(name, marked)


def gbt(depth: int, iterations: int = 10, rate: float = 0.1, bins: int = 32, seed: int = 255) -> GBTClassifier:
    """Boosted trees; every parameter that differs between tree libraries is set here."""
    return GBTClassifier(
        maxDepth=depth,
        maxIter=iterations,
        stepSize=rate,
        maxBins=bins,
        lossType="logistic",
        subsamplingRate=1.0,
        featureSubsetStrategy="all",
        minInstancesPerNode=1,
        minInfoGain=0.0,
        cacheNodeIds=depth >= DEEP,
        checkpointInterval=10,
        maxMemoryInMB=512,
        seed=seed,
    )


def forest(depth: int, trees: int = 10, bins: int = 32, seed: int = 255) -> RandomForestClassifier:
    """Random forest with Gini impurity and the usual feature subsets."""
    return RandomForestClassifier(
        maxDepth=depth,
        numTrees=trees,
        maxBins=bins,
        impurity="gini",
        featureSubsetStrategy="auto",
        minInstancesPerNode=1,
        minInfoGain=0.0,
        cacheNodeIds=depth >= DEEP,
        checkpointInterval=10,
        maxMemoryInMB=512,
        seed=seed,
    )


def cover_gbt(depth: int, seed: int = 255) -> GBTClassifier:
    return gbt(depth, rate=0.25, bins=54, seed=seed)


def higgs_gbt(depth: int, seed: int = 255) -> GBTClassifier:
    return gbt(depth, rate=0.25, bins=35, seed=seed)


def error_rates(model: Model, df: DataFrame, set_column: str = "set") -> DataFrame:
    """``set, n, error``: share of wrong predictions, all sets in one pass; the label stays in the
    row, so predictions need not be matched back."""
    wrong = (F.col("label") != F.col("prediction")).cast("double")
    scored = model.transform(df)
    return scored.groupBy(set_column).agg(F.count(F.lit(1)).alias("n"), F.avg(wrong).alias("error"))


def depth_sweep(
    df: DataFrame,
    name: str,
    make,
    depths: Sequence[int],
    set_column: str = "set",
    parallelism: int = 1,
) -> DataFrame:
    """``model, depth, set, n, error, seconds`` for ``make(depth)`` trained on the rows of set
    'train'.  ``df`` has label, features and the set; it is cached for the sweep.

    With ``parallelism`` several depths train at once on the same cached rows, which keeps the
    cores busy through the many small jobs of a tree learner.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    cached = df.persist(StorageLevel.MEMORY_AND_DISK)

    def measure(depth: int) -> list[tuple]:
        started = time.time()
        learner: Estimator = make(depth)
        model = learner.fit(cached.where(F.col(set_column) == "train"))
        rates = error_rates(model, cached, set_column).collect()  # one row per set
        seconds = time.time() - started
        return [(name, depth, r[set_column], r["n"], r["error"], seconds) for r in rates]

    try:
        with ThreadPool(parallelism) as pool:
            rows = pool.map(inheritable_thread_target(spark)(measure), depths)
    finally:
        cached.unpersist()
    return spark.createDataFrame([row for part in rows for row in part], ERRORS)


def compare(*sweeps: DataFrame) -> DataFrame:
    """One table of several sweeps, a column of errors per model: ``depth, set, <model>...``."""
    rows = sweeps[0]
    for more in sweeps[1:]:
        rows = rows.unionByName(more)
    return rows.groupBy("depth", "set").pivot("model").agg(F.first("error"))


def save_model(model: Model, path: str) -> None:
    model.write().overwrite().save(path)


def load_gbt(path: str) -> GBTClassificationModel:
    return GBTClassificationModel.load(path)


def load_forest(path: str) -> RandomForestClassificationModel:
    return RandomForestClassificationModel.load(path)


def saved_nodes(spark: SparkSession, path: str) -> DataFrame:
    """The trees of a model saved by :func:`save_model`, one row per node: ``tree, weight, node, feature,
    threshold, categories, left, right, gain, prediction, stats, n``.

    A row goes left if its feature is at most the threshold, or in the categories.  Leaves have no
    feature; ``stats`` are a node's class counts (forests) or label sums (boosted trees).
    """
    inner = F.col("d.leftChild") >= 0
    nodes = spark.read.parquet(f"{path}/data").select("treeID", F.col("nodeData").alias("d"))
    # Tree, its metadata and its weight; named differently by different versions.
    weights = spark.read.parquet(f"{path}/treesMetadata").toDF("treeID", "metadata", "weight").drop("metadata")
    split, limits = F.col("d.split"), F.col("d.split.leftCategoriesOrThreshold")
    continuous = split["numCategories"] < 0
    return nodes.join(F.broadcast(weights), "treeID").select(  # a weight per tree
        F.col("treeID").alias("tree"), "weight", F.col("d.id").alias("node"),
        F.when(inner, split["featureIndex"]).alias("feature"),
        F.when(inner & continuous, F.get(limits, F.lit(0))).alias("threshold"),
        F.when(inner & ~continuous, limits).alias("categories"),
        F.when(inner, F.col("d.leftChild")).alias("left"), F.when(inner, F.col("d.rightChild")).alias("right"),
        F.when(inner, F.col("d.gain")).alias("gain"), F.col("d.prediction").alias("prediction"),
        F.col("d.impurityStats").alias("stats"), F.col("d.rawCount").alias("n"),
    )


def walk(df: DataFrame, nodes: DataFrame, keys: Sequence[str], depth: int, boosted: bool) -> DataFrame:
    """``keys..., prediction`` by following the node table from the root, ``depth`` steps in every tree.

    A step is a join to the nodes (broadcast while their measured size allows).  ``keys`` must name a row.
    Boosted trees add up their weighted leaves, forests their leaves' class shares; a tie goes to the first class.
    """
    keys = list(keys)
    size = table_bytes(nodes)
    trees = [r["tree"] for r in nodes.where("node = 0").select("tree").orderBy("tree").collect()]  # a row per tree
    at = df.select(*keys, vector_to_array("features").alias("x"), F.explode(F.array(*[F.lit(t) for t in trees])).alias("tree"))
    at = at.withColumn("node", F.lit(0))
    steps = nodes.select("tree", "node", "feature", "threshold", "categories", "left", "right")
    for _ in range(depth):
        here = join_small(at, steps, ["tree", "node"], salt_by=keys, small_bytes=size)
        value = F.get("x", F.col("feature"))
        left = F.when(F.col("threshold").isNotNull(), value <= F.col("threshold")).otherwise(F.array_contains("categories", value))
        to = F.when(F.col("feature").isNull(), F.col("node")).when(left, F.col("left")).otherwise(F.col("right"))
        at = here.select(*keys, "x", "tree", to.alias("node"))
    leaves = join_small(at, nodes.select("tree", "node", "weight", "prediction", "stats"), ["tree", "node"], salt_by=keys, small_bytes=size)
    if boosted:
        total = F.sum(F.col("weight") * F.col("prediction"))
        return leaves.groupBy(*keys).agg(F.when(total > 0, 1.0).otherwise(0.0).alias("prediction"))
    counted = F.aggregate("stats", F.lit(0.0), lambda t, s: t + s)
    shares = leaves.select(*keys, F.posexplode("stats").alias("class", "votes"), counted.alias("all"))
    votes = shares.groupBy(*keys, "class").agg(F.sum(F.col("votes") / F.col("all")).alias("votes"))
    first = F.max(F.struct("votes", (-F.col("class")).alias("class")))
    return votes.groupBy(*keys).agg((-first["class"]).cast("double").alias("prediction"))


def describe(model: Model) -> str:
    """The trees as text."""
    return model.toDebugString
