"""Clustering, regression and tree ensembles: exact small cases and invariants."""

import math

import numpy as np
import pyarrow as pa
import pytest
from conftest import rows
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tallyforge import joins

from tallyforge.functions import draws
from tallyforge.functions.vectors import matrix
from tallyforge.session import shared_folder
from tallyforge.operators import clustering, regression, sampling, trees
from tallyforge.plans import inputs
from tallyforge.plans.queries import _tree_rows

# --- clustering ------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def blobs(spark):
    generator = np.random.default_rng(3)
    middles = np.array([[0, 0], [20, 0], [0, 20], [20, 20], [10, 50]], dtype=float)
    data = [
        (f"p{i}", (middles[i % 5] + generator.normal(size=2)).tolist()) for i in range(500)
    ]
    return spark.createDataFrame(data, "id string, v array<double>").repartition(8).cache()


def brute_nearest(x, centers):
    squares = ((x[:, None, None] - centers[None]) ** 2).sum(axis=3)
    return squares.argmin(axis=2), squares.min(axis=2)


def test_nearest_equals_brute_force():
    generator = np.random.default_rng(1)
    x, centers = generator.normal(size=(300, 6)), generator.normal(size=(7, 5, 6))
    assert (clustering.nearest(x, centers) == brute_nearest(x, centers)[0]).all()
    far = 1e8
    assert (clustering.nearest(x + far, centers + far) == brute_nearest(x + far, centers + far)[0]).all()


def test_ties_go_to_the_first_centre():
    x = np.array([[0.0, 0.0], [1.0, 1.0]])
    centers = np.array([[[1.0, 0.0], [-1.0, 0.0], [0.0, 1.0]], [[5.0, 5.0]] * 3])
    assert clustering.nearest(x, centers).tolist() == [[0, 0], [0, 0]]
    assert clustering.nearest(x, centers[:, :1]).tolist() == [[0, 0], [0, 0]]


def test_draws_follow_the_weights():
    ids = np.arange(4)
    h1, h2 = ids * 7919 + 11, ids * 104729 + 5
    weight = np.array([1.0, 2.0, 3.0, 4.0])
    picks = [int(draws.race(h1, h2, 1, run, 0, weight).argmin()) for run in range(20000)]
    shares = np.bincount(picks, minlength=4) / len(picks)
    assert np.allclose(shares, weight / 10, atol=0.015)
    assert not np.isfinite(draws.race(h1, h2, 1, 0, 0, np.zeros(4))).any()


def test_seeds_do_not_depend_on_partitions(spark, blobs):
    _, drawn = clustering.seed_centers(blobs, 5, 10, 42)
    _, again = clustering.seed_centers(blobs.coalesce(1).orderBy(F.desc("id")), 5, 10, 42)
    assert drawn == again
    assert all(len({i for r, _, i in drawn if r == run}) == 5 for run in range(10))
    assert clustering.seed_centers(blobs, 5, 10, 43)[1] != drawn


def test_too_few_points(spark):
    same = spark.createDataFrame([(str(i), [1.0, 1.0]) for i in range(9)], "id string, v array<double>")
    with pytest.raises(ValueError):
        clustering.seed_centers(same, 2, 3, 1)


def test_a_centre_without_points_stays(spark):
    points = spark.createDataFrame([("a", [0.0]), ("b", [2.0])], "id string, v array<double>")
    moved = clustering.update(points, np.array([[[1.0], [99.0]]]))
    assert moved.tolist() == [[[1.0], [99.0]]]
    moved = clustering.update(points, np.array([[[0.5], [99.0]]]))
    assert moved.tolist() == [[[1.0], [99.0]]]


def test_cost_never_rises(blobs):
    centers, _ = clustering.seed_centers(blobs, 5, 6, 9)
    last = None
    for _ in range(4):
        costs = np.array([r.cost for r in clustering.cost_by_run(blobs, centers).orderBy("run").collect()])
        assert last is None or (costs <= last + 1e-9).all()
        last, centers = costs, clustering.update(blobs, centers)


def test_whole_clustering(spark, blobs):
    result = clustering.kmeans(blobs, 5, 8, 7)
    assert result.shift <= 0.1 and result.iterations == len(result.shifts)
    costs = clustering.cost_by_run(blobs, result.centers)
    summary = clustering.cost_summary(costs).first()
    best = costs.orderBy("cost", "run").first()
    assert summary.best_run == best.run and math.isclose(2**summary.log2_min, best.cost)
    ml = KMeans(k=5, seed=1, featuresCol="f").fit(blobs.select(array_to_vector("v").alias("f")))
    assert best.cost <= ml.summary.trainingCost * 1.01
    assigned = clustering.assign(blobs, result.centers).cache()
    assert assigned.count() == 500 and assigned.where(F.size("assigned") != 8).isEmpty()
    entropy = [r.entropy for r in clustering.joint_entropy(assigned, 8).orderBy("runs").collect()]
    assert len(entropy) == 8 and all(b >= a - 1e-12 for a, b in zip(entropy, entropy[1:]))
    total = assigned.select(F.explode("squared").alias("s")).agg(F.sum("s")).first()[0]
    assert math.isclose(total, costs.agg(F.sum("cost")).first()[0])
    assert clustering.centers_table(spark, result).count() == 40


def test_points_of(spark):
    df = spark.createDataFrame([("s", [1.0], [2.0], [3.0])], "station string, a array<double>, b array<double>, c array<double>")
    assert tuple(clustering.points_of(df, "station", "a", "b", "c").first()) == ("s", [1.0, 2.0, 3.0])


def test_matrix_refuses_ragged_and_null_vectors():
    with pytest.raises(ValueError):
        matrix(pa.array([[1.0], [1.0, 2.0, 3.0]]), 2)
    with pytest.raises(ValueError):
        matrix(pa.array([[1.0], None]), 1)
    assert matrix(pa.array([[1.0, 2.0], [3.0, 4.0]]).slice(1), 2).tolist() == [[3.0, 4.0]]


# --- regression ------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def table(spark):
    generator = np.random.default_rng(5)
    x = generator.normal(size=(400, 3)) + [1000.0, 0.0, -5.0]
    y = 2 * x[:, 0] - x[:, 1] + generator.normal(size=400)
    z = x[:, 2] ** 2 + generator.normal(size=400)
    data = [(i, *map(float, x[i]), float(y[i]), float(z[i])) for i in range(400)]
    df = spark.createDataFrame(data, "id long, a double, b double, c double, y double, z double")
    return sampling.hash_split(df, ["id"], [("train", 0.5), ("test", 0.5)], 3).cache()


def test_one_pass_equals_refitting(table):
    pdf = table.toPandas()
    train, test = pdf[pdf["set"] == "train"], pdf[pdf["set"] == "test"]
    report = {(r.target, r.removed): r for r in regression.sensitivity(table, list("abc"), list("yz")).collect()}
    assert len(report) == 8
    for target in "yz":
        for removed in (None, *"abc"):
            use = [f for f in "abc" if f != removed]
            design = lambda p: np.column_stack([np.ones(len(p)), p[use]])
            beta = np.linalg.lstsq(design(train), train[target], rcond=None)[0]
            row = report[target, removed]
            assert math.isclose(row.intercept, beta[0], rel_tol=1e-6, abs_tol=1e-6)
            assert np.allclose([row.coefficients[f] for f in use], beta[1:], atol=1e-8)
            for name, part in (("train", train), ("test", test)):
                rest = part[target] - design(part) @ beta
                score = 1 - (rest**2).sum() / ((part[target] - part[target].mean()) ** 2).sum()
                assert math.isclose(row[f"r2_{name}"], score, abs_tol=1e-8)
            assert math.isclose(row.decrease_train, report[target, None].r2_train - row.r2_train)
            assert row.decrease_train >= -1e-12
            assert math.isclose(row.ratio, row.r2_test / row.r2_train)
    slopes = regression.coefficients(regression.sensitivity(table, list("abc"), ["y"]))
    assert slopes.count() == 3


def test_dependent_features_and_missing_values(table):
    doubled = table.withColumn("a2", F.col("a") * 2)
    holes = doubled.unionByName(doubled.limit(3).withColumn("a", F.lit(None).cast("double")))
    score = regression.sensitivity(holes, ["a", "a2"], ["y"]).where("removed is null").first().r2_train
    alone = regression.sensitivity(table, ["a"], ["y"]).where("removed is null").first().r2_train
    assert math.isclose(score, alone, abs_tol=1e-8)


def test_sets_are_needed(table):
    with pytest.raises(Exception, match="both a train and a test set"):
        regression.sensitivity(table.where("set = 'train'"), ["a"], ["y"]).collect()


def test_prediction(table):
    train = table.where("set = 'train'")
    model = regression.fit(train, ["a", "b", "c"], "y")
    row = regression.sensitivity(table, ["a", "b", "c"], ["y"]).where("removed is null").first()
    assert np.allclose(model.coefficients.toArray(), [row.coefficients[f] for f in "abc"], atol=1e-8)
    predicted = regression.predict(model, table, ["a", "b", "c"])
    assert predicted.count() == 400 and "features" not in predicted.columns


# --- tree ensembles --------------------------------------------------------------------------


@pytest.fixture(scope="module")
def tree_rows(spark, sf_dir):
    return _tree_rows(spark, sf_dir)


def test_depth_sweeps(tree_rows):
    boosted = trees.depth_sweep(tree_rows, "gbt", trees.cover_gbt, (1, 6), parallelism=2)
    errors = {(r.depth, r.set): r for r in boosted.collect()}
    assert len(errors) == 4 and all(r.seconds > 0 for r in errors.values())
    assert errors[6, "train"].error <= errors[1, "train"].error
    assert errors[1, "train"].n + errors[1, "test"].n == tree_rows.count()
    grown = trees.depth_sweep(tree_rows, "forest", trees.forest, (1,))
    both = trees.compare(boosted, grown)
    assert set(both.columns) == {"depth", "set", "gbt", "forest"} and both.count() == 4


def test_settings():
    gbt = trees.higgs_gbt(10)
    assert (gbt.getMaxDepth(), gbt.getMaxIter(), gbt.getStepSize(), gbt.getMaxBins()) == (10, 10, 0.25, 35)
    gbt = trees.cover_gbt(3)
    assert (gbt.getStepSize(), gbt.getMaxBins()) == (0.25, 54)
    forest = trees.forest(20)
    assert (forest.getNumTrees(), forest.getImpurity(), forest.getFeatureSubsetStrategy()) == (10, "gini", "auto")


def test_error_rate_save_load_and_text(spark, tree_rows, tmp_path):
    train = tree_rows.where("set = 'train'")
    model = trees.gbt(2, iterations=2).fit(train)
    scored = model.transform(train)
    wrong = scored.where("label != prediction").count() / scored.count()
    got = trees.error_rates(model, train).first()
    assert math.isclose(got.error, wrong)
    trees.save_model(model, str(tmp_path / "gbt"))
    again = trees.error_rates(trees.load_gbt(str(tmp_path / "gbt")), train).first()
    assert again.error == got.error
    assert "Tree 0" in trees.describe(model)
    forest = trees.forest(2, trees=2).fit(train)
    trees.save_model(forest, str(tmp_path / "forest"))
    assert trees.load_forest(str(tmp_path / "forest")).getNumTrees == 2


def test_categories(spark):
    """Listed values become marked places, which the learner splits as categories; others are an error."""
    data = [(i, "bad"[i % 3], float(i % 7), float(i % 3 == 1)) for i in range(90)]
    df = trees.nominal(spark.createDataFrame(data, "id long, kind string, x double, y double"), "kind", list("abd"))
    assert {(r.kind, r.kind_index) for r in df.collect()} == {("a", 0.0), ("b", 1.0), ("d", 2.0)}
    model = trees.gbt(1, iterations=1).fit(trees.labelled(df, "y", ["x", "kind_index"]))
    assert "feature 1 in {" in trees.describe(model) or "feature 1 not in {" in trees.describe(model)
    assert trees.error_rates(model, trees.labelled(df.withColumn("set", F.lit("all")), "y", ["x", "kind_index"], ["set"])).first().error == 0
    for values in (["a", "b"], ["a", "b", None]):
        with pytest.raises(Exception, match="no category of kind"):
            trees.nominal(df.drop("kind_index"), "kind", values).collect()


@pytest.mark.parametrize("limit", [joins.BROADCAST_BYTES, -1])
def test_walked_predictions_are_the_model_s(spark, monkeypatch, limit):
    """Saved through the shared folder, read as a table and walked: the model's own predictions, at every depth."""
    monkeypatch.setattr(joins.join_small, "__defaults__", (*joins.join_small.__defaults__[:2], limit, *joins.join_small.__defaults__[3:]))
    generator = np.random.default_rng(8)
    data = [
        (i, "pqrs"[int(k)], float(a), float(b), float((a + (k == 2) + generator.normal() * 0.4 > 0.5) ^ (b > 1)))
        for i, (k, a, b) in enumerate(zip(generator.integers(0, 4, 300), generator.normal(size=300), generator.normal(size=300)))
    ]
    df = trees.nominal(spark.createDataFrame(data, "id long, kind string, a double, b double, y double"), "kind", list("pqrs"))
    rows_ = trees.labelled(df, "y", ["a", "kind_index", "b"], ["id"]).cache()
    for depth in (1, 3, 5) if limit > 0 else (2,):
        for boosted, learner in ((True, trees.gbt(depth, iterations=3)), (False, trees.forest(depth, trees=3))):
            model = learner.fit(rows_)
            path = f"{shared_folder(spark)}/model"
            trees.save_model(model, path)
            nodes = trees.saved_nodes(spark, path)
            assert nodes.count() == model.totalNumNodes
            assert nodes.where("categories is not null").count() > 0 or depth == 1
            walked = {r.id: r.prediction for r in trees.walk(rows_, nodes, ["id"], depth, boosted).collect()}
            assert walked == {r.id: r.prediction for r in model.transform(rows_).collect()}


def test_labelled_projection(spark, sf_dir):
    df = inputs.labelled_vectors(spark, sf_dir)
    assert rows(df.groupBy("label").count().select("label")) == [(0.0,), (1.0,)]
