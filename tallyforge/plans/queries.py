"""Registered queries: every operator of the library over the given tables."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyforge.functions import tokens as tokens_
from tallyforge.functions.entities import decode_entities
from tallyforge.functions.escape import escape_non_ascii
from tallyforge.operators import (
    clustering,
    components,
    ngrams,
    popularity,
    profiles,
    regression,
    sampling,
    trees,
)
from tallyforge.plans import inputs
from tallyforge.session import materialise, shared_folder
from tallyforge.sources import corpus, messages, numeric, stations, tables

Query = Callable[[SparkSession, str], DataFrame]

MIN_USERS = 20
# Clusters, parallel runs and seed of the clustering; seed of the splits.
SEED = 60295531
K, RUNS = 5, 25
SPLIT_SEED = 255


def rounded(value: str | Column, digits: int = 6) -> Column:
    """Rounded for comparison across engines; never a negative zero."""
    return F.round(F.col(value) if isinstance(value, str) else value, digits) + F.lit(0.0)


# --- n-grams ---------------------------------------------------------------------------------


def ngram_top5(n: int) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        if n == 1:  # words are few: one pass
            top = ngrams.sorted_ngrams(inputs.texts(spark, sf_dir, "documents"), "text", n).limit(5)
        else:
            documents = inputs.texts(spark, sf_dir, "documents", ngrams.PASSES)
            top = ngrams.leading_ngrams(documents, "text", n, 5)
        return tables.ranked(top, [F.desc("count"), F.asc("ngram")])

    return query


def ngram_top5_all(spark, sf_dir):
    return ngrams.top_ngrams(inputs.texts(spark, sf_dir, "documents", ngrams.PASSES), "text")


def ngram5_punct_deleted_top100(spark, sf_dir):
    documents = inputs.texts(spark, sf_dir, "documents", ngrams.PASSES)
    return ngrams.leading_ngrams(documents, "text", 5, 100, punct="delete", ascii_only=True)


def ngram_counts_n2(spark, sf_dir):
    counts = ngrams.count_ngrams(inputs.texts(spark, sf_dir, "documents"), "text", [2])
    return counts.select("ngram", "count")


# --- readers: the given tables written as files of another kind, and read from there -----------


def reader_paragraphs(spark, sf_dir):
    """Documents as paragraphs of text files, each counted by its digest."""
    path = f"{shared_folder(spark)}/paragraphs"
    texts = inputs.table(spark, sf_dir, "documents").select("text").where(F.col("text").isNotNull())
    texts.write.option("lineSep", corpus.PARAGRAPH_BREAK).text(path)
    digests = corpus.read_paragraphs(spark, path).select(F.md5("value").alias("digest"))
    return digests.groupBy("digest").agg(F.count(F.lit(1)).alias("n"))


def reader_manifest(spark, sf_dir):
    """JSON lines in three folders named by a manifest: posts per user."""
    folder = shared_folder(spark)
    lines = inputs.message_lines(spark, sf_dir).withColumn("part", F.pmod(F.xxhash64("value"), F.lit(3)))
    lines.write.partitionBy("part").text(f"{folder}/lines")
    named = [(f"  {folder}/lines/part={part} ",) for part in range(3)] + [("",)]
    spark.createDataFrame(named, "value string").coalesce(1).write.text(f"{folder}/manifest")
    posts = messages.posts(corpus.read_lines(spark, corpus.read_manifest(spark, f"{folder}/manifest")))
    return posts.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))


def reader_csv_report(spark, sf_dir):
    """Order lines as gzip CSV of which some have a bad, an empty or a missing cell: sound rows and reasons."""
    names = ["quantity", "price", "discount", "tax"]
    path = f"{shared_folder(spark)}/csv"
    inputs.line_cells(spark, sf_dir).write.option("compression", "gzip").text(path)
    table = numeric.read_checked_csv(spark, path, names)
    sound = F.when(F.col("reason").isNull(), F.col("price"))
    return table.groupBy(F.coalesce("reason", F.lit("sound")).alias("reason")).agg(
        F.count(F.lit(1)).alias("n"), F.count("record").alias("records"), rounded(F.sum(sound), 2).alias("price")
    )


# --- messages and groups ---------------------------------------------------------------------


def json_valid_posts(spark, sf_dir):
    return messages.posts(inputs.message_lines(spark, sf_dir))


def json_distinct_users(spark, sf_dir):
    return popularity.distinct_users(messages.posts(inputs.message_lines(spark, sf_dir)))


def posts_per_group(spark, sf_dir):
    posts = inputs.event_posts(spark, sf_dir)
    return popularity.posts_per_group(posts, inputs.user_groups(posts))


def posts_right_outer(spark, sf_dir):
    posts = inputs.event_posts(spark, sf_dir)
    grouped = popularity.grouped_posts(posts, inputs.user_groups(posts))
    return grouped.groupBy("user_id", "group_id", "text").agg(F.count(F.lit(1)).alias("n"))


def tokens_extract(spark, sf_dir):
    rows = tokens_.explode_tokens(inputs.texts(spark, sf_dir, "conversations"), ["conv_id"], "text")
    return rows.groupBy("conv_id", "token").agg(F.count(F.lit(1)).alias("n"))


def tokens_rich(spark, sf_dir):
    rows = tokens_.explode_tokens(inputs.rich_messages(spark, sf_dir), ["conv_id"], "text")
    return rows.groupBy("conv_id", "token").agg(F.count(F.lit(1)).alias("n"))


def tokens_markup(spark, sf_dir):
    rows = tokens_.explode_tokens(inputs.texts(spark, sf_dir, "pages"), [], "html")
    return rows.groupBy("token").agg(F.count(F.lit(1)).alias("n"))


def entities_decoded(spark, sf_dir):
    pages = inputs.texts(spark, sf_dir, "pages")
    return pages.select("page_id", decode_entities(F.col("html")).alias("decoded"))


def text_escaped(spark, sf_dir):
    turns = inputs.texts(spark, sf_dir, "conversations")
    return turns.select("conv_id", "turn", escape_non_ascii(F.col("text")).alias("escaped"))


def _mentions(spark, sf_dir):
    return popularity.user_tokens(inputs.document_posts(spark, sf_dir))


def token_users_total(spark, sf_dir):
    return popularity.token_totals(_mentions(spark, sf_dir))


def token_vocabulary(spark, sf_dir):
    totals = popularity.token_totals(_mentions(spark, sf_dir))
    return totals.agg(
        F.count(F.lit(1)).alias("tokens"),
        F.count_if(F.col("n_all") >= MIN_USERS).alias("popular"),
    )


def token_popular_top20(spark, sf_dir):
    return popularity.top_tokens(_mentions(spark, sf_dir), MIN_USERS)


def token_group_counts(spark, sf_dir):
    posts = inputs.document_posts(spark, sf_dir)
    mentions = popularity.user_tokens(posts)
    return popularity.group_token_counts(mentions, inputs.user_groups(posts), MIN_USERS)


def token_relative_popularity_top10(spark, sf_dir):
    posts = inputs.document_posts(spark, sf_dir)
    mentions = popularity.user_tokens(posts)
    top = popularity.top_relative_tokens(mentions, inputs.user_groups(posts), MIN_USERS)
    return top.withColumn("score", rounded("score", 4))


def message_job_top10(spark, sf_dir):
    """From raw JSON lines to the tokens relatively popular in each group of users."""
    posts = messages.posts(inputs.message_lines(spark, sf_dir))
    groups = inputs.user_groups(posts)
    top = popularity.top_relative_tokens(popularity.user_tokens(posts), groups, MIN_USERS)
    return top.withColumn("score", rounded("score", 4))


# --- classes, samples, splits ----------------------------------------------------------------


def class_distribution(spark, sf_dir):
    shares = sampling.class_distribution(inputs.table(spark, sf_dir, "orders"), "o_orderpriority")
    return shares.withColumn("percent", rounded("percent", 4))


def class_distribution_named(spark, sf_dir):
    rows = inputs.vectors(spark, sf_dir).select(F.col("label").cast("double").alias("label"))
    shares = sampling.class_distribution(rows, "label", numeric.cover_names(spark))
    return shares.withColumn("name", F.coalesce("name", F.lit("no name"))).withColumn(
        "percent", rounded("percent", 4)
    )


def hash_sample_split(spark, sf_dir):
    ids = ["l_orderkey", "l_linenumber", "l_partkey"]
    lines = inputs.table(spark, sf_dir, "lineitem")
    sample = sampling.hash_sample(lines, ids, 0.1, seed=1)
    split = sampling.hash_split(sample, ids, seed=SPLIT_SEED)
    return split.groupBy("set").agg(
        F.count(F.lit(1)).alias("n"), rounded(F.sum("l_quantity"), 2).alias("quantity")
    )


def class_distribution_test_set(spark, sf_dir):
    split = sampling.hash_split(inputs.vectors(spark, sf_dir), ["vec_id"], seed=SPLIT_SEED)
    test = split.where(F.col("set") == "test")
    binary = test.select(sampling.one_vs_rest(F.col("label"), 2).alias("label"))
    return sampling.class_distribution(binary, "label").select("label", "n")


# --- profiles --------------------------------------------------------------------------------


def profile_day_stats(spark, sf_dir):
    profile = profiles.day_profile(inputs.station_years(spark, sf_dir))
    return profile.select("measurement", "day", rounded("mean").alias("mean"), rounded("var").alias("var"), "ne")


def profile_band(spark, sf_dir):
    band = profiles.bands(profiles.day_profile(inputs.station_years(spark, sf_dir)))
    return band.select("measurement", "day", *[rounded(c).alias(c) for c in ("mean", "std", "low", "high")])


def profile_missing_days(spark, sf_dir):
    return profiles.day_counts(inputs.station_years(spark, sf_dir), ["station", "measurement"])


def profile_scalars(spark, sf_dir):
    stats = profiles.measure_stats(inputs.event_values(spark, sf_dir))
    return stats.withColumn("mean", rounded("mean")).withColumn("std", rounded("std"))


def profile_histogram(spark, sf_dir):
    values = inputs.event_values(spark, sf_dir)
    counts = profiles.histogram(values, profiles.measure_stats(values))
    return counts.withColumn("lo", rounded("lo"))


def statistics_store(spark, sf_dir):
    """Statistics written once and read for the histogram; then those of one measure are renewed."""
    values = inputs.event_values(spark, sf_dir)
    path = f"{shared_folder(spark)}/measure_stats"
    tables.store_partitions(profiles.measure_stats(values), path, tables.MEASURE_STATS)
    doubled = values.where("measurement = 'click'").withColumn("value", F.col("value") * 2)
    tables.store_partitions(profiles.measure_stats(doubled), path, tables.MEASURE_STATS)
    stats = tables.read_stored(spark, path, tables.MEASURE_STATS)
    return stats.withColumn("mean", rounded("mean")).withColumn("std", rounded("std"))


def stored_band(spark, sf_dir):
    """Bands from a day profile in the store."""
    path = f"{shared_folder(spark)}/day_profile"
    tables.store_partitions(profiles.day_profile(inputs.station_years(spark, sf_dir)), path, tables.DAY_PROFILE)
    band = profiles.bands(tables.read_stored(spark, path, tables.DAY_PROFILE))
    return band.select("measurement", "day", *[rounded(c).alias(c) for c in ("mean", "std", "low", "high")])


def nested_flatten(spark, sf_dir):
    flat = stations.flatten_stations(inputs.nested_stations(spark, sf_dir))
    total = F.aggregate("values", F.lit(0.0), lambda s, x: s + x)
    return flat.select(
        "station", "measurement", "year", F.size("values").alias("days"), rounded(total).alias("total")
    )


def derived_measures(spark, sf_dir):
    rows = inputs.station_years(spark, sf_dir)
    derived = stations.derive_measures(
        rows, [("TAVG", "TMAX", "TMIN", "mean"), ("TRANGE", "TMAX", "TMIN", "range")]
    )
    days = profiles.day_values(derived, ["station", "measurement", "year"])
    return days.select("station", "measurement", "year", "day", rounded("value").alias("value"))


def vector_contract(spark, sf_dir):
    """Null vectors and vectors of a wrong length, per measure."""
    return stations.length_report(inputs.ragged_station_years(spark, sf_dir), 64)


def profile_sound_days(spark, sf_dir):
    """Day statistics of the vectors that keep the contract; the others are set aside."""
    rows = stations.keep_length(inputs.ragged_station_years(spark, sf_dir), 64)
    profile = profiles.day_profile(rows)
    return profile.select("measurement", "day", rounded("mean").alias("mean"), rounded("var").alias("var"), "ne")


def station_selection(spark, sf_dir):
    rows = inputs.station_years(spark, sf_dir)
    chosen = rows.where(
        (F.col("measurement") == "TMAX") & (F.col("station") == "S7") & (F.col("year") == 1901)
    )
    days = profiles.day_values(chosen, ["station", "year"])
    return days.select("station", "year", "day", rounded("value").alias("value"))


# --- principal components --------------------------------------------------------------------


def covariance_matrix(spark, sf_dir):
    cells = components.covariance_cells(
        components.covariance_rows(inputs.station_years(spark, sf_dir))
    )
    return cells.withColumn("cov", rounded("cov"))


def full_rank_identity(spark, sf_dir):
    """With all d directions kept, a vector is rebuilt without error and its coefficients carry
    its whole squared length."""
    rows = inputs.station_years(spark, sf_dir, gaps=False)
    model = components.fit_basis(rows, k=64)
    rebuilt = components.reconstruct(rows, model)
    length = F.aggregate("coeff", F.lit(0.0), lambda s, c: s + c * c)
    return rebuilt.select("measurement", length.alias("e"), F.element_at("mse", -1).alias("last")).groupBy(
        "measurement"
    ).agg(F.count(F.lit(1)).alias("n"), rounded(F.sum("e")).alias("energy"), rounded(F.max("last")).alias("error"))


def eigen_invariants(spark, sf_dir):
    """Sum of eigenvalues and of their squares, which equal sums over the covariance cells."""
    rows = inputs.station_years(spark, sf_dir, gaps=False)
    pairs = components.eigenpairs(components.covariance_rows(rows))
    return pairs.groupBy("measurement").agg(
        rounded(F.sum("eigval")).alias("trace"),
        rounded(F.sum(F.col("eigval") * F.col("eigval"))).alias("frobenius"),
    )


def explained_variance(spark, sf_dir):
    rows = components.covariance_rows(inputs.station_years(spark, sf_dir))
    return components.explained_variance(components.eigenpairs(rows))


def eigenvectors_top3(spark, sf_dir):
    rows = components.covariance_rows(inputs.station_years(spark, sf_dir))
    return components.component_series(components.eigenpairs(rows, 3))


def components_lines(spark, sf_dir):
    """Variance shares and unit vectors of order lines (quantity, price)."""
    return _shares(components.eigenpairs(components.covariance_rows(inputs.line_vectors(spark, sf_dir))))


def stored_components(spark, sf_dir):
    """The same from eigenpairs in the store."""
    path = f"{shared_folder(spark)}/eigenpairs"
    pairs = components.eigenpairs(components.covariance_rows(inputs.line_vectors(spark, sf_dir)))
    tables.store_partitions(pairs.drop("clipped"), path, tables.EIGENPAIRS)
    return _shares(tables.read_stored(spark, path, tables.EIGENPAIRS))


def _shares(pairs):
    shares = components.explained_variance(pairs).join(
        pairs.select("measurement", "rank", "eigvec"), ["measurement", "rank"]
    )
    return shares.select(
        "measurement", "rank",
        *[rounded(c).alias(c) for c in ("eigval", "ratio", "cumulative")],
        *[rounded(F.col("eigvec")[i]).alias(f"v{i + 1}") for i in (0, 1)],
    )


def reconstruction_lines(spark, sf_dir):
    """Every order line on the first component of its return flag."""
    rows = inputs.line_vectors(spark, sf_dir)
    errors = components.reconstruct(rows, components.fit_basis(rows, k=1))
    return errors.select(
        "station", "measurement", "year",
        rounded(F.col("coeff")[0]).alias("coeff"), rounded(F.col("mse")[0]).alias("mse"),
    )


def extremes_lines(spark, sf_dir):
    """The two best and two worst rebuilt order lines per return flag."""
    rows = inputs.line_vectors(spark, sf_dir)
    chosen = components.extremes(rows, components.fit_basis(rows, k=1))
    return chosen.select("measurement", "kind", "place", "station", "year", rounded("error").alias("error"))


def extremes_lines_series(spark, sf_dir):
    """The vectors of those lines: as they are, their mean, and rebuilt."""
    rows = inputs.line_vectors(spark, sf_dir)
    series = components.extreme_series(rows, components.fit_basis(rows, k=1))
    return series.select(
        "measurement", "kind", "place", "station", "year", "series", "day", rounded("value").alias("value")
    )


# Measures, kept components and the columns they make in a table of one row per station.
FLAGS, KEPT = ("A", "N", "R"), 2
COEFFICIENTS = [f"{flag}_coeff{i + 1}" for flag in FLAGS for i in range(KEPT)]


def _station_table(spark, sf_dir):
    """``station, A_coeff, N_coeff, R_coeff``: mean coefficients of a supplier's order lines."""
    rows = inputs.station_lines(spark, sf_dir)
    projected = components.reconstruct(rows, components.fit_basis(rows, k=KEPT))
    return components.station_coefficients(projected, FLAGS, KEPT)


def _split_table(table):
    for flag in FLAGS:
        table = stations.split_columns(table, f"{flag}_coeff", KEPT)
    return table


def station_coefficients(spark, sf_dir):
    return _split_table(_station_table(spark, sf_dir)).select("station", *[rounded(c).alias(c) for c in COEFFICIENTS])


def station_regression(spark, sf_dir):
    """Each coefficient of a station from what else is known of it."""
    table = _split_table(_station_table(spark, sf_dir)).join(inputs.station_facts(spark, sf_dir), "station").na.drop()
    split = sampling.hash_split(table, ["station"], [("train", 0.5), ("test", 0.5)], SPLIT_SEED)
    report = regression.sensitivity(split, ["balance", "nation"], COEFFICIENTS)
    slope = F.col("coefficients")
    return report.where(F.col("removed").isNull()).select(
        "target", rounded(slope["balance"], 9).alias("b_balance"), rounded(slope["nation"]).alias("b_nation"),
        rounded("r2_train").alias("r2_train"), rounded("r2_test").alias("r2_test"),
    )


STATION_K, STATION_RUNS = 2, 3


def station_clusters(spark, sf_dir):
    """Clusters of stations by their coefficients: the centres of the best run."""
    table = _station_table(spark, sf_dir).na.drop()
    points = materialise(clustering.points_of(table, "station", *[f"{flag}_coeff" for flag in FLAGS]))
    first = points.orderBy("id").limit(STATION_RUNS * STATION_K).collect()
    start = np.array([row["v"] for row in first]).reshape(STATION_RUNS, STATION_K, -1)
    best = clustering.best_centers(points, clustering.lloyd(points, start))
    rows = best.select("run", "k", "cost", F.posexplode("center").alias("pos", "value"))
    return rows.select(
        "run", "k", (F.col("pos") + 1).alias("dim"), rounded("value").alias("value"), rounded("cost", 4).alias("cost")
    )


def reconstruction_fixed_basis(spark, sf_dir):
    """Projection on the day means and three cosine waves: the whole reconstruction, with a basis
    that SQL can write down."""
    rows = inputs.station_years(spark, sf_dir, gaps=False)
    means = components.mean_vectors(rows)
    d = F.size("mean")
    wave = lambda j: F.transform(
        "mean", lambda _, i: F.sqrt(F.lit(2.0) / d) * F.cos(F.pi() * (i + 0.5) * j / d)
    )
    model = means.select("measurement", "mean", F.concat(*[wave(j) for j in (1, 2, 3)]).alias("basis"))
    errors = components.reconstruct(rows, model)
    return errors.select(
        "station", "measurement", "year",
        *[rounded(F.col("coeff")[j]).alias(f"coeff{j + 1}") for j in range(3)],
        *[rounded(F.col("mse")[j]).alias(f"mse{j + 1}") for j in range(3)],
    )


def reconstruction_error(spark, sf_dir):
    rows = inputs.station_years(spark, sf_dir, gaps=False)
    return components.reconstruct(rows, components.fit_basis(rows))


def reconstruction_extremes(spark, sf_dir):
    rows = inputs.station_years(spark, sf_dir, gaps=False)
    return components.extreme_series(rows, components.fit_basis(rows))


# --- regression ------------------------------------------------------------------------------


def regression_2f(spark, sf_dir):
    lines = inputs.table(spark, sf_dir, "lineitem")
    split = sampling.hash_split(
        lines, ["l_orderkey", "l_linenumber", "l_partkey"], [("train", 0.5), ("test", 0.5)], SPLIT_SEED
    )
    report = regression.sensitivity(split, ["l_quantity", "l_discount"], ["l_extendedprice"])
    slope = F.col("coefficients")
    return report.where(F.col("removed").isNull()).select(
        rounded("intercept", 3).alias("intercept"),
        rounded(slope["l_quantity"], 4).alias("b_quantity"),
        rounded(slope["l_discount"], 3).alias("b_discount"),
        rounded("r2_train").alias("r2_train"),
        rounded("r2_test").alias("r2_test"),
        rounded("ratio").alias("ratio"),
    )


def regression_sensitivity(spark, sf_dir):
    split = sampling.hash_split(
        inputs.projections(spark, sf_dir), ["vec_id"], [("train", 0.5), ("test", 0.5)], SPLIT_SEED
    )
    report = regression.sensitivity(
        split, [f"x{i}" for i in range(1, 5)], [f"y{i}" for i in range(1, 61)]
    )
    numbers = ("r2_train", "r2_test", "decrease_train", "decrease_test")
    return report.select(
        "target", F.coalesce("removed", F.lit("none")).alias("removed"),
        *[rounded(c).alias(c) for c in numbers],
    )


def regression_coefficients(spark, sf_dir):
    split = sampling.hash_split(
        inputs.projections(spark, sf_dir), ["vec_id"], [("train", 0.5), ("test", 0.5)], SPLIT_SEED
    )
    report = regression.sensitivity(
        split, [f"x{i}" for i in range(1, 5)], [f"y{i}" for i in range(1, 61)]
    )
    slopes = regression.coefficients(report)
    return slopes.select("target", "feature", rounded("coefficient").alias("coefficient"))


def regression_predictions(spark, sf_dir):
    lines = inputs.table(spark, sf_dir, "lineitem")
    features = ["l_quantity", "l_discount"]
    model = regression.fit(lines, features, "l_extendedprice")
    predicted = regression.predict(model, lines, features)
    return predicted.select(
        "l_orderkey", "l_linenumber", "l_partkey", rounded("prediction", 2).alias("prediction")
    )


# --- clustering ------------------------------------------------------------------------------


def fixed_centers(spark: SparkSession, sf_dir: str) -> np.ndarray:
    """Start centres that need no draw: the first runs x k vectors by id."""
    first = inputs.vectors(spark, sf_dir).orderBy("vec_id").limit(RUNS * K).collect()
    return np.array([row["values"] for row in first]).reshape(RUNS, K, -1)


def kmeans_seed_d2(spark, sf_dir):
    _, drawn = clustering.seed_centers(inputs.points(spark, sf_dir), K, RUNS, SEED)
    return spark.createDataFrame(drawn, "run int, place int, id string")


def kmeans_lloyd_steps(spark, sf_dir):
    points = inputs.points(spark, sf_dir)
    result = clustering.lloyd(points, fixed_centers(spark, sf_dir))
    centers = clustering.centers_table(spark, result)
    rows = centers.select("run", "k", "converged", F.posexplode("center").alias("pos", "value"))
    return rows.select(
        "run", "k", (F.col("pos") + 1).alias("dim"), rounded("value").alias("value"), "converged"
    )


def kmeans_cost_by_run(spark, sf_dir):
    costs = clustering.cost_by_run(inputs.points(spark, sf_dir), fixed_centers(spark, sf_dir))
    return costs.select("run", rounded("cost", 4).alias("cost"))


def kmeans_cost_summary(spark, sf_dir):
    costs = clustering.cost_by_run(inputs.points(spark, sf_dir), fixed_centers(spark, sf_dir))
    summary = clustering.cost_summary(costs)
    logs = [rounded(c).alias(c) for c in ("log2_max", "log2_min", "log2_mean")]
    return summary.select(*logs, "best_run")


def kmeans_assignment(spark, sf_dir):
    assigned = clustering.assign(inputs.points(spark, sf_dir), fixed_centers(spark, sf_dir))
    return assigned.select("id", F.array_join("assigned", ",").alias("assigned"))


def kmeans_best_centers(spark, sf_dir):
    points = inputs.points(spark, sf_dir)
    best = clustering.best_centers(points, clustering.lloyd(points, fixed_centers(spark, sf_dir)))
    rows = best.select("run", "k", "cost", F.posexplode("center").alias("pos", "value"))
    return rows.select(
        "run", "k", (F.col("pos") + 1).alias("dim"), rounded("value").alias("value"), rounded("cost", 4).alias("cost")
    )


def kmeans_entropy(spark, sf_dir):
    assigned = clustering.assign(inputs.points(spark, sf_dir), fixed_centers(spark, sf_dir))
    entropy = clustering.joint_entropy(assigned, RUNS)
    return entropy.select("runs", rounded("entropy").alias("entropy"))


def kmeans_full(spark, sf_dir):
    points = inputs.points(spark, sf_dir)
    result = clustering.kmeans(points, K, RUNS, SEED)
    costs = clustering.cost_by_run(points, result.centers)
    centers = clustering.centers_table(spark, result).join(costs, "run")
    rows = centers.select("run", "k", "cost", "converged", F.posexplode("center").alias("pos", "value"))
    return rows.select(
        "run", "k", (F.col("pos") + 1).alias("dim"), rounded("value").alias("value"),
        rounded("cost", 4).alias("cost"), "converged",
    )


# --- tree ensembles --------------------------------------------------------------------------


def _tree_rows(spark, sf_dir):
    return sampling.hash_split(inputs.labelled_vectors(spark, sf_dir), ["vec_id"], seed=SPLIT_SEED)


STUMP_FEATURES = ["l_quantity", "l_discount", "l_tax"]
STUMP_PRICE = 40_000
STUMP_BINS = 64  # more than any of these features has values: every midpoint is tried


def _stump_errors(spark, sf_dir, name, make):
    """One split over order lines, through the sweep: its best midpoint has a closed form."""
    lines = inputs.table(spark, sf_dir, "lineitem")
    dear = lines.withColumn("dear", (F.col("l_extendedprice") > STUMP_PRICE).cast("double"))
    split = sampling.hash_split(dear, ["l_orderkey", "l_linenumber", "l_partkey"], seed=SPLIT_SEED)
    rows = trees.labelled(split, "dear", STUMP_FEATURES, ["set"])
    sweep = trees.depth_sweep(rows, name, make, (1,))
    return sweep.select("model", "depth", "set", "n", rounded("error").alias("error"))


def tree_stump_errors(spark, sf_dir):
    return _stump_errors(spark, sf_dir, "boosted", lambda depth: trees.gbt(depth, iterations=1, bins=STUMP_BINS))


def forest_stump_errors(spark, sf_dir):
    return _stump_errors(spark, sf_dir, "forest", lambda depth: trees.forest(depth, trees=1, bins=STUMP_BINS))


# Categories of the features of tree_categorical_errors, in the order of their numbers.
CATEGORIES = {"l_returnflag": ["A", "N", "R"], "l_linestatus": ["F", "O"], "month": list(range(1, 13))}


def tree_categorical_errors(spark, sf_dir):
    """One split over categories of order lines: the best subset is one of those ordered by mean."""
    lines = inputs.table(spark, sf_dir, "lineitem").withColumn("month", F.month("l_shipdate"))
    for column, values in CATEGORIES.items():
        lines = trees.nominal(lines, column, values)
    many = lines.withColumn("many", (F.col("l_quantity") > 25).cast("double"))
    split = sampling.hash_split(many, ["l_orderkey", "l_linenumber", "l_partkey"], seed=SPLIT_SEED)
    rows = trees.labelled(split, "many", [f"{c}_index" for c in CATEGORIES], ["set"])
    sweep = trees.depth_sweep(rows, "boosted", lambda depth: trees.gbt(depth, iterations=1), (1,))
    return sweep.select("model", "depth", "set", "n", rounded("error").alias("error"))


def tree_nodes(spark, sf_dir):
    """A two-level boosted tree over order lines, saved and read back as a table of nodes."""
    lines = inputs.table(spark, sf_dir, "lineitem")
    dear = lines.withColumn("dear", (F.col("l_extendedprice") > STUMP_PRICE).cast("double"))
    model = trees.gbt(2, iterations=1, bins=STUMP_BINS).fit(trees.labelled(dear, "dear", STUMP_FEATURES))
    path = f"{shared_folder(spark)}/model"
    trees.save_model(model, path)
    return trees.saved_nodes(spark, path).select(
        "tree", "node", "feature", rounded("threshold").alias("threshold"), "left", "right",
        rounded("gain", 9).alias("gain"), rounded("prediction", 9).alias("prediction"), "n",
    )


def gbt_depth_sweep(spark, sf_dir):
    sweep = trees.depth_sweep(_tree_rows(spark, sf_dir), "gbt", trees.cover_gbt, trees.GBT_DEPTHS, parallelism=4)
    return sweep.drop("seconds")


def rf_depth_sweep(spark, sf_dir):
    rows = _tree_rows(spark, sf_dir)
    return trees.depth_sweep(rows, "forest", trees.forest, trees.FOREST_DEPTHS, parallelism=4).drop("seconds")


def model_compare(spark, sf_dir):
    rows = _tree_rows(spark, sf_dir)
    boosted = trees.depth_sweep(rows, "gbt", trees.higgs_gbt, trees.GBT_DEPTHS, parallelism=4)
    grown = trees.depth_sweep(rows, "forest", trees.forest, trees.FOREST_DEPTHS, parallelism=4)
    return trees.compare(boosted, grown)


QUERIES: dict[str, Query] = {
    **{f"ngram_top5_n{n}": ngram_top5(n) for n in range(1, 6)},
    **{
        f.__name__: f
        for f in (
            ngram_top5_all, ngram5_punct_deleted_top100, ngram_counts_n2,
            reader_paragraphs, reader_manifest, reader_csv_report,
            json_valid_posts, json_distinct_users, posts_per_group, posts_right_outer,
            tokens_extract, tokens_rich, tokens_markup, entities_decoded, text_escaped,
            token_users_total, token_vocabulary, token_popular_top20, token_group_counts,
            token_relative_popularity_top10, message_job_top10,
            class_distribution, class_distribution_named, hash_sample_split,
            class_distribution_test_set,
            profile_day_stats, profile_band, profile_missing_days, profile_scalars,
            profile_histogram, statistics_store, stored_band, nested_flatten, derived_measures, station_selection, vector_contract, profile_sound_days,
            covariance_matrix, eigen_invariants, full_rank_identity, explained_variance, eigenvectors_top3,
            components_lines, stored_components, reconstruction_lines, extremes_lines, extremes_lines_series,
            station_coefficients, station_regression, station_clusters,
            reconstruction_fixed_basis, reconstruction_error, reconstruction_extremes,
            regression_2f, regression_sensitivity, regression_coefficients, regression_predictions,
            kmeans_seed_d2, kmeans_lloyd_steps, kmeans_cost_by_run, kmeans_cost_summary,
            kmeans_assignment, kmeans_entropy, kmeans_best_centers, kmeans_full,
            tree_stump_errors, forest_stump_errors, tree_categorical_errors, tree_nodes, gbt_depth_sweep, rf_depth_sweep, model_compare,
        )
    },
}
