"""What the physical plans must and must not contain."""

import pytest

from tallyforge.functions import tokens
from tallyforge.operators import ngrams, popularity
from tallyforge.plans import inputs
from tallyforge.plans.queries import QUERIES
from tallyforge.sources import messages


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


EAGER = ("kmeans", "station_clusters", "depth_sweep", "model_compare")


@pytest.fixture(scope="module")
def plans(spark, sf_dir):
    names = [n for n in QUERIES if not any(e in n for e in EAGER)]
    return {name: plan(QUERIES[name](spark, sf_dir)) for name in names}


def test_no_pairwise_joins(plans):
    for name, text in plans.items():
        assert "CartesianProduct" not in text and "NestedLoopJoin" not in text, name


def test_python_only_where_arrays_need_it(plans):
    numeric = ("covariance", "eigen", "explained", "reconstruction", "components", "extremes", "identity", "regression", "station_c", "station_r", "stored_components")
    for name, text in plans.items():
        if not name.startswith(numeric) and "identity" not in name:
            assert "Python" not in text and "InPandas" not in text and "InArrow" not in text, name


def test_columns_are_pruned(plans):
    assert "ReadSchema: struct<text:string>" in plans["ngram_top5_n2"]
    assert "ReadSchema: struct<o_orderpriority:string>" in plans["class_distribution"]
    assert "ReadSchema: struct<user_id:bigint>" in plans["posts_per_group"]


def test_filters_reach_the_scan(plans):
    text = plans["station_selection"]
    assert text.index("Filter") < text.index("FileScan")


def test_top_k_without_a_full_sort(plans):
    assert "TakeOrderedAndProject" in plans["ngram_top5_n3"]
    assert "TakeOrderedAndProject" in plans["token_popular_top20"]
    assert "WindowGroupLimit" in plans["token_relative_popularity_top10"]
    # Ends of a measure are kept in the pass that rebuilds it: one scan, one Arrow pass, with the vectors.
    for name in ("extremes_lines", "extremes_lines_series"):
        assert plans[name].count("FileScan") == 1 and plans[name].count("MapInArrow") == 1, name
        assert "WindowGroupLimit" in plans[name]


def test_each_text_is_parsed_once(spark, tmp_path, sf_dir):
    (tmp_path / "lines").write_text('{"text":"a","user":{"id_str":"u"}}\n')
    found = plan(messages.posts(spark.read.text(str(tmp_path / "lines"))))
    assert found.count("from_json") == 1
    documents = inputs.texts(spark, sf_dir, "documents")
    found = plan(tokens.explode_tokens(documents, ["doc_id"], "text"))
    assert found.count(tokens.CLASSES["phone"]) == 1
    found = plan(ngrams.count_ngrams(documents, "text", [2]))
    assert found.count("split(lower") == 1 and found.count("split(text") == 1


def test_exchanges(spark, plans, sf_dir):
    """Shuffles beyond the dealing-out of a small table."""

    def shuffles(text):
        return text.count("Exchange hashpartitioning")

    assert shuffles(plans["ngram_top5_n1"]) == 1
    documents = inputs.texts(spark, sf_dir, "documents")
    all_sizes = plan(ngrams._best(ngrams.count_ngrams(documents, "text", [1, 2, 3]), 5))
    assert shuffles(all_sizes) == 2  # counts, then k rows per task and size
    assert "WindowGroupLimit" in all_sizes
    posts = inputs.document_posts(spark, sf_dir)
    mentions = popularity.user_tokens(posts)
    lookup = spark.createDataFrame([("1", 1)], "user_id string, group_id int")
    text = plan(popularity.top_relative_tokens(mentions, lookup, 20))
    assert shuffles(text) == 3  # distinct pairs, counters per token, k rows per task and group
    assert "BroadcastHashJoin" in text


def test_percentiles_without_a_window(plans):
    assert "Window" not in plans["profile_scalars"] and "Window" not in plans["profile_histogram"]


def test_derived_measures_move_once(plans):
    text = plans["derived_measures"]
    assert text.count("FileScan") == 1 and text.count("Exchange hashpartitioning") == 1 and "Join" not in text


def test_counts_are_combined_before_the_exchange(plans):
    for name in ("ngram_top5_n5", "token_users_total", "profile_day_stats", "posts_per_group"):
        assert "partial_" in plans[name], name
