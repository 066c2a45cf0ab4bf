import math

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tallyforge import joins
from tallyforge.operators import popularity
from tallyforge.sources import messages, tables

LINES = [
    ('{"id_str":"1","text":"Hello","user":{"id_str":"u1","name":"N"}}', ("u1", "Hello")),
    ('{"text":"two\\nlines 🎉","user":{"id_str":"u2"}}', ("u2", "two\nlines 🎉")),
    ('{"text":7,"user":{"id_str":8}}', ("8", "7")),
    ('  {"text":"blank around","user":{"id_str":"u1"}}  ', ("u1", "blank around")),
    ('{"text":"cut","user":{"id_str":"u1"', None),
    ('{"text":"more","user":{"id_str":"u1"}} trailing', None),
    ('{"text":"twice","user":{"id_str":"u1"}},{"text":"x","user":{"id_str":"u1"}}', None),
    ('{"text":"bracket","user":{"id_str":"u1"}}]', None),
    ('[{"text":"list","user":{"id_str":"u1"}}]', None),
    ('{"limit":{"track":77}}', None),
    ('{"text":null,"user":{"id_str":"u1"}}', None),
    ('{"text":"no user"}', None),
    ('{"text":"odd user","user":"bob"}', None),
    ("42", None),
    ('"text"', None),
    ("", None),
]


def test_posts(spark):
    lines = spark.createDataFrame([(raw,) for raw, _ in LINES], "value string")
    assert rows(messages.posts(lines)) == sorted(found for _, found in LINES if found)


def test_full_schema(spark):
    raw = (
        '{"id_str":"9","text":"RT","user":{"id_str":"u","screen_name":"s"},"entities":{"hashtags":'
        '[{"text":"h"}],"urls":[]},"retweeted_status":{"id_str":"3","text":"orig"}}'
    )
    parsed = messages.parse_messages(
        spark.createDataFrame([(raw,)], "value string"), schema=messages.MESSAGE
    ).first().message
    assert parsed.retweeted_status.text == "orig" and parsed.entities.hashtags[0].text == "h"


@pytest.fixture(scope="module")
def posts(spark):
    data = [("a", "x"), ("a", "x"), ("b", "y"), ("c", "z"), ("d", "x"), ("e", "y")]
    return spark.createDataFrame(data, "user_id string, text string")


@pytest.fixture(scope="module")
def lookup(spark):
    return tables.local_table(spark, [("a", 0), ("b", None), ("c", -1), ("d", 9)], tables.USER_GROUPS)


def test_groups(posts, lookup):
    assert [tuple(r) for r in popularity.posts_per_group(posts, lookup).collect()] == [(0, 2), (7, 4)]
    assert popularity.distinct_users(posts).first().n_users == 5
    assert popularity.distinct_users(posts, approximate=True).first().n_users == 5
    grouped = popularity.grouped_posts(posts, lookup)
    assert rows(grouped.where("group_id = 0")) == [("a", 0, "x"), ("a", 0, "x")]
    assert grouped.count() == 6


def test_popularity(spark):
    words = {"u1": "hot cold", "u2": "hot hot", "u3": "hot mild", "u4": "mild cold", "u5": "rare"}
    posts = spark.createDataFrame(list(words.items()), "user_id string, text string")
    lookup = spark.createDataFrame([("u1", 0), ("u2", 0), ("u3", 1)], tables.USER_GROUPS)
    mentions = popularity.user_tokens(posts)
    assert rows(popularity.token_totals(mentions)) == [("cold", 2), ("hot", 3), ("mild", 2), ("rare", 1)]
    assert rows(popularity.popular_tokens(mentions, 2)) == [("cold", 2), ("hot", 3), ("mild", 2)]
    assert [r.token for r in popularity.top_tokens(mentions, 1, 3).collect()] == ["hot", "cold", "mild"]
    top = popularity.top_relative_tokens(mentions, lookup, 2)
    got = {(r.group_id, r.rank): (r.token, round(r.score, 4)) for r in top.collect()}
    assert got == {
        (0, 1): ("hot", round(math.log2(2 / 3), 4)),
        (0, 2): ("cold", -1.0),
        (1, 1): ("mild", -1.0),
        (1, 2): ("hot", round(math.log2(1 / 3), 4)),
        (7, 1): ("cold", -1.0),
        (7, 2): ("mild", -1.0),
    }


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("salt", [(), ("v",)])
def test_join_beyond_the_broadcast_bound(spark, how, salt):
    """A key with a third of the rows: the salted and the plain shuffle join give the same."""
    big = spark.range(900).select(
        F.when(F.col("id") < 300, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("key"),
        F.col("id").alias("v"),
    )
    small = spark.createDataFrame([("hot", 1), ("k3", 2), ("k4", None)], "key string, g int")
    expected = rows(big.join(small, ["key"], how))
    assert rows(joins.join_small(big, small, ["key"], how)) == expected
    assert rows(joins.join_small(big, small, ["key"], how, salt, limit_bytes=0)) == expected


def test_salt_splits_a_hot_key(spark):
    big = spark.range(3000).select(F.lit("hot").alias("key"), F.col("id").alias("v"))
    small = spark.createDataFrame([("hot", 1)], "key string, g int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = joins.join_small(big, small, ["key"], "inner", ["v"], limit_bytes=0)
        sizes = joined.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(sizes) > 4 and max(r["count"] for r in sizes) < 1500


def test_join_kinds_that_would_drop_rows_are_refused(spark, posts, lookup):
    with pytest.raises(ValueError):
        joins.join_small(posts, lookup, ["user_id"], "full")


def test_table_bytes_counts_text(spark):
    short = spark.createDataFrame([("a", [1.0])], "s string, v array<double>")
    long = spark.createDataFrame([("a" * 1000, [1.0] * 1000)], "s string, v array<double>")
    assert joins.table_bytes(long) > joins.table_bytes(short) + 8000
