"""Posts per user group and tokens that are relatively popular in a group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyforge.functions.tokens import explode_tokens
from tallyforge.joins import join_small

GROUPS = 7  # groups 0..6 are named in the lookup, group 7 is everybody else


def group_or_rest(group_id: Column, groups: int = GROUPS) -> Column:
    """The group when it is a valid one, else the rest group."""
    return F.when(group_id.between(0, groups - 1), group_id).otherwise(F.lit(groups)).cast("int")


def attach_group(
    df: DataFrame, lookup: DataFrame, salt_by: tuple[str, ...] = (), groups: int = GROUPS
) -> DataFrame:
    """Adds ``group_id`` by ``user_id``; users absent or with an invalid group get the rest."""
    known = lookup.select("user_id", F.col("group_id").alias("_group"))
    joined = join_small(df, known, ["user_id"], "left", salt_by)
    return joined.withColumn("group_id", group_or_rest(F.col("_group"), groups)).drop("_group")


def distinct_users(posts: DataFrame, approximate: bool = False) -> DataFrame:
    """``n_users``, exact unless an approximate answer is asked for."""
    count = F.approx_count_distinct if approximate else F.count_distinct
    return posts.agg(count("user_id").alias("n_users"))


def posts_per_group(posts: DataFrame, lookup: DataFrame, groups: int = GROUPS) -> DataFrame:
    """``group_id, n`` by group.  Posts are counted per user before the lookup, so the join sees
    one row per user however many posts a user has."""
    per_user = posts.groupBy("user_id").agg(F.count(F.lit(1)).alias("posts"))
    grouped = attach_group(per_user, lookup, groups=groups)
    return grouped.groupBy("group_id").agg(F.sum("posts").alias("n")).orderBy("group_id")


def grouped_posts(
    posts: DataFrame, lookup: DataFrame, salt_by: tuple[str, ...] = ("text",), groups: int = GROUPS
) -> DataFrame:
    """Every post with its group (right outer join of lookup and posts, group normalised)."""
    return attach_group(posts, lookup, salt_by, groups).select("user_id", "group_id", "text")


def user_tokens(posts: DataFrame, **options) -> DataFrame:
    """``user_id, token``: each token once per user."""
    rows = explode_tokens(posts, ["user_id"], "text", **options)
    return rows.dropDuplicates(["user_id", "token"])


def token_totals(mentions: DataFrame) -> DataFrame:
    """``token, n_all``: how many users mention the token."""
    return mentions.groupBy("token").agg(F.count(F.lit(1)).alias("n_all"))


def popular_tokens(mentions: DataFrame, min_users: int) -> DataFrame:
    """Tokens mentioned by at least ``min_users`` users."""
    return token_totals(mentions).where(F.col("n_all") >= min_users)


def top_tokens(mentions: DataFrame, min_users: int, k: int = 20) -> DataFrame:
    """The ``k`` most mentioned popular tokens, ties by token."""
    popular = popular_tokens(mentions, min_users)
    return popular.orderBy(F.desc("n_all"), F.asc("token")).limit(k)


def group_token_counts(
    mentions: DataFrame, lookup: DataFrame, min_users: int = 1, groups: int = GROUPS
) -> DataFrame:
    """``group_id, token, n_k, n_all`` for popular tokens.

    (user, token) pairs are unique, so the lookup join may salt by token.  One aggregate per
    token carries all group counters: the total, the popularity filter and the counts per group
    need a single exchange, and a token everybody uses is summed before it.
    """
    placed = attach_group(mentions, lookup, ("token",), groups)
    counters = [F.count_if(F.col("group_id") == g).alias(f"g{g}") for g in range(groups + 1)]
    wide = placed.groupBy("token").agg(F.count(F.lit(1)).alias("n_all"), *counters)
    popular = wide.where(F.col("n_all") >= min_users)
    cells = [F.struct(F.lit(g).alias("g"), F.col(f"g{g}").alias("n")) for g in range(groups + 1)]
    rows = popular.select("token", "n_all", F.inline(F.array(*cells)).alias("group_id", "n_k"))
    return rows.where(F.col("n_k") > 0).select("group_id", "token", "n_k", "n_all")


def relative_popularity(n_k: Column, n_all: Column) -> Column:
    """Log (base 2) of the share of a token's users who belong to the group."""
    return F.log2(n_k / n_all)


def top_relative_tokens(
    mentions: DataFrame, lookup: DataFrame, min_users: int, k: int = 10, groups: int = GROUPS
) -> DataFrame:
    """``group_id, rank, token, score``: the ``k`` best per group by score, ties by token."""
    counts = group_token_counts(mentions, lookup, min_users, groups)
    scored = counts.withColumn("score", relative_popularity(F.col("n_k"), F.col("n_all")))
    order = Window.partitionBy("group_id").orderBy(F.desc("score"), F.asc("token"))
    ranked = scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("group_id", "rank", "token", "score")
