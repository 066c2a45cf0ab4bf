"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and cores.
With BENCH_MESSAGE_MB, that many MB of JSON lines are written to a scratch folder first (the conversations
again and again, each copy with users of its own) and the whole message job over them is timed as well.
Each query is run to its last row (noop sink) BENCH_RUNS times (default 2); its best time counts, and
the first, with start-up and code generation, is given beside it.  Names as arguments choose queries.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tallyforge.operators import popularity  # noqa: E402
from tallyforge.plans import inputs  # noqa: E402
from tallyforge.plans.queries import MIN_USERS, QUERIES  # noqa: E402
from tallyforge.session import build_session  # noqa: E402
from tallyforge.sources import messages  # noqa: E402

HEADLINE = [
    "ngram_top5_n1",
    "ngram_top5_n2",
    "ngram_top5_n5",
    "ngram_top5_all",
    "json_valid_posts",
    "json_distinct_users",
    "posts_per_group",
    "tokens_extract",
    "tokens_rich",
    "tokens_markup",
    "entities_decoded",
    "token_vocabulary",
    "token_popular_top20",
    "token_relative_popularity_top10",
    "message_job_top10",
    "class_distribution",
    "hash_sample_split",
    "profile_day_stats",
    "profile_scalars",
    "profile_histogram",
    "derived_measures",
    "covariance_matrix",
    "extremes_lines_series",
    "station_coefficients",
    "reconstruction_error",
    "reconstruction_extremes",
    "regression_2f",
    "regression_sensitivity",
    "kmeans_seed_d2",
    "kmeans_entropy",
    "kmeans_full",
    "gbt_depth_sweep",
    "rf_depth_sweep",
]


def message_job(spark, sf_dir: str, megabytes: int) -> tuple[float, float]:
    """MB of the lines written, and seconds of the whole job over them: parse, count users, posts per
    group, and the ten relatively most popular tokens of each group."""
    folder = tempfile.mkdtemp(prefix="message-bench-")
    lines = inputs.message_lines(spark, sf_dir)
    once = lines.agg(F.sum(F.octet_length("value"))).first()[0]
    numbers = F.sequence(F.lit(1), F.lit(max(1, megabytes * 1_000_000 // once)))
    more = F.regexp_replace("value", '"id_str":"u', F.concat(F.lit('"id_str":"u'), F.col("copy"), F.lit("0")))
    copied = lines.repartition(64).select("value", F.explode(numbers).alias("copy"))
    copied.select(more.alias("value")).write.text(f"{folder}/lines")
    written = spark.read.text(f"{folder}/lines").agg(F.sum(F.octet_length("value"))).first()[0] / 1e6
    started = time.perf_counter()
    posts = messages.posts(spark.read.text(f"{folder}/lines"))
    groups = inputs.user_groups(posts)
    popularity.distinct_users(posts).collect()
    popularity.posts_per_group(posts, groups).collect()
    popularity.top_relative_tokens(popularity.user_tokens(posts), groups, MIN_USERS).collect()
    return round(written, 1), round(time.perf_counter() - started, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="12g",
        spark__ui__enabled="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    seconds: dict[str, float] = {}
    first: dict[str, float] = {}
    for name in sys.argv[1:] or HEADLINE:
        taken = []
        for _ in range(runs):
            started = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - started)
        seconds[name], first[name] = round(min(taken), 3), round(taken[0], 3)
    extra = {}
    if megabytes := int(os.environ.get("BENCH_MESSAGE_MB", "0")):
        size, taken = message_job(spark, sf_dir, megabytes)
        extra = {"message_job": {"mb": size, "seconds": taken}}
    spark.stop()
    total = round(sum(seconds.values()), 3)
    scale = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "total_seconds", "value": total, "unit": "sec", "queries": seconds, "first": first, "sf": scale} | extra))


if __name__ == "__main__":
    main()
