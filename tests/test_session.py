"""Defaults give way to what is set already."""

import os
import subprocess
import sys

from tallyforge.operators import clustering
from tallyforge.session import build_session

RUN = """
from tallyforge.session import build_session
spark = build_session("conf", "local[1]", spark__ui__enabled="false")
print("GOT", spark.conf.get("spark.sql.adaptive.enabled"), spark.conf.get("spark.sql.session.timeZone"),
      spark.conf.get("spark.sql.execution.arrow.pyspark.enabled"))
"""


def test_submitted_settings_stay():
    args = "--conf spark.sql.adaptive.enabled=false --conf spark.sql.session.timeZone=Asia/Tokyo pyspark-shell"
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = subprocess.run(
        [sys.executable, "-c", RUN], env=os.environ | {"PYSPARK_SUBMIT_ARGS": args}, cwd=root,
        capture_output=True, text=True, check=True,
    ).stdout
    assert "GOT false Asia/Tokyo true" in out


def test_a_running_session_is_left_alone(spark):
    before = spark.conf.get("spark.sql.adaptive.skewJoin.enabled")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
    try:
        assert build_session("again").conf.get("spark.sql.adaptive.skewJoin.enabled") == "false"
    finally:
        spark.conf.set("spark.sql.adaptive.skewJoin.enabled", before)


def test_rounds_cut_short_say_so(spark, sf_dir):
    from tallyforge.plans import inputs, queries

    points, start = inputs.points(spark, sf_dir), queries.fixed_centers(spark, sf_dir)
    cut = clustering.lloyd(points, start, max_iterations=1)
    assert not cut.converged and not clustering.centers_table(spark, cut).first().converged
    assert clustering.lloyd(points, start).converged
