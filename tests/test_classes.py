import gzip

import pytest
from conftest import rows
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tallyforge.operators import sampling
from tallyforge.sources import numeric, tables


def test_column_names():
    cover = numeric.expand_columns(numeric.COVER_COLUMNS)
    assert len(cover) == 55 and cover[10] == "WA_0" and cover[14] == "ST_0" and cover[-1] == "Cover_Type"
    assert len(numeric.HIGGS_COLUMNS) == 29 and numeric.HIGGS_COLUMNS[0] == "label"


def test_numeric_csv(spark, tmp_path):
    good = "1, 2.5,3\n 4,5 ,6\n"
    with gzip.open(tmp_path / "a.csv.gz", "wt") as file:
        file.write(good)
    (tmp_path / "b.csv").write_text(good + "7,x,9\n")
    names = ["p", "q", "r"]
    assert rows(numeric.read_numeric_csv(spark, str(tmp_path / "a.csv.gz"), names)) == [
        (1.0, 2.5, 3.0),
        (4.0, 5.0, 6.0),
    ]
    with pytest.raises((Py4JJavaError, PySparkException)):
        numeric.read_numeric_csv(spark, str(tmp_path / "b.csv"), names).collect()
    kept = numeric.read_numeric_csv(spark, str(tmp_path / "b.csv"), names, "DROPMALFORMED")
    assert kept.count() == 2 and kept.select("p").count() == 2
    (tmp_path / "c.csv").write_text(good + "7,,9\n")
    with pytest.raises((Py4JJavaError, PySparkException)):
        numeric.read_numeric_csv(spark, str(tmp_path / "c.csv"), names).count()


def test_cover_file(spark, tmp_path):
    line = ",".join(["1"] * 54 + ["2"])
    (tmp_path / "cover.csv").write_text(line + "\n")
    row = numeric.read_cover(spark, str(tmp_path / "cover.csv")).first()
    assert row.Elevation == 1.0 and row.Cover_Type == 2.0
    (tmp_path / "higgs.csv").write_text(",".join(["0"] + ["3"] * 28) + "\n")
    assert numeric.read_higgs(spark, str(tmp_path / "higgs.csv")).first()["m_wwbb"] == 3.0


def test_delimited_line(spark):
    df = spark.createDataFrame([("a , b,c ",)], "line string")
    assert df.select(numeric.split_delimited("line").alias("x")).first().x == ["a", "b", "c"]


def test_class_distribution(spark):
    df = spark.createDataFrame([(2.0,)] * 5 + [(1.0,)] * 4 + [(9.0,)], "label double")
    shares = sampling.class_distribution(df, "label", numeric.cover_names(spark))
    assert [tuple(r) for r in shares.collect()] == [
        (2.0, "Lodgepole Pine", 5, 50.0),
        (1.0, "Spruce/Fir", 4, 40.0),
        (9.0, None, 1, 10.0),
    ]


def test_split_is_a_property_of_the_row(spark):
    df = spark.range(20000)
    split = sampling.hash_split(df, ["id"], seed=255)
    again = sampling.hash_split(df.repartition(13).orderBy(F.desc("id")), ["id"], seed=255)
    assert rows(split.groupBy("set").agg(F.sum("id"))) == rows(again.groupBy("set").agg(F.sum("id")))
    sizes = {r.set: r.n for r in sampling.set_sizes(split).collect()}
    assert sum(sizes.values()) == 20000 and abs(sizes["train"] / 20000 - 0.7) < 0.02
    assert rows(sampling.hash_split(df, ["id"], seed=1).groupBy("set").agg(F.sum("id"))) != rows(
        split.groupBy("set").agg(F.sum("id"))
    )


def test_samples(spark):
    df = spark.range(20000)
    assert abs(sampling.hash_sample(df, ["id"], 0.1).count() - 2000) < 200
    assert abs(sampling.random_sample(df, 0.1, 3).count() - 2000) < 200
    train, test = sampling.random_split(df, [0.7, 0.3], 255)
    assert train.count() + test.count() == 20000 and train.intersect(test).isEmpty()


def test_one_vs_rest(spark):
    df = spark.createDataFrame([(1.0,), (2.0,)], "label double")
    assert rows(df.select(sampling.one_vs_rest(F.col("label"), 2.0))) == [(0.0,), (1.0,)]


def test_results_round_trip(spark, tmp_path):
    top = spark.createDataFrame([("b", 2), ("a", 3)], "t string, n long")
    ranked = tables.ranked(top, [F.desc("n")])
    tables.write_table(ranked, str(tmp_path / "out"))
    assert rows(tables.read_table(spark, str(tmp_path / "out"), "t string, n long, rank int")) == [
        ("a", 3, 1),
        ("b", 2, 2),
    ]
    shown = spark.createDataFrame([(-3.56478,)], "x double").select(tables.printed_score("x").alias("x"))
    assert shown.first().x == "-3.5648"


def test_spread_only_moves_small_tables(spark):
    few, many = spark.range(0, 100, 1, 2), spark.range(0, 100, 1, 64)
    assert tables.spread(few).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism * 4
    assert tables.spread(many) is many


def test_spread_for_several_passes(spark, tmp_path):
    """What would be moved in each pass stays where it is once every core has a file."""
    cores = spark.sparkContext.defaultParallelism
    for files in (2, cores):
        spark.range(0, 100, 1, files).write.parquet(str(tmp_path / str(files)))
    few, enough = (spark.read.parquet(str(tmp_path / str(files))) for files in (2, cores))
    assert tables.spread(few, 3).rdd.getNumPartitions() == cores * 4
    assert tables.spread(enough, 3) is enough and tables.spread(enough) is not enough


def test_bad_rows_are_kept_with_file_and_reason(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("1, 2\n3,x\n4,\n5\n6,7,8\n")
    with gzip.open(tmp_path / "in" / "b.csv.gz", "wt") as file:
        file.write("9,10\n,\n")
    found = numeric.read_checked_csv(spark, str(tmp_path / "in"), ["p", "q.r"])
    assert rows(found.where("reason is null").select("p", "`q.r`")) == [(1.0, 2.0), (9.0, 10.0)]
    bad = {(r.file.rsplit("/", 1)[1], r.reason, r.record) for r in found.where("reason is not null").collect()}
    assert bad == {
        ("a.csv", "malformed", "3,x"), ("a.csv", "empty cell", None), ("a.csv", "malformed", "5"),
        ("a.csv", "malformed", "6,7,8"), ("b.csv.gz", "empty cell", None),
    }
    assert found.groupBy("reason").count().count() == 3


def test_statistics_store(spark, tmp_path):
    """Measures are replaced one by one, a null one too; a wrong schema is refused on either side."""
    kinds, path = "measurement string, n bigint, mean double", str(tmp_path / "stats")
    tables.store_partitions(spark.createDataFrame([("a", 1, 1.0), (None, 2, 2.0), ("07", 3, 3.0)], kinds), path, kinds)
    tables.store_partitions(spark.createDataFrame([(None, 5, 5.0), ("b", 4, 4.0)], kinds), path, kinds)
    got = tables.read_stored(spark, path, kinds)
    assert got.columns == ["measurement", "n", "mean"]
    assert rows(got) == rows(spark.createDataFrame([("a", 1, 1.0), (None, 5, 5.0), ("07", 3, 3.0), ("b", 4, 4.0)], kinds))
    with pytest.raises(ValueError, match="expected"):
        tables.store_partitions(spark.createDataFrame([("a", 1)], "measurement string, n int"), path, kinds)
    with pytest.raises(ValueError, match="expected"):
        tables.read_stored(spark, path, "measurement string, n bigint, mean double, std double")
    assert got.count() == 4
