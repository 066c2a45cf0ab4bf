"""Stations, profiles, components: fixtures with edge rows, and invariants."""

import math

import numpy as np
import pytest
from conftest import rows
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tallyforge import joins
from tallyforge.functions import order, vectors
from tallyforge.operators import components, profiles
from tallyforge.plans import inputs
from tallyforge.sources import stations, tables

NAN = float("nan")


@pytest.fixture(scope="module")
def station_years(spark):
    """Complete rows on a plane, rows with gaps, a row of gaps only; day 3 of SNWD never recorded."""
    data = [
        ("A", "TMAX", 1990, [1.0, 2.0, 3.0, 4.0]),
        ("A", "TMAX", 1991, [2.0, 4.0, 6.0, 8.0]),
        ("B", "TMAX", 1990, [3.0, 6.0, 9.0, 12.0]),
        ("B", "TMAX", 1991, [NAN, 1.0, 1.0, 1.0]),
        ("C", "TMAX", 1990, [NAN] * 4),
        ("A", "TMIN", 1990, [0.0, 1.0, NAN, 2.0]),
        ("A", "SNWD", 1990, [5.0, 0.0, NAN, 1.0]),
        ("B", "SNWD", 1990, [7.0, 0.0, NAN, 3.0]),
    ]
    return spark.createDataFrame(data, tables.STATION_YEARS)


def test_flatten(spark):
    nested = spark.createDataFrame(
        [("A", [("TMAX", 1990, [1.0]), ("TMIN", 1991, [2.0])]), ("B", [])], tables.STATIONS
    )
    assert rows(stations.flatten_stations(nested)) == [
        ("A", "TMAX", 1990, [1.0]),
        ("A", "TMIN", 1991, [2.0]),
    ]


def test_length_check(spark, station_years):
    length = lambda d: stations.require_length(station_years, d).select(F.size("values").alias("d")).agg(F.sum("d"))
    assert length(4).first()[0] == 32
    with pytest.raises(Exception, match="expected 365 values, got 4"):
        length(365).collect()


RAGGED = [("A", "T", 1, [1.0, 2.0]), ("A", None, 2, [1.0, 2.0]), ("B", "T", 2, [1.0, NAN, 3.0]), ("B", None, 1, [5.0, 6.0])]


def test_rows_set_aside_are_counted(spark):
    table = spark.createDataFrame([*RAGGED, ("C", "T", 1, None), ("C", "T", 2, [])], tables.STATION_YEARS)
    assert stations.keep_length(table, 2).count() == 3
    report = {r.measurement: tuple(r)[1:] for r in stations.length_report(table, 2).collect()}
    assert report == {"T": (4, 1, 2, 0, 3), None: (2, 0, 0, 2, 2)}
    with pytest.raises(Exception, match="expected 2 values, got null"):
        stations.require_length(table.where("values is null"), 2).collect()


@pytest.mark.parametrize("bad", [None, [], [1.0, 2.0, 3.0], [NAN] * 3])
def test_vector_jobs_refuse_ragged_rows(spark, bad):
    """A vector that is null, empty or of another length than the rest of its measure stops every vector job."""
    sound = [("A", "T", y, [float(y), 2.0]) for y in range(4)] + [("A", None, 1, [1.0, 2.0, 3.0])]
    table = spark.createDataFrame(sound, tables.STATION_YEARS)
    broken = spark.createDataFrame([*sound, ("Z", "T", 9, bad)], tables.STATION_YEARS)
    model = components.fit_basis(table, 1)
    jobs = [
        profiles.day_profile, lambda t: profiles.day_counts(t, ["measurement"]), components.mean_vectors, components.covariance_rows,
        lambda t: components.reconstruct(t, model), lambda t: components.extremes(t, model), lambda t: stations.require_length(t, 2),
    ]
    for job in jobs[:-1]:
        job(table).collect()
    for job in jobs:
        with pytest.raises(Exception, match="entries|null|empty|expected|offsets"):
            job(broken).collect()


def test_missing(station_years):
    found = station_years.where(stations.has_missing(F.col("values"))).count()
    assert found == 5


def test_derived(station_years):
    both = stations.combine_measures(station_years, "TMAX", "TMIN", "TAVG", "mean").first()
    assert (both.station, both.measurement, both.year) == ("A", "TAVG", 1990)
    assert both["values"][:2] == [0.5, 1.5] and math.isnan(both["values"][2])
    spread = stations.combine_measures(station_years, "TMAX", "TMIN", "TRANGE", "range").first()
    assert spread["values"][3] == 2.0


def test_derived_edges(spark):
    """Repeated vectors pair like others; no partner or no station gives nothing; unequal lengths are an error."""
    rows_ = [
        ("A", "X", 1, [1.0, NAN]), ("A", "X", 1, [1.0, NAN]), ("A", "Y", 1, [3.0, 4.0]), ("A", "Y", 1, [5.0, 4.0]), ("A", "Z", 1, [0.0]),
        ("B", "X", 1, [1.0, 2.0]), (None, "X", 1, [1.0, 2.0]), (None, "Y", 1, [1.0, 2.0]), ("C", "X", None, [1.0]), ("C", "Y", None, [1.0]),
    ]
    table = spark.createDataFrame(rows_, tables.STATION_YEARS)
    found = stations.derive_measures(table, [("M", "X", "Y", "mean"), ("R", "X", "Y", "range")]).collect()
    assert sorted((r.station, r.measurement, r["values"][0]) for r in found) == [
        ("A", "M", 2.0), ("A", "M", 2.0), ("A", "M", 3.0), ("A", "M", 3.0),
        ("A", "R", -4.0), ("A", "R", -4.0), ("A", "R", -2.0), ("A", "R", -2.0),
    ]
    assert all(math.isnan(r["values"][1]) for r in found)
    for right in ([1.0, 2.0, 3.0], None):
        uneven = spark.createDataFrame([("A", "X", 1, [1.0, 2.0]), ("A", "Y", 1, right)], tables.STATION_YEARS)
        with pytest.raises(Exception, match="not of equal length"):
            stations.combine_measures(uneven, "X", "Y", "M", "mean").collect()


def test_split_columns(spark):
    df = spark.createDataFrame([("s", [1.0, 2.0, 3.0])], "station string, TAVG_coeff array<double>")
    out = stations.split_columns(df, "TAVG_coeff", 3)
    assert out.columns == ["station", "TAVG_coeff1", "TAVG_coeff2", "TAVG_coeff3"]
    assert tuple(out.first()) == ("s", 1.0, 2.0, 3.0)


def test_array_functions(spark):
    df = spark.createDataFrame([([3.0, 4.0], [0.0, 5.0])], "a array<double>, b array<double>")
    a, b = F.col("a"), F.col("b")
    got = df.select(
        vectors.norm(a), vectors.squared_distance(a, b), vectors.elementwise_min(a, b),
        vectors.dot(a, b), vectors.normalised(a, F.lit(7.0)),
    ).first()
    assert tuple(got) == (5.0, 10.0, [0.0, 4.0], 20.0, [3 / 7, 4 / 7])


def test_day_profile(station_years):
    profile = {(r.measurement, r.day): r for r in profiles.bands(profiles.day_profile(station_years)).collect()}
    first = profile[("TMAX", 1)]
    assert (first.mean, first.ne) == (2.0, 3) and math.isclose(first["var"], 2 / 3)
    assert math.isclose(first.high - first.low, 2 * math.sqrt(2 / 3))
    assert ("SNWD", 3) not in profile
    counts = profiles.day_counts(station_years, ["measurement"])
    missing = {(r.measurement, r.day): (r.rows, r.recorded, r.missing) for r in counts.collect()}
    assert missing[("SNWD", 3)] == (2, 0, 2) and missing[("TMAX", 1)] == (5, 3, 2)


def test_ordered_bits(spark):
    """Every power of two and its neighbours, both signs, zeros and infinities: the bits of the machine's own format."""
    powers = 2.0 ** np.arange(-1074, 1024)
    some = np.random.default_rng(3).integers(-(2**63), 2**63 - 1, 2000, dtype=np.int64).view(np.float64)
    values = np.concatenate([powers, np.nextafter(powers, 0), np.nextafter(powers[:-1], np.inf), [0.0, np.inf], some[~np.isnan(some)]])
    values = np.concatenate([values, -values])
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    got = [r.bits for r in order.with_ordered_bits(df, "v").select("bits").collect()]
    size = np.abs(values).view(np.int64)
    assert got == np.where(values < 0, -size, size).tolist()
    assert order.with_ordered_bits(spark.createDataFrame([(None,)], "v double"), "v").first().bits is None


def test_exact_percentiles(spark):
    """Hot values, a null measure, NaN, infinities and null, few values, and numbers that differ in their last bits only."""
    generator = np.random.default_rng(7)
    groups = {
        "spread": generator.normal(size=3000).round(3),
        "hot": np.where(generator.random(3000) < 0.4, 5.0, generator.random(3000)),
        "equal": np.full(2000, -7.25),
        "close": 1.0 + np.arange(1500) * 2.0**-52,
        "wide": np.concatenate([-(10.0 ** np.arange(-300, 300)), 10.0 ** np.arange(-300, 300), [0.0, -0.0, 5e-324]]),
        None: generator.normal(size=500),
        "one": np.array([2.5]),
        "two": np.array([1.0, 9.0]),
    }
    data = [(k, float(v)) for k, vs in groups.items() for v in vs]
    data += [("one", NAN), ("one", None), ("none", None)]
    df = spark.createDataFrame(data, "measurement string, value double").repartition(7)
    stats = {r.measurement: r for r in profiles.measure_stats(df).collect()}
    assert set(stats) == set(groups)
    for key, values in groups.items():
        ordered = np.sort(values)
        for name, share in profiles.TAILS.items():
            rank = max(-(-len(ordered) * share // 1000), 1)
            assert stats[key][name] == ordered[rank - 1], (key, name)
        assert stats[key].n == len(ordered)
        if key != "wide":
            assert math.isclose(stats[key]["mean"], ordered.mean(), rel_tol=1e-12, abs_tol=1e-12)
            assert math.isclose(stats[key]["std"], ordered.std(), abs_tol=1e-12)
    bins = profiles.histogram(df.where("measurement is null or measurement in ('spread', 'one')"), profiles.measure_stats(df))
    counted = {r.measurement: r.n for r in bins.groupBy("measurement").agg(F.sum("n").alias("n")).collect()}
    inside = lambda v: ((v >= np.sort(v)[-(-len(v) * 10 // 1000) - 1]) & (v <= np.sort(v)[-(-len(v) * 990 // 1000) - 1])).sum()
    assert counted == {None: inside(groups[None]), "spread": inside(groups["spread"]), "one": 1}
    endless = spark.createDataFrame([("m", v) for v in (math.inf, -math.inf, 1.0, 2.0)], "measurement string, value double")
    row = profiles.measure_stats(endless).first()
    assert (row.low1000, row.low100, row.high100, row.high1000) == (-math.inf, -math.inf, math.inf, math.inf)


@pytest.mark.parametrize("limit", [joins.BROADCAST_BYTES, -1])
def test_percentiles_whichever_way_ranks_travel(spark, monkeypatch, limit):
    monkeypatch.setattr(joins.join_small, "__defaults__", (*joins.join_small.__defaults__[:2], limit, *joins.join_small.__defaults__[3:]))
    df = spark.range(5000).select(F.when(F.col("id") % 5 > 0, F.lit("m")).alias("measurement"), F.sin("id").alias("value"))
    got = {r.measurement: (r.low100, r.high100) for r in profiles.measure_stats(df).collect()}
    values = {m: np.sort([math.sin(i) for i in range(5000) if (i % 5 > 0) == (m == "m")]) for m in ("m", None)}
    for m, v in values.items():
        assert np.allclose(got[m], (v[len(v) // 100 - 1], v[len(v) * 99 // 100 - 1]), atol=1e-15)


def test_histogram_ends(spark):
    values = spark.createDataFrame([("m", float(v)) for v in (-99, 0, 4.9, 5, 10, 99)], "measurement string, value double")
    stats = spark.createDataFrame([("m", 0.0, 10.0)], "measurement string, low100 double, high100 double")
    assert rows(profiles.histogram(values, stats)) == [
        ("m", 0, 0.0, 2),
        ("m", 1, 5.0, 1),
        ("m", 2, 10.0, 1),
    ]


def test_covariance_with_gaps(station_years):
    cells = {
        (r.i, r.j): r
        for r in components.covariance_cells(components.covariance_rows(station_years)).collect()
        if r.measurement == "TMAX"
    }
    x = np.array([[1, 2, 3, 4], [2, 4, 6, 8], [3, 6, 9, 12], [NAN, 1, 1, 1]])
    for i in range(4):
        for j in range(4):
            both = x[~np.isnan(x[:, i]) & ~np.isnan(x[:, j])]
            expected = np.cov(both[:, i], both[:, j], bias=True)[0, 1]
            assert cells[i + 1, j + 1].n == len(both)
            assert math.isclose(cells[i + 1, j + 1]["cov"], expected, abs_tol=1e-12)


def test_covariance_of_a_day_without_values(station_years):
    cells = components.covariance_cells(components.covariance_rows(station_years))
    never = cells.where("measurement = 'SNWD' and i = 3").collect()
    assert [r.n for r in never] == [0] * 4 and all(math.isnan(r["cov"]) for r in never)
    pairs = components.eigenpairs(components.covariance_rows(station_years))
    assert pairs.where("measurement = 'SNWD'").count() == 4


@pytest.fixture(scope="module")
def complete(spark, sf_dir):
    return inputs.station_years(spark, sf_dir, gaps=False).cache()


@pytest.fixture(scope="module")
def pairs(complete):
    return components.eigenpairs(components.covariance_rows(complete)).cache()


def test_eigenpairs(pairs):
    for measure in ("TMAX", "TMIN"):
        found = pairs.where(F.col("measurement") == measure).orderBy("rank").collect()
        basis = np.array([r.eigvec for r in found])
        assert np.allclose(basis @ basis.T, np.eye(64), atol=1e-10)
        assert all(a.eigval >= b.eigval >= 0 for a, b in zip(found, found[1:]))
        assert all(max(r.eigvec, key=abs) > 0 for r in found)


def test_same_components_as_spark_ml(complete, pairs):
    one = complete.where("measurement = 'TMAX'").select(array_to_vector("values").alias("v"))
    model = PCA(k=3, inputCol="v", outputCol="p").fit(one)
    theirs = model.pc.toArray().T
    mine = np.array(
        [r.eigvec for r in pairs.where("measurement = 'TMAX' and rank <= 3").orderBy("rank").collect()]
    )
    assert np.allclose(np.abs((mine * theirs).sum(axis=1)), 1, atol=1e-8)
    shares = components.explained_variance(pairs).where("measurement = 'TMAX'").orderBy("rank").collect()
    assert np.allclose([r.ratio for r in shares[:3]], model.explainedVariance.toArray(), atol=1e-8)
    assert len(shares) == 9 and math.isclose(shares[2].cumulative, sum(r.ratio for r in shares[:3]))


def test_errors_fall_with_rank(complete, pairs):
    model = components.fit_basis(complete, 3)
    errors = components.reconstruct(complete, model).collect()
    assert all(r.mse[0] >= r.mse[1] >= r.mse[2] > 0 for r in errors)
    for measure in ("TMAX", "TMIN"):
        values = [r.eigval for r in pairs.where(F.col("measurement") == measure).orderBy("rank").collect()]
        mean = np.mean([r.mse for r in errors if r.measurement == measure], axis=0)
        expected = [sum(values[k:]) / 64 for k in (1, 2, 3)]
        assert np.allclose(mean, expected)


def test_exact_fit_stays_and_gaps_go(station_years):
    model = components.fit_basis(station_years.where("station in ('A', 'B') and year = 1990 or station = 'A'"), 1)
    errors = components.reconstruct(station_years, model).collect()
    flat = {(r.station, r.year): r.mse[0] for r in errors if r.measurement == "TMAX"}
    assert set(flat) == {("A", 1990), ("A", 1991), ("B", 1990)}
    assert all(abs(e) < 1e-20 for e in flat.values())


def test_models_too_large_to_send_along(complete, monkeypatch):
    model = components.fit_basis(complete, 3)
    small = components.reconstruct(complete, model, keep_vectors=True)
    expected = {(r.station, r.measurement, r.year): r.rebuilt for r in small.collect()}
    monkeypatch.setattr(components, "MODEL_BYTES", 0)
    large = components.reconstruct(complete, model, keep_vectors=True)
    got = {(r.station, r.measurement, r.year): r.rebuilt for r in large.collect()}
    assert got.keys() == expected.keys()
    assert all(np.allclose(got[k], expected[k]) for k in got)
    shown = ("measurement", "i", "j", "n", "round(cov, 9) + 0.0")
    joined = rows(components.covariance_cells(components.covariance_rows(complete)).selectExpr(*shown))
    monkeypatch.undo()
    sent = rows(components.covariance_cells(components.covariance_rows(complete)).selectExpr(*shown))
    assert joined == sent and joined


@pytest.mark.parametrize("limit", [components.MODEL_BYTES, 0])
def test_a_null_measure_is_a_measure(spark, monkeypatch, limit):
    """Rows whose measure is null keep their means, sums and reconstructions, either way models travel."""
    monkeypatch.setattr(components, "MODEL_BYTES", limit)
    generator = np.random.default_rng(4)
    data = [
        (f"S{i}", None if i % 2 else "T", 1900 + i, generator.normal(size=3).tolist()) for i in range(40)
    ]
    table = spark.createDataFrame(data, "station string, measurement string, year int, values array<double>")
    assert components.mean_vectors(table).count() == 2
    assert components.covariance_cells(components.covariance_rows(table)).count() == 18
    assert components.reconstruct(table, components.fit_basis(table, 2)).count() == 40


def test_many_measures_in_one_task(spark, complete, monkeypatch):
    monkeypatch.setattr(components, "OPEN_BYTES", 0)
    cells = components.covariance_cells(components.covariance_rows(complete.coalesce(1)))
    monkeypatch.undo()
    usual = components.covariance_cells(components.covariance_rows(complete))
    shown = ("measurement", "i", "j", "n", "round(cov, 9) + 0.0")
    assert rows(cells.selectExpr(*shown)) == rows(usual.selectExpr(*shown))


def test_extreme_series(complete):
    model = components.fit_basis(complete, 3)
    series = components.extreme_series(complete, model)
    kinds = {(r.measurement, r.kind, r.place) for r in series.select("measurement", "kind", "place").distinct().collect()}
    assert len(kinds) == 8
    lines = {r.series for r in series.select("series").distinct().collect()}
    assert lines == {"original", "mean", "rank1", "rank2", "rank3"}
    assert series.count() == 8 * 5 * 64
    errors = components.reconstruct(complete, model)
    last = {(r.measurement, r.station, r.year): r.mse[2] for r in errors.collect()}
    chosen = components.extremes(complete, model).where("measurement = 'TMAX'").collect()
    ordered = sorted(v for k, v in last.items() if k[0] == "TMAX")
    by_kind = {(r.kind, r.place): r.error for r in chosen}
    assert [by_kind["best", 1], by_kind["best", 2]] == ordered[:2]
    assert [by_kind["worst", 2], by_kind["worst", 1]] == ordered[-2:]
    one = series.where("measurement = 'TMAX' and kind = 'worst' and place = 1 and day = 5").collect()
    at = {r.series: r.value for r in one}
    row = next(r for r in chosen if (r.kind, r.place) == ("worst", 1))
    original = complete.where(
        (F.col("measurement") == "TMAX") & (F.col("station") == row.station) & (F.col("year") == row.year)
    ).first()["values"]
    assert at["original"] == original[4]


@pytest.mark.parametrize("held", [components.OPEN_BYTES, 0])
def test_extremes_with_ties_and_nulls(spark, monkeypatch, held):
    """All errors equal but two, a null measure, rows without a station, gaps; also when tasks pass on early."""
    monkeypatch.setattr(components, "OPEN_BYTES", held)
    data = [(f"S{i:02}", m, 1900 + i % 3, [1.0 + (i == 7), 0.0]) for i in range(20) for m in ("T", None)]
    data += [(None, "T", 1900, [1.0, 0.0]), (None, None, None, [5.0, 0.0]), ("A", "T", 1, [NAN, 9.0]), ("B", "Q", 1, [NAN, 1.0])]
    table = spark.createDataFrame(data, tables.STATION_YEARS).repartition(5)
    model = spark.createDataFrame(
        [(m, [1.0, 0.0], [0.0, 1.0]) for m in ("T", None, "Q")], "measurement string, mean array<double>, basis array<double>"
    )
    found = {(r.measurement, r.kind, r.place): (r.station, r.year, r.error, r["values"]) for r in components.extremes(table, model, 3).collect()}
    assert len(found) == 12
    for m in ("T", None):
        assert [found[m, "best", p][0] for p in (1, 2, 3)] == ["S00", "S01", "S02"]
    assert found["T", "worst", 1] == ("S07", 1901, 0.5, [2.0, 0.0]) and found["T", "worst", 2][0] == "S00"
    assert found[None, "worst", 1] == (None, None, 8.0, [5.0, 0.0])


def test_station_table(spark):
    projected = spark.createDataFrame(
        [("A", "X", [1.0, 2.0]), ("A", "X", [3.0, 5.0]), ("A", "Y", [7.0, 8.0]), ("B", "Y", [1.0, 1.0]), (None, "X", [4.0, 4.0]), ("A", None, [9.0, 9.0])],
        "station string, measurement string, coeff array<double>",
    )
    table = components.station_coefficients(projected, ["X", "Y"], 2)
    assert rows(table) == rows(
        spark.createDataFrame(
            [("A", [2.0, 3.5], [7.0, 8.0]), ("B", None, [1.0, 1.0]), (None, [4.0, 4.0], None)], table.schema
        )
    )


def test_component_series(pairs):
    assert components.component_series(pairs).count() == 2 * 3 * 64
