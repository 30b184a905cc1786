"""Profile operators against Spark's RDD and ML forms, brute force and hand-made edges."""

from __future__ import annotations

import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import Correlation
from pyspark.sql import functions as F

from tripmill.functions.scalars import flag_to_int, round_half_up
from tripmill.operators import correlation, flags, profile
from tripmill.sources.trips import COORDINATES

quick = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def as_rdd_histogram(df):
    rows = df.collect()
    return [r["lo"] for r in rows] + [rows[-1]["hi"]], [r["n"] for r in rows]


@pytest.mark.parametrize("column", COORDINATES)
def test_histogram_equals_rdd_histogram(trips, column):
    edges, counts = trips.select(column).rdd.map(lambda r: r[0]).histogram(40)
    got_edges, got_counts = as_rdd_histogram(profile.histogram(trips, column))
    assert got_counts == counts
    assert got_edges == pytest.approx(edges)


def test_histograms_equal_single_histograms(trips):
    every = profile.histograms(trips, COORDINATES).collect()
    for c in COORDINATES:
        single = [tuple(r) for r in profile.histogram(trips, c).collect()]
        assert [tuple(r)[1:] for r in every if r["column"] == c] == single


def test_histogram_keeps_empty_buckets_and_skips_nan_and_null(spark):
    df = spark.createDataFrame([(0.0,), (10.0,), (float("nan"),), (None,)], "x double")
    rows = profile.histogram(df, "x", bins=5).collect()
    assert [r["n"] for r in rows] == [1, 0, 0, 0, 1]
    assert (rows[0]["lo"], rows[-1]["hi"]) == (0.0, 10.0)
    assert rows[0]["label"] == "[0.0, 2.0]"


def test_histogram_of_a_constant_is_one_bucket(spark):
    df = spark.createDataFrame([(2.0,), (2.0,)], "x double")
    rows = profile.histogram(df, "x").collect()
    assert [(r["bucket"], r["lo"], r["hi"], r["n"]) for r in rows] == [(0, 2.0, 2.0, 2)]
    assert profile.histograms(df, ["x"]).drop("column").collect() == rows


def test_histogram_of_nothing_is_empty(spark):
    df = spark.createDataFrame([(None,)], "x double")
    assert profile.histogram(df, "x").collect() == []
    assert profile.histograms(df, ["x"]).collect() == []


def test_clipped_histogram_looks_inside_only(trips):
    clip = (-73.95, -73.85)
    rows = profile.histogram(trips, "dropoff_longitude", clip=clip).collect()
    inside = trips.filter(F.col("dropoff_longitude").between(*clip)).count()
    assert sum(r["n"] for r in rows) == inside
    assert rows[0]["lo"] >= clip[0] and rows[-1]["hi"] <= clip[1]


@quick
@given(st.lists(st.integers(-(2**31), 2**31 - 1), min_size=1, max_size=40))
def test_exact_median_is_the_middle_value(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x int")
    expected = sorted(values)[math.ceil(len(values) / 2) - 1]
    assert profile.exact_median(df, "x").head()["median"] == expected


def test_exact_median_with_a_third_on_one_value(spark):
    df = spark.range(3000).selectExpr("cast(if(id % 3 = 0, 70000, id * 97) as int) x")
    values = sorted(r["x"] for r in df.collect())
    assert profile.exact_median(df, "x").head()["median"] == values[1499]


def test_medians_roughly_agree(trips):
    exact = profile.exact_median(trips, "trip_duration").head()["median"]
    assert abs(profile.approx_median(trips, "trip_duration") - exact) <= 5
    assert abs(profile.approx_median_frame(trips, "trip_duration").head()["median"] - exact) <= 5


@pytest.mark.parametrize(
    "value, expected", [(-73.985, -73.98), (73.985, 73.99), (40.754, 40.75), (-0.001, 0.0)]
)
def test_halves_round_up(spark, value, expected):
    df = spark.createDataFrame([(value,)], "x double")
    assert df.select(round_half_up("x")).head()[0] == expected


def test_flag_is_zero_for_everything_but_y(spark):
    df = spark.createDataFrame([("Y",), ("N",), (None,), ("y",)], "f string")
    assert [r[0] for r in df.select(flag_to_int("f")).collect()] == [1, 0, 0, 0]


def test_join_and_projection_give_the_same_flags(trips):
    joined = flags.join_flags(trips)
    assert {"id", "id2"} <= set(joined.columns)
    direct = flags.with_flag_int(trips).select("id", "store_and_fwd_flag_int")
    assert sorted(joined.select("id2", "store_and_fwd_flag_int").collect()) == sorted(
        direct.collect()
    )


def test_join_does_not_pair_copies_of_one_id(make_trips):
    repeated = make_trips([{"id": "hot" if i < 100 else f"id{i}"} for i in range(300)])
    assert flags.join_flags(repeated).count() == 200 + 100 * 2  # the hot id has both flags


def test_correlation_equals_sparks_own(trips):
    flagged = flags.with_flag_int(trips)
    vectors = VectorAssembler(inputCols=correlation.CORRELATED, outputCol="v").transform(flagged)
    own = Correlation.corr(vectors, "v").head()[0].toArray()
    matrix = correlation.correlation_matrix(flagged).collect()
    for i, row in enumerate(matrix):
        assert row["row"] == correlation.CORRELATED[i]
        for j, c in enumerate(correlation.CORRELATED):
            assert row[c] == pytest.approx(own[i][j], abs=1e-9)


def test_correlation_with_a_constant_is_null(spark):
    df = spark.createDataFrame([(1.0, 0.1), (2.0, 0.1), (4.0, 0.1)], "a double, b double")
    assert profile.numeric_summary(df, ["b"]).head()["stdev_pop"] == pytest.approx(0)
    assert correlation.pearson(df, "a", "b").head()[0] is None
    pairs = {(r["row"], r["col"]): r["corr"] for r in correlation.correlation_pairs(df, ["a", "b"]).collect()}
    assert pairs == {("a", "a"): 1.0, ("a", "b"): None, ("b", "a"): None, ("b", "b"): None}


def test_correlation_skips_rows_with_a_gap(spark):
    rows = [(1.0, 2.0), (2.0, 4.1), (3.0, None), (4.0, 8.0)]
    df = spark.createDataFrame(rows, "a double, b double")
    expected = df.dropna().stat.corr("a", "b")
    assert correlation.pearson(df, "a", "b").head()[0] == pytest.approx(expected)
    pairs = correlation.correlation_pairs(df, ["a", "b"]).collect()
    assert pairs[1]["corr"] == pytest.approx(expected)


def test_low_volume_days(make_trips):
    from datetime import datetime

    per_day = {1: 10, 2: 10, 3: 4, 4: 12}
    days = [d for d, n in per_day.items() for _ in range(n)]
    trips = make_trips([{"pickup_datetime": datetime(2016, 5, d, 8)} for d in days])
    rows = profile.low_volume_days(trips, "pickup_datetime").collect()
    assert [tuple(r) for r in rows] == [("2016-05-03", 4, 10.0)]


def test_shares_add_up(trips):
    rows = profile.frequency_share(trips, "vendor_id").collect()
    assert sum(r["pct"] for r in rows) == pytest.approx(100)


def test_preview_has_twenty_rows(trips):
    assert profile.preview(trips).count() == 20


def test_correlation_pairs_leave_out_their_own_nulls_only(spark):
    from tripmill.operators.correlation import correlation_pairs, pearson

    rows = [(1.0, 2.0, None), (2.0, None, 5.0), (3.0, 1.0, 4.0), (5.0, 7.0, 1.0), (None, 3.0, 2.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    for r in correlation_pairs(df, ["a", "b", "c"]).collect():
        assert abs(r["corr"] - pearson(df, r["row"], r["col"]).head()[0]) < 1e-12


def test_histogram_skips_infinite_values(spark):
    values = [(float("inf"),), (float("-inf"),), (float("nan"),), (1.0,), (2.0,), (3.0,)]
    found = profile.histogram(spark.createDataFrame(values, "x double"), "x", 4).collect()
    assert [r["n"] for r in found] == [1, 0, 1, 1] and (found[0]["lo"], found[-1]["hi"]) == (1, 3)


def test_median_of_no_rows_says_so(trips):
    with pytest.raises(ValueError):
        profile.approx_median(trips.limit(0), "trip_duration")
