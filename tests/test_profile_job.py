"""The profile job from three scans against the reports taken one by one."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tripmill.operators import profile
from tripmill.plans.profiling import correlation_report, survey, write_profile
from tripmill.plans.profiling import profile as reports
from tripmill.sources.trips import (
    COORDINATES,
    DATETIMES,
    INTEGERS,
    read_trips_csv,
    write_trips_csv,
)


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_survey_equals_the_single_reports(trips):
    found, single = survey(trips), reports(trips)
    assert found.n_rows == 1000
    for c in INTEGERS:
        assert rows(found.frequency(c)) == rows(single[c])
    for c in DATETIMES:
        assert rows(found.per_day(c)) == rows(single[c])
    for c in COORDINATES:
        assert rows(found.histogram(c)) == rows(single[c])
    assert rows(found.grid("pickup_grid")) == rows(single["pickup_grid"])
    assert rows(found.grid("dropoff_grid")) == rows(single["dropoff_grid"])
    assert rows(found.first_ids()) == rows(single["id"])
    for a, b in zip(rows(found.share()), rows(single["store_and_fwd_flag"])):
        assert a == pytest.approx(b) if a[0] is None else (a[0] == b[0] and a[1:] == pytest.approx(b[1:]))
    for a, b in zip(rows(found.matrix()), rows(correlation_report(trips))):
        assert a[:2] == b[:2] and a[2:] == pytest.approx(b[2:])
    assert {r[0]: r[1] for r in rows(found.summary_frame())} == {r[0]: r[1] for r in rows(single["summary"])}


def test_survey_of_odd_values(make_trips):
    nan, inf = float("nan"), float("inf")
    odd = [
        {"pickup_latitude": None, "passenger_count": None, "store_and_fwd_flag": None},
        {"dropoff_latitude": 40.0, "dropoff_longitude": inf, "id": None},
        {"dropoff_latitude": 40.0, "dropoff_longitude": nan},
        {"dropoff_latitude": 40.0, "dropoff_longitude": None},
    ]
    table = make_trips(odd).withColumn("dropoff_latitude", F.lit(40.0))
    found = survey(table)
    assert rows(found.histogram("dropoff_latitude")) == [(0, 40.0, 40.0, "[40.0, 40.0]", 4)]
    assert [r[4] for r in rows(found.histogram("dropoff_longitude"))] == [1]
    assert rows(found.frequency("passenger_count"))[0] == (None, 1)
    assert (None, 1, 25.0) in rows(found.share()) and rows(found.first_ids())[0] == (None, 1)
    assert sum(r[2] for r in rows(found.grid("pickup_grid"))) == 4


def test_survey_of_no_rows(trips):
    found = survey(trips.limit(0))
    assert found.n_rows == 0 and found.bounds == {} and found.counts.count() == 0
    assert rows(found.histogram("pickup_latitude")) == []
    assert {r["value"] for r in found.rows().filter("measure = 'count'").collect()} == {0.0}


def test_three_scans_of_a_file_write_the_whole_profile(spark, trips, tmp_path):
    path, folder = str(tmp_path / "trips"), str(tmp_path / "reports")
    write_trips_csv(trips, path)
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    file = read_trips_csv(spark, path)
    write_profile(file.mapInArrow(count, file.schema), folder)
    assert seen.value <= 3 * 1000
    assert seen.value % 1000 == 0 and seen.value > 0
    summary = spark.read.option("header", True).csv(f"{folder}/summary")
    assert {r["column"] for r in summary.collect()} == {*INTEGERS, *COORDINATES}
    assert len(spark.read.csv(f"{folder}/idTags").collect()) == 20
    flags = spark.read.option("header", True).csv(f"{folder}/store_and_fwd_flag").collect()
    assert {(r["tag"], r["n"]) for r in flags} == {("Y", "201"), ("N", "799")}
    for c in COORDINATES:
        assert sum(int(r[0]) for r in spark.read.csv(f"{folder}/{c}Values").collect()) == 1000
    assert spark.read.csv(f"{folder}/correlationsValues").count() == 7


@pytest.mark.parametrize("values", [["b", "a", None, "c"], ["a"] * 300 + ["b"] * 3 + ["c"], [], [None, None]])
def test_first_values_of_a_column(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "id string").repartition(4)
    expected = sorted({v for v in values}, key=lambda v: (v is not None, v or ""))[:2]
    found = rows(profile.frequency_preview(df, "id", 2))
    assert found == [(v, values.count(v)) for v in expected]


def test_cutoff_is_known_only_if_enough_values_were_seen(spark):
    df = spark.createDataFrame([("a",)] * 300 + [("b",), ("c",)], "id string")

    def cutoff(spare):
        cut = profile.smallest_cutoff(df, "id", 2, spare)
        return spark.range(1).select(cut.alias("cut")).head()["cut"]

    assert cutoff(10) is None and cutoff(200) == "b"
