"""Cleaning edges and split properties."""

from __future__ import annotations

import contextlib
import io
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tripmill.operators import clean, split
from tripmill.operators.clean import CleanRules


def ids(df):
    return sorted(r["id"] for r in df.select("id").collect())


def test_excluded_day_includes_both_midnights(make_trips):
    moments = {
        "before": datetime(2016, 1, 22, 23, 30),
        "start": datetime(2016, 1, 23),
        "inside": datetime(2016, 1, 23, 12),
        "end": datetime(2016, 1, 24),
        "after": datetime(2016, 1, 24, 0, 0, 1),
    }
    trips = make_trips(
        [{"id": k, "pickup_datetime": t, "trip_duration": 0} for k, t in moments.items()]
    )
    assert ids(clean.clean(trips)) == ["after", "before"]


def test_a_trip_into_the_excluded_day_goes_too(make_trips):
    trips = make_trips([{"pickup_datetime": datetime(2016, 1, 22, 23, 55), "trip_duration": 900}])
    assert clean.clean(trips).count() == 0


def test_cutoff_is_exclusive_and_on_dropoff(make_trips):
    trips = make_trips(
        [
            {"id": "in", "pickup_datetime": datetime(2016, 6, 30, 23, 0), "trip_duration": 3599},
            {"id": "out", "pickup_datetime": datetime(2016, 6, 30, 23, 0), "trip_duration": 3600},
        ]
    )
    assert ids(clean.clean(trips)) == ["in"]


def test_incomplete_rows_go(make_trips):
    trips = make_trips(
        [
            {"id": "ok"},
            {"id": None},
            {"id": "a", "passenger_count": None},
            {"id": "b", "pickup_latitude": float("nan")},
            {"id": "c", "pickup_datetime": None},
            {"id": "d", "store_and_fwd_flag": None},
        ]
    )
    assert ids(clean.clean(trips)) == ["ok"]
    assert trips.filter(clean.is_complete(trips)).collect() == clean.drop_incomplete(trips).collect()


def test_loss_counts_each_row_once(make_trips):
    trips = make_trips(
        [
            {"id": "ok"},
            {"id": "null", "passenger_count": None},
            {"id": "both", "passenger_count": None, "pickup_datetime": datetime(2016, 1, 23, 5)},
            {"id": "day", "pickup_datetime": datetime(2016, 1, 23, 5)},
        ]
    )
    loss = clean.clean_loss(trips).head()
    assert (loss["n_total"], loss["n_null"], loss["n_outlier"]) == (4, 2, 1)
    assert loss["loss_rate"] == 0.75
    assert clean.clean(trips).count() == 1


def test_loss_of_an_empty_file(make_trips):
    assert clean.clean_loss(make_trips([{}]).filter("false")).head()["loss_rate"] is None


def test_clean_split_reports_the_test_side(make_trips):
    train = make_trips([{"id": "a", "passenger_count": None}])
    test = make_trips([{"id": "b"}, {"id": "c", "pickup_datetime": datetime(2016, 1, 23, 5)}])
    train, test, loss = clean.clean_split(train, test)
    assert (train.count(), test.count()) == (0, 1)
    assert loss.head()["n_total"] == 2 and loss.head()["n_outlier"] == 1


def test_date_filters_reach_a_parquet_scan(make_trips, spark, tmp_path):
    make_trips([{}, {}]).write.parquet(str(tmp_path / "trips"))
    stored = spark.read.parquet(str(tmp_path / "trips"))
    with contextlib.redirect_stdout(io.StringIO()) as plan:
        clean.clean(stored).explain("formatted")
    pushed = plan.getvalue().split("PushedFilters")[1]
    assert "LessThan(dropoff_datetime,2016-07-01" in pushed
    assert "Or(LessThan(pickup_datetime,2016-01-23" in pushed


def test_hash_split_is_a_partition_of_the_rows(trips):
    train, test = split.hash_split(trips)
    assert sorted(ids(train) + ids(test)) == ids(trips)
    assert not set(ids(train)) & set(ids(test))


def test_hash_split_ignores_partitioning(trips):
    train, _ = split.hash_split(trips)
    again, _ = split.hash_split(trips.repartition(7))
    assert ids(train) == ids(again)


def test_salted_split_is_independent(trips):
    outer, _ = split.hash_split(trips)
    inner, _ = split.hash_split(outer, salt="inner")
    assert 0.55 < inner.count() / outer.count() < 0.77


def test_rows_without_a_key_land_on_one_side(make_trips):
    trips = make_trips([{"id": None}, {"id": None}, {"id": "x"}])
    train, test = split.hash_split(trips)
    assert train.count() + test.count() == 3


def test_random_split_covers_and_repeats(trips):
    train, test = split.random_split(trips)
    cover = split.split_cover(trips, [train, test]).head()
    assert cover["n_rows"] == cover["n_split"] == 1000 and cover["same_rows"]
    assert ids(train) == ids(split.random_split(trips)[0])


def test_cover_sees_a_missing_and_a_doubled_row(trips):
    train, test = split.hash_split(trips)
    one = ids(test)[0]
    broken = train.union(train.filter(F.col("id") == ids(train)[0]))
    cover = split.split_cover(trips, [broken, test.filter(F.col("id") != one)]).head()
    assert cover["n_split"] == 1000 and not cover["same_rows"]


def test_folds_are_even(trips):
    sizes = [r["count"] for r in split.with_fold(trips, 3).groupBy("fold").count().collect()]
    assert sum(sizes) == 1000 and min(sizes) > 270


@pytest.mark.parametrize("rules", [CleanRules(), CleanRules("2016-03-01", "2016-03-02")])
def test_rules_are_parameters(make_trips, rules):
    trips = make_trips([{"pickup_datetime": datetime(2016, 3, 1, 12)}])
    assert clean.clean(trips, rules).count() == (0 if rules.exclude_from == "2016-03-01" else 1)
