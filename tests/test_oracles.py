"""Every query with SQL text against DuckDB; the others for their shape."""

from __future__ import annotations

import compare
import pytest
from conftest import SF_DIR

from __spark_entry__ import entry, oracle_sql, queries


@pytest.fixture(scope="module")
def con():
    return compare.connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_same_as_sql(spark, con, name):
    assert compare.differences(con, queries()[name](spark, SF_DIR), oracle_sql()[name]) == []


def test_every_oracle_has_its_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry_has_one_row_per_kept_day(spark):
    days = [r["day"] for r in entry(spark).collect()]
    assert days == sorted(days) and "2024-01-23" not in days and max(days) < "2024-01-30"


def test_results_do_not_depend_on_the_session_time_zone(spark, con):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        for name in ("clean_rows", "split_datetimes", "trips_per_dropoff_day"):
            df = queries()[name](spark, SF_DIR)
            assert compare.differences(con, df, oracle_sql()[name]) == []
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


@pytest.mark.parametrize(
    "name, columns, rows",
    [
        ("rf_model", ["feature", "importance"], 21),
        ("rf_cv_four_settings", ["params", "avg_auc", "std_auc", "chosen"], 4),
    ],
)
def test_model_queries_have_their_shape(spark, name, columns, rows):
    df = queries()[name](spark, SF_DIR)
    assert df.columns == columns
    assert len(df.collect()) == rows


# Fixed values: (events, kept by date, short at 1200, exact median, flag Y, vendor 1, train side,
# pickup cells) known for the smallest table.
ANCHORS = (1000, 935, 787, 534, 201, 562, 643, 430)


def test_known_counts(trips):
    from tripmill.operators import clean, features, profile, split
    from tripmill.plans.queries import RULES

    classes = features.classify(trips)
    got = (
        trips.count(),
        clean.clean(trips, RULES).count(),
        classes.filter("trip_duration = 'short'").count(),
        profile.exact_median(trips, "trip_duration").head()[0],
        trips.filter("store_and_fwd_flag = 'Y'").count(),
        trips.filter("vendor_id = 1").count(),
        split.hash_split(trips)[0].count(),
        profile.density_grid(trips, "pickup_latitude", "pickup_longitude").count(),
    )
    assert got == ANCHORS
