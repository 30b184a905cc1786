from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tripmill-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def trips(spark):
    """The trip view over the smallest events table, kept for the session."""
    from tripmill.plans.queries import trips as view

    return view(spark, SF_DIR).persist()


@pytest.fixture(scope="session")
def make_trips(spark):
    """Trips from partial rows: missing columns get ordinary values."""
    from datetime import datetime, timedelta

    from tripmill.sources.trips import TRIP_SCHEMA

    def build(rows):
        full = []
        for i, given in enumerate(rows):
            pickup = given.get("pickup_datetime", datetime(2016, 3, 1 + i % 28, 12, 0, i % 60))
            seconds = given.get("trip_duration", 600)
            row = {
                "id": f"id{i}",
                "vendor_id": 1 + i % 2,
                "pickup_datetime": pickup,
                "dropoff_datetime": pickup + timedelta(seconds=seconds or 0) if pickup else None,
                "passenger_count": 1 + i % 4,
                "pickup_longitude": -73.98 + i % 7 / 100,
                "pickup_latitude": 40.75 + i % 5 / 100,
                "dropoff_longitude": -73.96 + i % 3 / 100,
                "dropoff_latitude": 40.76 + i % 11 / 100,
                "store_and_fwd_flag": "Y" if i % 3 == 0 else "N",
                "trip_duration": seconds,
            } | given
            full.append(tuple(row[f] for f in TRIP_SCHEMA.names))
        return spark.createDataFrame(full, TRIP_SCHEMA)

    return build
