"""The trip table: its schema, the CSV reader/writer and the view over an events table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# The column names, order and types of a trip file.
TRIP_SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType(), True),
        T.StructField("vendor_id", T.IntegerType(), True),
        T.StructField("pickup_datetime", T.TimestampType(), True),
        T.StructField("dropoff_datetime", T.TimestampType(), True),
        T.StructField("passenger_count", T.IntegerType(), True),
        T.StructField("pickup_longitude", T.DoubleType(), True),
        T.StructField("pickup_latitude", T.DoubleType(), True),
        T.StructField("dropoff_longitude", T.DoubleType(), True),
        T.StructField("dropoff_latitude", T.DoubleType(), True),
        T.StructField("store_and_fwd_flag", T.StringType(), True),
        T.StructField("trip_duration", T.IntegerType(), True),
    ]
)

COORDINATES = ["pickup_longitude", "pickup_latitude", "dropoff_longitude", "dropoff_latitude"]
DATETIMES = ["pickup_datetime", "dropoff_datetime"]
INTEGERS = ["vendor_id", "passenger_count", "trip_duration"]


def read_trips_csv(spark: SparkSession, path: str) -> DataFrame:
    """Trips from CSV with a header row; fields that do not parse become null."""
    return spark.read.schema(TRIP_SCHEMA).option("header", True).option("delimiter", ",").csv(path)


def write_trips_csv(trips: DataFrame, path: str) -> None:
    """Trips to CSV in the layout read_trips_csv expects."""
    (
        trips.select(TRIP_SCHEMA.names)
        .write.mode("overwrite")
        .option("header", True)
        .option("timestampFormat", "yyyy-MM-dd HH:mm:ss")
        .csv(path)
    )


def trips_from_events(events: DataFrame, null_passengers_every: int | None = None) -> DataFrame:
    """Trip rows derived from events(event_id, ts, user_id, event_type, value), one per event.

    Keys are reduced before each multiplication, so ids far beyond 10^12 do not overflow.
    null_passengers_every=n leaves passenger_count null on every n-th event.
    """
    passengers = "cast(user_id % 7 as int)"
    if null_passengers_every:
        passengers = f"case when event_id % {int(null_passengers_every)} <> 0 then {passengers} end"
    # SQL text: one call each, where column objects would cost a call per operator
    pickup_x = "(event_id % 250000 * 7919) % 250000"
    pickup_y = "(user_id % 220000 * 104729 + event_id % 220000 * 31) % 220000"
    dropoff_x = f"{pickup_x} + (event_id % 40000 * 1299709) % 40000 - 20000"
    dropoff_y = f"{pickup_y} + (event_id % 60000 * 15485863) % 60000 - 30000"
    pickup = "unix_seconds(cast(ts as timestamp))"
    duration = "cast(floor(value * 15) as int)"
    return events.selectExpr(
        "concat('id', cast(event_id as string)) as id",
        "cast(user_id % 2 + 1 as int) as vendor_id",
        f"timestamp_seconds({pickup}) as pickup_datetime",
        f"timestamp_seconds({pickup} + {duration}) as dropoff_datetime",
        f"{passengers} as passenger_count",
        f"cast({pickup_x} - 74030000 as double) / 1000000 as pickup_longitude",
        f"cast({pickup_y} + 40630000 as double) / 1000000 as pickup_latitude",
        f"cast({dropoff_x} - 74030000 as double) / 1000000 as dropoff_longitude",
        f"cast({dropoff_y} + 40630000 as double) / 1000000 as dropoff_latitude",
        "case when event_type = 'error' then 'Y' else 'N' end as store_and_fwd_flag",
        f"{duration} as trip_duration",
    )
