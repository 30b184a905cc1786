"""Column expressions over trip columns. All are built-in functions, so they stay in codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SHORT, LONG = "short", "long"


def seconds_of_day(ts: Column | str) -> Column:
    """Seconds since midnight of a timestamp, as double."""
    return (F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)).cast("double")


def weekday(ts: Column | str) -> Column:
    """Day of week as text, '1' for Sunday to '7' for Saturday."""
    return F.dayofweek(ts).cast("string")


def duration_class(duration: Column | str, threshold: float) -> Column:
    """'short' below the threshold, otherwise 'long' (equality and null are long)."""
    duration = F.col(duration) if isinstance(duration, str) else duration
    return F.when(duration < F.lit(int(threshold)), SHORT).otherwise(LONG)


def class_label(cls: Column | str) -> Column:
    """0.0 for 'short', 1.0 for 'long'."""
    cls = F.col(cls) if isinstance(cls, str) else cls
    return F.when(cls == LONG, 1.0).otherwise(0.0)


def flag_to_int(flag: Column | str) -> Column:
    """1 for 'Y', 0 for anything else, null included."""
    flag = F.col(flag) if isinstance(flag, str) else flag
    return F.when(flag == "Y", 1).otherwise(0)


def round_half_up(value: Column | str, scale: float = 100.0) -> Column:
    """Round to 1/scale with halves toward +infinity (F.round sends halves away from zero)."""
    value = F.col(value) if isinstance(value, str) else value
    return F.floor(value * F.lit(scale) + F.lit(0.5)).cast("double") / F.lit(scale)


def shift_longitude(lon: Column | str) -> Column:
    """Longitude moved to 0..360, for models that need non-negative inputs."""
    return (F.col(lon) if isinstance(lon, str) else lon) + F.lit(180.0)


def shift_latitude(lat: Column | str) -> Column:
    """Latitude moved to 0..180."""
    return (F.col(lat) if isinstance(lat, str) else lat) + F.lit(90.0)


def hash_bucket(key: Column | str, buckets: int, salt: str = "") -> Column:
    """Bucket 0..buckets-1 from the md5 of a row key; independent of partitioning and retries."""
    key = F.col(key) if isinstance(key, str) else key
    text = F.concat(F.lit(salt), F.coalesce(key.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") % F.lit(buckets)
