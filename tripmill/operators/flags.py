"""The stored-and-forwarded flag as a number: as a projection, and as the self-join on the key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.functions.scalars import flag_to_int

FLAG = "store_and_fwd_flag"


def with_flag_int(trips: DataFrame) -> DataFrame:
    """Add store_and_fwd_flag_int without moving a row. The form to use when ids are unique."""
    return trips.withColumn("store_and_fwd_flag_int", flag_to_int(FLAG))


def flag_table(trips: DataFrame) -> DataFrame:
    """(id2, store_and_fwd_flag_int), each pair once."""
    return trips.select(
        F.col("id").alias("id2"), flag_to_int(FLAG).alias("store_and_fwd_flag_int")
    ).distinct()


def join_flags(trips: DataFrame) -> DataFrame:
    """Inner self-join of trips with their flag table on the id; keeps both key columns.

    The flag table holds each (id, flag) once, so a repeated id adds at most two rows per trip
    instead of all pairs of its copies. Both inputs arrive by plain shuffles on the id, which
    lets adaptive execution split a hot id or broadcast a small flag table at run time.
    """
    flags = flag_table(trips)
    return trips.join(flags, trips["id"] == flags["id2"], "inner")
