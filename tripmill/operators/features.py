"""Feature encoding as a persistable chain of Spark ML stages.

The whole chain, derived columns included, is one Pipeline, so scoring loads what training
fitted and never refits an encoder on new data.
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame

from tripmill.functions.scalars import (
    LONG,
    SHORT,
    duration_class,
    seconds_of_day,
    shift_latitude,
    shift_longitude,
    weekday,
)

# The encoded columns in the order the feature vector holds them.
NUMERIC = [
    "vendor_id",
    "passenger_count",
    "pickup_longitude",
    "pickup_latitude",
    "dropoff_longitude",
    "dropoff_latitude",
    "pickup_datetime_time",
    "dropoff_datetime_time",
]
CATEGORICAL = ["store_and_fwd_flag", "pickup_datetime_weekday", "dropoff_datetime_weekday"]
CLASS_THRESHOLD = 1200


def split_datetime(df: DataFrame, column: str) -> DataFrame:
    """Replace a timestamp by <column>_time (seconds since midnight) and <column>_weekday."""
    return df.withColumns(
        {f"{column}_time": seconds_of_day(column), f"{column}_weekday": weekday(column)}
    ).drop(column)


def shift_coordinates(df: DataFrame) -> DataFrame:
    """Coordinates moved into the non-negative range."""
    return df.withColumns(
        {
            "pickup_longitude": shift_longitude("pickup_longitude"),
            "pickup_latitude": shift_latitude("pickup_latitude"),
            "dropoff_longitude": shift_longitude("dropoff_longitude"),
            "dropoff_latitude": shift_latitude("dropoff_latitude"),
        }
    )


def classify(df: DataFrame, threshold: float = CLASS_THRESHOLD) -> DataFrame:
    """Replace trip_duration by its class, 'short' or 'long'."""
    return df.withColumn("trip_duration", duration_class("trip_duration", threshold))


def string_indexer(columns: list[str], handle_invalid: str = "error") -> StringIndexer:
    """Index each column into <column>_num, last value in alphabetical order first."""
    return StringIndexer(
        inputCols=columns,
        outputCols=[f"{c}_num" for c in columns],
        stringOrderType="alphabetDesc",
        handleInvalid=handle_invalid,
    )


def one_hot(columns: list[str], handle_invalid: str = "error") -> OneHotEncoder:
    """Encode each <column>_num as the vector <column>_hot, without a slot for the last index."""
    return OneHotEncoder(
        inputCols=[f"{c}_num" for c in columns],
        outputCols=[f"{c}_hot" for c in columns],
        handleInvalid=handle_invalid,
    )


def _derive(threshold: float, shift: bool) -> SQLTransformer:
    """The row-wise columns as a stage, because only stages are saved with the model."""
    parts = ["id"]
    for c in NUMERIC:
        if c.endswith("_time"):
            ts = c.removesuffix("_time")
            seconds = f"hour({ts}) * 3600 + minute({ts}) * 60 + second({ts})"
            parts.append(f"cast({seconds} as double) {c}")
        elif shift and c.endswith("_longitude"):
            parts.append(f"{c} + 180D as {c}")
        elif shift and c.endswith("_latitude"):
            parts.append(f"{c} + 90D as {c}")
        else:
            parts.append(c)
    for c in CATEGORICAL:
        if c.endswith("_weekday"):
            parts.append(f"cast(dayofweek({c.removesuffix('_weekday')}) as string) {c}")
        else:
            parts.append(c)
    parts.append(
        f"case when trip_duration < {int(threshold)} then '{SHORT}' else '{LONG}' end trip_class"
    )
    return SQLTransformer(statement=f"select {', '.join(parts)} from __THIS__")


def feature_stages(
    threshold: float = CLASS_THRESHOLD,
    shift: bool = False,
    with_dropoff_time: bool = True,
    handle_invalid: str = "error",
) -> list:
    """Unfitted stages from clean trips to (id, features, label).

    shift: move coordinates into the non-negative range (Naive Bayes needs it).
    with_dropoff_time=False leaves out dropoff clock time and weekday, from which the duration
    can nearly be read off. handle_invalid="keep" gives unseen categories a slot of their own.
    """
    numeric = [c for c in NUMERIC if with_dropoff_time or c != "dropoff_datetime_time"]
    categorical = [c for c in CATEGORICAL if with_dropoff_time or c != "dropoff_datetime_weekday"]
    return [
        _derive(threshold, shift),
        string_indexer(categorical, handle_invalid),
        one_hot(categorical, handle_invalid),
        VectorAssembler(
            inputCols=numeric + [f"{c}_hot" for c in categorical], outputCol="features"
        ),
        SQLTransformer(
            statement=f"select id, features, case when trip_class = '{LONG}' "
            "then 1D else 0D end label from __THIS__"
        ),
    ]


def feature_pipeline(**options) -> Pipeline:
    """feature_stages as one estimator."""
    return Pipeline(stages=feature_stages(**options))
