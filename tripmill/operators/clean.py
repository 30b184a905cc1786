"""Row cleaning: drop incomplete rows and rows on excluded dates, and account for the loss."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class CleanRules:
    """A day to leave out (both of its midnights included) and the first instant after the data.

    Fixed values: the defaults are the snow-storm day and the end of the known trip file.
    """

    exclude_from: str = "2016-01-23"
    exclude_to: str = "2016-01-24"
    cutoff: str = "2016-07-01"


def is_complete(df: DataFrame) -> Column:
    """True where no column is null and no floating-point column is NaN, as na.drop keeps."""
    checks = [f"`{f.name}` is not null" for f in df.schema.fields]
    checks += [
        f"not isnan(`{f.name}`)"
        for f in df.schema.fields
        if isinstance(f.dataType, (T.DoubleType, T.FloatType))
    ]
    return F.expr(" and ".join(checks))


def in_dates(rules: CleanRules) -> Column:
    """True where pickup and dropoff avoid the excluded day and dropoff precedes the cutoff."""
    lo, hi, end = (
        f"timestamp'{t}'" for t in (rules.exclude_from, rules.exclude_to, rules.cutoff)
    )
    return F.expr(
        f"(pickup_datetime < {lo} or pickup_datetime > {hi})"
        f" and (dropoff_datetime < {lo} or dropoff_datetime > {hi})"
        f" and dropoff_datetime < {end}"
    )


def drop_incomplete(df: DataFrame) -> DataFrame:
    """Rows without a null or NaN."""
    return df.na.drop()


def clean(trips: DataFrame, rules: CleanRules = CleanRules()) -> DataFrame:
    """Complete trips on allowed dates."""
    return drop_incomplete(trips).filter(in_dates(rules))


def clean_loss(trips: DataFrame, rules: CleanRules = CleanRules()) -> DataFrame:
    """(n_total, n_null, n_outlier, loss_rate) of cleaning, from one pass."""
    complete = is_complete(trips)
    return trips.agg(
        F.count("*").alias("n_total"),
        F.count_if(~complete).alias("n_null"),
        F.count_if(complete & ~in_dates(rules)).alias("n_outlier"),
    ).withColumn(
        "loss_rate",
        F.try_divide(
            (F.col("n_null") + F.col("n_outlier")).cast("double"), F.col("n_total").cast("double")
        ),
    )


def clean_split(
    train: DataFrame, test: DataFrame, rules: CleanRules = CleanRules()
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Both sides cleaned, and the loss of the test side."""
    return clean(train, rules), clean(test, rules), clean_loss(test, rules)
