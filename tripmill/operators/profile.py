"""Profiling operators: frequencies, days, density cells, summaries, histograms, medians.

Every operator reads only the columns it needs, pre-aggregates map-side and returns a lazy
DataFrame. Totals and bounds enter as scalar subqueries, so no row ever meets a join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmill.functions.scalars import round_half_up

PREVIEW_ROWS = 20
HISTOGRAM_BINS = 40


def preview(df: DataFrame, rows: int = PREVIEW_ROWS) -> DataFrame:
    """The first rows of a frame, for looking at."""
    return df.limit(rows)


def frequency(df: DataFrame, column: str) -> DataFrame:
    """(tag, n) for each value of a column, ordered by value."""
    return df.groupBy(F.col(column).alias("tag")).agg(F.count("*").alias("n")).orderBy("tag")


def frequency_share(df: DataFrame, column: str) -> DataFrame:
    """(tag, n, pct): frequency with each value's percentage of all rows.

    The total is summed over the grouped rows, whose exchange both uses share.
    """
    counts = df.groupBy(F.col(column).alias("tag")).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("pct", F.col("n") * F.lit(100.0).cast("double") / total).orderBy("tag")


def smallest_cutoff(df: DataFrame, column: str, rows: int, spare: int = 50) -> Column:
    """The rows-th smallest different value of a column, as a scalar subquery.

    Each task keeps only its rows * spare smallest values. Null if fewer than `rows` different
    ones are among all of these, because the column has no more or repeats its first ones often.
    """
    taken = df.select(F.col(column).alias("tag")).filter("tag is not null").orderBy("tag")
    tags = taken.limit(rows * spare).agg(F.sort_array(F.collect_set("tag")).alias("tags"))
    return tags.select(F.get("tags", F.lit(rows - 1))).scalar()


def up_to(value: Column, cutoff: Column) -> Column:
    """Whether a value may be among the smallest: all may be where the cutoff is not known."""
    return cutoff.isNull() | value.isNull() | (value <= cutoff)


def frequency_preview(df: DataFrame, column: str, rows: int = PREVIEW_ROWS) -> DataFrame:
    """The first values of a column, in value order, with their counts.

    One scan finds how far the first values reach, a second counts those alone, so the other
    values of a column, mostly unique ones, are not shuffled.
    """
    tags = df.select(F.col(column).alias("tag"))
    tags = tags.withColumn("cut", smallest_cutoff(df, column, rows))
    return frequency(tags.filter(up_to(F.col("tag"), F.col("cut"))), "tag").limit(rows)


def trips_per_day(df: DataFrame, column: str) -> DataFrame:
    """(day, n) with day as yyyy-MM-dd text, ordered. Days are formatted after counting."""
    return _daily(df, column).orderBy("day")


def _daily(df: DataFrame, column: str) -> DataFrame:
    days = df.groupBy(F.to_date(column).alias("date")).agg(F.count("*").alias("n"))
    return days.select(F.date_format("date", "yyyy-MM-dd").alias("day"), "n")


def low_volume_days(df: DataFrame, column: str, fraction: float = 0.5) -> DataFrame:
    """(day, n, median_n): days with fewer trips than fraction times the median daily count."""
    daily = _daily(df, column)
    # the percentile's state holds one entry per distinct daily count, so at most one per day
    median = daily.agg(F.expr("percentile_disc(0.5) within group (order by n)")).scalar()
    return (
        daily.withColumn("median_n", median.cast("double"))
        .filter(F.col("n") < F.col("median_n") * F.lit(fraction))
        .orderBy("day")
    )


def density_grid(df: DataFrame, lat: str, lon: str, scale: float = 100.0) -> DataFrame:
    """(lat, lon, n) per grid cell, densest first; ties by position."""
    return _cells(df, lat, lon, scale).orderBy(F.desc("n"), "lat", "lon")


def top_cells(df: DataFrame, lat: str, lon: str, k: int, scale: float = 100.0) -> DataFrame:
    """The k densest grid cells. Each task keeps k rows, so there is no global sort."""
    return density_grid(df, lat, lon, scale).limit(k)


def _cells(df: DataFrame, lat: str, lon: str, scale: float) -> DataFrame:
    return df.groupBy(
        round_half_up(lat, scale).alias("lat"), round_half_up(lon, scale).alias("lon")
    ).agg(F.count("*").alias("n"))


def summary_measures(columns: Sequence[str]) -> list[Column]:
    """Aggregates (column, count, mean, stdev_pop, max, min), one struct per column."""
    return [
        F.struct(
            F.lit(c).alias("column"),
            F.count(c).alias("count"),
            F.avg(c).alias("mean"),
            F.stddev_pop(c).alias("stdev_pop"),
            F.max(c).cast("double").alias("max"),
            F.min(c).cast("double").alias("min"),
        )
        for c in columns
    ]


def numeric_summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, count, mean, stdev_pop, max, min) per column, all from one pass."""
    return df.agg(F.array(*summary_measures(columns)).alias("m")).selectExpr("inline(m)")


def usable(value: Column) -> Column:
    """Whether a value has a place in a histogram: not null, NaN or infinite."""
    # false for NaN as well, which Spark orders above infinity
    return value.isNotNull() & (F.abs(value) < F.lit(float("inf")))


def histogram_bounds(value: Column) -> Column:
    kept = F.when(usable(value), value)
    return F.struct(F.min(kept).alias("lo"), F.max(kept).alias("hi"))


def histogram_bucket(value: Column, lo: Column, hi: Column, bins: int) -> Column:
    """Half-open equal-width buckets, the last one closed; one bucket if all values are equal."""
    position = F.floor((value - lo) / (hi - lo) * F.lit(bins))
    return F.when(hi == lo, 0).otherwise(F.least(position, F.lit(bins - 1))).cast("int")


def _spread(counted: DataFrame, bins: int, *keys: str) -> DataFrame:
    """One row per bucket from rows of (keys, by_bucket: map of bucket to n, b: lo and hi).

    A map holds at most `bins` entries; buckets that it lacks come out with n = 0.
    """
    lo, hi, bucket = F.col("b.lo"), F.col("b.hi"), F.col("bucket")
    span, last = hi - lo, F.when(hi > lo, F.lit(bins - 1)).otherwise(F.lit(0))
    end = F.when(bucket == last, hi).otherwise(lo + (bucket + 1) * span / F.lit(bins))
    return (
        counted.filter(lo.isNotNull())
        .select("*", F.explode(F.sequence(F.lit(0), last)).alias("bucket"))
        .select(
            *keys,
            "bucket",
            (lo + bucket * span / F.lit(bins)).alias("lo"),
            end.alias("hi"),
            F.coalesce(F.try_element_at("by_bucket", bucket), F.lit(0)).alias("n"),
        )
        .select(
            *keys,
            "bucket",
            "lo",
            "hi",
            F.concat(F.lit("["), "lo", F.lit(", "), "hi", F.lit("]")).alias("label"),
            "n",
        )
    )


def _as_map() -> Column:
    return F.map_from_entries(F.collect_list(F.struct("bucket", "n"))).alias("by_bucket")


def histogram(
    df: DataFrame,
    column: str,
    bins: int = HISTOGRAM_BINS,
    clip: tuple[float, float] | None = None,
) -> DataFrame:
    """(bucket, lo, hi, label, n) in bucket order: equal-width histogram, empty buckets included.

    clip=(a, b) looks only at values from a to b. Nulls, NaN and infinities are skipped. One pass
    finds the bounds, a second counts; at most `bins` rows leave the counting.
    """
    values = df.select(F.col(column).cast("double").alias("x")).filter(usable(F.col("x")))
    if clip:
        values = values.filter(F.col("x").between(*[F.lit(float(v)) for v in clip]))
    bounds = values.agg(histogram_bounds(F.col("x"))).scalar()
    bucket = histogram_bucket(F.col("x"), F.col("b.lo"), F.col("b.hi"), bins)
    counts = (
        values.withColumn("b", bounds)
        .groupBy(bucket.alias("bucket"))
        .agg(F.count("*").alias("n"))
    )
    return _spread(counts.agg(_as_map()).withColumn("b", bounds), bins)


def histograms(df: DataFrame, columns: Sequence[str], bins: int = HISTOGRAM_BINS) -> DataFrame:
    """(column, bucket, lo, hi, label, n) for several columns from two passes over the rows,
    however many columns there are. Meant for sources that cannot read one column alone (CSV)."""
    values = df.select([F.col(c).cast("double").alias(c) for c in columns])
    bounds = values.agg(F.struct(*[histogram_bounds(F.col(c)).alias(c) for c in columns])).scalar()
    # each row adds 1 to one bucket per column, all collapsed map-side to columns x bins rows
    hits = [
        F.struct(
            F.lit(c).alias("column"),
            F.when(
                usable(F.col(c)), histogram_bucket(F.col(c), F.col(f"b.{c}.lo"), F.col(f"b.{c}.hi"), bins)
            ).alias("bucket"),
        )
        for c in columns
    ]
    counts = (
        values.withColumn("b", bounds)
        .select(F.inline(F.array(*hits)))
        .filter(F.col("bucket").isNotNull())
        .groupBy("column", "bucket")
        .agg(F.count("*").alias("n"))
    )
    limits = F.create_map(*[part for c in columns for part in (F.lit(c), bounds[c])])
    counted = counts.groupBy("column").agg(_as_map()).withColumn("b", limits[F.col("column")])
    return _spread(counted, bins, "column").orderBy("column", "bucket")


def approx_median(df: DataFrame, column: str, relative_error: float = 0.0001) -> float:
    """Approximate median of a numeric column, computed now (mergeable summaries per task)."""
    found = df.approxQuantile(column, [0.5], relative_error)
    if not found:
        raise ValueError(f"no rows with a {column} to take a median of")
    return found[0]


def approx_median_frame(df: DataFrame, column: str, accuracy: int = 10000) -> DataFrame:
    """(median): the lazy form of approx_median."""
    return df.agg(F.percentile_approx(column, 0.5, accuracy).cast("double").alias("median"))


def median_rank(df: DataFrame, column: str, accuracy: int = 10000) -> DataFrame:
    """(n, within): how many values there are, and whether approx_median_frame's value holds the
    middle rank within a relative error of 1 / accuracy."""
    median = approx_median_frame(df, column, accuracy).scalar()
    value = F.col("x")
    ranks = df.select(F.col(column).alias("x"), median.alias("m")).agg(
        F.count("x").alias("n"),
        F.count_if(value < F.col("m")).alias("below"),
        F.count_if(value <= F.col("m")).alias("upto"),
    )
    slack = F.col("n") / F.lit(accuracy) + 1
    middle = F.col("n") / 2
    within = (F.col("below") <= middle + slack) & (F.col("upto") >= middle - slack)
    return ranks.select("n", within.alias("within"))


def exact_median(df: DataFrame, column: str) -> DataFrame:
    """(median): the smallest value of an integer column with at least half of the rows at or
    below it.

    Values are counted per high half-word first and then, inside the half-word that holds the
    median, per value. Both running sums therefore see at most 65,536 rows of counts.
    """
    values = df.select(F.col(column).cast("int").alias("v")).filter(F.col("v").isNotNull())
    high = F.shiftright("v", 16)
    coarse = values.groupBy(high.alias("high")).agg(F.count("*").alias("n"))
    running = Window.orderBy("high").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    everything = Window.partitionBy()
    ranked = coarse.select(
        "high",
        (F.sum("n").over(running) - F.col("n")).alias("before"),
        F.sum("n").over(running).alias("upto"),
        F.sum("n").over(everything).alias("total"),
    )
    target = ranked.filter(
        (F.col("before") * 2 < F.col("total")) & (F.col("upto") * 2 >= F.col("total"))
    )
    pick = target.agg(F.first(F.struct("high", "before", "total"))).scalar()
    fine = values.filter(high == pick["high"]).groupBy("v").agg(F.count("*").alias("n"))
    running = Window.orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    reached = fine.withColumn("upto", F.sum("n").over(running) + pick["before"])
    return reached.filter(F.col("upto") * 2 >= pick["total"]).agg(F.min("v").alias("median"))
