"""The registered queries: each operator over the whole trip view of the events table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.functions.scalars import class_label, hash_bucket, seconds_of_day
from tripmill.operators import clean as cleaning
from tripmill.operators import bayes, correlation, flags, metrics, models, profile, split, trees
from tripmill.operators.features import (
    CATEGORICAL,
    CLASS_THRESHOLD,
    classify,
    feature_pipeline,
    one_hot,
    shift_coordinates,
    split_datetime,
    string_indexer,
)
from tripmill.plans.profiling import survey
from tripmill.plans.training import CHOICES, score, train
from tripmill.session import tune
from tripmill.sources import sinks
from tripmill.sources.scratch import scratch_dir
from tripmill.sources.trips import (
    COORDINATES,
    DATETIMES,
    INTEGERS,
    TRIP_SCHEMA,
    read_trips_csv,
    trips_from_events,
    write_trips_csv,
)

Query = Callable[[SparkSession, str], DataFrame]

# The cleaning rules that suit the days of the events table.
RULES = cleaning.CleanRules("2024-01-23", "2024-01-24", "2024-01-30")
CLIP = {"column": "dropoff_longitude", "lo": -73.95, "hi": -73.85}
TOP_CELLS = 10
LOW_VOLUME_FRACTION = 0.95
# two settings of each kind: the full grids are models.BAYES_GRID and models.FOREST_GRID
FOUR_FORESTS = {
    "maxBins": [10],
    "maxDepth": [3, 5],
    "numTrees": [3, 5],
    "minInfoGain": [0.0],
}

_QUERIES: dict[str, Query] = {}


def _register(fn: Query, name: str | None = None) -> Query:
    _QUERIES[name or fn.__name__] = fn
    return fn


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tune(spark).read.parquet(f"{sf_dir}/events.parquet")


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trips_from_events(_events(spark, sf_dir))


def trips_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips with missing passenger counts."""
    return trips_from_events(_events(spark, sf_dir), null_passengers_every=101)


def _r6(value: Column | str) -> Column:
    return F.round(value, 6)


def _printable(df: DataFrame) -> DataFrame:
    """Timestamps as text."""
    text = {
        c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in DATETIMES if c in df.columns
    }
    return df.withColumns(text)


# ---- sources and sinks ------------------------------------------------------------------------


@_register
def csv_scan_roundtrip(spark, sf_dir):
    path = scratch_dir(spark, "trips-csv")
    write_trips_csv(trips(spark, sf_dir), path)
    return _printable(read_trips_csv(spark, path)).select(TRIP_SCHEMA.names)


@_register
def series_sink(spark, sf_dir):
    base = scratch_dir(spark, "passengers")
    sinks.write_series(profile.frequency(trips(spark, sf_dir), "passenger_count"), base, "tag", "n")
    return sinks.read_series(spark, base, "tag int, n bigint")


@_register
def series_sink_lines(spark, sf_dir):
    """Values and Tags of a series read back by line number."""
    base = scratch_dir(spark, "durations")
    series = profile.frequency(trips(spark, sf_dir), "trip_duration")
    sinks.write_series(series, base, "tag", "n")
    values, tags = (sinks.read_lines(spark, base + part) for part in ("Values", "Tags"))
    return values.withColumnRenamed("text", "value").join(
        tags.withColumnRenamed("text", "tag"), "line", "full"
    )


@_register
def histogram_sink(spark, sf_dir):
    base = scratch_dir(spark, "histogram")
    sinks.write_histogram(profile.histogram(trips(spark, sf_dir), "pickup_longitude"), base)
    table = sinks.read_series(
        spark, base, "bucket int, lo double, hi double, label string, n bigint"
    )
    return table.select("bucket", _r6("lo").alias("lo"), _r6("hi").alias("hi"), "n")


@_register
def grid_sink(spark, sf_dir):
    path = scratch_dir(spark, "grid")
    sinks.write_grid(
        profile.density_grid(trips(spark, sf_dir), "pickup_latitude", "pickup_longitude"), path
    )
    return spark.read.schema("lat double, lon double, n bigint").csv(path)


@_register
def matrix_sink(spark, sf_dir):
    base = scratch_dir(spark, "matrix")
    sinks.write_matrix(
        correlation.correlation_matrix(flags.with_flag_int(trips(spark, sf_dir))), base
    )
    names = correlation.CORRELATED
    values = spark.read.schema(", ".join(f"{c} double" for c in names)).csv(base + "Values")
    return values.select([_r6(c).alias(c) for c in names])


# ---- profile ----------------------------------------------------------------------------------


@_register
def preview(spark, sf_dir):
    return _printable(profile.preview(trips(spark, sf_dir).orderBy("id")))


@_register
def freq_vendor(spark, sf_dir):
    return profile.frequency(trips(spark, sf_dir), "vendor_id")


@_register
def freq_passengers(spark, sf_dir):
    return profile.frequency(trips_raw(spark, sf_dir), "passenger_count")


@_register
def freq_duration(spark, sf_dir):
    return profile.frequency(trips(spark, sf_dir), "trip_duration")


@_register
def freq_flag_share(spark, sf_dir):
    shares = profile.frequency_share(trips(spark, sf_dir), "store_and_fwd_flag")
    return shares.withColumn("pct", _r6("pct"))


@_register
def freq_vendor_share(spark, sf_dir):
    shares = profile.frequency_share(trips(spark, sf_dir), "vendor_id")
    return shares.withColumn("pct", _r6("pct"))


@_register
def freq_id_preview(spark, sf_dir):
    return profile.frequency_preview(trips(spark, sf_dir), "id")


@_register
def trips_per_pickup_day(spark, sf_dir):
    return profile.trips_per_day(trips(spark, sf_dir), "pickup_datetime")


@_register
def trips_per_dropoff_day(spark, sf_dir):
    return profile.trips_per_day(trips(spark, sf_dir), "dropoff_datetime")


@_register
def clean_trips_per_day(spark, sf_dir):
    return profile.trips_per_day(cleaning.clean(trips(spark, sf_dir), RULES), "pickup_datetime")


@_register
def low_volume_days(spark, sf_dir):
    return profile.low_volume_days(trips(spark, sf_dir), "dropoff_datetime", LOW_VOLUME_FRACTION)


@_register
def grid_density_pickup(spark, sf_dir):
    return profile.density_grid(trips(spark, sf_dir), "pickup_latitude", "pickup_longitude")


@_register
def grid_density_dropoff(spark, sf_dir):
    return profile.density_grid(trips(spark, sf_dir), "dropoff_latitude", "dropoff_longitude")


@_register
def grid_topk(spark, sf_dir):
    return profile.top_cells(
        trips(spark, sf_dir), "pickup_latitude", "pickup_longitude", TOP_CELLS
    )


@_register
def numeric_summary(spark, sf_dir):
    summary = profile.numeric_summary(trips_raw(spark, sf_dir), INTEGERS + COORDINATES)
    return summary.withColumns({c: _r6(c) for c in ("mean", "stdev_pop", "max", "min")})


def _printed_histogram(h: DataFrame) -> DataFrame:
    """Edges rounded, and the label written from the rounded edges."""
    h = h.withColumns({"lo": _r6("lo"), "hi": _r6("hi")})
    return h.withColumn("label", F.concat(F.lit("["), "lo", F.lit(", "), "hi", F.lit("]")))


for _column in COORDINATES:
    _register(
        lambda spark, sf_dir, c=_column: _printed_histogram(
            profile.histogram(trips(spark, sf_dir), c)
        ),
        f"histogram_{_column}",
    )


@_register
def histogram_clipped(spark, sf_dir):
    return _printed_histogram(
        profile.histogram(
            trips(spark, sf_dir), CLIP["column"], clip=(CLIP["lo"], CLIP["hi"])
        )
    )


@_register
def histogram_all_coordinates(spark, sf_dir):
    return _printed_histogram(profile.histograms(trips(spark, sf_dir), COORDINATES))


@_register
def flag_self_join(spark, sf_dir):
    joined = flags.join_flags(trips(spark, sf_dir))
    return joined.select("id", "id2", "store_and_fwd_flag", "store_and_fwd_flag_int")


@_register
def flag_column(spark, sf_dir):
    flagged = flags.with_flag_int(trips(spark, sf_dir))
    return flagged.select("id", "store_and_fwd_flag", "store_and_fwd_flag_int")


@_register
def corr_pair(spark, sf_dir):
    pair = correlation.pearson(trips_raw(spark, sf_dir), "passenger_count", "pickup_latitude")
    return pair.select(_r6("corr").alias("corr"))


@_register
def corr_matrix(spark, sf_dir):
    pairs = correlation.correlation_pairs(flags.with_flag_int(trips_raw(spark, sf_dir)))
    return pairs.withColumn("corr", _r6("corr"))


@_register
def corr_heatmap(spark, sf_dir):
    matrix = correlation.correlation_matrix(flags.with_flag_int(trips(spark, sf_dir)))
    return matrix.withColumns({c: _r6(c) for c in correlation.CORRELATED})


@_register
def profile_report(spark, sf_dir):
    rows = survey(trips_raw(spark, sf_dir)).rows()
    # sums in another order move a mean of 6-digit coordinates across an edge of six digits
    value = F.when(F.col("measure") == "mean", F.round("value", 5)).otherwise(_r6("value"))
    return rows.withColumn("value", value)


# ---- cleaning, classes, splits ----------------------------------------------------------------


@_register
def clean_rows(spark, sf_dir):
    return _printable(cleaning.clean(trips_raw(spark, sf_dir), RULES))


@_register
def clean_loss_rate(spark, sf_dir):
    loss = cleaning.clean_loss(trips_raw(spark, sf_dir), RULES)
    return loss.withColumn("loss_rate", _r6("loss_rate"))


@_register
def clean_test_loss_rate(spark, sf_dir):
    loss = cleaning.clean_split(*split.hash_split(trips_raw(spark, sf_dir)), RULES)[2]
    return loss.withColumn("loss_rate", _r6("loss_rate"))


@_register
def duration_class(spark, sf_dir):
    return classify(trips(spark, sf_dir)).select("id", "trip_duration")


@_register
def duration_median_exact(spark, sf_dir):
    return profile.exact_median(trips(spark, sf_dir), "trip_duration")


@_register
def duration_median_approx(spark, sf_dir):
    return profile.median_rank(trips(spark, sf_dir), "trip_duration")


@_register
def split_datetimes(spark, sf_dir):
    parts = split_datetime(
        split_datetime(trips(spark, sf_dir), "pickup_datetime"), "dropoff_datetime"
    )
    return parts.select(
        "id",
        "pickup_datetime_time",
        "pickup_datetime_weekday",
        "dropoff_datetime_time",
        "dropoff_datetime_weekday",
    )


@_register
def shifted_coordinates(spark, sf_dir):
    shifted = shift_coordinates(trips(spark, sf_dir))
    return shifted.select("id", *[_r6(c).alias(c) for c in COORDINATES])


@_register
def hash_split_counts(spark, sf_dir):
    side = F.when(hash_bucket("id", 100) < split.TRAIN_PERCENT, "train").otherwise("test")
    return trips(spark, sf_dir).groupBy(side.alias("side")).agg(F.count("*").alias("n"))


@_register
def inner_split_counts(spark, sf_dir):
    outer, _ = split.hash_split(trips(spark, sf_dir))
    side = F.when(hash_bucket("id", 100, "inner") < split.TRAIN_PERCENT, "fit").otherwise("valid")
    return outer.groupBy(side.alias("side")).agg(F.count("*").alias("n"))


@_register
def fold_counts(spark, sf_dir):
    folded = split.with_fold(trips(spark, sf_dir), models.FOLDS)
    return folded.groupBy("fold").agg(F.count("*").alias("n"))


@_register
def hash_split_rows(spark, sf_dir):
    train_side, test_side = split.hash_split(trips(spark, sf_dir))
    return train_side.select("id", F.lit("train").alias("side")).union(
        test_side.select("id", F.lit("test").alias("side"))
    )


@_register
def random_split_cover(spark, sf_dir):
    whole = trips(spark, sf_dir)
    return split.split_cover(whole, list(split.random_split(whole)))


# ---- features ---------------------------------------------------------------------------------


def _categories(spark, sf_dir) -> DataFrame:
    parts = split_datetime(trips(spark, sf_dir), "pickup_datetime")
    return split_datetime(parts, "dropoff_datetime").select("id", *CATEGORICAL)


@_register
def string_index(spark, sf_dir):
    rows = _categories(spark, sf_dir)
    indexed = string_indexer(CATEGORICAL).fit(rows).transform(rows)
    return indexed.select("id", *[f"{c}_num" for c in CATEGORICAL])


@_register
def label_index(spark, sf_dir):
    rows = classify(trips(spark, sf_dir)).select("id", "trip_duration")
    indexed = string_indexer(["trip_duration"]).fit(rows).transform(rows)
    return indexed.select(
        "id", F.col("trip_duration_num").alias("fitted"), class_label("trip_duration").alias("fixed")
    )


@_register
def one_hot_vectors(spark, sf_dir):
    rows = _categories(spark, sf_dir)
    stages = [string_indexer(CATEGORICAL), one_hot(CATEGORICAL)]
    encoded = Pipeline(stages=stages).fit(rows).transform(rows)
    arrays = {c: vector_to_array(f"{c}_hot") for c in CATEGORICAL}
    slots = {"store_and_fwd_flag": 1, "pickup_datetime_weekday": 6, "dropoff_datetime_weekday": 6}
    return encoded.select(
        "id", *[arrays[c][i].alias(f"{c}_{i}") for c in CATEGORICAL for i in range(slots[c])]
    )


def _encoded(spark, sf_dir, **options) -> DataFrame:
    rows = cleaning.clean(trips_raw(spark, sf_dir), RULES)
    return feature_pipeline(**options).fit(rows).transform(rows)


@_register
def feature_vector(spark, sf_dir):
    encoded = _encoded(spark, sf_dir)
    slots = vector_to_array("features")
    return encoded.select("id", "label", *[_r6(slots[i]).alias(f"f{i}") for i in range(21)])


@_register
def feature_vector_shifted(spark, sf_dir):
    encoded = _encoded(spark, sf_dir, shift=True)
    slots = vector_to_array("features")
    return encoded.select("id", "label", *[_r6(slots[i]).alias(f"f{i}") for i in range(21)])


# ---- metrics over a fixed rule's predictions --------------------------------------------------


def rule_predictions(spark, sf_dir) -> DataFrame:
    """label from the duration; prediction from the clock hands; a score of many values."""
    pickup, dropoff = F.col("pickup_datetime"), F.col("dropoff_datetime")
    coarse = (F.hour(dropoff) - F.hour(pickup)) * 3600 + (
        F.minute(dropoff) - F.minute(pickup)
    ) * 60
    fine = seconds_of_day(dropoff) - seconds_of_day(pickup) + F.col("passenger_count") * 100
    return classify(trips(spark, sf_dir), CLASS_THRESHOLD).select(
        class_label("trip_duration").alias("label"),
        F.when(coarse >= 1080, 1.0).otherwise(0.0).alias("prediction"),
        (fine / F.lit(7200.0)).alias("score"),
    )


@_register
def error_rate(spark, sf_dir):
    errors = metrics.error_rate(rule_predictions(spark, sf_dir))
    return errors.withColumn("error_rate", _r6("error_rate"))


@_register
def confusion_matrix(spark, sf_dir):
    return metrics.confusion_matrix(rule_predictions(spark, sf_dir))


@_register
def weighted_metrics(spark, sf_dir):
    report = metrics.metric_report(rule_predictions(spark, sf_dir))
    return report.withColumn("value", _r6("value"))


@_register
def swapped_metrics(spark, sf_dir):
    report = metrics.metric_report(rule_predictions(spark, sf_dir), swap=True)
    return report.withColumn("value", _r6("value"))


@_register
def roc_curve(spark, sf_dir):
    curve = metrics.roc_curve(rule_predictions(spark, sf_dir))
    return curve.select("point", _r6("fpr").alias("fpr"), _r6("tpr").alias("tpr"))


@_register
def pr_curve(spark, sf_dir):
    curve = metrics.pr_curve(rule_predictions(spark, sf_dir))
    return curve.select("point", _r6("recall").alias("recall"), _r6("precision").alias("precision"))


@_register
def auc_roc(spark, sf_dir):
    area = metrics.auc_roc(rule_predictions(spark, sf_dir))
    return area.select(_r6("auc_roc").alias("auc_roc"))


@_register
def auc_pr(spark, sf_dir):
    area = metrics.auc_pr(rule_predictions(spark, sf_dir))
    return area.select(_r6("auc_pr").alias("auc_pr"))


@_register
def score_roc_curve(spark, sf_dir):
    curve = metrics.roc_curve(rule_predictions(spark, sf_dir), "score")
    return curve.select("point", _r6("fpr").alias("fpr"), _r6("tpr").alias("tpr"))


@_register
def score_auc(spark, sf_dir):
    both = metrics.areas(rule_predictions(spark, sf_dir), "score")
    rows = [F.struct(F.lit(c).alias("metric"), _r6(c).alias("value")) for c in both.columns]
    return both.select(F.inline(F.array(*rows)))


# ---- models -----------------------------------------------------------------------------------


@_register
def dt_grid(spark, sf_dir):
    compared = models.compare_trees(_encoded(spark, sf_dir))
    return compared.withColumn("error_rate", _r6("error_rate"))


def _trained(spark, sf_dir, kind: str, **options):
    return train(
        trips_raw(spark, sf_dir), kind, RULES, CLASS_THRESHOLD, params=CHOICES[kind], **options
    )


@_register
def dt_score(spark, sf_dir):
    return _trained(spark, sf_dir, "dt").confusion


@_register
def dt_score_without_dropoff_time(spark, sf_dir):
    return _trained(spark, sf_dir, "dt", with_dropoff_time=False).confusion


@_register
def nb_model(spark, sf_dir):
    fitted = models.naive_bayes(**models.BAYES_CHOICE).fit(_encoded(spark, sf_dir, shift=True))
    return models.bayes_parameters(spark, fitted).withColumns(
        {"theta": _r6("theta"), "pi": _r6("pi")}
    )


@_register
def nb_score(spark, sf_dir):
    return train(trips_raw(spark, sf_dir), "nb", RULES, params=CHOICES["nb"]).confusion


@_register
def nb_cv(spark, sf_dir):
    tuning = train(trips_raw(spark, sf_dir), "nb", RULES).tuning
    return tuning.withColumns({"avg_auc": _r6("avg_auc"), "std_auc": _r6("std_auc")})


@_register
def nb_cv_folds(spark, sf_dir):
    learned = split.hash_split(cleaning.clean(trips_raw(spark, sf_dir), RULES))[0]
    encoded = feature_pipeline(shift=True).fit(learned).transform(learned)
    with models.cached(split.with_fold(encoded, models.FOLDS)) as kept:
        folds = bayes.tune_bayes(kept, models.BAYES_GRID)[1]
    return folds.withColumn("auc", _r6("auc"))


@_register
def rf_model(spark, sf_dir):
    weights = models.feature_importance(spark, _trained(spark, sf_dir, "rf").model)
    return weights.withColumn("importance", _r6("importance"))


@_register
def rf_score(spark, sf_dir):
    return _trained(spark, sf_dir, "rf").confusion


@_register
def rf_cv_four_settings(spark, sf_dir):
    return train(trips_raw(spark, sf_dir), "rf", RULES, grid=FOUR_FORESTS).tuning


@_register
def model_rules(spark, sf_dir):
    nodes = trees.node_table(spark, _trained(spark, sf_dir, "dt").model)
    return nodes.withColumns({"threshold": _r6("threshold"), "gain": F.round("gain", 9)})


@_register
def save_load_score(spark, sf_dir):
    return _saved_and_scored(spark, sf_dir, "dt")


@_register
def save_load_score_nb(spark, sf_dir):
    return _saved_and_scored(spark, sf_dir, "nb")


@_register
def save_load_score_rf(spark, sf_dir):
    return _saved_and_scored(spark, sf_dir, "rf")


def _saved_and_scored(spark, sf_dir, kind: str) -> DataFrame:
    """Train, store, load and score the whole file as if it were a new one."""
    path = scratch_dir(spark, "model")
    sinks.save_model(_trained(spark, sf_dir, kind).model, path)
    return score(trips_raw(spark, sf_dir), path, RULES).confusion
