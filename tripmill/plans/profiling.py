"""The profile job: every report over a trip table, lazily one by one, or all from three scans."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.operators.correlation import CORRELATED, coefficient_measures, correlation_matrix
from tripmill.operators.flags import with_flag_int
from tripmill.operators.profile import (
    HISTOGRAM_BINS,
    PREVIEW_ROWS,
    density_grid,
    frequency,
    frequency_preview,
    frequency_share,
    histogram,
    histogram_bounds,
    histogram_bucket,
    numeric_summary,
    smallest_cutoff,
    summary_measures,
    trips_per_day,
    up_to,
    usable,
)
from tripmill.sources.scratch import scratch_dir
from tripmill.sources.sinks import (
    write_grid,
    write_histogram,
    write_matrix,
    write_series,
    write_table,
)
from tripmill.sources.trips import COORDINATES, DATETIMES, INTEGERS

FLAG = "store_and_fwd_flag"
GRIDS = {"pickup_grid": "pickup", "dropoff_grid": "dropoff"}
#: Reports that count keys, by the number that stands for them in the counts.
COUNTED = [*INTEGERS, *DATETIMES, *COORDINATES, FLAG, "id", *GRIDS]
MEASURES = ("count", "mean", "stdev_pop", "max", "min")
SCALE = 100.0


def profile(trips: DataFrame) -> dict[str, DataFrame]:
    """One report per attribute, none of them computed yet; each scans the table by itself."""
    reports = {"summary": numeric_summary(trips, INTEGERS + COORDINATES)}
    reports["id"] = frequency_preview(trips, "id")
    for c in INTEGERS:
        reports[c] = frequency(trips, c)
    for c in DATETIMES:
        reports[c] = trips_per_day(trips, c)
    for c in COORDINATES:
        reports[c] = histogram(trips, c)
    reports[FLAG] = frequency_share(trips, FLAG)
    for name, end in GRIDS.items():
        reports[name] = density_grid(trips, f"{end}_latitude", f"{end}_longitude")
    reports["correlation"] = correlation_report(trips)
    return reports


def correlation_report(trips: DataFrame) -> DataFrame:
    """The correlation matrix of the numeric attributes and the flag."""
    return correlation_matrix(with_flag_int(trips))


@dataclass
class Survey:
    """What three scans of a trip table give.

    n_rows, the summary, the bounds of coordinates with usable values, and the correlations are a
    few dozen numbers. counts (kind, a, b, s, n) is a table in the scratch folder with a row per
    value, day, bucket, cell, flag and first id; kind is the position in COUNTED. a holds
    numbers, days since 1970, buckets and cell rows, b cell columns, s texts.
    """

    n_rows: int
    summary: list[tuple]
    bounds: dict[str, tuple[float, float]]
    correlations: dict[tuple[str, str], float | None]
    counts: DataFrame

    @property
    def spark(self) -> SparkSession:
        return self.counts.sparkSession

    def counted(self, report: str) -> DataFrame:
        return self.counts.filter(F.col("kind") == COUNTED.index(report))

    def frequency(self, column: str) -> DataFrame:
        """(tag, n) of an integer column."""
        return self.counted(column).select(F.col("a").cast("int").alias("tag"), "n").orderBy("tag")

    def per_day(self, column: str) -> DataFrame:
        """(day, n)."""
        return self.counted(column).select(_day().alias("day"), "n").orderBy("day")

    def share(self) -> DataFrame:
        """(tag, n, pct) of the flag."""
        pct = F.col("n") * F.lit(100.0) / F.lit(float(self.n_rows))
        return self.counted(FLAG).select(F.col("s").alias("tag"), "n", pct.alias("pct")).orderBy("tag")

    def first_ids(self) -> DataFrame:
        """(tag, n) of the smallest ids."""
        return self.counted("id").select(F.col("s").alias("tag"), "n").orderBy("tag").limit(PREVIEW_ROWS)

    def grid(self, name: str) -> DataFrame:
        """(lat, lon, n) of a density grid, densest first."""
        cells = self.counted(name).select(_cell("a").alias("lat"), _cell("b").alias("lon"), "n")
        return cells.orderBy(F.desc("n"), "lat", "lon")

    def edges(self, column: str) -> list[tuple[int, float, float]]:
        """(bucket, lo, hi) of a coordinate's histogram; none without usable values."""
        if column not in self.bounds:
            return []
        lo, hi = self.bounds[column]
        last = HISTOGRAM_BINS - 1 if hi > lo else 0
        at = [lo + b * (hi - lo) / HISTOGRAM_BINS for b in range(last + 1)]
        return [(b, x, hi if b == last else at[b + 1]) for b, x in enumerate(at)]

    def histogram(self, column: str) -> DataFrame:
        """(bucket, lo, hi, label, n)."""
        edges = self.spark.createDataFrame(self.edges(column), "bucket int, lo double, hi double")
        counts = self.counted(column).select(F.col("a").cast("int").alias("bucket"), "n")
        label = F.concat(F.lit("["), "lo", F.lit(", "), "hi", F.lit("]"))
        joined = counts.join(F.broadcast(edges), "bucket")  # a row per bucket
        return joined.select("bucket", "lo", "hi", label.alias("label"), "n").orderBy("bucket")

    def summary_frame(self) -> DataFrame:
        schema = "column string, count bigint, mean double, stdev_pop double, max double, min double"
        return self.spark.createDataFrame(self.summary, schema)

    def matrix(self) -> DataFrame:
        """The correlation matrix, as correlation_report gives it."""
        rows = [
            (i + 1, a, *[self.correlations[a, b] for b in CORRELATED]) for i, a in enumerate(CORRELATED)
        ]
        cells = ", ".join(f"{c} double" for c in CORRELATED)
        return self.spark.createDataFrame(rows, f"position int, row string, {cells}")

    def rows(self) -> DataFrame:
        """(report, item, measure, value): every figure of the profile."""
        figures = [
            ("summary", r[0], m, None if v is None else float(v))
            for r in self.summary
            for m, v in zip(MEASURES, r[1:])
        ]
        figures += [("correlation", f"{a},{b}", "corr", r) for (a, b), r in self.correlations.items()]
        for c in COORDINATES:
            for bucket, lo, hi in self.edges(c):
                figures += [(c, str(bucket), "lo", lo), (c, str(bucket), "hi", hi)]
        small = self.spark.createDataFrame(figures, "report string, item string, measure string, value double")

        kind = F.col("kind")

        def one_of(names) -> Column:
            return kind.isin([COUNTED.index(n) for n in names])

        item = (
            F.when(one_of(DATETIMES), _day())
            .when(one_of(GRIDS), F.concat_ws(",", _cell("a"), _cell("b")))
            .when(one_of([FLAG, "id"]), F.col("s"))
            .otherwise(F.col("a").cast("string"))
        )
        pct = F.col("n") * F.lit(100.0) / F.lit(float(max(1, self.n_rows)))
        named = F.array(*map(F.lit, COUNTED))
        ids = self.first_ids().select(
            F.lit("id").alias("report"),
            F.col("tag").alias("item"),
            F.lit("n").alias("measure"),
            F.col("n").cast("double").alias("value"),
        )
        counted = self.counts.filter(~one_of(["id"])).select(
            F.get(named, kind).alias("report"),
            item.alias("item"),
            F.explode(
                F.array_compact(
                    F.array(
                        F.struct(F.lit("n").alias("measure"), F.col("n").cast("double").alias("value")),
                        F.when(one_of([FLAG]), F.struct(F.lit("pct").alias("measure"), pct.alias("value"))),
                    )
                )
            ).alias("m"),
        )
        return small.unionByName(counted.select("report", "item", "m.*")).unionByName(ids)


def _day() -> Column:
    return F.date_format(F.date_from_unix_date(F.col("a").cast("int")), "yyyy-MM-dd")


def _cell(name: str) -> Column:
    return F.col(name).cast("double") / F.lit(SCALE)


def survey(trips: DataFrame) -> Survey:
    """Everything that the profile reports, from three scans however many reports there are.

    The first takes all aggregates without a key: summary, bounds, correlations. The second finds
    how far the first ids reach, each task keeping a bounded number. The third counts all keys at
    once: every row gives its values, days, buckets and cells, which are collapsed map-side; they
    are written to the scratch folder, from where all reports read them.
    """
    flagged = with_flag_int(trips)
    shifted = [f"cast(`{c}` as double) as x{i}" for i, c in enumerate(CORRELATED)]
    measured = INTEGERS + COORDINATES
    values = flagged.selectExpr(*measured, *shifted)
    found = values.agg(
        F.count("*").alias("n_rows"),
        F.array(*summary_measures(measured)).alias("summary"),
        *[histogram_bounds(F.col(c)).alias(f"bounds_{c}") for c in COORDINATES],
        *map(F.expr, coefficient_measures(len(CORRELATED))),
    ).first()
    bounds = {
        c: (found[f"bounds_{c}"]["lo"], found[f"bounds_{c}"]["hi"])
        for c in COORDINATES
        if found[f"bounds_{c}"]["lo"] is not None
    }
    correlations = {
        (a, b): found[f"r{min(i, j)}_{max(i, j)}"]
        for i, a in enumerate(CORRELATED)
        for j, b in enumerate(CORRELATED)
    }
    summary = [tuple(r) for r in found["summary"]]
    spark, path = trips.sparkSession, scratch_dir(trips.sparkSession, "profile")
    counts = _key_counts(trips, bounds)
    counts.write.parquet(path)
    counts = spark.read.schema(counts.schema).parquet(path)
    return Survey(found["n_rows"], summary, bounds, correlations, counts)


def _key_counts(trips: DataFrame, bounds: dict[str, tuple[float, float]]) -> DataFrame:
    """counts of a Survey: one exploded aggregation; buckets without a row come out with n = 0."""
    kind = {name: F.lit(i).alias("kind") for i, name in enumerate(COUNTED)}

    def key(name: str, a: Column | None = None, b: Column | None = None, s: Column | None = None):
        whole, text = F.lit(None).cast("bigint"), F.lit(None).cast("string")
        a = whole if a is None else a.cast("bigint")
        b = whole if b is None else b.cast("bigint")
        return F.struct(kind[name], a.alias("a"), b.alias("b"), (text if s is None else s).alias("s"))

    def cell(column: str) -> Column:
        return F.floor(F.col(column) * F.lit(SCALE) + F.lit(0.5))

    keys = [key(c, F.col(c)) for c in INTEGERS]
    keys += [key(c, F.unix_date(F.to_date(c))) for c in DATETIMES]
    for c, (lo, hi) in bounds.items():
        bucket = histogram_bucket(F.col(c), F.lit(lo), F.lit(hi), HISTOGRAM_BINS)
        keys.append(F.when(usable(F.col(c)), key(c, bucket)))
    keys.append(key(FLAG, s=F.col(FLAG)))
    keys.append(F.when(up_to(F.col("id"), F.col("cut")), key("id", s=F.col("id"))))
    keys += [key(name, cell(f"{end}_latitude"), cell(f"{end}_longitude")) for name, end in GRIDS.items()]
    cut = smallest_cutoff(trips, "id", PREVIEW_ROWS)
    ones = trips.withColumn("cut", cut).select(F.inline(F.array_compact(F.array(*keys))))
    buckets = [
        (COUNTED.index(c), b)
        for c, (lo, hi) in bounds.items()
        for b in range(HISTOGRAM_BINS if hi > lo else 1)
    ]
    none = trips.sparkSession.createDataFrame(buckets, "kind int, a bigint").selectExpr(
        "kind", "a", "cast(null as bigint) as b", "cast(null as string) as s", "0L as n"
    )
    every = ones.withColumn("n", F.lit(1).cast("bigint")).unionByName(none)
    return every.groupBy("kind", "a", "b", "s").agg(F.sum("n").alias("n"))


def write_profile(trips: DataFrame, folder: str) -> None:
    """Write every report as text under a folder, one base name per attribute; three scans."""
    found = survey(trips)
    write_table(found.summary_frame(), f"{folder}/summary")
    for c in INTEGERS:
        write_series(found.frequency(c), f"{folder}/{c}", "tag", "n")
    write_series(found.first_ids(), f"{folder}/id", "tag", "n")
    write_table(found.share(), f"{folder}/{FLAG}")
    for c in DATETIMES:
        write_series(found.per_day(c), f"{folder}/{c}", "day", "n")
    for c in COORDINATES:
        write_histogram(found.histogram(c), f"{folder}/{c}")
    for name, end in GRIDS.items():
        write_grid(found.grid(name), f"{folder}/{end}_latitude{end}_longitude")
    write_matrix(found.matrix(), f"{folder}/correlations")
