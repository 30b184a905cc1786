"""CSV reading and the text sinks."""

from __future__ import annotations

import glob

import pytest

from tripmill.operators import correlation, flags, profile
from tripmill.plans.profiling import profile as profile_job
from tripmill.plans.profiling import write_profile
from tripmill.sources import scratch, sinks
from tripmill.sources.trips import TRIP_SCHEMA, read_trips_csv, trips_from_events, write_trips_csv

HEADER = ",".join(TRIP_SCHEMA.names)
GOOD = "id1,2,2016-03-14 17:24:55,2016-03-14 17:32:30,1,-73.98,40.76,-73.96,40.75,N,455"


def lines(path):
    """All lines of a text folder in part order."""
    out = []
    for part in sorted(glob.glob(f"{path}/part-*")):
        with open(part) as f:
            out += f.read().splitlines()
    return out


def test_csv_has_the_declared_schema(spark, tmp_path):
    (tmp_path / "t.csv").write_text(f"{HEADER}\n{GOOD}\n")
    df = read_trips_csv(spark, str(tmp_path / "t.csv"))
    row = df.head()
    assert df.schema == TRIP_SCHEMA
    assert (row["vendor_id"], row["trip_duration"], row["pickup_datetime"].hour) == (2, 455, 17)


def test_bad_csv_fields_become_null_losses(spark, tmp_path):
    from tripmill.operators.clean import clean_loss

    bad = GOOD.replace("-73.98", "west").replace("id1", "id2")
    (tmp_path / "t.csv").write_text(f"{HEADER}\n{GOOD}\n{bad}\nid3,1\n")
    df = read_trips_csv(spark, str(tmp_path / "t.csv"))
    loss = clean_loss(df).head()
    assert (loss["n_total"], loss["n_null"]) == (3, 2)
    assert df.filter("id = 'id2'").head()["pickup_longitude"] is None


def test_csv_reads_only_the_columns_asked_for(spark, tmp_path):
    (tmp_path / "t.csv").write_text(f"{HEADER}\n{GOOD}\n")
    df = profile.frequency(read_trips_csv(spark, str(tmp_path / "t.csv")), "vendor_id")
    assert "ReadSchema: struct<vendor_id:int>" in df._jdf.queryExecution().toString()


def test_csv_roundtrip(spark, trips, tmp_path):
    path = str(tmp_path / "csv")
    write_trips_csv(trips, path)
    assert sorted(read_trips_csv(spark, path).collect()) == sorted(trips.collect())


def test_large_event_ids_do_not_overflow(spark):
    events = spark.range(5_000_000_000_000, 5_000_000_000_003).selectExpr(
        "id event_id",
        "timestamp_ntz'2024-01-02 03:04:05.9' ts",
        "7L user_id",
        "'view' event_type",
        "10.0D value",
    )
    got = trips_from_events(events).collect()
    for r, event in zip(got, range(5_000_000_000_000, 5_000_000_000_003)):
        x = event * 7919 % 250000
        assert r["pickup_longitude"] == (x - 74030000) / 1000000
        assert r["dropoff_longitude"] == (x + event * 1299709 % 40000 - 20000 - 74030000) / 1000000
        assert str(r["pickup_datetime"]) == "2024-01-02 03:04:05"


def test_series_lines_belong_together(trips, tmp_path):
    base = str(tmp_path / "passenger_count")
    series = profile.frequency(trips, "passenger_count")
    sinks.write_series(series, base, "tag", "n")
    expected = [(str(r["tag"]), str(r["n"])) for r in series.collect()]
    assert list(zip(lines(base + "Tags"), lines(base + "Values"))) == expected
    assert lines(base)[0] == "tag,n"


def test_missing_and_empty_tags_stay_apart(spark, tmp_path):
    base = str(tmp_path / "tags")
    rows = [(None, 3), ("", 2), ("a,b", 1), ('say "x"', 5), ("N", None)]
    series = spark.createDataFrame(rows, "tag string, n bigint")
    sinks.write_series(series, base, "tag", "n")
    back = sinks.read_series(spark, base, "tag string, n bigint")
    assert sorted(back.collect(), key=repr) == sorted(series.collect(), key=repr)
    tags = {r.line: r.text for r in sinks.read_lines(spark, base + "Tags").collect()}
    values = {r.line: r.text for r in sinks.read_lines(spark, base + "Values").collect()}
    assert sorted(tags) == sorted(values) == [1, 2, 3, 4, 5]
    assert (tags[1], values[1]) == (sinks.MISSING, "3") and (tags[2], values[2]) == ('""', "2")
    assert ("N", sinks.MISSING) in {(tags[k], values[k]) for k in tags}


def test_lines_are_numbered_over_parts_and_splits(spark, tmp_path):
    path = str(tmp_path / "many")
    numbers = spark.range(0, 20_000, 1, 7).selectExpr("cast(id as string) as value")
    numbers.write.text(path)
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for bytes_ in ("4096", "1000000"):  # parts cut into splits, parts packed together
            spark.conf.set("spark.sql.files.maxPartitionBytes", bytes_)
            found = sinks.read_lines(spark, path).collect()
            assert sorted((r.line, int(r.text)) for r in found) == [(k + 1, k) for k in range(20_000)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.range(0).selectExpr("cast(id as string) as value").write.text(path + "-none")
    assert sinks.read_lines(spark, path + "-none").count() == 0


def test_histogram_ranges_are_edges(trips, tmp_path):
    base = str(tmp_path / "pickup_latitude")
    histogram = profile.histogram(trips, "pickup_latitude")
    sinks.write_histogram(histogram, base)
    edges = [float(v) for v in lines(base + "Ranges")]
    rows = histogram.collect()
    assert edges == [r["lo"] for r in rows] + [rows[-1]["hi"]] and len(edges) == 41
    assert [int(v) for v in lines(base + "Values")] == [r["n"] for r in rows]


def test_grid_lines_fall_in_count(trips, tmp_path):
    path = str(tmp_path / "grid")
    grid = profile.density_grid(trips, "pickup_latitude", "pickup_longitude")
    sinks.write_grid(grid, path)
    got = [line.split(",") for line in lines(path)]
    assert [(float(a), float(b), int(n)) for a, b, n in got] == [tuple(r) for r in grid.collect()]


def test_matrix_lines_and_names(trips, tmp_path):
    base = str(tmp_path / "correlations")
    sinks.write_matrix(correlation.correlation_matrix(flags.with_flag_int(trips)), base)
    assert lines(base + "Tags") == [",".join(correlation.CORRELATED)]
    values = [[float(v) for v in line.split(",")] for line in lines(base + "Values")]
    assert len(values) == 7 and all(values[i][i] == 1.0 for i in range(7))


def test_profile_job_reports_every_column(trips, tmp_path):
    reports = profile_job(trips)
    assert set(TRIP_SCHEMA.names) <= set(reports)
    write_profile(trips, str(tmp_path))
    assert len(lines(str(tmp_path / "pickup_datetimeTags"))) == reports["pickup_datetime"].count()
    assert len(lines(str(tmp_path / "dropoff_longitudeRanges"))) == 41


def test_scratch_uses_the_shared_folder(spark, monkeypatch):
    class Conf:
        def get(self, key, default=None):
            return "/shared/checkpoints/" if key == "spark.checkpoint.dir" else default

    class Session:
        conf = Conf()

    first, second = (scratch.scratch_dir(Session(), "x") for _ in range(2))
    assert first.startswith("/shared/checkpoints/x-") and first != second


def test_scratch_refuses_a_cluster_without_a_shared_folder():
    class Session:
        class conf:
            get = staticmethod(lambda key, default=None: default)

        class sparkContext:
            master = "spark://host:7077"

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch.scratch_dir(Session(), "x")


PLAN_DIR = "/root/testdata/sf0.01"  # a table that no fixture keeps in memory
PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas")
EAGER = ("_sink", "csv_", "dt_", "nb_", "rf_", "model_", "save_")


def test_plans_stay_in_the_jvm_without_cartesian_products(spark):
    from tripmill.plans.queries import queries

    for name, query in queries().items():
        if name.startswith(EAGER) or name.endswith(EAGER):
            continue
        plan = query(spark, PLAN_DIR)._jdf.queryExecution().executedPlan().toString()
        for node in (*PYTHON_NODES, "CartesianProduct", "BroadcastNestedLoopJoin"):
            assert node not in plan, (name, node)


def test_profile_scans_read_only_their_column(spark):
    from tripmill.plans.queries import queries

    wanted = {
        "trips_per_pickup_day": "ts:timestamp_ntz",
        "freq_flag_share": "event_type:string",
        "histogram_pickup_longitude": "event_id:bigint",
    }
    for name, columns in wanted.items():
        plan = queries()[name](spark, PLAN_DIR)._jdf.queryExecution().toString()
        schemas = {part.split(">")[0] for part in plan.split("ReadSchema: struct<")[1:]}
        assert schemas - {""} == {columns}, (name, schemas)  # "" only counts rows


def test_grid_lines_keep_three_fields_without_a_coordinate(spark, tmp_path):
    rows = [(40.75, None, 1), (None, -73.98, 2), (None, None, 3)]
    path = str(tmp_path / "grid")
    sinks.write_grid(spark.createDataFrame(rows, "lat double, lon double, n bigint"), path)
    lines = [r.value for r in spark.read.text(path).collect()]
    assert sorted(x.replace('""', "") for x in lines) == [",,3", ",-73.98,2", "40.75,,1"]
