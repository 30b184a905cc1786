"""Encoding, fitting, saving and scoring."""

from __future__ import annotations

import math
from datetime import datetime, timedelta

import pytest
from pyspark.ml.feature import OneHotEncoderModel
from pyspark.sql import functions as F

from tripmill.operators import features, models
from tripmill.operators.features import CATEGORICAL, feature_pipeline
from tripmill.plans.queries import RULES
from tripmill.plans.training import CHOICES, FULL_GRIDS, score, score_csv, train
from tripmill.sources.sinks import load_model, save_model
from tripmill.sources.trips import write_trips_csv


@pytest.fixture(scope="module")
def encoded(trips):
    from tripmill.operators.clean import clean

    rows = clean(trips, RULES)
    return feature_pipeline().fit(rows).transform(rows).persist()


@pytest.fixture(scope="module")
def tree(trips):
    return train(trips, "dt", RULES, params=CHOICES["dt"], threshold=1200)


def prediction_rows(df):
    return sorted((r["id"], r["prediction"], r["label"]) for r in df.collect())


def test_datetime_parts(make_trips):
    trips = make_trips([{"pickup_datetime": datetime(2016, 5, 1, 1, 2, 3)}])  # a Sunday
    row = features.split_datetime(trips, "pickup_datetime").head()
    assert (row["pickup_datetime_time"], row["pickup_datetime_weekday"]) == (3723.0, "1")
    assert "pickup_datetime" not in row


def test_class_at_the_threshold_is_long(make_trips):
    trips = make_trips([{"trip_duration": s} for s in (1199, 1200, 1201)] + [{"trip_duration": None}])
    got = [r["trip_duration"] for r in features.classify(trips).collect()]
    assert got == ["short", "long", "long", "long"]


def test_pipeline_columns_equal_the_column_functions(trips, encoded):
    from tripmill.operators.clean import clean

    one = encoded.orderBy("id").head()
    row = clean(trips, RULES).filter(F.col("id") == one["id"])
    parts = features.split_datetime(features.split_datetime(row, "pickup_datetime"), "dropoff_datetime")
    parts = parts.head()
    vector = one["features"].toArray()
    assert len(vector) == 21
    assert list(vector[:8]) == [float(parts[c]) for c in features.NUMERIC]


def test_index_order_and_missing_last_slot(encoded, trips):
    index = features.string_indexer(CATEGORICAL)
    parts = features.split_datetime(features.split_datetime(trips, "pickup_datetime"), "dropoff_datetime")
    labels = index.fit(parts).labelsArray
    assert list(labels[0]) == ["Y", "N"]
    assert list(labels[1]) == ["7", "6", "5", "4", "3", "2", "1"]
    assert encoded.filter("label not in (0.0, 1.0)").count() == 0


def test_without_dropoff_time_is_fourteen_wide(trips):
    rows = feature_pipeline(with_dropoff_time=False).fit(trips).transform(trips)
    assert rows.head()["features"].size == 14


def test_shifted_features_are_not_negative(trips):
    rows = feature_pipeline(shift=True).fit(trips).transform(trips)
    assert min(min(r["features"].toArray()) for r in rows.select("features").take(50)) >= 0


def test_bayes_rejects_unshifted_coordinates(encoded):
    with pytest.raises(Exception, match="(?i)negative"):
        models.naive_bayes().fit(encoded)


def test_bayes_parameters_follow_the_formula(spark, trips):
    rows = feature_pipeline(shift=True).fit(trips).transform(trips)
    fitted = models.naive_bayes(modelType="multinomial", smoothing=100.0).fit(rows)
    sums, sizes = {0.0: [0.0] * 21, 1.0: [0.0] * 21}, {0.0: 0, 1.0: 0}
    for r in rows.collect():
        sizes[r["label"]] += 1
        for i, v in enumerate(r["features"].toArray()):
            sums[r["label"]][i] += v
    for r in models.bayes_parameters(spark, fitted).collect():
        c, i = r["label"], r["feature"]
        theta = math.log(sums[c][i] + 100) - math.log(sum(sums[c]) + 21 * 100)
        pi = math.log(sizes[c] + 100) - math.log(1000 + 2 * 100)
        assert (r["theta"], r["pi"]) == (pytest.approx(theta), pytest.approx(pi))


def test_bayes_from_sums_equals_separate_fits(trips):
    from pyspark.ml.functions import vector_to_array

    from tripmill.operators import bayes, metrics
    from tripmill.operators.split import with_fold

    rows = feature_pipeline(shift=True).fit(trips).transform(trips)
    data = with_fold(rows, 3).persist()
    table, folds, chosen = bayes.tune_bayes(data, models.BAYES_GRID)
    found = {(r["params"], r["fold"]): r["auc"] for r in folds.collect()}
    assert len(found) == 18
    for kind, smoothing in (("multinomial", 1.0), ("complement", 100.0)):
        for fold in range(3):
            model = models.naive_bayes(modelType=kind, smoothing=smoothing).fit(data.filter(f"fold <> {fold}"))
            raw = vector_to_array("rawPrediction")
            scored = model.transform(data.filter(f"fold = {fold}")).select("label", (raw[1] - raw[0]).alias("s"))
            area = metrics.auc_roc(scored, "s").head()[0]
            assert found[f"modelType={kind}, smoothing={smoothing}", fold] == pytest.approx(area, abs=1e-9)
    tuned = models.cross_validate(models.naive_bayes(), models.BAYES_GRID, data)
    for r, mean in zip(table.collect(), tuned.avgMetrics):
        assert r["avg_auc"] == pytest.approx(mean, abs=5e-3)  # that one puts scores into 1,000 bins
    best = max(table.collect(), key=lambda r: r["avg_auc"])
    assert best["chosen"] and bayes.setting_names({k: [v] for k, v in chosen.items()}) == [best["params"]]


def test_bayes_tuning_needs_both_classes_in_every_fold(trips):
    from tripmill.operators import bayes
    from tripmill.operators.split import with_fold

    rows = feature_pipeline(shift=True).fit(trips).transform(trips)
    data = with_fold(rows, 3).filter("label = 0 or fold = 1")
    with pytest.raises(ValueError, match="both classes"):
        bayes.tune_bayes(data, {"modelType": ["multinomial"], "smoothing": [1.0]})


def test_tree_fits_repeat(encoded):
    first = models.decision_tree(*models.TREE_CHOICE).fit(encoded).toDebugString
    again = models.decision_tree(*models.TREE_CHOICE).fit(encoded).toDebugString
    assert first.split("\n")[1:] == again.split("\n")[1:]


def test_tree_comparison_judges_every_setting(encoded):
    rows = models.compare_trees(encoded).collect()
    assert [(r["impurity"], r["max_depth"], r["max_bins"]) for r in rows] == models.TREE_SETTINGS
    assert all(0 <= r["error_rate"] <= 1 for r in rows)
    assert encoded.is_cached  # a frame that was kept stays kept


def test_shallower_trees_are_the_upper_levels_of_the_deepest(encoded):
    from tripmill.operators.split import hash_split

    fit, valid = hash_split(encoded, salt="inner")
    settings = [("gini", d, b) for d in (2, 3, 5, 9) for b in (5, 32)] + [("entropy", 4, 5)]
    rows = models.compare_trees(encoded, settings).collect()
    assert [(r["impurity"], r["max_depth"], r["max_bins"]) for r in rows] == settings
    for r, setting in zip(rows, settings):
        judged = models.decision_tree(*setting).fit(fit).transform(valid)
        wrong = judged.filter("prediction <> label").count()
        assert r["n_valid"] == judged.count() and r["error_rate"] == pytest.approx(wrong / r["n_valid"])


@pytest.mark.parametrize("kind", ["dt", "rf"])
def test_compiled_expressions_predict_like_the_model(spark, encoded, kind):
    from tripmill.operators import trees

    grown = models.decision_tree("gini", 6, 10) if kind == "dt" else models.random_forest(**models.FOREST_CHOICE)
    model = grown.fit(encoded)
    nodes = trees.tree_nodes(spark, model)
    assert prediction_rows(trees.predict_by_sql(encoded, nodes)) == prediction_rows(model.transform(encoded))
    # the same expression in another engine, over the features as rows of numbers
    import duckdb

    slots = [tuple(r["features"].toArray()) for r in encoded.orderBy("id").collect()]
    con = duckdb.connect()
    con.execute(f"create table x (k int, {', '.join(f'f{i} double' for i in range(21))})")
    con.executemany(f"insert into x values ({', '.join('?' * 22)})", [(k, *s) for k, s in enumerate(slots)])
    found = con.execute(f"select {trees.prediction_expression(nodes)} from x order by k").fetchall()
    assert [p for (p,) in found] == [r["prediction"] for r in model.transform(encoded).orderBy("id").collect()]


def test_node_table(spark, encoded):
    from tripmill.operators import trees

    model = models.random_forest(maxDepth=4, numTrees=3).fit(encoded)
    rows = trees.node_table(spark, model).collect()
    by = {(r["tree"], r["node"]): r for r in rows}
    assert len(by) == len(rows) == model.totalNumNodes and {t for t, _ in by} == {0, 1, 2}
    for r in rows:
        assert r["depth"] <= 4 and r["prediction"] == float(r["n_long"] > r["n_short"])
        if r["feature"] is not None:
            left, right = by[r["tree"], r["left"]], by[r["tree"], r["right"]]
            assert left["n_short"] + right["n_short"] == r["n_short"] and left["depth"] == r["depth"] + 1
            assert (r["threshold"] is None) == (r["feature"] >= 8) != (r["category"] is None)


def test_a_tree_cut_at_its_root(spark, encoded):
    from tripmill.operators import trees

    nodes = trees.tree_nodes(spark, models.decision_tree(*models.TREE_CHOICE).fit(encoded))
    assert trees.case_expression(nodes, lambda n: n.prediction, depth=0) == "0.0E0"
    counts = [(leaf, label, 1) for leaf in (0, 1) for label in (0.0, 1.0)]
    assert trees.truncated_errors(nodes, counts, [0]) == {0: 2}  # all rows are said to be short


def test_grids_have_their_published_size(spark):
    forest = models.param_grid(models.random_forest(), models.FOREST_GRID)
    bayes = models.param_grid(models.naive_bayes(), models.BAYES_GRID)
    assert (len(forest), len(bayes), len(FULL_GRIDS["dt"])) == (168, 6, 10)


def test_cross_validation_picks_the_best_average(spark, encoded):
    grid = {"maxDepth": [2, 4], "numTrees": [3], "maxBins": [10], "minInfoGain": [0.0]}
    tuned = models.cross_validate(models.random_forest(), grid, encoded)
    rows = models.tuning_table(spark, tuned).collect()
    best = max(rows, key=lambda r: r["avg_auc"])
    assert len(rows) == 2 and best["chosen"] and sum(r["chosen"] for r in rows) == 1
    assert f"maxDepth={tuned.bestModel.getMaxDepth()}" in best["params"]


@pytest.mark.parametrize("kind", ["dt", "nb", "rf"])
def test_training_predicts_the_clean_test_side(trips, kind):
    from tripmill.operators.clean import clean
    from tripmill.operators.split import hash_split

    trained = train(trips, kind, RULES, params=CHOICES[kind])
    expected = clean(hash_split(trips)[1], RULES)
    assert trained.predictions.count() == expected.count()
    assert {r["metric"] for r in trained.metrics.collect()} >= {"error_rate", "auc_roc", "auc_pr"}
    assert (trained.threshold == 1200) == (kind != "dt")


def test_random_split_training(trips):
    trained = train(trips, "dt", RULES, params=CHOICES["dt"], split="random", threshold=1200)
    assert 200 < trained.predictions.count() < 450


def test_dt_grid_is_reported(trips):
    grid = [("gini", 3, 5), ("gini", 4, 5)]
    assert train(trips, "dt", RULES, grid=grid).tuning.count() == 2


def test_unknown_kind(trips):
    with pytest.raises(ValueError):
        train(trips, "svm")


@pytest.mark.parametrize("kind", ["nb", "rf"])
def test_saved_bayes_and_forest_predict_the_same(trips, kind, tmp_path):
    path, trained = str(tmp_path / "model"), train(trips, kind, RULES, params=CHOICES[kind])
    save_model(trained.model, path)
    loaded, direct = score(trips, path, RULES), score(trips, trained.model, RULES)
    assert prediction_rows(loaded.predictions) == prediction_rows(direct.predictions)
    assert loaded.metrics.count() == 7


def test_saved_model_predicts_the_same(spark, trips, tree, tmp_path):
    path = str(tmp_path / "model")
    save_model(tree.model, path)
    save_model(tree.model, path)  # replaces
    loaded = score(trips, path, RULES)
    direct = score(trips, tree.model, RULES)
    assert prediction_rows(loaded.predictions) == prediction_rows(direct.predictions)
    assert loaded.loss.head()["n_total"] == 1000
    rules = models.model_rules(spark, load_model(path)).collect()
    assert "DecisionTreeClassificationModel" in rules[0]["rule"] and len(rules) > 3


def test_scoring_a_file(spark, trips, tree, tmp_path):
    path, csv = str(tmp_path / "model"), str(tmp_path / "trips")
    save_model(tree.model, path)
    write_trips_csv(trips, csv)
    scored = score_csv(spark, csv, path, RULES)
    assert prediction_rows(scored.predictions) == prediction_rows(score(trips, path, RULES).predictions)
    assert scored.metrics.count() == 7


def test_curves_and_preview_of_trained_and_scored(trips, tree):
    for judged in (tree, score(trips, tree.model, RULES)):
        figures = {r["metric"]: r["value"] for r in judged.metrics.collect()}
        points = [(r["fpr"], r["tpr"]) for r in judged.roc.collect()]
        assert points[0] == (0.0, 0.0) and points[-1] == (1.0, 1.0) and len(points) == 4
        assert points[1] == pytest.approx((figures["fpr"], figures["tpr"]))
        curve = judged.pr.collect()
        assert curve[0]["recall"] == 0.0 and curve[1]["recall"] == pytest.approx(figures["tpr"])
        assert judged.preview.count() == 20 and judged.preview.columns == judged.predictions.columns


def test_scoring_a_file_with_one_flag_only(trips, tree):
    only_n = trips.filter("store_and_fwd_flag = 'N'")
    assert score(only_n, tree.model, RULES).predictions.count() > 0


def test_a_file_of_long_trips_is_labelled_long(trips, tree):
    only_long = trips.filter("trip_duration >= 1200")
    labels = score(only_long, tree.model, RULES).predictions.select("label").distinct().collect()
    assert [r["label"] for r in labels] == [1.0]


def test_unseen_category_fails_or_is_kept(trips):
    odd = trips.withColumn("store_and_fwd_flag", F.lit("Z"))
    strict = train(trips, "dt", RULES, params=CHOICES["dt"], threshold=1200)
    with pytest.raises(Exception, match="(?i)unseen label"):
        score(odd, strict.model, RULES).predictions.collect()
    lenient = train(trips, "dt", RULES, params=CHOICES["dt"], threshold=1200, handle_invalid="keep")
    assert score(odd, lenient.model, RULES).predictions.count() > 0


def test_encoders_are_fitted_on_training_rows_only(make_trips):
    start = datetime(2016, 3, 1)
    rows = [{"pickup_datetime": start + timedelta(hours=7 * i)} for i in range(120)]
    trained = train(make_trips(rows), "dt", params=CHOICES["dt"], threshold=1200)
    assert any(isinstance(s, OneHotEncoderModel) for s in trained.model.stages)
