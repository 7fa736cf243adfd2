"""Classifiers and clusters: shapes, ranges and agreement with Spark's own evaluators."""

from __future__ import annotations

import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from shoplens.ml import classification as c
from shoplens.ml import segmentation as s
from shoplens.operators import features as f
from shoplens.registry import queries
from shoplens.registry.models import _classifiers, _state, _sweep
from shoplens.sources.writers import write_table

NAMES = ["Gradient-Boosted Trees", "Logistic Regression", "Random Forest"]


@pytest.fixture(scope="module")
def folder(testdata):
    return f"{testdata}/sf0.01"


def test_metrics(spark, folder):
    rows = c.classifier_metrics(*_classifiers(spark, folder)).collect()
    assert sorted(r.model for r in rows) == NAMES
    assert all(r.error is None and 0 < r[m] < 1 for r in rows for m in c.METRICS)


def test_metrics_as_json(spark, folder, tmp_path):
    metrics = c.classifier_metrics(*_classifiers(spark, folder))
    path = write_table(metrics, str(tmp_path / "metrics"), "json")
    stored = spark.read.schema(metrics.schema).json(path)
    assert sorted(map(tuple, stored.collect())) == sorted(map(tuple, metrics.collect()))


def test_metrics_agree_with_the_evaluators(spark, folder):
    fitted, scored = _classifiers(spark, folder)
    rows = {r.model: r for r in c.classifier_metrics(fitted, scored, digits=9).collect()}
    names = {"f1": "f1", "precision": "weightedPrecision", "recall": "weightedRecall", "accuracy": "accuracy"}
    for model in NAMES:
        for ours, theirs in names.items():
            judge = MulticlassClassificationEvaluator(
                labelCol="label", predictionCol=f"prediction_{c._slug(model)}", metricName=theirs
            )
            assert rows[model][ours] == pytest.approx(judge.evaluate(scored), abs=1e-8)


def test_one_sided_predictions_score_like_the_evaluator(spark):
    cells = spark.createDataFrame(
        [("m", 0.0, 0.0, 90), ("m", 1.0, 0.0, 10)], "model STRING, label DOUBLE, prediction DOUBLE, `count` BIGINT"
    )
    r = c.metrics_from_confusion(cells).collect()[0]
    pairs = spark.createDataFrame([(0.0, 0.0)] * 90 + [(1.0, 0.0)] * 10, "label DOUBLE, prediction DOUBLE")
    judge = MulticlassClassificationEvaluator(metricName="f1")
    assert r.f1 == pytest.approx(judge.evaluate(pairs)) and r.accuracy == pytest.approx(0.9)


def test_confusion_covers_the_test_half(spark, folder):
    _, scored = _classifiers(spark, folder)
    cells = queries()["ml_confusion"](spark, folder).collect()
    for model in NAMES:
        assert sum(r["count"] for r in cells if r.model == model) == scored.count()
    assert {r.label for r in cells if r.payment_status == "O"} == {1.0}


def test_a_failing_model_scores_zero(spark, folder, monkeypatch):
    class Broken:
        def __init__(self, **_):
            raise ValueError("broken")

    monkeypatch.setattr(
        c, "MODELS", {"Logistic Regression": c.MODELS["Logistic Regression"], "Random Forest": (Broken, {})}
    )
    features = spark.read.parquet(f"{folder}/orders.parquet").selectExpr(
        "o_orderkey AS k", "o_totalprice AS total_amount", "0.0D AS shipment_fee", "0.0D AS promo_amount",
        "0.0D AS has_promo", "o_orderpriority AS payment_method", "'a' AS device_type", "'b' AS gender",
        "o_orderstatus AS payment_status",
    ).where("payment_status <> 'P'")
    train, test = c.prepare(features, "k", "O", ("F", "O"))
    fitted = c.fit_classifiers(train)
    metrics = c.classifier_metrics(fitted, c.score(fitted, test))
    broken = metrics.where("model = 'Random Forest'").collect()[0]
    assert broken.error == "broken" and broken.f1 == broken.auc == 0.0
    assert c.best_model(metrics).collect()[0].model == "Logistic Regression"


def test_an_empty_test_half_scores_zero(spark, folder):
    fitted, scored = _classifiers(spark, folder)
    metrics = c.classifier_metrics(fitted, scored.where("false")).collect()
    assert sorted(r.model for r in metrics) == NAMES and all(r.f1 == 0.0 and r.error for r in metrics)


def test_prepare_weights_and_labels(spark, folder):
    df = spark.createDataFrame(
        [(i, "Failed" if i % 10 == 0 else "Success") for i in range(100)], "k INT, payment_status STRING"
    )
    train, test = c.prepare(df, "k")
    rows = train.unionByName(test).select("label", F.round("class_weight", 4), "payment_status").distinct().collect()
    assert sorted(map(tuple, rows)) == [(0.0, 0.5556, "Success"), (1.0, 5.0, "Failed")]


def test_tables_written_anew_are_another_state(spark, folder, tmp_path):
    for name in ("orders", "lineitem", "customer", "nation", "region"):
        spark.range(3).write.parquet(f"{tmp_path}/{name}.parquet")
    before = _state(spark, str(tmp_path))
    assert _state(spark, str(tmp_path)) == before
    spark.range(4).write.mode("overwrite").parquet(f"{tmp_path}/orders.parquet")
    assert _state(spark, str(tmp_path)) != before


def test_prepare_within_a_budget(spark):
    df = spark.range(20_000).selectExpr("id AS k", "if(id % 4 = 0, 'Failed', 'Success') AS payment_status")
    train, test = c.prepare(df, "k", budget=2_000)
    assert abs(train.count() - 1_600) < 200 and abs(test.count() - 400) < 120


def test_sweep(spark, folder):
    rows = _sweep(spark, folder).scores.collect()
    assert [r.k for r in rows] == list(s.KS)
    best = [r for r in rows if r.is_best]
    assert len(best) == 1 and best[0].silhouette_score == max(r.silhouette_score for r in rows)
    assert all(-1 <= r.silhouette_score <= 1 and r.error is None for r in rows)


def test_clusters_cover_all_customers(spark, folder):
    q = queries()
    customers = q["customer_features"](spark, folder).count()
    profile = s.cluster_profile(_sweep(spark, folder).assigned).collect()
    assert sum(r.num_customers for r in profile) == customers == q["cluster_assignments"](spark, folder).count()
    crosstab = q["cluster_crosstab"](spark, folder).groupBy("attribute").agg(F.sum("count")).collect()
    assert sorted(map(tuple, crosstab)) == [("device_type", customers), ("gender", customers)]
    assert len(profile) == _sweep(spark, folder).best_k


def test_sweep_without_a_score_uses_the_default(spark, folder):
    features = spark.createDataFrame([(float(i), 1.0) for i in range(6)], "x DOUBLE, y DOUBLE")
    sweep = s.kmeans_sweep(features, cols=["x", "y"], ks=(1,))
    assert sweep.best_k == s.DEFAULT_K
    assert sweep.scores.collect()[0].error and sweep.assigned.count() == 6


def test_the_split_is_stored_with_the_features(spark, testdata):
    rows = spark.range(500).selectExpr(
        "id AS booking_id", "IF(id % 3 = 0, 'Failed', 'Success') AS payment_status", "id * 1.0D AS total_amount"
    )
    train, test = c.prepare(rows, "booking_id")
    for found, expected in zip((train, test), f.train_test_split(rows, "booking_id")):
        assert "md5" not in found._jdf.queryExecution().executedPlan().toString()
        assert {r.booking_id for r in found.collect()} == {r.booking_id for r in expected.collect()}
        assert found.columns == [*rows.columns, "label", "class_weight"]


def test_k_means_is_fitted_in_blocks(spark):
    rows = spark.range(300).selectExpr("id", "(id % 3) * 50.0D + id / 300 AS x", "(id % 3) * 20.0D AS y")
    sweep = s.kmeans_sweep(rows, cols=("x", "y"), ks=(3,))
    assert sweep.model.stages[-1].getSolver() == "block"
    assert sweep.assigned.groupBy((sweep.assigned.id % 3).alias("k")).agg({"cluster": "min"}).count() == 3
    assert sweep.assigned.select((sweep.assigned.id % 3).alias("k"), "cluster").distinct().count() == 3
