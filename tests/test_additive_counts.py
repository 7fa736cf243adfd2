"""Bitmaps, sketches, the exact area under the curve, rejected rows, kept models: on small fixtures."""

from __future__ import annotations

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from shoplens.ml import classification as c
from shoplens.ml import segmentation as s
from shoplens.ml.ranking import exact_auc
from shoplens.operators import distincts as d
from shoplens.registry.models import _classifiers
from shoplens.sources.rejects import read_csv_checked
from shoplens.streaming import windows as w


def test_bitmaps_of_negative_large_and_missing_keys(spark):
    keys = [0, 0, 1, -1, -1, 32768, 32769, -32768, 2**40, None]
    df = spark.createDataFrame([(k, "a" if i % 2 else "b") for i, k in enumerate(keys)], "k BIGINT, g STRING")
    stored = d.bitmaps(df, "k", ["g"])
    per_group = {r.g: r.n for r in d.count_bitmaps(stored, ["g"], "n").collect()}
    assert per_group == {r.g: r.n for r in df.groupBy("g").agg(F.count_distinct("k").alias("n")).collect()}
    whole = d.count_bitmaps(d.merge_bitmaps(stored, []), [], "n").collect()[0].n
    assert whole == len({k for k in keys if k is not None})
    assert d.count_bitmaps(d.bitmaps(df.where("false"), "k", ["g"]), ["g"], "n").count() == 0


def test_a_hot_key_leaves_each_task_as_one_bitmap(spark):
    """A third of the rows on one key: what is shuffled are bitmaps, no rows."""
    df = spark.range(90_000).selectExpr("if(id % 3 = 0, 7, id) AS k", "1 AS g")
    stored = d.bitmaps(df, "k", ["g"])
    assert stored.count() == 3
    assert d.count_bitmaps(stored, ["g"], "n").collect()[0].n == df.select("k").distinct().count()


def test_united_sketches_of_small_sets_are_exact(spark):
    rows = [(f"2024-01-01 {h:02d}:{m:02d}:00", "web", f"s{(h * 7 + m) % 23}") for h in range(3) for m in range(0, 60, 2)]
    events = spark.createDataFrame([*rows, ("2024-01-01 00:01:00", "app", None)], "t STRING, source STRING, session_id STRING")
    sketches = w.window_sketches(w.with_event_time(events, "t"), "source")
    hours = w.unite_sketches(sketches, "source", "hour")
    day = w.sketch_estimates(w.unite_sketches(hours, "source", "day")).collect()
    assert {(r.source, r.event_count, r.sessions) for r in day} == {("web", 90, 23), ("app", 1, 0)}


def test_auc_by_pairs(spark):
    rows = [("m", s_, l) for s_, l in [(0.1, 0.0), (0.4, 1.0), (0.4, 0.0), (0.4, 0.0), (0.9, 1.0), (0.2, 1.0), (float("inf"), 0.0)]]
    rows += [("m", None, 1.0), ("m", 0.3, None), ("one class", 0.5, 1.0), ("all tied", 0.5, 1.0), ("all tied", 0.5, 0.0)]
    found = {r.model: r for r in exact_auc(spark.createDataFrame(rows, "model STRING, score DOUBLE, label DOUBLE")).collect()}
    known = [(s_, l) for m, s_, l in rows if m == "m" and s_ is not None and l is not None]
    won = [1.0 if p > n else 0.5 if p == n else 0.0 for p, lp in known if lp for n, ln in known if not ln]
    assert found["m"].auc == pytest.approx(sum(won) / len(won)) and (found["m"].positives, found["m"].negatives) == (3, 4)
    assert found["one class"].auc is None and found["all tied"].auc == 0.5


def test_auc_agrees_with_the_evaluator(spark, testdata):
    fitted, scored = _classifiers(spark, f"{testdata}/sf0.01")
    ours = {r.model: r.auc for r in exact_auc(c.model_scores(fitted, scored)).collect()}
    assert len(ours) == 3
    for model, auc in ours.items():
        judge = BinaryClassificationEvaluator(labelCol="label", rawPredictionCol=f"raw_{c._slug(model)}", numBins=0)
        assert auc == pytest.approx(judge.evaluate(scored), abs=1e-9)


def test_rejected_rows_carry_file_and_reason(spark, tmp_path):
    lines = ["id,price,note", "1,2.5,a", "2,x,b", ",3,c", "4,5", "5,,", '6,1,"d,e"', "7,8,f,9", "y,z,g"]
    (tmp_path / "a.csv").write_text("\n".join(lines) + "\n")
    checked = read_csv_checked(spark, str(tmp_path / "a.csv"), "id INT NOT NULL, price DOUBLE, note STRING")
    assert sorted(map(tuple, checked.good.collect())) == [(1, 2.5, "a"), (5, None, None), (6, 1.0, "d,e")]
    rejected = {(r.reason, r.line) for r in checked.rejected.collect()}
    assert rejected == {("price", "2,x,b"), ("id", ",3,c"), ("cells", "4,5"), ("cells", "7,8,f,9"), ("id,price", "y,z,g")}
    assert all(r.file.endswith("a.csv") for r in checked.rejected.collect())


def test_a_kept_model_assigns_new_rows(spark, tmp_path):
    known = spark.createDataFrame([(float(i % 2) * 50 + i / 100, 1.0) for i in range(40)], "x DOUBLE, y DOUBLE")
    sweep = s.kmeans_sweep(known, cols=["x", "y"], ks=(2,))
    model = s.load_segments(s.save_segments(sweep.model, str(tmp_path / "model")))
    new = spark.createDataFrame([(0.1, 1.0), (50.2, 1.0), (-3.0, 1.0), (70.0, 1.0)], "x DOUBLE, y DOUBLE")
    rows = s.assign(model, new).withColumn("far", s.centre_distances(model)).orderBy("x").collect()
    assert rows[0].cluster == rows[1].cluster != rows[2].cluster == rows[3].cluster
    assert all(r.far[r.cluster] == min(r.far) for r in rows)
    again = {r.x: r.cluster for r in s.assign(model, known).collect()}
    assert again == {r.x: r.cluster for r in sweep.assigned.collect()}


def test_kept_classifiers_judge_as_before(spark, testdata, tmp_path):
    fitted, scored = _classifiers(spark, f"{testdata}/sf0.01")
    c.save_classifiers(fitted, str(tmp_path / "models"))
    again = c.load_classifiers(str(tmp_path / "models"))
    assert list(again.models) == list(fitted.models)
    features = spark.createDataFrame(
        [(i * 1000.0, i * 3.0, i % 5 * 9.0, float(i % 5 > 0), "1-URGENT", "BUILDING", "ASIA", "F", 0.0) for i in range(200)],
        "total_amount DOUBLE, shipment_fee DOUBLE, promo_amount DOUBLE, has_promo DOUBLE, payment_method STRING, "
        "device_type STRING, gender STRING, payment_status STRING, label DOUBLE",
    )
    rows = [sorted(map(str, c.score(kept, features).collect())) for kept in (fitted, again)]
    assert rows[0] == rows[1] and len(rows[0]) == 200
