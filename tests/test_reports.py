"""Reports, distributions and features on hand-made rows with known answers."""

from __future__ import annotations

from datetime import datetime
from decimal import ROUND_HALF_UP, Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from shoplens.functions.columns import label_map, mean_of, near, safe_ratio
from shoplens.operators import distributions as d
from shoplens.operators import features as f
from shoplens.operators import profile
from shoplens.plans import reports

TX = (
    "booking_id STRING, customer_id STRING, created_at TIMESTAMP, session_id STRING, payment_method STRING, "
    "payment_status STRING, promo_code STRING, promo_amount DOUBLE, shipment_fee DOUBLE, total_amount DOUBLE"
)


def tx(spark, *rows):
    """Rows as dicts over sensible defaults."""
    base = dict(
        booking_id="B", customer_id="C1", created_at=datetime(2023, 1, 1), session_id="S", payment_method="Card",
        payment_status="Success", promo_code=None, promo_amount=0.0, shipment_fee=1.0, total_amount=10.0,
    )
    return spark.createDataFrame([tuple({**base, **r}.values()) for r in rows], TX)


def people(spark, *ids, country="X"):
    return spark.createDataFrame(
        [(i, "f" + i, "l" + i, country, "iOS", "F") for i in ids],
        "customer_id STRING, first_name STRING, last_name STRING, home_country STRING, device_type STRING, "
        "gender STRING",
    )


def rows(df, *cols):
    return [tuple(r) for r in (df.select(*cols) if cols else df).collect()]


def test_revenue_ranked_is_dense_and_restarts_per_status(spark):
    df = tx(
        spark,
        dict(payment_method="A", total_amount=5.0), dict(payment_method="B", total_amount=5.0),
        dict(payment_method="C", total_amount=1.0), dict(payment_method="C", payment_status="Failed"),
    )
    assert rows(reports.revenue_ranked(df), "payment_status", "payment_method", "revenue_rank") == [
        ("Failed", "C", 1), ("Success", "A", 1), ("Success", "B", 1), ("Success", "C", 2),
    ]


def test_ltv_ties_at_the_cut_go_by_customer(spark):
    ids = [f"C{i:02}" for i in range(17)]
    amounts = [100.0 - i for i in range(14)] + [50.0, 50.0, 50.0]
    df = tx(spark, *[dict(customer_id=c, booking_id=c, total_amount=a) for c, a in zip(ids, amounts)])
    top = reports.customer_ltv(df, people(spark, *ids))
    assert rows(top, "customer_id")[-1] == ("C14",) and top.count() == 15
    assert [r[0] for r in rows(top, "ltv_rank")] == list(range(1, 16))
    tied = reports.customer_ltv(df, people(spark, *ids), top=17)
    assert [r[0] for r in rows(tied, "ltv_rank")][-3:] == [15, 15, 15]


def test_ltv_counts_distinct_bookings_and_repeated_customers_like_a_join(spark):
    df = tx(spark, dict(booking_id="B1"), dict(booking_id="B1", promo_amount=2.0), dict(booking_id="B2"))
    once = people(spark, "C1")
    cols = ["total_orders", "lifetime_value", "avg_order_value", "total_promo_used", "first_name", "last_name"]
    assert rows(reports.customer_ltv(df, once), *cols) == [(2, 30.0, 10.0, 2.0, "fC1", "lC1")]
    twice = once.unionByName(once)
    assert rows(reports.customer_ltv(df, twice), *cols) == [(2, 60.0, 10.0, 4.0, "fC1", "lC1")]
    assert rows(d.revenue_by(df, twice, "customer_id", "home_country")) == [("X", 6, 60.0, 10.0)]
    assert rows(reports.segment_revenue(df, twice)) == [("X", "VIP", 1, 60.0, 60.0)]


def test_promo_codes_null_and_blank_are_one_group(spark):
    df = tx(
        spark, dict(), dict(promo_code="", payment_status="Failed"),
        dict(promo_code="SALE20", promo_amount=4.0, total_amount=20.0),
    )
    assert rows(reports.promo_effectiveness(df)) == [
        ("No Promo", 2, 10.0, 20.0, 0.0, 50.0), ("SALE20", 1, 20.0, 20.0, 4.0, 100.0),
    ]


def test_monthly_trend_with_gap_and_empty_month(spark):
    df = tx(
        spark,
        dict(created_at=datetime(2023, 1, 5), total_amount=100.0), dict(created_at=datetime(2023, 2, 5), total_amount=0.0),
        dict(created_at=datetime(2023, 4, 5), total_amount=50.0), dict(created_at=datetime(2023, 5, 5), total_amount=75.0),
        dict(created_at=None, total_amount=9.0), dict(payment_status="Failed"),
    )
    assert rows(reports.monthly_trend(df)) == [
        ("2023-01", 1, 100.0, 100.0, None), ("2023-02", 1, 0.0, 100.0, -100.0),
        ("2023-04", 1, 50.0, 150.0, None), ("2023-05", 1, 75.0, 225.0, 50.0),
    ]
    assert [r[0] for r in rows(reports.rolling_revenue(df), "rolling_avg_revenue")] == [100.0, 50.0, 50.0, 41.67]


def clicks(spark, *pairs):
    return spark.createDataFrame(list(pairs), "session_id STRING, event_name STRING")


def test_funnel_is_membership_without_order(spark):
    df = clicks(spark, ("a", "add_to_cart"), ("b", "view_product"), ("b", "search"), ("c", "search"))
    assert rows(reports.funnel(df)) == [(3, 1, 1, 0, 33.3, 100.0, 0.0, 1.3)]
    nobody = clicks(spark, ("a", "search"))
    assert rows(reports.funnel(nobody)) == [(1, 0, 0, 0, 0.0, None, None, 1.0)]


def test_segments_at_their_thresholds(spark):
    counts = {"C2": 2, "C3": 3, "C4": 4, "C5": 5}
    df = tx(spark, *[dict(customer_id=c, booking_id=f"{c}{i}") for c, n in counts.items() for i in range(n)])
    result = reports.segment_revenue(df, people(spark, *counts))
    assert rows(result) == [
        ("X", "Regular", 2, 70.0, 35.0), ("X", "VIP", 1, 50.0, 50.0), ("X", "Occasional", 1, 20.0, 20.0),
    ]


def test_line_revenue(spark):
    lines = spark.createDataFrame([(1, 2, 3.0), (1, 1, 3.0), (2, 1, 5.0)], "product_id INT, quantity INT, price DOUBLE")
    goods = spark.createDataFrame([(1, "A"), (2, "B")], "product_id INT, masterCategory STRING")
    assert rows(reports.line_revenue(lines, goods, "masterCategory")) == [("A", 2, 3, 9.0), ("B", 1, 1, 5.0)]


def test_key_findings(spark):
    df = tx(spark, dict(), dict(payment_status="Failed", total_amount=20.0))
    assert rows(reports.key_findings(df, {"customers": people(spark, "C1", "C2")})) == [(30.0, 15.0, 50.0, 2, 2)]


def test_class_weights(spark):
    df = tx(spark, *[dict()] * 9, dict(payment_status="Failed"), dict(payment_status="Pending"))
    weights = {r.payment_status: (r.class_count, r.class_weight) for r in f.class_weights(df, "payment_status").collect()}
    assert weights == {"Success": (9, pytest.approx(10 / 18)), "Failed": (1, pytest.approx(5.0))}
    added = f.with_class_weight(df, "payment_status").select("payment_status", "class_weight").distinct().collect()
    assert {r[0]: r[1] for r in added} == {
        "Success": pytest.approx(10 / 18), "Failed": pytest.approx(5.0), "Pending": 1.0,
    }
    alone = f.with_class_weight(tx(spark, dict()), "payment_status")
    assert rows(alone, "class_weight") == [(1.0,)]


def test_customer_features_guard_zero_spend(spark):
    df = tx(spark, dict(total_amount=0.0, promo_amount=3.0), dict(payment_status="Failed"), dict(customer_id="C9"))
    result = f.customer_features(df, people(spark, "C1")).collect()
    assert len(result) == 1 and result[0].promo_usage_rate == 0.0 and result[0].num_transactions == 1


def test_customer_features_count_sessions_and_methods(spark):
    df = tx(
        spark, dict(session_id="a", payment_method="Card"), dict(session_id="a", payment_method="Cash", promo_amount=5.0),
        dict(session_id="b", payment_method="Cash", total_amount=30.0), dict(session_id=None),
    )
    r = f.customer_features(df, people(spark, "C1")).collect()[0]
    assert (r.num_sessions, r.payment_methods_used, r.num_transactions, r.total_spend) == (2, 2, 4, 60.0)
    assert r.promo_usage_rate == pytest.approx(5 / 60) and r.avg_order_value == 15.0


def test_classification_features(spark):
    df = tx(
        spark, dict(promo_amount=None, shipment_fee=None), dict(promo_amount=2.0, payment_status="Failed"),
        dict(payment_status="Pending"), dict(total_amount=None), dict(payment_method=None), dict(customer_id="C9"),
    )
    result = f.classification_features(df, people(spark, "C1"))
    assert sorted(rows(result)) == [
        (10.0, 0.0, 0.0, 0.0, "Card", "iOS", "F", "Success"), (10.0, 1.0, 2.0, 1.0, "Card", "iOS", "F", "Failed"),
    ]


def test_split_is_stable_under_repartitioning(spark, testdata):
    df = spark.read.parquet(f"{testdata}/sf0.01/orders.parquet").select("o_orderkey")
    train, test = f.train_test_split(df, "o_orderkey")
    again, _ = f.train_test_split(df.repartition(13), "o_orderkey")
    assert train.exceptAll(again).isEmpty() and again.exceptAll(train).isEmpty()
    assert train.unionByName(test).exceptAll(df).isEmpty() and train.count() + test.count() == df.count()
    assert 0.78 < train.count() / df.count() < 0.82


def test_sample_to_budget(spark):
    df = spark.range(10_000)
    assert abs(f.sample_to_budget(df, "id", 1_000).count() - 1_000) < 120
    assert f.sample_to_budget(df, "id", 20_000).count() == 10_000


def test_label_map_and_ratio(spark):
    df = spark.createDataFrame([("M", 1.0, 0.0), ("F", 1.0, 4.0), ("x", 1.0, None)], "g STRING, n DOUBLE, m DOUBLE")
    shown = df.select(label_map("g", {"M": "Male", "F": "Female"}), safe_ratio("n", "m"))
    assert rows(shown) == [("Male", 0.0), ("Female", 0.25), (None, 0.0)]


@pytest.mark.parametrize("seed", range(4))
def test_histogram_equals_numpy(spark, seed):
    rng = np.random.default_rng(seed)
    values = [*map(float, range(41)), *(rng.integers(0, 4000, 300) / 100.0).tolist()]
    df = spark.createDataFrame([(v,) for v in values] + [(None,), (float("nan"),)], "x DOUBLE")
    counts, edges = np.histogram(values, bins=40)
    result = d.histogram(df, "x").collect()
    assert [r["count"] for r in result] == counts.tolist()
    assert [r.lower for r in result] == [round(e, 2) for e in edges[:-1]]


def test_histogram_of_one_value(spark):
    df = spark.createDataFrame([(3.0,)] * 5, "x DOUBLE")
    counts, _ = np.histogram([3.0] * 5, bins=40)
    assert [r["count"] for r in d.histogram(df, "x").collect()] == counts.tolist()


def test_shares_rates_and_stages(spark):
    df = tx(spark, dict(), dict(), dict(payment_status="Failed", payment_method="Cash"))
    assert rows(d.share(df, "payment_status")) == [("Success", 2, 66.7), ("Failed", 1, 33.3)]
    assert rows(d.rate_by(df, "payment_method", reports.succeeded())) == [("Card", 2, 2, 100.0), ("Cash", 1, 0, 0.0)]
    events = clicks(spark, ("a", "checkout"), ("a", "checkout"), ("a", "view_product"), ("a", "search"))
    assert rows(d.stage_counts(events, "event_name", reports.FUNNEL)) == [(1, "view_product", 1), (3, "checkout", 2)]


def test_value_counts_keep_null_and_break_ties(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), (None,)], "x STRING")
    assert rows(d.value_counts(df, "x")) == [(None, 2), ("a", 1), ("b", 1)]
    assert rows(d.value_counts(df, "x", top=2)) == [(None, 2), ("a", 1)]


def test_profiles(spark):
    df = spark.createDataFrame([(1, None), (3, "x")], "`a.b` INT, c STRING")
    assert rows(profile.table_sizes({"t": df, "u": df.limit(1)})) == [("t", 2, 2), ("u", 1, 2)]
    assert rows(profile.null_profile({"t": df})) == [("t", "a.b", 0), ("t", "c", 1)]
    assert rows(profile.numeric_summary(df, digits=3)) == [("a.b", 2, 2.0, 1.414, 1.0, 3.0)]
    assert rows(profile.schema_report(df)) == [(1, "a.b", "int", True, 2), (2, "c", "string", True, 1)]


def test_key_quality(spark):
    df = spark.createDataFrame([(1, "x"), (1, "y"), (1, "z"), (None, "x"), (2, None)], "k INT, r STRING")
    known = spark.createDataFrame([("x",), ("y",)], "id STRING")
    assert rows(profile.key_quality(df, "k", {"r": (known, "id")})) == [
        ("k is not null", 1), ("k is unique", 2), ("r has a match", 1),
    ]
    assert rows(profile.key_quality(df.limit(0), "k"), "bad_rows") == [(0,), (0,)]


def test_means_round_half_up_whatever_the_order(spark):
    """Against exact fractions, over many groups and two partitionings."""
    rng = np.random.default_rng(7)
    cents = {g: rng.integers(1, 50_000_000, 1 + g % 9).tolist() for g in range(3000)}
    df = spark.createDataFrame([(g, c / 100.0) for g, cs in cents.items() for c in cs], "g INT, x DOUBLE")
    exact = {
        g: float((Decimal(sum(cs)) / len(cs) / 100).quantize(Decimal("0.01"), ROUND_HALF_UP)) for g, cs in cents.items()
    }
    for partitions in (1, 13):
        shuffled = df.repartition(partitions).groupBy("g")
        assert dict(rows(shuffled.agg(near(F.avg("x"))))) == exact
        assert dict(rows(shuffled.agg(mean_of(F.sum("x"), F.count("x"))))) == exact


def test_histogram_leaves_out_infinities(spark):
    df = spark.createDataFrame([(float(x),) for x in range(10)] + [(float("inf"),), (float("-inf"),), (float("nan"),), (None,)], "x DOUBLE")
    result = d.histogram(df, "x", bins=3).collect()
    assert [r["count"] for r in result] == [3, 3, 4] and result[0].lower == 0 and result[-1].upper == 9


def test_rows_without_key_are_split_too(spark):
    df = spark.range(300).selectExpr("CAST(NULL AS BIGINT) AS k", "id AS v")
    train, test = f.train_test_split(df, "k")
    assert train.count() + test.count() == 300 and 20 < test.count() < 120


def test_ordered_funnel_wants_the_order_of_time(spark):
    data = [("a", "view_product", 1), ("a", "add_to_cart", 2), ("a", "checkout", 3), ("b", "add_to_cart", 1), ("b", "view_product", 2), ("c", "checkout", 1)]
    df = spark.createDataFrame(data, "session_id STRING, event_name STRING, event_time INT")
    assert [r.sessions for r in reports.ordered_funnel(df, ["view_product", "add_to_cart", "checkout"]).collect()] == [2, 1, 1]


def test_customer_features_read_each_row_once(spark):
    tx = spark.createDataFrame([(1, "Success", 2.0, "s", 0.5, "card"), (1, "Success", 4.0, "t", 0.5, "cash"), (1, "Success", 1.0, None, 0.0, None)],
        "customer_id INT, payment_status STRING, total_amount DOUBLE, session_id STRING, promo_amount DOUBLE, payment_method STRING")
    who = spark.createDataFrame([(1, "iOS", "F")], "customer_id INT, device_type STRING, gender STRING")
    features = f.customer_features(tx, who)
    row = features.first()
    assert (row.num_sessions, row.payment_methods_used, row.total_spend) == (2, 2, 7.0)
    assert "Expand" not in features._jdf.queryExecution().executedPlan().toString()


def test_counts_of_several_groups_equal_single_counts(spark):
    df = spark.createDataFrame([("a", 1, None), ("a", 2, "x"), (None, 1, "x"), ("b", None, "y")], "p STRING, q INT, r STRING")
    groups = [["p"], ["q"], ["p", "r"]]
    for group, found in zip(groups, d.counts_of(df, *groups)):
        assert found.collect() == d.value_counts(df, *group).collect()
