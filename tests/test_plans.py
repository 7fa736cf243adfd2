"""What the physical plans must and must not hold, whatever the size of the tables."""

from __future__ import annotations

import contextlib
import io

import pytest
from pyspark.sql import functions as F

from shoplens.operators import features
from shoplens.registry import bindings, queries

RUN_JOBS = ("stream", "ml_", "kmeans", "cluster_", "csv_", "json_", "parquet_")
LAZY = sorted(name for name in queries() if not name.startswith(RUN_JOBS))


@pytest.fixture(scope="module")
def plan(spark, testdata):
    """Plan text with broadcasts off, as for tables too large for them."""
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")

    def explain(name):
        text = io.StringIO()
        with contextlib.redirect_stdout(text):
            queries()[name](spark, f"{testdata}/sf0.01").explain("formatted")
        return text.getvalue()

    yield explain
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_join_and_no_python(plan, name):
    text = plan(name)
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "EvalPython", "InPandas"):
        assert bad not in text
    # Spark aggregates bitmaps by sorting only.
    assert name.startswith("bitmap_") or "SortAggregate" not in text


@pytest.mark.parametrize(
    "name, pushed",
    [
        ("monthly_revenue_trend", "EqualTo(o_orderstatus,F)"),
        ("customer_ltv", "EqualTo(o_orderstatus,F)"),
        ("revenue_by_country", "EqualTo(o_orderstatus,F)"),
        ("customer_features", "EqualTo(o_orderstatus,F)"),
        ("classification_features", "In(o_orderstatus, [F,O])"),
        ("funnel_event_counts", "In(event_type, [click,purchase,view])"),
    ],
)
def test_filters_reach_the_scan(plan, name, pushed):
    assert pushed in plan(name)


@pytest.mark.parametrize(
    "name, schema",
    [
        ("revenue_by_method_ranked", "struct<o_orderstatus:string,o_totalprice:double,o_orderpriority:string>"),
        ("session_stats", "struct<ts:timestamp_ntz,user_id:bigint>"),
        ("order_value_histogram", "struct<o_totalprice:double>"),
        ("traffic_distribution", "struct<props:string>"),
    ],
)
def test_scans_read_only_the_columns_used(plan, name, schema):
    scans = [line for line in plan(name).splitlines() if line.startswith("ReadSchema")]
    assert scans and all(line == f"ReadSchema: {schema}" for line in scans)


def test_facts_shrink_before_they_are_joined(plan):
    """The join of the revenue report gets sums per customer, not orders."""
    text = plan("revenue_by_country")
    tree = text.split("\n\n")[0].splitlines()
    join = next(i for i, line in enumerate(tree) if "SortMergeJoin Inner" in line)
    left = [line for line in tree[join:] if "HashAggregate" in line]
    assert left, text


def test_top_customers_are_cut_before_the_ranking_window(plan):
    tree = plan("customer_ltv").split("\n\n")[0]
    assert tree.index("Window") < tree.index("TakeOrderedAndProject")


def test_a_hot_customer_is_split_in_the_feature_join(spark, testdata):
    """The one join that keeps every fact row leaves AQE free to split a skewed partition."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "64",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
        "spark.sql.files.maxPartitionBytes": "64k",
    }
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        folder = f"{testdata}/sf0.01"
        hot = F.when(F.col("booking_id") % 3 == 0, 7).otherwise(F.col("customer_id")).alias("customer_id")
        tx = bindings.orders(spark, folder)
        tx = tx.select(hot, *[c for c in tx.columns if c != "customer_id"], F.lit(0.0).alias("promo_amount"))
        tx = tx.withColumn("shipment_fee", F.lit(0.0)).repartition(16, "booking_id")
        df = features.classification_features(tx, bindings.customers(spark, folder), ("F", "O"))
        rows = df.collect()
        expected = tx.where("payment_status IN ('F', 'O')").count()
        assert len(rows) == expected
        assert "SortMergeJoin(skew=true)" in df._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
