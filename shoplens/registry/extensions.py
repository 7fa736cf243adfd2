"""What the shop's documentation names beside the reports: by their sample queries and titles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.operators.distributions import value_counts
from shoplens.plans import reports
from shoplens.registry import bindings as b
from shoplens.registry.entries import query
from shoplens.registry.streams import batch_events, live_events, plain_times
from shoplens.sources.catalog import register_views
from shoplens.streaming import runner
from shoplens.streaming import windows as w


@query(f"""WITH {b.SQL_PRODUCTS}
SELECT "masterCategory", count(*) AS num_lines, sum(l_quantity::INTEGER)::BIGINT AS units_sold,
       {b.near("sum(l_quantity::INTEGER * l_extendedprice)")} AS total_revenue
FROM lineitem JOIN products_v ON l_partkey = product_id GROUP BY 1""")
def revenue_by_category(spark: SparkSession, sf: str) -> DataFrame:
    return reports.line_revenue(b.order_lines(spark, sf), b.products(spark, sf), "masterCategory")


@query(f"""WITH {b.SQL_ORDERS}, {b.SQL_MONTHS}
SELECT month, monthly_revenue,
       {b.near("avg(monthly_revenue) OVER (ORDER BY month ROWS 2 PRECEDING)")} AS rolling_avg_revenue
FROM months""")
def rolling_revenue(spark: SparkSession, sf: str) -> DataFrame:
    return reports.rolling_revenue(b.orders(spark, sf), paid=b.PAID)


@query(f"""WITH {b.SQL_ORDERS}
SELECT payment_status, count(*) AS transaction_count, {b.near("sum(total_amount)")} AS total_revenue
FROM orders_v GROUP BY 1""")
def revenue_by_status(spark: SparkSession, sf: str) -> DataFrame:
    return reports.revenue_by_status(b.orders(spark, sf))


@query(f"""WITH {b.SQL_CUSTOMERS} SELECT gender, device_type, count(*) AS "count" FROM customers_v GROUP BY 1, 2""")
def segment_region_counts(spark: SparkSession, sf: str) -> DataFrame:
    return value_counts(b.customers(spark, sf), "gender", "device_type")


@query(f"""WITH {b.SQL_CLICKS},
shifted AS (
    SELECT event_name, time_bucket(INTERVAL 1 MINUTE, event_time) - (INTERVAL 1 MINUTE * i) AS window_start
    FROM clicks, range(5) r(i))
SELECT window_start, window_start + INTERVAL 5 MINUTE AS window_end, event_name, count(*) AS event_count
FROM shifted WHERE window_start IS NOT NULL GROUP BY 1, 2, 3""")
def sliding_events(spark: SparkSession, sf: str) -> DataFrame:
    counts = w.window_counts(batch_events(spark, sf), "event_name", slide="1 minute")
    return plain_times(counts).drop("unique_sessions")


@query("""SELECT time_bucket(INTERVAL 1 MINUTE, ts) AS minute, count(DISTINCT user_id) AS visitors
FROM events WHERE ts IS NOT NULL GROUP BY 1""")
def visitors_per_minute(spark: SparkSession, sf: str) -> DataFrame:
    events = b.load_table(spark, "events", sf)
    per_minute = events.groupBy(F.window("ts", "1 minute").alias("w"))
    visitors = per_minute.agg(F.count_distinct("user_id").alias("visitors"))
    return visitors.select(F.col("w.start").alias("minute"), "visitors")


@query(f"""WITH {b.SQL_CLICKS},
cut AS (SELECT *, time_bucket(INTERVAL 5 MINUTE, event_time) AS window_start FROM clicks)
SELECT window_start, window_start + INTERVAL 5 MINUTE AS window_end, traffic_source,
       count(DISTINCT session_id) AS sessions
FROM cut WHERE event_time IS NOT NULL GROUP BY 1, 2, 3
HAVING window_start + INTERVAL 5 MINUTE <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE""")
def stream_exact_sessions(spark: SparkSession, sf: str) -> DataFrame:
    """Exact distinct sessions of the windows that the watermark has closed."""
    closed, _ = runner.append_stream(w.exact_sessions(live_events(spark, sf), "traffic_source"))
    return plain_times(closed)


@query(f"""WITH {b.SQL_CLICKS},
firsts AS (
    SELECT session_id, min(event_time) FILTER (event_name = 'view') AS v, min(event_time) FILTER (event_name = 'click') AS c,
           min(event_time) FILTER (event_name = 'purchase') AS p
    FROM clicks GROUP BY 1)
SELECT 1::BIGINT AS stage, 'view' AS event_name, count(*) FILTER (v IS NOT NULL) AS sessions FROM firsts
UNION ALL SELECT 2, 'click', count(*) FILTER (c >= v) FROM firsts
UNION ALL SELECT 3, 'purchase', count(*) FILTER (c >= v AND p >= c) FROM firsts""")
def ordered_funnel(spark: SparkSession, sf: str) -> DataFrame:
    return reports.ordered_funnel(b.clickstream(spark, sf), b.STAGES)


@query(f"""WITH {b.SQL_ORDERS},
active AS (
    SELECT customer_id, date_trunc('month', created_at)::DATE AS active, count(*) AS orders FROM orders_v
    WHERE payment_status = 'F' AND created_at IS NOT NULL AND customer_id IS NOT NULL GROUP BY 1, 2),
cohorts AS (SELECT customer_id, min(active) AS cohort FROM active GROUP BY 1)
SELECT strftime(cohort, '%Y-%m') AS cohort_month, date_diff('month', cohort, active) AS months_since,
       count(*) AS customers, sum(orders)::BIGINT AS orders
FROM active JOIN cohorts USING (customer_id) GROUP BY 1, 2""")
def cohort_retention(spark: SparkSession, sf: str) -> DataFrame:
    return reports.cohort_retention(b.orders(spark, sf), b.PAID)


@query("""WITH sums AS (
    SELECT l_orderkey, sum(l_extendedprice * (1 - l_discount) * (1 + l_tax)) AS s FROM lineitem GROUP BY 1)
SELECT o_orderstatus AS payment_status, count(*) AS orders,
       count(*) FILTER (abs(round(s - o_totalprice, 6)) <= 0.01) AS agree,
       count(*) FILTER (abs(round(s - o_totalprice, 6)) > 0.01) AS differ,
       count(*) FILTER (s IS NULL) AS without_lines
FROM orders LEFT JOIN sums ON l_orderkey = o_orderkey GROUP BY 1""")
def order_reconciliation(spark: SparkSession, sf: str) -> DataFrame:
    charged = F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))
    lines = b.load_table(spark, "lineitem", sf).select(F.col("l_orderkey").alias("booking_id"), charged.alias("line_total"))
    return reports.reconcile_orders(b.orders(spark, sf), lines)


@query(f"""WITH {b.SQL_ORDERS}
SELECT payment_status, count(*) AS orders, count(DISTINCT customer_id) AS customers FROM orders_v GROUP BY 1""")
def orders_by_view(spark: SparkSession, sf: str) -> DataFrame:
    """Plain SQL over registered views; the name is this query's own, so that it hides no other view."""
    register_views({"shoplens_orders": b.orders(spark, sf)})
    return spark.sql(
        "SELECT payment_status, count(*) AS orders, count(DISTINCT customer_id) AS customers FROM shoplens_orders GROUP BY payment_status"
    )
