"""The six reports and the findings record."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shoplens.plans import reports
from shoplens.registry import bindings as b
from shoplens.registry.entries import query


@query(f"""WITH {b.SQL_ORDERS},
grouped AS (
    SELECT payment_method, payment_status, count(*) AS n, sum(total_amount) AS s, avg(total_amount) AS a
    FROM orders_v GROUP BY ALL)
SELECT payment_method, payment_status, n AS num_transactions, {b.near("s")} AS total_revenue,
       {b.near("a")} AS avg_order_value,
       dense_rank() OVER (PARTITION BY payment_status ORDER BY s DESC) AS revenue_rank
FROM grouped""")
def revenue_by_method_ranked(spark: SparkSession, sf: str) -> DataFrame:
    return reports.revenue_ranked(b.orders(spark, sf))


@query(f"""WITH {b.SQL_TRANSACTIONS}, {b.SQL_CUSTOMERS},
spending AS (
    SELECT customer_id, username, home_country, device_type,
           count(DISTINCT booking_id) AS total_orders, {b.near("sum(total_amount)")} AS lifetime_value,
           {b.near("avg(total_amount)")} AS avg_order_value, min(created_at) AS first_order,
           max(created_at) AS last_order, {b.near("sum(promo_amount)")} AS total_promo_used
    FROM tx JOIN customers_v USING (customer_id)
    WHERE payment_status = 'F' GROUP BY ALL)
SELECT *, dense_rank() OVER (ORDER BY lifetime_value DESC) AS ltv_rank
FROM spending ORDER BY lifetime_value DESC, customer_id LIMIT 15""")
def customer_ltv(spark: SparkSession, sf: str) -> DataFrame:
    return reports.customer_ltv(b.transactions(spark, sf), b.customers(spark, sf), attrs=b.PERSON, paid=b.PAID)


@query(f"""WITH {b.SQL_LINES}
SELECT CASE WHEN coalesce(promo_code, '') = '' THEN 'No Promo' ELSE promo_code END AS promo_code,
       count(*) AS num_transactions, {b.near("avg(total_amount)")} AS avg_order_value,
       {b.near("sum(total_amount)")} AS total_revenue, {b.near("avg(promo_amount)")} AS avg_discount,
       {b.near("count(*) FILTER (WHERE payment_status = 'F') * 100.0::DOUBLE / count(*)", 1)} AS success_rate_pct
FROM lines_v GROUP BY 1""")
def promo_effectiveness(spark: SparkSession, sf: str) -> DataFrame:
    return reports.promo_effectiveness(b.line_transactions(spark, sf), paid=b.PAID)


@query(f"""WITH {b.SQL_ORDERS}, {b.SQL_MONTHS},
linked AS (SELECT *, lag(monthly_revenue) OVER (ORDER BY month) AS before FROM months)
SELECT month, num_transactions, monthly_revenue,
       {b.near("sum(monthly_revenue) OVER (ORDER BY month ROWS UNBOUNDED PRECEDING)")} AS cumulative_revenue,
       {b.near("(monthly_revenue - before) * 100.0::DOUBLE / nullif(before, 0)", 1)} AS mom_growth_pct
FROM linked""")
def monthly_revenue_trend(spark: SparkSession, sf: str) -> DataFrame:
    return reports.monthly_trend(b.orders(spark, sf), paid=b.PAID)


@query(f"""WITH {b.SQL_CLICKS},
per_session AS (
    SELECT bool_or(event_name = 'view')::INTEGER AS v, bool_or(event_name = 'click')::INTEGER AS c,
           bool_or(event_name = 'purchase')::INTEGER AS p, count(*) AS n
    FROM clicks GROUP BY session_id)
SELECT count(*) AS total_sessions, sum(v)::BIGINT AS sessions_with_view, sum(c)::BIGINT AS sessions_with_cart,
       sum(p)::BIGINT AS sessions_with_checkout,
       {b.near("sum(v) * 100.0::DOUBLE / count(*)", 1)} AS view_rate,
       {b.near("sum(c) * 100.0::DOUBLE / nullif(sum(v), 0)", 1)} AS view_to_cart_rate,
       {b.near("sum(p) * 100.0::DOUBLE / nullif(sum(c), 0)", 1)} AS cart_to_checkout_rate,
       {b.near("avg(n)", 1)} AS avg_events_per_session
FROM per_session""")
def clickstream_funnel(spark: SparkSession, sf: str) -> DataFrame:
    return reports.funnel(b.clickstream(spark, sf), b.STAGES)


@query(f"""WITH {b.SQL_ORDERS}, {b.SQL_CUSTOMERS},
spending AS (
    SELECT home_country, customer_id, count(booking_id) AS n, sum(total_amount) AS spent
    FROM customers_v JOIN orders_v USING (customer_id) WHERE payment_status = 'F' GROUP BY ALL)
SELECT home_country, CASE WHEN n >= 5 THEN 'VIP' WHEN n >= 3 THEN 'Regular' ELSE 'Occasional' END AS customer_segment,
       count(*) AS num_customers, {b.near("sum(spent)")} AS segment_revenue,
       {b.near("avg(spent)")} AS avg_customer_value
FROM spending GROUP BY 1, 2""")
def revenue_by_country_segment(spark: SparkSession, sf: str) -> DataFrame:
    return reports.segment_revenue(b.orders(spark, sf), b.customers(spark, sf), paid=b.PAID)


@query(f"""WITH {b.SQL_ORDERS}
SELECT {b.near("sum(total_amount)")} AS total_revenue, {b.near("avg(total_amount)")} AS avg_order_value,
       {b.near("count(*) FILTER (WHERE payment_status = 'F') * 100.0::DOUBLE / count(*)", 1)} AS success_pct,
       count(*) AS transactions_rows, (SELECT count(*) FROM customer) AS customers_rows,
       (SELECT count(*) FROM part) AS products_rows, (SELECT count(*) FROM events) AS clickstream_rows
FROM orders_v""")
def key_findings(spark: SparkSession, sf: str) -> DataFrame:
    others = {
        "customers": b.load_table(spark, "customer", sf),
        "products": b.load_table(spark, "part", sf),
        "clickstream": b.load_table(spark, "events", sf),
    }
    return reports.key_findings(b.orders(spark, sf), others, paid=b.PAID)
