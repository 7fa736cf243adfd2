"""Counts, shares, rates, time profiles, histograms and table profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.functions.columns import label_map, near
from shoplens.operators import distributions as d
from shoplens.operators import distincts, profile
from shoplens.operators.features import class_weights
from shoplens.plans.reports import succeeded
from shoplens.registry import bindings as b
from shoplens.registry.entries import query
from shoplens.sources.catalog import load_table


def _counts(key: str, table, view: str, source: str, col: str, top: int | None = None) -> None:
    """Register the value counts of one column."""
    limit = f"ORDER BY 2 DESC, 1 LIMIT {top}" if top else ""
    sql = f'WITH {view} SELECT "{col}", count(*) AS "count" FROM {source} GROUP BY 1 {limit}'
    query(sql, name=key)(lambda spark, sf: d.value_counts(table(spark, sf), col, top=top))


_counts("count_by_region", b.customers, b.SQL_CUSTOMERS, "customers_v", "gender")
_counts("count_by_segment", b.customers, b.SQL_CUSTOMERS, "customers_v", "device_type")
_counts("count_by_country", b.customers, b.SQL_CUSTOMERS, "customers_v", "home_country")
_counts("count_by_category", b.products, b.SQL_PRODUCTS, "products_v", "masterCategory")
_counts("count_by_size", b.products, b.SQL_PRODUCTS, "products_v", "season")
_counts("top_colours", b.products, b.SQL_PRODUCTS, "products_v", "baseColour", top=10)
_counts("count_by_brand", b.products, b.SQL_PRODUCTS, "products_v", "gender")
_counts("count_by_priority", b.orders, b.SQL_ORDERS, "orders_v", "payment_method")
_counts("event_distribution", b.clickstream, b.SQL_CLICKS, "clicks", "event_name")
_counts("traffic_distribution", b.clickstream, b.SQL_CLICKS, "clicks", "traffic_source")
_counts("class_counts", b.orders, b.SQL_ORDERS, "orders_v", "payment_status")


@query(f"""WITH {b.SQL_PRODUCTS}
SELECT "masterCategory", "subCategory", count(*) AS "count" FROM products_v GROUP BY 1, 2""")
def category_breakdown(spark: SparkSession, sf: str) -> DataFrame:
    return d.breakdown(b.products(spark, sf), "masterCategory", "subCategory")


@query(f"WITH {b.SQL_ORDERS} SELECT DISTINCT payment_status FROM orders_v")
def distinct_status(spark: SparkSession, sf: str) -> DataFrame:
    return b.orders(spark, sf).select("payment_status").distinct()


@query("""WITH joined AS (SELECT min(o_orderdate) AS first_day FROM orders GROUP BY o_custkey)
SELECT strftime(first_day, '%Y-%m') AS join_month, count(*) AS new_customers FROM joined
WHERE first_day IS NOT NULL GROUP BY 1""")
def monthly_new_customers(spark: SparkSession, sf: str) -> DataFrame:
    joined = b.orders(spark, sf).groupBy("customer_id").agg(F.min("created_at").alias("first_join_date"))
    return d.by_period(joined, "first_join_date", "month", [F.count("*").alias("new_customers")], "join_month")


@query(f"""WITH {b.SQL_ORDERS}
SELECT strftime(created_at, '%Y-%m') AS month, count(*) AS num_transactions, {b.near("sum(total_amount)")} AS revenue
FROM orders_v WHERE created_at IS NOT NULL GROUP BY 1""")
def monthly_revenue(spark: SparkSession, sf: str) -> DataFrame:
    measures = [F.count("*").alias("num_transactions"), near(F.sum("total_amount"), 2).alias("revenue")]
    return d.by_period(b.orders(spark, sf), "created_at", "month", measures, "month")


@query(f"""WITH {b.SQL_ORDERS}
SELECT hour(created_at)::BIGINT AS hour_of_day, count(*) AS num_transactions
FROM orders_v WHERE created_at IS NOT NULL GROUP BY 1""")
def orders_by_hour(spark: SparkSession, sf: str) -> DataFrame:
    return d.by_period(
        b.orders(spark, sf), "created_at", "hour", [F.count("*").alias("num_transactions")], "hour_of_day"
    )


@query(f"""WITH {b.SQL_ORDERS}
SELECT dayofweek(created_at)::BIGINT + 1 AS day_of_week, count(*) AS num_transactions,
       strftime(any_value(created_at), '%a') AS day_name
FROM orders_v WHERE created_at IS NOT NULL GROUP BY 1""")
def orders_by_dow(spark: SparkSession, sf: str) -> DataFrame:
    days = d.by_period(
        b.orders(spark, sf), "created_at", "dayofweek", [F.count("*").alias("num_transactions")], "day_of_week"
    )
    return days.withColumn("day_name", label_map("day_of_week", d.DAY_NAMES))


@query(f"""WITH {b.SQL_CLICKS}
SELECT hour(event_time)::BIGINT AS hour_of_day, count(*) AS event_count
FROM clicks WHERE event_time IS NOT NULL GROUP BY 1""")
def events_by_hour(spark: SparkSession, sf: str) -> DataFrame:
    return d.by_period(
        b.clickstream(spark, sf), "event_time", "hour", [F.count("*").alias("event_count")], "hour_of_day"
    )


@query(f"""WITH {b.SQL_TRANSACTIONS}
SELECT count(*) AS total_transactions, count(DISTINCT customer_id) AS unique_customers,
       {b.near("avg(total_amount)")} AS avg_order_value, {b.near("min(total_amount)")} AS min_order_value,
       {b.near("max(total_amount)")} AS max_order_value, {b.near("sum(total_amount)")} AS total_revenue,
       {b.near("avg(shipment_fee)")} AS avg_shipment_fee, {b.near("avg(promo_amount)")} AS avg_promo_amount
FROM tx""")
def transaction_summary(spark: SparkSession, sf: str) -> DataFrame:
    return d.summary(b.transactions(spark, sf))


@query(f"""WITH {b.SQL_ORDERS}
SELECT payment_status, count(*) AS "count",
       {b.near("count(*) * 100.0::DOUBLE / (SELECT count(*) FROM orders_v)", 1)} AS pct
FROM orders_v GROUP BY 1""")
def status_share(spark: SparkSession, sf: str) -> DataFrame:
    return d.share(b.orders(spark, sf), "payment_status")


@query(f"""WITH {b.SQL_CLICKS}
SELECT count(DISTINCT session_id) AS unique_sessions,
       {b.near("count(*) * 1.0::DOUBLE / count(DISTINCT session_id)", 1)} AS avg_events_per_session
FROM clicks""")
def session_stats(spark: SparkSession, sf: str) -> DataFrame:
    return d.session_stats(b.clickstream(spark, sf))


def _revenue_sql(col: str) -> str:
    return f"""WITH {b.SQL_ORDERS}, {b.SQL_CUSTOMERS}
SELECT {col}, count(booking_id) AS num_orders, {b.near("sum(total_amount)")} AS total_revenue,
       {b.near("avg(total_amount)")} AS avg_order_value
FROM orders_v JOIN customers_v USING (customer_id) WHERE payment_status = 'F' GROUP BY 1"""


@query(_revenue_sql("home_country"))
def revenue_by_country(spark: SparkSession, sf: str) -> DataFrame:
    paid = b.orders(spark, sf).where(succeeded(b.PAID))
    return d.revenue_by(paid, b.customers(spark, sf), "customer_id", "home_country")


@query(_revenue_sql("device_type"))
def revenue_by_device(spark: SparkSession, sf: str) -> DataFrame:
    paid = b.orders(spark, sf).where(succeeded(b.PAID))
    return d.revenue_by(paid, b.customers(spark, sf), "customer_id", "device_type")


@query(f"""WITH {b.SQL_ORDERS}
SELECT payment_method, count(*) AS total, count(*) FILTER (WHERE payment_status = 'F') AS success_count,
       {b.near("count(*) FILTER (WHERE payment_status = 'F') * 100.0::DOUBLE / count(*)", 1)} AS success_rate
FROM orders_v GROUP BY 1""")
def success_rate_by_method(spark: SparkSession, sf: str) -> DataFrame:
    return d.rate_by(b.orders(spark, sf), "payment_method", succeeded(b.PAID))


@query(f"""WITH {b.SQL_CLICKS}
SELECT list_position(['view', 'click', 'purchase'], event_name)::BIGINT AS stage, event_name, count(*) AS "count"
FROM clicks WHERE event_name IN ('view', 'click', 'purchase') GROUP BY ALL""")
def funnel_event_counts(spark: SparkSession, sf: str) -> DataFrame:
    return d.stage_counts(b.clickstream(spark, sf), "event_name", b.STAGES)


@query(f"""WITH {b.SQL_ORDERS},
span AS (
    SELECT min(total_amount) AS lo, max(total_amount) AS hi, avg(total_amount) AS mean,
           (max(total_amount) - min(total_amount)) / 40.0::DOUBLE AS width
    FROM orders_v),
guessed AS (
    SELECT total_amount AS x, lo, width,
           least(floor((total_amount - lo) / (hi - lo) * 40.0::DOUBLE), 39)::BIGINT AS g
    FROM orders_v, span WHERE total_amount IS NOT NULL),
placed AS (
    SELECT CASE WHEN x < lo + g * width THEN g - 1
                WHEN g < 39 AND x >= lo + (g + 1) * width THEN g + 1 ELSE g END AS bin
    FROM guessed),
filled AS (SELECT bin, count(*) AS n FROM placed GROUP BY 1)
SELECT i AS bin, {b.near("lo + i * width")} AS lower, {b.near("lo + (i + 1) * width")} AS upper,
       coalesce(n, 0) AS "count", {b.near("mean")} AS mean_value
FROM range(40) r(i) CROSS JOIN span LEFT JOIN filled ON bin = i""")
def order_value_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return d.histogram(b.orders(spark, sf), "total_amount", bins=40)


@query(f"""WITH {b.SQL_ORDERS},
found AS (
    SELECT payment_status, count(*) AS class_count FROM orders_v
    WHERE payment_status IN ('F', 'O') GROUP BY 1)
SELECT payment_status, class_count,
       {b.near("n / (k * class_count::DOUBLE)", 6)} AS class_weight
FROM found, (SELECT sum(class_count) AS n, count(*) AS k FROM found)""", name="class_weights")
def balanced_weights(spark: SparkSession, sf: str) -> DataFrame:
    weights = class_weights(b.orders(spark, sf), "payment_status", (b.PAID, b.FAILED))
    return weights.withColumn("class_weight", near("class_weight", 6))


_PROFILED = ("customer", "part", "orders", "events")


def _profiled(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return {name: load_table(spark, name, sf) for name in _PROFILED}


@query(" UNION ALL ".join(
    f"""SELECT '{t}' AS table_name, (SELECT count(*) FROM {t}) AS row_count,
        (SELECT count(*) FROM (DESCRIBE {t})) AS column_count"""
    for t in _PROFILED))
def table_sizes(spark: SparkSession, sf: str) -> DataFrame:
    return profile.table_sizes(_profiled(spark, sf))


# The discount code is NULL without a discount, which gives the profile something to find.
@query(f"""WITH {b.SQL_LINES}
SELECT 'lines' AS table_name, column_name, null_count FROM (
    SELECT count(*) - count(promo_code) AS promo_code, count(*) - count(promo_amount) AS promo_amount,
           count(*) - count(total_amount) AS total_amount, count(*) - count(payment_status) AS payment_status
    FROM lines_v) UNPIVOT (null_count FOR column_name IN (promo_code, promo_amount, total_amount, payment_status))
UNION ALL
SELECT 'orders', column_name, null_count FROM (
    SELECT count(*) - count(o_orderkey) AS o_orderkey, count(*) - count(o_custkey) AS o_custkey,
           count(*) - count(o_orderstatus) AS o_orderstatus, count(*) - count(o_totalprice) AS o_totalprice,
           count(*) - count(o_orderdate) AS o_orderdate, count(*) - count(o_orderpriority) AS o_orderpriority
    FROM orders) UNPIVOT (null_count FOR column_name IN
        (o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority))""")
def null_profile(spark: SparkSession, sf: str) -> DataFrame:
    tables = {"lines": b.line_transactions(spark, sf), "orders": load_table(spark, "orders", sf)}
    return profile.null_profile(tables)


_SUMMARISED = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


@query(" UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, count({c}) AS non_null, {b.near(f"avg({c})", 4)} AS mean,
        {b.near(f"stddev_samp({c})", 4)} AS stddev, {b.near(f"min({c})", 4)} AS min,
        {b.near(f"max({c})", 4)} AS max FROM lineitem"""
    for c in _SUMMARISED))
def numeric_summary(spark: SparkSession, sf: str) -> DataFrame:
    return profile.numeric_summary(load_table(spark, "lineitem", sf), _SUMMARISED, digits=4)


@query("""SELECT row_number() OVER () AS position, column_name,
       CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double'
            WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE column_type END AS data_type,
       "null" = 'YES' AS nullable, value_count
FROM (DESCRIBE lineitem) JOIN (
    UNPIVOT (SELECT count(COLUMNS('(.*)')) AS '\\1' FROM lineitem) ON COLUMNS(*) INTO NAME column_name VALUE value_count
) USING (column_name)""")
def schema_report(spark: SparkSession, sf: str) -> DataFrame:
    return profile.schema_report(load_table(spark, "lineitem", sf))


@query("SELECT * FROM orders ORDER BY o_orderkey LIMIT 5")
def preview_orders(spark: SparkSession, sf: str) -> DataFrame:
    return profile.preview(load_table(spark, "orders", sf), ["o_orderkey"])


@query("""WITH k AS (SELECT o_orderkey AS k, count(*) AS n FROM orders GROUP BY 1)
SELECT 'o_orderkey is not null' AS check_name, coalesce(sum(n) FILTER (WHERE k IS NULL), 0)::BIGINT AS bad_rows FROM k
UNION ALL
SELECT 'o_orderkey is unique', coalesce(sum(n - 1), 0)::BIGINT FROM k WHERE k IS NOT NULL
UNION ALL
SELECT 'o_custkey has a match', count(*) FROM orders
WHERE o_custkey IS NOT NULL AND o_custkey NOT IN (SELECT c_custkey FROM customer)""")
def key_quality(spark: SparkSession, sf: str) -> DataFrame:
    return profile.key_quality(
        load_table(spark, "orders", sf), "o_orderkey", {"o_custkey": (load_table(spark, "customer", sf), "c_custkey")}
    )


@query(f"""WITH {b.SQL_ORDERS},
periods AS (
    SELECT unit, date_trunc(unit, created_at)::DATE AS period_start, customer_id
    FROM orders_v, (VALUES ('month'), ('quarter'), ('year')) u(unit) WHERE created_at IS NOT NULL)
SELECT unit, period_start, count(DISTINCT customer_id) AS customers FROM periods WHERE customer_id IS NOT NULL GROUP BY 1, 2""")
def bitmap_customers(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct customers per month, and per quarter and year from the months' bitmaps."""
    return distincts.distinct_per_period(b.orders(spark, sf), "customer_id", "created_at", out="customers")


@query(f"""WITH {b.SQL_CLICKS}
SELECT event_time::DATE AS day, traffic_source, count(DISTINCT event_id) AS events
FROM clicks WHERE event_id IS NOT NULL GROUP BY 1, 2""")
def bitmap_events(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct events per day and source; rows without time are a group of their own."""
    by = ["day", "traffic_source"]
    clicks = b.clickstream(spark, sf).withColumn("day", F.to_date("event_time"))
    return distincts.count_bitmaps(distincts.bitmaps(clicks, "event_id", by), by, "events")
