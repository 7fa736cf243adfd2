"""The shop's tables as views of the given ones: for Spark here, for SQL as CTE text.

Only this package knows the given tables; operators take the logical columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.functions.columns import bucket
from shoplens.sources.catalog import load_table

# Which statuses stand for paid and failed (P is neither), funnel events, traffic
# sources by props.k. The statuses keep their given letters, so filters on them reach the scan.
PAID, FAILED = "F", "O"
STAGES = ("view", "click", "purchase")
TRAFFIC = ((67, "tablet"), (34, "web"))
PERSON = ("username", "home_country", "device_type")


def _session(who: str, when: str) -> Column:
    """One session per person and day."""
    return F.concat(F.col(who).cast("string"), F.lit("-"), F.to_date(when).cast("string")).alias("session_id")


def orders(spark: SparkSession, sf: str) -> DataFrame:
    """Transactions without their promotion and fee, which need the order lines."""
    return load_table(spark, "orders", sf).select(
        F.col("o_orderkey").alias("booking_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("created_at"),
        _session("o_custkey", "o_orderdate"),
        F.col("o_orderpriority").alias("payment_method"),
        F.col("o_orderstatus").alias("payment_status"),
        F.col("o_totalprice").alias("total_amount"),
    )


def transactions(spark: SparkSession, sf: str) -> DataFrame:
    """Transactions with the discounts (as promotion) and taxes (as fee) of their lines."""
    charges = (
        load_table(spark, "lineitem", sf)
        .groupBy(F.col("l_orderkey").alias("booking_id"))
        .agg(
            F.sum(F.col("l_extendedprice") * F.col("l_discount")).alias("promo_amount"),
            F.sum(F.col("l_extendedprice") * F.col("l_tax")).alias("shipment_fee"),
        )
    )
    return orders(spark, sf).join(charges, "booking_id", "left").fillna({"promo_amount": 0.0, "shipment_fee": 0.0})


def line_transactions(spark: SparkSession, sf: str) -> DataFrame:
    """Order lines as transactions with a promotion code; no discount means no code."""
    code = F.concat(F.lit("DISC"), F.round(F.col("l_discount") * 100).cast("int").cast("string"))
    return load_table(spark, "lineitem", sf).select(
        F.when(F.col("l_discount") != 0, code).alias("promo_code"),
        (F.col("l_extendedprice") * F.col("l_discount")).alias("promo_amount"),
        F.col("l_extendedprice").alias("total_amount"),
        F.col("l_linestatus").alias("payment_status"),
    )


def customers(spark: SparkSession, sf: str) -> DataFrame:
    """Customers with their nation as home country; the region takes the place of gender."""
    nation = load_table(spark, "nation", sf).join(
        load_table(spark, "region", sf), F.col("n_regionkey") == F.col("r_regionkey")
    )
    return (
        load_table(spark, "customer", sf)
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_name").alias("username"),
            F.col("c_mktsegment").alias("device_type"),
            F.col("n_name").alias("home_country"),
            F.col("r_name").alias("gender"),
        )
    )


def products(spark: SparkSession, sf: str) -> DataFrame:
    return load_table(spark, "part", sf).select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_type").alias("masterCategory"),
        F.col("p_brand").alias("subCategory"),
        F.substring_index("p_name", " ", 1).alias("baseColour"),
        F.col("p_size").alias("season"),
        F.col("p_brand").alias("gender"),
    )


def order_lines(spark: SparkSession, sf: str) -> DataFrame:
    return load_table(spark, "lineitem", sf).select(
        F.col("l_orderkey").alias("booking_id"),
        F.col("l_linenumber").alias("line_number"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_extendedprice").alias("price"),
    )


def as_clickstream(events: DataFrame) -> DataFrame:
    """Events, batch or streaming, under the clickstream's column names."""
    # A step of its own: the JSON is then read once per row, not once per threshold.
    numbered = events.withColumn("k", F.get_json_object("props", "$.k").try_cast("int"))
    return numbered.select(
        _session("user_id", "ts"),
        F.col("event_type").alias("event_name"),
        F.col("ts").alias("event_time"),
        "event_id",
        bucket("k", TRAFFIC, "mobile").alias("traffic_source"),
        F.col("props").alias("event_metadata"),
    )


def clickstream(spark: SparkSession, sf: str) -> DataFrame:
    return as_clickstream(load_table(spark, "events", sf))


# The same tables for the checking SQL.


def near(expr: str, digits: int = 2) -> str:
    """Rounding half up as Spark does it; on doubles the checking engine rounds otherwise."""
    return f"CAST(round(CAST({expr} AS DECIMAL(38, {digits + 6})), {digits}) AS DOUBLE)"


SQL_ORDERS = """orders_v AS (
    SELECT o_orderkey AS booking_id, o_custkey AS customer_id, o_orderdate AS created_at,
           o_custkey || '-' || strftime(o_orderdate, '%Y-%m-%d') AS session_id,
           o_orderpriority AS payment_method, o_totalprice AS total_amount, o_orderstatus AS payment_status
    FROM orders)"""

SQL_TRANSACTIONS = f"""{SQL_ORDERS},
charges AS (
    SELECT l_orderkey, sum(l_extendedprice * l_discount) AS promo, sum(l_extendedprice * l_tax) AS fee
    FROM lineitem GROUP BY l_orderkey),
tx AS (
    SELECT o.*, coalesce(promo, 0.0) AS promo_amount, coalesce(fee, 0.0) AS shipment_fee
    FROM orders_v o LEFT JOIN charges ON l_orderkey = booking_id)"""

SQL_LINES = """lines_v AS (
    SELECT CASE WHEN l_discount <> 0 THEN 'DISC' || CAST(round(l_discount * 100) AS INTEGER) END AS promo_code,
           l_extendedprice * l_discount AS promo_amount, l_extendedprice AS total_amount,
           l_linestatus AS payment_status
    FROM lineitem)"""

SQL_CUSTOMERS = """customers_v AS (
    SELECT c_custkey AS customer_id, c_name AS username, c_mktsegment AS device_type,
           n_name AS home_country, r_name AS gender
    FROM customer, nation, region
    WHERE c_nationkey = n_nationkey AND n_regionkey = r_regionkey)"""

SQL_PRODUCTS = """products_v AS (
    SELECT p_partkey AS product_id, p_type AS "masterCategory", p_brand AS "subCategory",
           split_part(p_name, ' ', 1) AS "baseColour", p_size AS season, p_brand AS gender
    FROM part)"""

SQL_CLICKS = """clicks AS (
    SELECT user_id || '-' || strftime(ts, '%Y-%m-%d') AS session_id, event_type AS event_name,
           ts AS event_time, event_id, props AS event_metadata,
           CASE WHEN CAST(json_extract(props, '$.k') AS INTEGER) >= 67 THEN 'tablet'
                WHEN CAST(json_extract(props, '$.k') AS INTEGER) >= 34 THEN 'web' ELSE 'mobile' END
               AS traffic_source
    FROM events)"""

SQL_MONTHS = f"""months AS (
    SELECT strftime(created_at, '%Y-%m') AS month, count(*) AS num_transactions,
           {near("sum(total_amount)")} AS monthly_revenue
    FROM orders_v WHERE payment_status = 'F' AND created_at IS NOT NULL GROUP BY 1)"""
