"""The exploration of the four tables: every distribution as a DataFrame, by name.

Plain counts of a table's columns come from one scan, whose result is stored; the rest is lazy.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.functions.columns import label_map, near
from shoplens.operators import distributions as d
from shoplens.operators import profile
from shoplens.plans.reports import FUNNEL, key_findings, succeeded

# Labels for codes.
GENDERS = {"M": "Male", "F": "Female"}


def customer_profile(customers: DataFrame) -> dict[str, DataFrame]:
    joined = [F.count("*").alias("new_customers")]
    gender, device, country = d.counts_of(customers, ["gender"], ["device_type"], ["home_country"])
    return {
        "gender": gender.withColumn("label", label_map("gender", GENDERS)),
        "device_type": device,
        "home_country": country,
        "join_month": d.by_period(customers, "first_join_date", "month", joined, "join_month"),
    }


def product_profile(products: DataFrame) -> dict[str, DataFrame]:
    master, season, colour, gender, sub = d.counts_of(
        products, ["masterCategory"], ["season"], ["baseColour"], ["gender"], ["masterCategory", "subCategory"]
    )
    return {
        "master_category": master,
        "season": season,
        "base_colour": colour.limit(10),
        "target_gender": gender,
        "sub_category": sub.orderBy("masterCategory", F.desc("count"), "subCategory"),
    }


def transaction_profile(tx: DataFrame) -> dict[str, DataFrame]:
    number = F.count("*").alias("num_transactions")
    revenue = near(F.sum("total_amount")).alias("revenue")
    weekdays = d.by_period(tx, "created_at", "dayofweek", [number], "day_of_week")
    return {
        "transaction_summary": d.summary(tx),
        "payment_status": d.share(tx, "payment_status"),
        "payment_method": d.value_counts(tx, "payment_method"),
        "monthly_revenue": d.by_period(tx, "created_at", "month", [number, revenue], "month"),
        "hour_of_day": d.by_period(tx, "created_at", "hour", [number], "hour_of_day"),
        "day_of_week": weekdays.withColumn("day_name", label_map("day_of_week", d.DAY_NAMES)),
        "order_value": d.histogram(tx, "total_amount"),
    }


def click_profile(clicks: DataFrame) -> dict[str, DataFrame]:
    names, sources = d.counts_of(clicks, ["event_name"], ["traffic_source"])
    return {
        "event_name": names,
        "traffic_source": sources,
        "sessions": d.session_stats(clicks),
        "event_hour": d.by_period(clicks, "event_time", "hour", [F.count("*").alias("event_count")], "hour_of_day"),
        "funnel_events": d.stage_counts(clicks, "event_name", FUNNEL),
    }


def cross_profile(tx: DataFrame, customers: DataFrame) -> dict[str, DataFrame]:
    paid = tx.where(succeeded())
    return {
        "revenue_by_country": d.revenue_by(paid, customers, "customer_id", "home_country"),
        "revenue_by_device": d.revenue_by(paid, customers, "customer_id", "device_type"),
        "success_rate": d.rate_by(tx, "payment_method", succeeded()),
    }


def explore(tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """All profiles of customers, products, transactions and clickstream."""
    tx, customers = tables["transactions"], tables["customers"]
    others = {name: df for name, df in tables.items() if name != "transactions"}
    return {
        "table_sizes": profile.table_sizes(tables),
        "null_profile": profile.null_profile(tables),
        **customer_profile(customers),
        **product_profile(tables["products"]),
        **transaction_profile(tx),
        **click_profile(tables["clickstream"]),
        **cross_profile(tx, customers),
        "key_findings": key_findings(tx, others),
    }
