"""The business reports.

Every report sums its fact table by the finest key it needs before anything is joined or
ranked, so shuffles carry partial sums and windows see only the grouped rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoplens.functions.columns import blank_as, bucket, count_where, mean_of, near, percent

# Successful orders a customer needs for each segment.
SEGMENTS = ((5, "VIP"), (3, "Regular"))
LOWEST_SEGMENT = "Occasional"

# The events that make up the funnel.
FUNNEL = ("view_product", "add_to_cart", "checkout")


# Fixed value: the payment status of a transaction that counts as revenue.
PAID = "Success"


def succeeded(status: str = PAID) -> Column:
    return F.col("payment_status") == status


def revenue_ranked(tx: DataFrame, digits: int = 2) -> DataFrame:
    """Revenue per payment method and status, ranked within the status."""
    by_revenue = Window.partitionBy("payment_status").orderBy(F.desc(F.round("revenue", digits + 6)))
    return (
        tx.groupBy("payment_method", "payment_status")
        .agg(
            F.count("*").alias("num_transactions"),
            F.sum("total_amount").alias("revenue"),
            near(F.avg("total_amount"), digits).alias("avg_order_value"),
        )
        .select(
            "payment_method",
            "payment_status",
            "num_transactions",
            near("revenue", digits).alias("total_revenue"),
            "avg_order_value",
            F.dense_rank().over(by_revenue).cast("bigint").alias("revenue_rank"),
        )
        .orderBy("payment_status", "revenue_rank", "payment_method")
    )


def customer_ltv(
    tx: DataFrame,
    customers: DataFrame,
    top: int = 15,
    attrs: Sequence[str] = ("first_name", "last_name", "home_country", "device_type"),
    digits: int = 2,
    paid: str = PAID,
) -> DataFrame:
    """The ``top`` customers by lifetime value, ranked densely.

    Ranks count from the top, so the rows are limited first and only they reach the
    unpartitioned window. Ties at the cut go by customer id. Grouping again after the join
    needs no shuffle and keeps duplicate customer rows counted as a join would.
    """
    per_customer = (
        tx.where(succeeded(paid))
        .groupBy("customer_id")
        .agg(
            F.count_distinct("booking_id").alias("orders"),
            F.sum("total_amount").alias("spent"),
            F.count("total_amount").alias("priced"),
            F.min("created_at").alias("first"),
            F.max("created_at").alias("last"),
            F.sum("promo_amount").alias("promo"),
        )
    )
    leaders = (
        per_customer.join(customers.select("customer_id", *attrs), "customer_id")
        .groupBy("customer_id", *attrs)
        .agg(
            F.max("orders").alias("total_orders"),
            near(F.sum("spent"), digits).alias("lifetime_value"),
            mean_of(F.sum("spent"), F.sum("priced"), digits).alias("avg_order_value"),
            F.min("first").alias("first_order"),
            F.max("last").alias("last_order"),
            near(F.sum("promo"), digits).alias("total_promo_used"),
        )
        .orderBy(F.desc("lifetime_value"), "customer_id", *attrs)
        .limit(top)
    )
    rank = F.dense_rank().over(Window.orderBy(F.desc("lifetime_value"))).cast("bigint")
    return leaders.withColumn("ltv_rank", rank).orderBy("ltv_rank", "customer_id")


def promo_effectiveness(tx: DataFrame, digits: int = 2, paid: str = PAID) -> DataFrame:
    """Volume, order value, discount and success rate per promotion code."""
    return (
        tx.groupBy(blank_as("promo_code", "No Promo").alias("promo_code"))
        .agg(
            F.count("*").alias("num_transactions"),
            near(F.avg("total_amount"), digits).alias("avg_order_value"),
            near(F.sum("total_amount"), digits).alias("total_revenue"),
            near(F.avg("promo_amount"), digits).alias("avg_discount"),
            percent(count_where(succeeded(paid)), F.count("*")).alias("success_rate_pct"),
        )
        .orderBy(F.desc("num_transactions"), "promo_code")
    )


def monthly_revenue(tx: DataFrame, digits: int = 2, paid: str = PAID) -> DataFrame:
    """Successful transactions and rounded revenue per month, the month as its first day."""
    return (
        tx.where(succeeded(paid) & F.col("created_at").isNotNull())
        .groupBy(F.trunc("created_at", "MM").alias("month_start"))
        .agg(
            F.count("*").alias("num_transactions"),
            near(F.sum("total_amount"), digits).alias("monthly_revenue"),
        )
    )


def monthly_trend(tx: DataFrame, digits: int = 2, paid: str = PAID) -> DataFrame:
    """Monthly revenue with running total and growth over the month before.

    The windows are unpartitioned, but one row per calendar month is all they get.
    """
    in_order = Window.orderBy("month_start")
    so_far = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    revenue, before = F.col("monthly_revenue"), F.col("previous")
    return (
        monthly_revenue(tx, digits, paid)
        .withColumn("previous", F.lag("monthly_revenue").over(in_order))
        .select(
            F.date_format("month_start", "yyyy-MM").alias("month"),
            "num_transactions",
            "monthly_revenue",
            near(F.sum("monthly_revenue").over(so_far), digits).alias("cumulative_revenue"),
            percent(revenue - before, before).alias("mom_growth_pct"),
        )
        .orderBy("month")
    )


def rolling_revenue(tx: DataFrame, months: int = 3, digits: int = 2, paid: str = PAID) -> DataFrame:
    """Monthly revenue with the mean of the last ``months`` months on record."""
    recent = Window.orderBy("month_start").rowsBetween(1 - months, Window.currentRow)
    return (
        monthly_revenue(tx, digits, paid)
        .select(
            F.date_format("month_start", "yyyy-MM").alias("month"),
            "monthly_revenue",
            near(F.avg("monthly_revenue").over(recent), digits).alias("rolling_avg_revenue"),
        )
        .orderBy("month")
    )


def funnel(events: DataFrame, stages: Sequence[str] = FUNNEL) -> DataFrame:
    """Sessions that show each funnel event, in any order, and the rates between them."""
    viewed, carted, checked = (F.max(F.when(F.col("event_name") == s, 1).otherwise(0)) for s in stages)
    sessions = events.groupBy("session_id").agg(
        viewed.alias("viewed"), carted.alias("carted"), checked.alias("checked"), F.count("*").alias("events")
    )
    views, carts, checkouts = F.sum("viewed"), F.sum("carted"), F.sum("checked")
    return sessions.agg(
        F.count("*").alias("total_sessions"),
        views.alias("sessions_with_view"),
        carts.alias("sessions_with_cart"),
        checkouts.alias("sessions_with_checkout"),
        percent(views, F.count("*")).alias("view_rate"),
        percent(carts, views).alias("view_to_cart_rate"),
        percent(checkouts, carts).alias("cart_to_checkout_rate"),
        near(F.avg("events"), 1).alias("avg_events_per_session"),
    )


def ordered_funnel(events: DataFrame, stages: Sequence[str] = FUNNEL, ts: str = "event_time") -> DataFrame:
    """Sessions that reach each stage in order of time: their first event of a stage is not before that of the stage before.

    One aggregate per session finds the first time of every stage; the comparison needs no second look at the events.
    """
    firsts = [F.min(F.when(F.col("event_name") == s, F.col(ts))).alias(f"t{i}") for i, s in enumerate(stages)]
    sessions = events.groupBy("session_id").agg(*firsts)
    reached = [F.col("t0").isNotNull()]
    for i in range(1, len(stages)):
        reached.append(reached[-1] & F.coalesce(F.col(f"t{i}") >= F.col(f"t{i - 1}"), F.lit(False)))
    counted = sessions.agg(F.array(*[F.struct(F.lit(i + 1).cast("bigint").alias("stage"), F.lit(s).alias("event_name"), F.count_if(r).alias("sessions")) for i, (s, r) in enumerate(zip(stages, reached))]).alias("stages"))
    return counted.select(F.inline("stages")).orderBy("stage")


def cohort_retention(tx: DataFrame, paid: str = PAID) -> DataFrame:
    """Customers by the month of their first successful transaction and the months since then in which they bought again.

    Customers are reduced to their active months before the first one is looked up, so a busy customer is a few rows.
    """
    month = F.trunc("created_at", "month")
    bought = tx.where(succeeded(paid) & F.col("created_at").isNotNull() & F.col("customer_id").isNotNull())
    active = bought.groupBy("customer_id", month.alias("active")).agg(F.count("*").alias("orders"))
    first = Window.partitionBy("customer_id")
    since = F.months_between("active", "cohort").cast("bigint")
    return (
        active.withColumn("cohort", F.min("active").over(first))
        .groupBy(F.date_format("cohort", "yyyy-MM").alias("cohort_month"), since.alias("months_since"))
        .agg(F.count("*").alias("customers"), F.sum("orders").alias("orders"))
        .orderBy("cohort_month", "months_since")
    )


def reconcile_orders(tx: DataFrame, lines: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """Stored totals against the sums of the lines, per payment status: orders that agree, differ or have no lines.

    lines: booking_id and line_total. Lines are summed per order before the join.
    """
    sums = lines.groupBy("booking_id").agg(F.sum("line_total").alias("lines_total"))
    gap = F.abs(F.round(F.col("lines_total") - F.col("total_amount"), 6))
    return (
        tx.join(sums, "booking_id", "left")
        .groupBy("payment_status")
        .agg(
            F.count("*").alias("orders"),
            F.count_if(gap <= tolerance).alias("agree"),
            F.count_if(gap > tolerance).alias("differ"),
            F.count_if(F.col("lines_total").isNull()).alias("without_lines"),
        )
        .orderBy("payment_status")
    )


def segment_revenue(
    tx: DataFrame,
    customers: DataFrame,
    thresholds: Sequence[tuple[float, str]] = SEGMENTS,
    lowest: str = LOWEST_SEGMENT,
    digits: int = 2,
    paid: str = PAID,
) -> DataFrame:
    """Customers and revenue per country and order-count segment."""
    spending = (
        tx.where(succeeded(paid))
        .groupBy("customer_id")
        .agg(F.count("booking_id").alias("orders"), F.sum("total_amount").alias("spent"))
    )
    per_customer = (
        spending.join(customers.select("customer_id", "home_country"), "customer_id")
        .groupBy("customer_id", "home_country")
        .agg(F.sum("orders").alias("orders"), F.sum("spent").alias("spent"))
    )
    return (
        per_customer.groupBy("home_country", bucket("orders", thresholds, lowest).alias("customer_segment"))
        .agg(
            F.count("*").alias("num_customers"),
            near(F.sum("spent"), digits).alias("segment_revenue"),
            near(F.avg("spent"), digits).alias("avg_customer_value"),
        )
        .orderBy("home_country", F.desc("segment_revenue"), "customer_segment")
    )


def line_revenue(lines: DataFrame, products: DataFrame, attr: str, digits: int = 2) -> DataFrame:
    """Order lines, units and revenue per product attribute, from lines of
    (product_id, quantity, price)."""
    sold = lines.groupBy("product_id").agg(
        F.count("*").alias("lines"),
        F.sum("quantity").alias("units"),
        F.sum(F.col("quantity") * F.col("price")).alias("revenue"),
    )
    return (
        sold.join(products.select("product_id", attr), "product_id")
        .groupBy(attr)
        .agg(
            F.sum("lines").alias("num_lines"),
            F.sum("units").alias("units_sold"),
            near(F.sum("revenue"), digits).alias("total_revenue"),
        )
        .orderBy(F.desc("total_revenue"), attr)
    )


def revenue_by_status(tx: DataFrame, digits: int = 2) -> DataFrame:
    """Transactions and revenue per payment status."""
    return (
        tx.groupBy("payment_status")
        .agg(
            F.count("*").alias("transaction_count"),
            near(F.sum("total_amount"), digits).alias("total_revenue"),
        )
        .orderBy("payment_status")
    )


def key_findings(
    tx: DataFrame, other_tables: Mapping[str, DataFrame], digits: int = 2, paid: str = PAID
) -> DataFrame:
    """Revenue, mean order, success rate and table sizes as one row."""
    success: Column = percent(count_where(succeeded(paid)), F.count("*"))
    facts = tx.agg(
        near(F.sum("total_amount"), digits).alias("total_revenue"),
        near(F.avg("total_amount"), digits).alias("avg_order_value"),
        success.alias("success_pct"),
        F.count("*").alias("transactions_rows"),
    )
    sizes = {f"{name}_rows": df.agg(F.count("*")).scalar() for name, df in other_tables.items()}
    return facts.withColumns(sizes)
