"""What was known of a customer when an order was placed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def point_in_time_features(tx: DataFrame, paid: str = "Success", failed: str = "Failed") -> DataFrame:
    """Per order: days_since_previous, prior_orders, prior_spend (paid) and prior_failure_share, all of the customer's strictly earlier orders.

    Orders at one moment do not see one another. A first order has no days and no share (NULL), no orders and no spend. Orders
    without customer or time are left out. Moments are summed up first, then running sums go in two levels, over a customer's days
    and over the moments of a day: the orders of one customer are many groups, a day each, and the window over
    days has one row a day.
    """
    known = tx.where(F.col("customer_id").isNotNull() & F.col("created_at").isNotNull())
    sums = ["orders", "spend", "failures"]
    moments = known.groupBy("customer_id", "created_at").agg(
        F.count("*").alias("orders"),
        F.sum(F.when(F.col("payment_status") == paid, F.col("total_amount"))).alias("spend"),
        F.count_if(F.col("payment_status") == failed).alias("failures"),
    )
    moments = moments.withColumn("day", F.to_date("created_at"))
    days = moments.groupBy("customer_id", "day").agg(*[F.sum(c).alias(c) for c in sums], F.max("created_at").alias("latest"))
    before = Window.partitionBy("customer_id").orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    earlier_days = days.select(
        "customer_id", "day", *[F.sum(c).over(before).alias(f"day_{c}") for c in sums], F.max("latest").over(before).alias("day_latest")
    )
    today = Window.partitionBy("customer_id", "day").orderBy("created_at").rowsBetween(Window.unboundedPreceding, -1)
    total = {c: F.coalesce(F.col(f"day_{c}"), F.lit(0)) + F.coalesce(F.sum(c).over(today), F.lit(0)) for c in sums}
    running = moments.join(earlier_days, ["customer_id", "day"]).select(
        "customer_id", "created_at",
        F.datediff("created_at", F.coalesce(F.max("created_at").over(today), F.col("day_latest"))).cast("bigint").alias("days_since_previous"),
        total["orders"].alias("prior_orders"), total["spend"].alias("prior_spend"),
        (total["failures"].cast("double") / F.nullif(total["orders"], F.lit(0))).alias("prior_failure_share"),
    )
    return known.select("booking_id", "customer_id", "created_at").join(running, ["customer_id", "created_at"])
