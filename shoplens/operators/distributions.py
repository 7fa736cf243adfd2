"""Counts, shares, rates, time profiles and histograms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplens.functions.columns import as_col, count_where, mean_of, near, percent
from shoplens.scratch import materialize

# Weekday numbers as Spark counts them.
DAY_NAMES = {1: "Sun", 2: "Mon", 3: "Tue", 4: "Wed", 5: "Thu", 6: "Fri", 7: "Sat"}


def value_counts(df: DataFrame, *cols: str, top: int | None = None, name: str = "count") -> DataFrame:
    """Rows per combination of values, most frequent first, ties in value order."""
    counts = df.groupBy(*cols).agg(F.count("*").alias(name)).orderBy(F.desc(name), *cols)
    return counts.limit(top) if top else counts


def counts_of(df: DataFrame, *groups: Sequence[str]) -> list[DataFrame]:
    """Rows per combination of values of each group of columns, all from one scan.

    Grouping sets count every group at once, combined within the tasks; the counts are stored, and each
    group's are read from there. Order as in ``value_counts``.
    """
    cols = list(dict.fromkeys(c for group in groups for c in group))
    counted = df.groupingSets([list(g) for g in groups], *cols).agg(F.count("*").alias("count"), F.grouping_id().alias("_set"))
    stored = materialize(counted, "counts")
    found = []
    for group in groups:
        left_out = sum(1 << (len(cols) - 1 - i) for i, c in enumerate(cols) if c not in group)
        mine = stored.where(F.col("_set") == left_out).select(*group, "count")
        found.append(mine.orderBy(F.desc("count"), *group))
    return found


def breakdown(df: DataFrame, outer: str, inner: str, name: str = "count") -> DataFrame:
    """Counts of ``inner`` within ``outer``: by outer value, then most frequent first."""
    return df.groupBy(outer, inner).agg(F.count("*").alias(name)).orderBy(outer, F.desc(name), inner)


def share(df: DataFrame, col: str, digits: int = 1) -> DataFrame:
    """Count and percentage of all rows per value."""
    counts = df.groupBy(col).agg(F.count("*").alias("count"))
    total = counts.agg(F.sum("count")).scalar()
    return counts.withColumn("pct", percent(F.col("count"), total, digits)).orderBy(F.desc("count"), col)


def by_period(df: DataFrame, ts: str, unit: str, measures: Sequence[Column], name: str) -> DataFrame:
    """Measures per calendar month, hour of day or weekday; rows without a time are left out.

    Months are grouped as dates and formatted afterwards, once per group instead of per row.
    """
    grouping = {
        "month": F.trunc(ts, "MM"),
        "hour": F.hour(ts).cast("bigint"),
        "dayofweek": F.dayofweek(ts).cast("bigint"),
    }[unit]
    grouped = df.where(F.col(ts).isNotNull()).groupBy(grouping.alias(name)).agg(*measures)
    if unit == "month":
        grouped = grouped.withColumn(name, F.date_format(name, "yyyy-MM"))
    return grouped.orderBy(name)


def rate_by(df: DataFrame, col: str, predicate: Column, digits: int = 1) -> DataFrame:
    """Rows, hits and hit percentage per value."""
    grouped = df.groupBy(col).agg(F.count("*").alias("total"), count_where(predicate).alias("success_count"))
    rate = percent(F.col("success_count"), F.col("total"), digits)
    return grouped.withColumn("success_rate", rate).orderBy(F.desc("success_rate"), col)


def stage_counts(df: DataFrame, col: str, stages: Sequence[str]) -> DataFrame:
    """Events per funnel stage in stage order; a stage without events has no row."""
    order = F.array_position(F.array(*map(F.lit, stages)), F.col(col))
    return (
        df.where(F.col(col).isin(*stages))
        .groupBy(col)
        .agg(F.count("*").alias("count"))
        .select(order.alias("stage"), col, "count")
        .orderBy("stage")
    )


def session_stats(df: DataFrame, session: str = "session_id", digits: int = 1) -> DataFrame:
    """Distinct sessions and events per session."""
    sessions = F.count_distinct(session)
    return df.agg(
        sessions.alias("unique_sessions"),
        mean_of(F.count("*"), sessions, digits).alias("avg_events_per_session"),
    )


def summary(
    df: DataFrame,
    customer: str = "customer_id",
    amount: str = "total_amount",
    fee: str = "shipment_fee",
    promo: str = "promo_amount",
    digits: int = 2,
) -> DataFrame:
    """The one-row overview of all transactions."""
    return df.agg(
        F.count("*").alias("total_transactions"),
        F.count_distinct(customer).alias("unique_customers"),
        near(F.avg(amount), digits).alias("avg_order_value"),
        near(F.min(amount), digits).alias("min_order_value"),
        near(F.max(amount), digits).alias("max_order_value"),
        near(F.sum(amount), digits).alias("total_revenue"),
        near(F.avg(fee), digits).alias("avg_shipment_fee"),
        near(F.avg(promo), digits).alias("avg_promo_amount"),
    )


def revenue_by(
    fact: DataFrame,
    dim: DataFrame,
    key: str,
    col: str,
    amount: str = "total_amount",
    order_id: str = "booking_id",
    top: int | None = None,
    digits: int = 2,
) -> DataFrame:
    """Orders, revenue and mean order value per attribute of the joined dimension.

    The fact is summed per key before the join: what crosses the network is one row per key
    and map task, and a key that holds much of the fact joins as a single row.
    """
    per_key = fact.groupBy(key).agg(
        F.count(order_id).alias("orders"), F.sum(amount).alias("revenue"), F.count(amount).alias("priced")
    )
    result = (
        per_key.join(dim.select(key, col), key)
        .groupBy(col)
        .agg(
            F.sum("orders").alias("num_orders"),
            near(F.sum("revenue"), digits).alias("total_revenue"),
            mean_of(F.sum("revenue"), F.sum("priced"), digits).alias("avg_order_value"),
        )
        .orderBy(F.desc("total_revenue"), col)
    )
    return result.limit(top) if top else result


def histogram(df: DataFrame, col: str | Column, bins: int = 40, digits: int = 2) -> DataFrame:
    """Equal-width histogram over [min, max]: ``bins`` rows, empty bins included.

    Bins are half-open but for the last, which holds the maximum. NULL, NaN and infinities are skipped. A
    column with one value gets a range one unit wide around it. Bin edges decide: a value
    that rounding put next to its bin is moved by one. The mean comes along on every row.
    """
    values = df.select(as_col(col).cast("double").alias("x")).where("abs(x) < double('inf')")
    half = F.when(F.min("x") == F.max("x"), 0.5).otherwise(0.0)
    limits = values.agg(
        F.struct(
            (F.min("x") - half).alias("lo"),
            (F.max("x") + half).alias("hi"),
            near(F.avg("x"), digits).alias("mean_value"),
        ).alias("limits")
    ).scalar()

    def edge(i: Column) -> Column:
        return F.col("lo") + i * ((F.col("hi") - F.col("lo")) / F.lit(float(bins)))

    last = F.lit(bins - 1).cast("bigint")
    scaled = (F.col("x") - F.col("lo")) / (F.col("hi") - F.col("lo")) * F.lit(float(bins))
    guess = F.least(F.floor(scaled), last)
    settled = (
        F.when(F.col("x") < edge(F.col("guess")), F.col("guess") - 1)
        .when((F.col("guess") < last) & (F.col("x") >= edge(F.col("guess") + 1)), F.col("guess") + 1)
        .otherwise(F.col("guess"))
    )
    counts = (
        values.withColumn("limits", limits)
        .select("x", "limits.lo", "limits.hi")
        .withColumn("guess", guess)
        .groupBy(settled.alias("bin"))
        .agg(F.count("*").alias("n"))
    )
    return (
        df.sparkSession.range(bins)
        .withColumnRenamed("id", "bin")
        .join(F.broadcast(counts), "bin", "left")  # at most ``bins`` rows
        .withColumn("limits", limits)
        .select("bin", "n", "limits.*")
        .select(
            "bin",
            near(edge(F.col("bin")), digits).alias("lower"),
            near(edge(F.col("bin") + 1), digits).alias("upper"),
            F.coalesce("n", F.lit(0)).alias("count"),
            "mean_value",
        )
        .orderBy("bin")
    )
