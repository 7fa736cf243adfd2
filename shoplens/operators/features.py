"""Feature tables, class weights, splits and samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplens.functions.columns import count_where, flag_positive, hash_unit, safe_ratio

CLASSES = ("Success", "Failed")
CUSTOMER_FEATURES = (
    "total_spend",
    "num_transactions",
    "avg_order_value",
    "num_sessions",
    "promo_usage_rate",
    "payment_methods_used",
)


def classification_features(
    tx: DataFrame, customers: DataFrame, classes: Sequence[str] = CLASSES, keep: Sequence[str] = ()
) -> DataFrame:
    """One row per paid or failed transaction with what is known about it and its customer.

    ``keep`` names extra columns to carry along, such as the key to split on.
    """
    usable = tx.where(
        F.col("payment_status").isin(*classes)
        & F.col("total_amount").isNotNull()
        & F.col("payment_method").isNotNull()
    )
    return (
        usable.join(customers.select("customer_id", "device_type", "gender"), "customer_id")
        .fillna({"promo_amount": 0.0, "shipment_fee": 0.0})
        .withColumn("has_promo", flag_positive("promo_amount"))
        .select(
            *keep,
            "total_amount",
            "shipment_fee",
            "promo_amount",
            "has_promo",
            "payment_method",
            "device_type",
            "gender",
            "payment_status",
        )
    )


def customer_features(tx: DataFrame, customers: DataFrame, paid: str = "Success") -> DataFrame:
    """Buying behaviour of each customer with a successful transaction.

    Transactions are aggregated first; the join then sees one row per customer.
    """
    behaviour = (
        tx.where(F.col("payment_status") == paid)
        .groupBy("customer_id")
        .agg(
            F.sum("total_amount").alias("total_spend"),
            F.count("*").alias("num_transactions"),
            F.avg("total_amount").alias("avg_order_value"),
            F.count_distinct("session_id").alias("num_sessions"),
            F.sum("promo_amount").alias("total_promo_used"),
            # Few methods exist, so their set is small; a second distinct count would triple the rows.
            F.size(F.collect_set("payment_method")).cast("bigint").alias("payment_methods_used"),
        )
        .withColumn("promo_usage_rate", safe_ratio("total_promo_used", "total_spend"))
    )
    known = customers.select("customer_id", "device_type", "gender")
    return behaviour.join(known, "customer_id").dropna(subset=list(CUSTOMER_FEATURES))


def class_weights(df: DataFrame, label: str, classes: Sequence[str] = CLASSES) -> DataFrame:
    """Rows and balanced weight, rows / (classes * rows of the class), of each class present."""
    found = df.where(F.col(label).isin(*classes)).groupBy(label).agg(F.count("*").alias("class_count"))
    totals = found.agg(F.struct(F.sum("class_count").alias("n"), F.count("*").alias("k"))).scalar()
    weight = F.col("t.n") / (F.col("t.k") * F.col("class_count").cast("double"))
    return found.withColumn("t", totals).select(label, "class_count", weight.alias("class_weight"))


def with_class_weight(
    df: DataFrame, label: str, classes: Sequence[str] = CLASSES, out: str = "class_weight"
) -> DataFrame:
    """Add the balanced weight of each row's class; a row of another class gets 1.0.

    The weights come from one aggregate with a counter per class, as a scalar subquery. No
    join on the label, which would send most rows to a single task.
    """
    counts = [count_where(F.col(label) == c) for c in classes]
    present = sum((F.when(n > 0, 1.0).otherwise(0.0) for n in counts[1:]), F.when(counts[0] > 0, 1.0).otherwise(0.0))
    total = sum(counts[1:], counts[0])
    weights = df.agg(
        F.struct(
            *[
                (total.cast("double") / F.nullif(present * n, F.lit(0.0))).alias(f"w{i}")
                for i, n in enumerate(counts)
            ]
        )
    ).scalar()
    chosen: Column = F.lit(1.0)
    for i, c in reversed(list(enumerate(classes))):
        chosen = F.when(F.col(label) == c, F.col("_weights")[f"w{i}"]).otherwise(chosen)
    return df.withColumn("_weights", weights).withColumn(out, F.coalesce(chosen, F.lit(1.0))).drop("_weights")


def train_test_split(
    df: DataFrame, key: str | Sequence[str], frac: float = 0.8, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """Split by a hash of the key: the same rows on either side however Spark partitions them."""
    part = split_part(df, key, frac, seed)
    return df.where(part == "train"), df.where(part == "test")


def split_part(df: DataFrame, key: str | Sequence[str], frac: float = 0.8, seed: int = 42) -> Column:
    """The side, "train" or "test", of each row of ``train_test_split``; for both sides in one scan."""
    return F.when(_place(df, key, seed) < frac, "train").otherwise("test")


def fold_of(df: DataFrame, key: str | Sequence[str], folds: int = 3, seed: int = 5) -> Column:
    """The fold, from 0, that a hash of the key puts each row in."""
    return F.floor(_place(df, key, seed) * folds).cast("int")


def _place(df: DataFrame, key: str | Sequence[str], seed: int) -> Column:
    """Hash of the key, which may be several columns; rows without any of them are spread by all their values."""
    keys = [key] if isinstance(key, str) else list(key)
    known = F.coalesce(*[F.col(k).cast("string") for k in keys]).isNotNull()
    return F.when(known, hash_unit(*keys, seed=seed)).otherwise(
        hash_unit(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])), seed=seed)
    )


def sample_to_budget(df: DataFrame, key: str | Sequence[str], rows: int, seed: int = 7) -> DataFrame:
    """About ``rows`` rows, picked by a hash of the key; all of them if the table is smaller.

    The seed differs from the split's, or a small sample would lie on one side of it.
    """
    total = df.agg(F.count("*")).scalar()
    return df.where(_place(df, key, seed) * total < F.lit(float(rows)))


def rebalance(df: DataFrame, label: str, key: str | Sequence[str], classes: Sequence[str] = CLASSES, seed: int = 11) -> DataFrame:
    """Rows of ``classes``, the larger ones thinned by a hash of the key to about the size of the smallest present.

    Rows of other classes are left out. The class sizes are one aggregate, used as a scalar subquery.
    """
    counts = df.agg(F.struct(*[count_where(F.col(label) == c).alias(f"n{i}") for i, c in enumerate(classes)])).scalar()
    sized = df.where(F.col(label).isin(*classes)).withColumn("_n", counts)
    sizes = [F.nullif(F.col(f"_n.n{i}"), F.lit(0)) for i in range(len(classes))]
    smallest = F.array_min(F.array(*sizes))
    own: Column = F.lit(None).cast("bigint")
    for i, c in enumerate(classes):
        own = F.when(F.col(label) == c, sizes[i]).otherwise(own)
    return sized.where(_place(df, key, seed) * own < smallest).drop("_n")


def recency_features(tx: DataFrame, paid: str = "Success") -> DataFrame:
    """Per customer: days since the last successful transaction, days between the first and the last, how many and how much.

    Days count to the newest transaction of the table, paid or not. One aggregate per customer; rows without customer or time
    are left out.
    """
    newest = tx.agg(F.max("created_at")).scalar()
    return (
        tx.where((F.col("payment_status") == paid) & F.col("created_at").isNotNull() & F.col("customer_id").isNotNull())
        .groupBy("customer_id")
        .agg(
            F.min("created_at").alias("first"), F.max("created_at").alias("last"),
            F.count("*").alias("frequency"), F.sum("total_amount").alias("monetary"),
        )
        .withColumn("newest", newest)
        .select(
            "customer_id",
            F.datediff("newest", "last").cast("bigint").alias("recency_days"),
            F.datediff("last", "first").cast("bigint").alias("tenure_days"),
            "frequency",
            "monetary",
        )
    )
