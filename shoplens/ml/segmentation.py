"""Customer segments by k-means."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import partial

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import GaussianMixture, KMeans, KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from shoplens.functions.columns import near
from shoplens.ml.attempts import attempt_all
from shoplens.operators.features import CUSTOMER_FEATURES
from shoplens.scratch import materialize

# The numbers of clusters tried.
KS = (3, 4, 5, 6, 8)
DEFAULT_K = 4


@dataclass
class Sweep:
    """Scores per k, the customers with the cluster that the best model gives them, and that model with its feature steps."""

    scores: DataFrame
    best_k: int
    assigned: DataFrame
    model: PipelineModel


def _feature_steps(cols: Sequence[str]) -> Pipeline:
    gathered = VectorAssembler(inputCols=list(cols), outputCol="raw_features")
    return Pipeline(stages=[gathered, StandardScaler(inputCol="raw_features", outputCol="features", withStd=True, withMean=False)])


def kmeans_sweep(
    features: DataFrame,
    cols: Sequence[str] = CUSTOMER_FEATURES,
    ks: Sequence[int] = KS,
    digits: int = 4,
    parallelism: int = 3,
) -> Sweep:
    """Fit one model per k, score each by silhouette and keep the best.

    A k that cannot be fitted is skipped and has no score; of equal scores the first k wins.
    The winner is the swept model itself, there is no second fit. If no k scored, the default
    number of clusters is fitted unscored.
    """
    spark = features.sparkSession
    stored = materialize(features, "customer-features")
    steps = _feature_steps(cols).fit(stored)
    scaled = steps.transform(stored)
    vectors = scaled.select("features").persist(StorageLevel.MEMORY_AND_DISK)
    silhouette = ClusteringEvaluator(featuresCol="features", predictionCol="cluster", metricName="silhouette")

    def fit(k: int) -> KMeansModel:
        # In blocks: the same steps, but rows are unpacked once a fit and distances are products of matrices.
        return KMeans(featuresCol="features", predictionCol="cluster", k=k, seed=42, maxIter=20, solver="block").fit(vectors)

    def fit_and_score(k: int) -> tuple[KMeansModel, float]:
        model = fit(k)
        return model, silhouette.evaluate(model.transform(vectors))

    try:
        fits = {k: partial(fit_and_score, k) for k in ks}
        scored, errors = attempt_all(spark, fits, parallelism)
        best_k = max(scored, key=lambda k: scored[k][1], default=DEFAULT_K)
        best = scored[best_k][0] if scored else fit(best_k)
    finally:
        vectors.unpersist()
    table = spark.createDataFrame(
        [(k, round(scored[k][1], digits) if k in scored else None, errors.get(k), k == best_k) for k in ks],
        "k INT, silhouette_score DOUBLE, error STRING, is_best BOOLEAN",
    )
    model = PipelineModel([*steps.stages, best])
    return Sweep(table, best_k, assign(model, stored), model)


def save_segments(model: PipelineModel, path: str) -> str:
    """Store the model of a sweep, feature steps included, and return the path."""
    model.write().overwrite().save(path)
    return path


def load_segments(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def assign(model: PipelineModel, features: DataFrame) -> DataFrame:
    """``features`` with the cluster that a kept model gives each row, be it of the fit or new; nothing is fitted again."""
    return model.transform(features).drop("raw_features", "features")


def centre_distances(model: PipelineModel) -> Column:
    """Array of a row's squared distances to the model's centres, by cluster, from the feature columns and the model's numbers alone.

    A feature without spread in the fit counts nothing, as in the scaling of the model.
    """
    gathered, scaler, kmeans = model.stages
    cols = gathered.getInputCols()
    scale = [1 / spread if spread > 0 else 0.0 for spread in scaler.std]
    parts = [[(F.col(c) * by - float(at)) ** 2 for c, by, at in zip(cols, scale, centre)] for centre in kmeans.clusterCenters()]
    return F.array(*[sum(squares[1:], squares[0]) for squares in parts])


def gaussian_mixture(features: DataFrame, cols: Sequence[str] = CUSTOMER_FEATURES, k: int = DEFAULT_K, seed: int = 42) -> DataFrame:
    """Soft segments: ``features`` with the likeliest of k Gaussian components and its probability."""
    stored = materialize(features, "customer-features")
    steps = _feature_steps(cols).fit(stored)
    scaled = steps.transform(stored)
    model = GaussianMixture(featuresCol="features", predictionCol="cluster", probabilityCol="chances", k=k, seed=seed, maxIter=20).fit(scaled)
    chance = F.array_max(vector_to_array("chances"))
    return model.transform(scaled).withColumn("probability", chance).drop("raw_features", "features", "chances")


def cluster_profile(assigned: DataFrame) -> DataFrame:
    """Size and mean behaviour of each cluster."""
    return (
        assigned.groupBy("cluster")
        .agg(
            F.count("*").alias("num_customers"),
            near(F.avg("total_spend"), 2).alias("avg_total_spend"),
            near(F.avg("num_transactions"), 2).alias("avg_transactions"),
            near(F.avg("avg_order_value"), 2).alias("avg_order_value"),
            near(F.avg("num_sessions"), 2).alias("avg_sessions"),
            near(F.avg("promo_usage_rate"), 4).alias("avg_promo_rate"),
        )
        .orderBy("cluster")
    )


def cluster_crosstab(assigned: DataFrame, col: str) -> DataFrame:
    """Customers per cluster and value of ``col``."""
    return (
        assigned.groupBy("cluster", col).agg(F.count("*").alias("count")).orderBy("cluster", F.desc("count"), col)
    )


def cluster_assignments(assigned: DataFrame) -> DataFrame:
    """Each customer's cluster with the figures behind it."""
    return assigned.select(
        "customer_id",
        "cluster",
        "total_spend",
        "num_transactions",
        "avg_order_value",
        "num_sessions",
        "promo_usage_rate",
        "device_type",
        "gender",
    )
