"""Three classifiers for the payment outcome, and their scores."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import partial, reduce

from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from shoplens.ml.attempts import attempt_all
from shoplens.ml.ranking import exact_auc
from shoplens.operators.features import CLASSES, fold_of, sample_to_budget, split_part, with_class_weight
from shoplens.scratch import materialize

NUMERIC = ("total_amount", "shipment_fee", "promo_amount", "has_promo")
CATEGORICAL = ("payment_method", "device_type", "gender")

# Model names and their settings.
MODELS = {
    "Logistic Regression": (LogisticRegression, {"maxIter": 20}),
    "Random Forest": (RandomForestClassifier, {"numTrees": 20, "seed": 42}),
    "Gradient-Boosted Trees": (GBTClassifier, {"maxIter": 10, "seed": 42}),
}
WEIGHTED = ("Logistic Regression", "Gradient-Boosted Trees")

METRICS = ("auc", "f1", "precision", "recall", "accuracy")


@dataclass
class Classifiers:
    """The shared feature steps, the fitted models and what went wrong with the others."""

    preparation: PipelineModel
    models: dict[str, Transformer]
    errors: dict[str, str]


def _slug(name: str) -> str:
    return name.replace(" ", "_").replace("-", "_").lower()


def prepare(
    features: DataFrame,
    key: str | Sequence[str],
    positive: str = "Failed",
    classes: Sequence[str] = CLASSES,
    frac: float = 0.8,
    budget: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Label, class weight and a repeatable split, from a stored copy of the features.

    The positive class is named, not left to which label is rarer. The joins behind the
    features run once; the class counts then read one column of the stored copy. The side of a
    row is stored too: each pass of the feature steps reads it, none hashes the keys again. All rows
    are used unless a ``budget`` of rows is given.
    """
    label = F.when(F.col("payment_status") == positive, 1.0).otherwise(0.0)
    labelled = features.withColumn("label", label)
    stored = materialize(labelled.withColumn("_part", split_part(labelled, key, frac)), "classification-features")
    used = sample_to_budget(stored, key, budget) if budget else stored
    weighted = with_class_weight(used, "payment_status", classes)
    return tuple(weighted.where(F.col("_part") == part).drop("_part") for part in ("train", "test"))


def feature_steps() -> Pipeline:
    indexed = [f"{c}_idx" for c in CATEGORICAL]
    return Pipeline(
        stages=[
            StringIndexer(inputCols=list(CATEGORICAL), outputCols=indexed, handleInvalid="keep"),
            VectorAssembler(inputCols=[*NUMERIC, *indexed], outputCol="raw_features"),
            StandardScaler(inputCol="raw_features", outputCol="features", withStd=True, withMean=False),
        ]
    )


def fit_classifiers(
    train: DataFrame, weighted: Sequence[str] = WEIGHTED, parallelism: int = 3
) -> Classifiers:
    """Fit every model on one prepared, persisted feature table.

    ``weighted`` names the models that see the class weights. A model that cannot be fitted is
    recorded with its error and does not stop the others.
    """
    preparation = feature_steps().fit(train)
    ready = preparation.transform(train).select("features", "label", "class_weight")
    ready.persist(StorageLevel.MEMORY_AND_DISK)

    def fit(name: str) -> Transformer:
        kind, settings = MODELS[name]
        weight = {"weightCol": "class_weight"} if name in weighted else {}
        model = kind(featuresCol="features", labelCol="label", **settings, **weight)
        model.setPredictionCol(f"prediction_{_slug(name)}")
        model.setRawPredictionCol(f"raw_{_slug(name)}")
        model.setProbabilityCol(f"probability_{_slug(name)}")
        return model.fit(ready)

    try:
        fits = {name: partial(fit, name) for name in MODELS}
        models, errors = attempt_all(train.sparkSession, fits, parallelism)
    finally:
        ready.unpersist()
    return Classifiers(preparation, models, errors)


def save_classifiers(fitted: Classifiers, path: str) -> str:
    """Store the feature steps and all models that were fitted, as one pipeline, and return the path."""
    PipelineModel([fitted.preparation, *fitted.models.values()]).write().overwrite().save(path)
    return path


def load_classifiers(path: str) -> Classifiers:
    """What ``save_classifiers`` stored, to score new rows; errors of the fit are not kept."""
    preparation, *models = PipelineModel.load(path).stages
    by_column = {m.getPredictionCol(): m for m in models}
    return Classifiers(preparation, {n: by_column[p] for n in MODELS if (p := f"prediction_{_slug(n)}") in by_column}, {})


def score(fitted: Classifiers, test: DataFrame) -> DataFrame:
    """The test rows with the raw score and prediction of every model, in one pass."""
    scored = fitted.preparation.transform(test)
    kept = ["payment_status", "label"]
    for name, model in fitted.models.items():
        scored = model.transform(scored)
        kept += [f"raw_{_slug(name)}", f"prediction_{_slug(name)}"]
    return scored.select(*kept)


def confusion(fitted: Classifiers, scored: DataFrame) -> DataFrame:
    """Rows per model, true status and prediction."""
    outcomes = F.array(
        *[
            F.struct(F.lit(name).alias("model"), F.col(f"prediction_{_slug(name)}").alias("prediction"))
            for name in fitted.models
        ]
    )
    return (
        scored.select("payment_status", "label", F.inline(outcomes))
        .groupBy("model", "payment_status", "label", "prediction")
        .agg(F.count("*").alias("count"))
    )


def metrics_from_confusion(cells: DataFrame) -> DataFrame:
    """F1, precision and recall weighted by class size, and accuracy, from confusion counts."""
    hits = F.sum(F.when(F.col("label") == F.col("prediction"), F.col("count")).otherwise(0))
    actual = cells.groupBy("model", "label").agg(F.sum("count").alias("actual"), hits.alias("hit"))
    predicted = cells.groupBy("model", F.col("prediction").alias("label")).agg(F.sum("count").alias("predicted"))
    per_class = (
        actual.join(predicted, ["model", "label"], "left")
        .withColumn("precision", F.coalesce(F.col("hit") / F.col("predicted"), F.lit(0.0)))
        .withColumn("recall", F.col("hit") / F.col("actual"))
        .withColumn("both", F.col("precision") + F.col("recall"))
        .withColumn(
            "f1", F.when(F.col("both") > 0, 2 * F.col("precision") * F.col("recall") / F.col("both")).otherwise(0.0)
        )
    )

    def by_size(measure: str):
        return (F.sum(F.col("actual") * F.col(measure)) / F.sum("actual")).alias(measure)

    return per_class.groupBy("model").agg(
        by_size("f1"), by_size("precision"), by_size("recall"), (F.sum("hit") / F.sum("actual")).alias("accuracy")
    )


def model_scores(fitted: Classifiers, scored: DataFrame) -> DataFrame:
    """model, label and score: a row for each test row and model."""
    raw = [(name, vector_to_array(f"raw_{_slug(name)}")) for name in fitted.models]
    return scored.select("label", F.inline(F.array(*[F.struct(F.lit(name).alias("model"), v[1].alias("score")) for name, v in raw])))


def classifier_metrics(fitted: Classifiers, scored: DataFrame, digits: int = 4) -> DataFrame:
    """AUC, F1, precision, recall and accuracy per model.

    A model that could not be fitted or has no rows to be judged by scores zero and carries its error. Without rows of
    both classes the AUC is zero.
    """
    spark = scored.sparkSession
    scored = scored.persist(StorageLevel.MEMORY_AND_DISK)

    try:
        cells = metrics_from_confusion(confusion(fitted, scored)).collect() if fitted.models else []
        others = {r["model"]: r for r in cells}
        areas = {r["model"]: r["auc"] for r in exact_auc(model_scores(fitted, scored)).collect()} if fitted.models else {}
    finally:
        scored.unpersist()
    rows, errors = [], {}
    for name in fitted.models:
        if name not in others:  # no test rows
            errors[name] = "no rows to evaluate"
            continue
        measures = [areas.get(name) or 0.0, *(others[name][m] for m in METRICS[1:])]
        rows.append((name, *(round(m, digits) for m in measures), None))
    for name, error in {**errors, **fitted.errors}.items():
        rows.append((name, *(0.0 for _ in METRICS), error))
    columns = ", ".join(f"{m} DOUBLE" for m in METRICS)
    return spark.createDataFrame(rows, f"model STRING, {columns}, error STRING")


def cross_validate(
    features: DataFrame,
    key: str | Sequence[str],
    name: str = "Logistic Regression",
    positive: str = "Failed",
    classes: Sequence[str] = CLASSES,
    folds: int = 3,
    digits: int = 4,
) -> DataFrame:
    """One row per fold: the rows judged, and F1 and accuracy of a model that was fitted on the other folds.

    Folds hash the key. The features are stored once; the feature steps are fitted per fold, so nothing of a judged row
    is known to its model.
    """
    label = F.when(F.col("payment_status") == positive, 1.0).otherwise(0.0)
    marked = features.withColumn("label", label).withColumn("fold", fold_of(features, key, folds))
    stored = materialize(with_class_weight(marked, "payment_status", classes), "cross-validation")
    kind, settings = MODELS[name]
    weight = {"weightCol": "class_weight"} if name in WEIGHTED else {}
    cells = []
    for fold in range(folds):
        train, test = stored.where(F.col("fold") != fold), stored.where(F.col("fold") == fold)
        steps = feature_steps().fit(train)
        model = kind(featuresCol="features", labelCol="label", **settings, **weight).fit(steps.transform(train))
        judged = model.transform(steps.transform(test)).groupBy("label", "prediction").agg(F.count("*").alias("count"))
        cells.append(judged.withColumn("model", F.lit(fold)))
    counted = materialize(reduce(DataFrame.unionByName, cells), "folds")
    sizes = counted.groupBy("model").agg(F.sum("count").alias("test_rows"))
    scores = metrics_from_confusion(counted).select("model", *(F.round(m, digits).alias(m) for m in ("f1", "accuracy")))
    return sizes.join(scores, "model").select(F.col("model").alias("fold"), "test_rows", "f1", "accuracy").orderBy("fold")


def best_model(metrics: DataFrame) -> DataFrame:
    """The model with the highest F1 among those that scored at all."""
    return metrics.where("f1 > 0").orderBy(F.desc("f1"), "model").limit(1)
