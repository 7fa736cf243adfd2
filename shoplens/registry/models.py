"""Feature tables, samples, splits, classifiers and clusters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.functions.columns import near
from shoplens.ml import classification as c
from shoplens.ml import density as d
from shoplens.ml import segmentation as s
from shoplens.ml.ranking import exact_auc
from shoplens.operators import features as f
from shoplens.operators import history as h
from shoplens.operators import oversample as o
from shoplens.operators.clean import present
from shoplens.registry import bindings as b
from shoplens.registry.entries import query
from shoplens.scratch import scratch_path

# One fit per session and state of the tables serves all the queries that report on it.
_fitted: dict[tuple, tuple[c.Classifiers, DataFrame]] = {}
_swept: dict[tuple, s.Sweep] = {}


def forget_fits() -> None:
    """Make the next query fit again, as a timing run wants it."""
    _fitted.clear()
    _swept.clear()


def _state(spark: SparkSession, sf: str) -> tuple:
    """Changes when a table behind the features is written anew: its files with their sizes and times."""
    found = []
    for table in ("orders", "lineitem", "customer", "nation", "region"):
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{sf.rstrip('/')}/{table}.parquet")
        for status in path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path):
            found.append((status.getPath().toString(), status.getLen(), status.getModificationTime()))
    return spark.sparkContext.applicationId, tuple(sorted(found))


def _features(spark: SparkSession, sf: str) -> DataFrame:
    return f.classification_features(
        b.transactions(spark, sf), b.customers(spark, sf), (b.PAID, b.FAILED), keep=["booking_id"]
    )


def _classifiers(spark: SparkSession, sf: str) -> tuple[c.Classifiers, DataFrame]:
    key = _state(spark, sf)
    if key not in _fitted:
        train, test = c.prepare(_features(spark, sf), "booking_id", b.FAILED, (b.PAID, b.FAILED))
        fitted = c.fit_classifiers(train)
        _fitted[key] = fitted, c.score(fitted, test)
    return _fitted[key]


def _sweep(spark: SparkSession, sf: str) -> s.Sweep:
    key = _state(spark, sf)
    if key not in _swept:
        _swept[key] = s.kmeans_sweep(f.customer_features(b.transactions(spark, sf), b.customers(spark, sf), b.PAID))
    return _swept[key]


@query(f"""WITH {b.SQL_TRANSACTIONS}, {b.SQL_CUSTOMERS}
SELECT booking_id, total_amount, {b.near("shipment_fee", 6)} AS shipment_fee,
       {b.near("promo_amount", 6)} AS promo_amount,
       CASE WHEN promo_amount > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS has_promo,
       payment_method, device_type, gender, payment_status
FROM tx JOIN customers_v USING (customer_id)
WHERE payment_status IN ('F', 'O') AND total_amount IS NOT NULL AND payment_method IS NOT NULL""")
def classification_features(spark: SparkSession, sf: str) -> DataFrame:
    features = _features(spark, sf)
    return features.withColumns({col: near(col, 6) for col in ("shipment_fee", "promo_amount")})


@query(f"""WITH {b.SQL_TRANSACTIONS}, {b.SQL_CUSTOMERS},
spending AS (
    SELECT customer_id, sum(total_amount) AS spend, count(*) AS num_transactions, avg(total_amount) AS mean,
           count(DISTINCT session_id) AS num_sessions, sum(promo_amount) AS promo,
           count(DISTINCT payment_method) AS payment_methods_used
    FROM tx WHERE payment_status = 'F' GROUP BY 1)
SELECT customer_id, {b.near("spend", 6)} AS total_spend, num_transactions,
       {b.near("mean", 6)} AS avg_order_value, num_sessions,
       {b.near("promo", 6)} AS total_promo_used, payment_methods_used,
       {b.near("CASE WHEN spend > 0 THEN promo / spend ELSE 0.0::DOUBLE END", 6)} AS promo_usage_rate,
       device_type, gender
FROM spending JOIN customers_v USING (customer_id) WHERE spend IS NOT NULL""")
def customer_features(spark: SparkSession, sf: str) -> DataFrame:
    features = f.customer_features(b.transactions(spark, sf), b.customers(spark, sf), b.PAID)
    doubles = present(features, ["total_spend", "avg_order_value", "total_promo_used", "promo_usage_rate"])
    return features.withColumns({col: near(col, 6) for col in doubles})


# The hash behind splits and samples, and the feature rows it is applied to.
def _place(key: str, seed: int) -> str:
    return f"(('0x' || substr(md5('{seed}|' || {key}::VARCHAR), 1, 8))::BIGINT / 4294967296.0::DOUBLE)"


_LABELLED = f"""{b.SQL_TRANSACTIONS}, {b.SQL_CUSTOMERS},
labelled AS (
    SELECT booking_id, payment_status FROM tx JOIN customers_v USING (customer_id)
    WHERE payment_status IN ('F', 'O') AND total_amount IS NOT NULL AND payment_method IS NOT NULL)"""
_TEST_ROWS = f"(SELECT * FROM labelled WHERE {_place('booking_id', 42)} >= 0.8)"
_SEGMENTED = f"""{b.SQL_TRANSACTIONS}, {b.SQL_CUSTOMERS},
spending AS (
    SELECT customer_id, sum(total_amount) AS spend, count(*) AS num_transactions, avg(total_amount) AS mean,
           count(DISTINCT session_id) AS num_sessions, sum(promo_amount) AS promo
    FROM tx WHERE payment_status = 'F' GROUP BY 1),
segmented AS (SELECT * FROM spending JOIN customers_v USING (customer_id) WHERE spend IS NOT NULL)"""
_MODELS = "(VALUES ('Logistic Regression'), ('Random Forest'), ('Gradient-Boosted Trees')) m(model)"


@query(f"""WITH {_LABELLED}
SELECT booking_id, payment_status FROM labelled
WHERE {_place("booking_id", 7)} * (SELECT count(*) FROM labelled) < 50000""")
def sample_to_budget(spark: SparkSession, sf: str) -> DataFrame:
    """A budget of 50,000 labelled rows for fitting; a table below it comes back whole."""
    return f.sample_to_budget(_features(spark, sf), "booking_id", rows=50_000).select("booking_id", "payment_status")


@query(f"""WITH {b.SQL_ORDERS}
SELECT booking_id, CASE WHEN {_place("booking_id", 42)} < 0.8 THEN 'train' ELSE 'test' END AS part FROM orders_v""")
def train_test_split(spark: SparkSession, sf: str) -> DataFrame:
    orders = b.orders(spark, sf)
    return orders.select("booking_id", f.split_part(orders, "booking_id").alias("part"))


@query(f"""WITH {b.SQL_ORDERS},
sizes AS (SELECT payment_status, count(*) AS n FROM orders_v WHERE payment_status IN ('F', 'O') GROUP BY 1)
SELECT booking_id, payment_status FROM orders_v JOIN sizes USING (payment_status)
WHERE {_place("booking_id", 11)} * n < (SELECT min(n) FROM sizes)""")
def rebalanced_classes(spark: SparkSession, sf: str) -> DataFrame:
    classes = f.rebalance(b.orders(spark, sf), "payment_status", "booking_id", (b.PAID, b.FAILED))
    return classes.select("booking_id", "payment_status")


_SMOTE_COLS = ["total_amount", "shipment_fee", "promo_amount"]


@query(f"""WITH {_LABELLED},
usable AS (SELECT booking_id, payment_status, {_place("booking_id", 13)} AS place FROM labelled),
sizes AS (SELECT payment_status, count(*) AS n FROM usable GROUP BY 1),
ranked AS (
    SELECT booking_id, payment_status, n, (SELECT max(n) FROM sizes) - n AS lack,
           row_number() OVER (PARTITION BY payment_status ORDER BY place, booking_id) - 1 AS rank
    FROM usable JOIN sizes USING (payment_status))
SELECT booking_id, payment_status, lack // n + CASE WHEN rank < lack % n THEN 1 ELSE 0 END AS copies FROM ranked WHERE lack > 0""")
def smote_allotment(spark: SparkSession, sf: str) -> DataFrame:
    """How many synthetic rows each order of the smaller class seeds."""
    dealt = o.allotted(_features(spark, sf), "payment_status", "booking_id", _SMOTE_COLS, (b.PAID, b.FAILED))
    return dealt.select("booking_id", "payment_status", F.col("copies").cast("bigint").alias("copies"))


@query(f"""WITH {_LABELLED}, sizes AS (SELECT payment_status, count(*) AS n FROM labelled GROUP BY 1)
SELECT payment_status, n AS real_rows, (SELECT max(n) FROM sizes) - n AS synthetic_rows, (SELECT max(n) FROM sizes) AS all_rows FROM sizes""")
def smote_classes(spark: SparkSession, sf: str) -> DataFrame:
    """Class sizes after over-sampling, counted on the real and the synthetic rows themselves."""
    rows = o.oversampled(_features(spark, sf), "payment_status", "booking_id", _SMOTE_COLS, (b.PAID, b.FAILED))
    return rows.groupBy("payment_status").agg(
        F.count_if(~F.col("synthetic")).alias("real_rows"), F.count_if(F.col("synthetic")).alias("synthetic_rows"), F.count("*").alias("all_rows")
    )


@query(f"""WITH {_LABELLED}
SELECT model, true AS fitted, true AS measures_in_range, true AS accuracy_matches, count(*) AS test_rows
FROM {_MODELS}, {_TEST_ROWS} GROUP BY 1""")
def ml_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """The metrics held against their definition: measures lie in 0 to 1 and accuracy is that of the confusion counts."""
    fitted, scored = _classifiers(spark, sf)
    metrics = c.classifier_metrics(fitted, scored)
    hits = F.sum(F.when(F.col("label") == F.col("prediction"), F.col("count")).otherwise(0))
    counted = c.confusion(fitted, scored).groupBy("model").agg(F.sum("count").alias("test_rows"), hits.alias("hits"))
    in_range = [F.col(m).between(0.0, 1.0) for m in c.METRICS]
    return metrics.join(counted, "model").select(
        "model",
        F.col("error").isNull().alias("fitted"),
        (in_range[0] & in_range[1] & in_range[2] & in_range[3] & in_range[4]).alias("measures_in_range"),
        (F.abs(F.col("accuracy") - F.col("hits") / F.col("test_rows")) < 1e-4).alias("accuracy_matches"),
        "test_rows",
    )


@query(f"""WITH {_LABELLED}
SELECT model, payment_status, CASE WHEN payment_status = 'O' THEN 1.0 ELSE 0.0 END::DOUBLE AS label, count(*) AS "count"
FROM {_MODELS}, {_TEST_ROWS} GROUP BY 1, 2, 3""")
def ml_confusion(spark: SparkSession, sf: str) -> DataFrame:
    """Confusion counts summed over the predictions: each model has judged every test row once."""
    cells = c.confusion(*_classifiers(spark, sf))
    return cells.groupBy("model", "payment_status", "label").agg(F.sum("count").alias("count"))


@query(f"WITH {_LABELLED} SELECT 1::BIGINT AS models, true AS highest_f1, count(*) AS test_rows FROM {_TEST_ROWS}")
def ml_best_model(spark: SparkSession, sf: str) -> DataFrame:
    """The chosen model, held against all metrics."""
    fitted, scored = _classifiers(spark, sf)
    metrics = c.classifier_metrics(fitted, scored)
    best = c.best_model(metrics).agg(F.count("*").alias("models"), F.max("f1").alias("best"))
    highest, judged = metrics.agg(F.max("f1")).scalar(), scored.agg(F.count("*")).scalar()
    return best.withColumns({"highest": highest, "test_rows": judged}).select(
        "models", (F.col("best") == F.col("highest")).alias("highest_f1"), "test_rows"
    )


@query(f"""WITH {_SEGMENTED}
SELECT k::INTEGER AS k, true AS scored, true AS best_is_highest, count(*) AS customers
FROM (VALUES {', '.join(f'({k})' for k in s.KS)}) t(k), segmented GROUP BY 1""")
def kmeans_sweep(spark: SparkSession, sf: str) -> DataFrame:
    """One row per k: its silhouette lies in -1 to 1, and it is the best just when no other is higher."""
    sweep = _sweep(spark, sf)
    top, customers = sweep.scores.agg(F.max("silhouette_score")).scalar(), sweep.assigned.agg(F.count("*")).scalar()
    return sweep.scores.withColumns({"top": top, "customers": customers}).select(
        "k",
        F.coalesce(F.col("silhouette_score").between(-1.0, 1.0), F.lit(False)).alias("scored"),
        (~F.col("is_best") | (F.col("silhouette_score") == F.col("top"))).alias("best_is_highest"),
        "customers",
    )


@query(f"""WITH {_SEGMENTED}
SELECT count(*) AS num_customers, sum(num_transactions)::BIGINT AS num_transactions, true AS best_k_clusters FROM segmented""")
def cluster_profile(spark: SparkSession, sf: str) -> DataFrame:
    """The profile summed over the clusters: all customers, and their transactions from the rounded means."""
    sweep = _sweep(spark, sf)
    profile = s.cluster_profile(sweep.assigned)
    exact = sweep.assigned.agg(F.sum("num_transactions")).scalar()
    total = F.sum(F.col("num_customers") * F.col("avg_transactions"))
    sums = profile.agg(
        F.sum("num_customers").alias("num_customers"), total.alias("near_total"), (F.count("*") == sweep.best_k).alias("best_k_clusters")
    )
    # The means carry two digits, so the total they give is right to half a hundredth per customer.
    close = F.abs(F.col("near_total") - F.col("exact")) <= F.col("num_customers") * 0.00501
    return sums.withColumn("exact", exact).select("num_customers", F.when(close, F.col("exact")).alias("num_transactions"), "best_k_clusters")


@query(f"""WITH {_SEGMENTED}
SELECT 'device_type' AS attribute, device_type AS value, count(*) AS "count" FROM segmented GROUP BY 2
UNION ALL SELECT 'gender', gender, count(*) FROM segmented GROUP BY 2""")
def cluster_crosstab(spark: SparkSession, sf: str) -> DataFrame:
    """The crosstabs summed over the clusters."""
    assigned = _sweep(spark, sf).assigned
    by_device = s.cluster_crosstab(assigned, "device_type").withColumnRenamed("device_type", "value")
    by_gender = s.cluster_crosstab(assigned, "gender").withColumnRenamed("gender", "value")
    both = by_device.withColumn("attribute", F.lit("device_type")).unionByName(by_gender.withColumn("attribute", F.lit("gender")))
    return both.groupBy("attribute", "value").agg(F.sum("count").alias("count"))


@query(f"""WITH {_SEGMENTED}
SELECT customer_id, {b.near("spend", 6)} AS total_spend, num_transactions, {b.near("mean", 6)} AS avg_order_value, num_sessions,
       {b.near("CASE WHEN spend > 0 THEN promo / spend ELSE 0.0::DOUBLE END", 6)} AS promo_usage_rate, device_type, gender,
       true AS has_cluster
FROM segmented""")
def cluster_assignments(spark: SparkSession, sf: str) -> DataFrame:
    """Each customer's figures, and that one of the clusters was given; which one is for k-means to say."""
    sweep = _sweep(spark, sf)
    given = F.coalesce(F.col("cluster").between(0, sweep.best_k - 1), F.lit(False)).alias("has_cluster")
    assigned = s.cluster_assignments(sweep.assigned).select("*", given).drop("cluster")
    return assigned.withColumns({col: near(col, 6) for col in ("total_spend", "avg_order_value", "promo_usage_rate")})


@query(f"""WITH {b.SQL_ORDERS}
SELECT customer_id, date_diff('day', max(created_at)::DATE, (SELECT max(created_at) FROM orders_v)::DATE) AS recency_days,
       date_diff('day', min(created_at)::DATE, max(created_at)::DATE) AS tenure_days, count(*) AS frequency,
       {b.near("sum(total_amount)", 6)} AS monetary
FROM orders_v WHERE payment_status = 'F' AND created_at IS NOT NULL AND customer_id IS NOT NULL GROUP BY 1""")
def recency_features(spark: SparkSession, sf: str) -> DataFrame:
    return f.recency_features(b.orders(spark, sf), b.PAID).withColumn("monetary", near("monetary", 6))


_PRIOR = "PARTITION BY customer_id ORDER BY created_at RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW EXCLUDE GROUP"


@query(f"""WITH {b.SQL_ORDERS},
prior AS (
    SELECT booking_id, customer_id, created_at, max(created_at) OVER w AS latest, count(*) OVER w AS prior_orders,
           coalesce(sum(total_amount) FILTER (payment_status = 'F') OVER w, 0) AS spend,
           count(*) FILTER (payment_status = 'O') OVER w AS failures
    FROM orders_v WHERE customer_id IS NOT NULL AND created_at IS NOT NULL WINDOW w AS ({_PRIOR}))
SELECT booking_id, customer_id, created_at, date_diff('day', latest::DATE, created_at::DATE) AS days_since_previous, prior_orders,
       {b.near("spend", 4)} AS prior_spend, {b.near("failures / nullif(prior_orders, 0)", 9)} AS prior_failure_share
FROM prior""")
def point_in_time_features(spark: SparkSession, sf: str) -> DataFrame:
    """What was known of the customer before each order."""
    known = h.point_in_time_features(b.orders(spark, sf), b.PAID, b.FAILED)
    return known.withColumns({"prior_spend": near("prior_spend", 4), "prior_failure_share": near("prior_failure_share", 9)})


_DENSE = (0.05, 8)


@query(f"""WITH RECURSIVE {_SEGMENTED},
scaled AS (
    SELECT DISTINCT customer_id, ln(1 + spend) AS x, ln(1 + mean) AS y FROM segmented),
near AS (
    SELECT p.customer_id AS a, q.customer_id AS b FROM scaled p JOIN scaled q
    ON q.x BETWEEN p.x - {_DENSE[0]} AND p.x + {_DENSE[0]} AND (p.x - q.x) * (p.x - q.x) + (p.y - q.y) * (p.y - q.y) <= {_DENSE[0]}::DOUBLE * {_DENSE[0]}::DOUBLE),
core AS (SELECT a AS id FROM near GROUP BY 1 HAVING count(*) >= {_DENSE[1]}),
links AS (SELECT a, b FROM near WHERE a IN (FROM core) AND b IN (FROM core)),
reach(id, other) USING KEY (id) AS (
    SELECT id, id FROM core
    UNION SELECT a, min(reach.other) FROM links JOIN reach ON reach.id = b JOIN recurring.reach AS own ON own.id = a
    WHERE reach.other < own.other GROUP BY a),
segments AS (SELECT id, other AS segment FROM reach)
SELECT customer_id, min(segment) AS segment, customer_id IN (FROM core) AS is_core
FROM segmented LEFT JOIN near ON a = customer_id LEFT JOIN segments ON id = b AND (a = b OR a NOT IN (FROM core))
GROUP BY 1""")
def density_segments(spark: SparkSession, sf: str) -> DataFrame:
    """Customers in dense places of spend and order value, both as logarithms; the rest is noise."""
    features = f.customer_features(b.transactions(spark, sf), b.customers(spark, sf), b.PAID).dropDuplicates(["customer_id"])
    logs = features.select("customer_id", F.log1p("total_spend").alias("x"), F.log1p("avg_order_value").alias("y"))
    return d.dbscan(logs, "customer_id", ["x", "y"], *_DENSE)


@query(f"""WITH {_LABELLED}
SELECT floor({_place("booking_id", 5)} * 3)::INTEGER AS fold, count(*) AS test_rows, true AS measures_in_range FROM labelled GROUP BY 1""")
def cross_validation(spark: SparkSession, sf: str) -> DataFrame:
    folds = c.cross_validate(_features(spark, sf), "booking_id", positive=b.FAILED, classes=(b.PAID, b.FAILED))
    in_range = F.col("f1").between(0.0, 1.0) & F.col("accuracy").between(0.0, 1.0)
    return folds.select("fold", "test_rows", in_range.alias("measures_in_range"))


@query(f"""WITH {_SEGMENTED}
SELECT customer_id, num_transactions, num_sessions, device_type, gender, true AS has_component FROM segmented""")
def gaussian_segments(spark: SparkSession, sf: str) -> DataFrame:
    """Each customer with a component whose probability is at least an equal share."""
    segments = s.gaussian_mixture(f.customer_features(b.transactions(spark, sf), b.customers(spark, sf), b.PAID))
    sound = F.col("cluster").between(0, s.DEFAULT_K - 1) & F.col("probability").between(1 / s.DEFAULT_K - 1e-9, 1 + 1e-9)
    return segments.select("customer_id", "num_transactions", "num_sessions", "device_type", "gender", sound.alias("has_component"))


@query(f"""WITH {_SEGMENTED} SELECT customer_id, num_transactions, true AS has_nearest_centre FROM segmented
WHERE {_place("customer_id", 42)} >= 0.8""")
def kept_segments(spark: SparkSession, sf: str) -> DataFrame:
    """A stored and reloaded model gives customers that were not in its fit the cluster whose centre is nearest."""
    features = f.customer_features(b.transactions(spark, sf), b.customers(spark, sf), b.PAID)
    known, new = f.train_test_split(features, "customer_id")
    path = s.save_segments(s.kmeans_sweep(known, ks=(s.DEFAULT_K,)).model, scratch_path(spark, "segments"))
    model = s.load_segments(path)
    assigned = s.assign(model, new).withColumn("far", s.centre_distances(model))
    # The last bits of the two ways to compute a distance differ.
    nearest = F.col("far")[F.col("cluster")] <= F.array_min("far") * (1 + 1e-9) + 1e-9
    return assigned.select("customer_id", "num_transactions", nearest.alias("has_nearest_centre"))


_MEASURES = ("total_amount", "shipment_fee", "promo_amount")


@query(f"""WITH {b.SQL_TRANSACTIONS},
scored AS (
    SELECT m AS measure, payment_status = 'O' AS failed, CASE m {" ".join(f"WHEN '{m}' THEN {b.near(m)}" for m in _MEASURES)} END AS score
    FROM tx, (VALUES {", ".join(f"('{m}')" for m in _MEASURES)}) t(m) WHERE payment_status IN ('F', 'O')),
ranked AS (
    SELECT *, rank() OVER (PARTITION BY measure ORDER BY score) + (count(*) OVER (PARTITION BY measure, score) - 1) / 2 AS place
    FROM scored WHERE score IS NOT NULL)
SELECT measure, count(*) FILTER (failed) AS positives, count(*) FILTER (NOT failed) AS negatives,
       {b.near("(sum(place) FILTER (failed) - positives * (positives + 1) / 2) / (positives * negatives)", 9)} AS auc
FROM ranked GROUP BY 1""")
def measure_auc(spark: SparkSession, sf: str) -> DataFrame:
    """How well each amount of an order, by itself, ranks failed payments above paid ones: the exact area under the curve."""
    tx = b.transactions(spark, sf).where(F.col("payment_status").isin(b.PAID, b.FAILED))
    label = F.when(F.col("payment_status") == b.FAILED, 1.0).otherwise(0.0).alias("label")
    each = F.array(*[F.struct(F.lit(m).alias("measure"), near(m, 2).alias("score")) for m in _MEASURES])
    return exact_auc(tx.select(label, F.inline(each)), by="measure").withColumn("auc", near("auc", 9))
