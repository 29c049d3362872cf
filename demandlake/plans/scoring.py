"""Batch scoring of demand requests (the serving path as a Spark job).

requests -> latest product features -> aligned feature matrix ->
hurdle soft prediction, or a fallback when no features / no model ->
prediction log rows.  Requests are joined, never looked up one by one.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as X
from ..operators import features as FE

# Fixed values of the serving contract.
SESSION_ID = "monthly_forecast_run"
VERSION_FALLBACK = "mock-v1"
VERSION_MODEL_ERROR = "mock-fallback"
DEFAULT_MODEL_VERSION = "hurdle-gbt-v1"
FALLBACK_LOW, FALLBACK_HIGH = 0.9, 1.1
REQUEST_COLUMNS = ["product_id", "brand", "category", "price", "prev_month_sales"]
SCORING_FEATURE_COLUMNS = [
    "product_id", "snapshot_date", "month", "week_of_year", "days_to_end_of_month",
    "product_category_l1", "product_price", "product_view_count_last_month",
    "product_cart_count_last_month", "product_purchase_count_last_month",
    "product_avg_price_last_month", "product_conversion_rate_last_month",
    "product_unique_buyers_last_month",
]


def latest_features_per_product(product_features: DataFrame) -> DataFrame:
    """Newest snapshot row of every product (top-1 per key).

    Rows per product = number of snapshots (bounded by months); Spark plans
    the rank filter as a WindowGroupLimit.
    """
    w = Window.partitionBy("product_id").orderBy(F.col("snapshot_date").desc())
    return product_features.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def scoring_features(product_features: DataFrame, calendar: DataFrame) -> DataFrame:
    latest = latest_features_per_product(product_features)
    return FE.join_snapshot_calendar(latest, calendar).select(*SCORING_FEATURE_COLUMNS)


class SnapshotFeatures:
    """Scoring features from the stored gold tables, as of the newest snapshot when they are asked for.

    A snapshot counts once its partition holds files: a run's write moves them
    there when it commits.
    """

    def __init__(self, product_features_path: str, calendar_path: str):
        self.product_features_path, self.calendar_path = product_features_path, calendar_path

    def newest(self, spark) -> str | None:
        """Date of the newest stored snapshot; read from folder names, so from one per month."""
        from ..sources import lake as L
        dates = [f.removeprefix("snapshot_date=") for f in L.list_folders(spark, self.product_features_path) if f.startswith("snapshot_date=")]
        for d in sorted(dates, reverse=True):
            if L.has_files(spark, f"{self.product_features_path}/snapshot_date={d}"):
                return d
        return None

    def at(self, spark, date: str) -> DataFrame:
        """Features as of the snapshot of date: later ones are not looked at."""
        known = spark.read.parquet(self.product_features_path).where(F.col("snapshot_date") <= F.to_date(F.lit(date)))
        return scoring_features(known, spark.read.parquet(self.calendar_path))


def scoring_lookup(requests: DataFrame, features: DataFrame) -> DataFrame:
    """Requests left-joined to features on the integer product id.

    A non-numeric id finds no features (has_features = false) and goes around
    the join, as all such requests would meet in one task.  Both sides grow
    with the data, so the join strategy is left to AQE's size checks.
    """
    feats = features.select(*[F.col(c).alias(f"f_{c}") for c in features.columns])
    req = requests.withColumn("_pid", X.safe_bigint("product_id"))
    j = req.where(F.col("_pid").isNotNull()).join(feats, F.col("_pid") == F.col("f_product_id"), "left").unionByName(
        req.where(F.col("_pid").isNull()), allowMissingColumns=True)
    return j.select(
        *REQUEST_COLUMNS,
        F.col("f_product_id").isNotNull().alias("has_features"),
        *[F.col(f"f_{c}").alias(c) for c in features.columns if c != "product_id"],
    )


def align_features(df: DataFrame, feature_names: list[str], category=None) -> DataFrame:
    """Same derived features as training, in the exact training order.

    category is the model's category encoding.  Unseen categories give
    all-zero dummies; features missing from the frame are 0.0.  Non-feature
    columns of df are kept in front.
    """
    base = category.transform(df.withColumn("_category", F.col("product_category_l1")), "_category") if category else df
    for c in FE.NUMERIC_COLS:
        base = base.withColumn(c, X.to_numeric_or_zero(c) if c in df.columns else F.lit(0.0))
    base = base.select("*", *FE.funnel_columns(), *FE.extended_columns())
    label = F.concat(F.lit(FE.CATEGORY_PREFIX), FE.category_label("product_category_l1"))
    cols: list[Column] = []
    for name in feature_names:
        if name.startswith(FE.CATEGORY_PREFIX):
            cols.append((label == F.lit(name)).cast("double").alias(name))
        elif name == FE.CATEGORY_VECTOR and category:
            cols += [F.col(name), F.col(FE.CATEGORY_INDEX)]
        elif name in base.columns:
            cols.append(F.col(name).cast("double").alias(name))
        else:
            cols.append(F.lit(0.0).alias(name))
    keep = [c for c in df.columns if c not in feature_names]
    return base.select(*keep, *cols)


def fallback_prediction(prev_month_sales: Column, key: Column, seed: int = 42) -> Column:
    """round(prev_month_sales * U(0.9, 1.1), 2) with a per-request hash draw."""
    u = X.uniform_from_key(key, seed)
    factor = F.lit(FALLBACK_LOW) + F.lit(FALLBACK_HIGH - FALLBACK_LOW) * u
    return F.round(prev_month_sales.cast("double") * factor, 2)


def score_requests(requests: DataFrame, features: DataFrame, model=None,
                   model_version: str = DEFAULT_MODEL_VERSION, seed: int = 42) -> DataFrame:
    """prediction_score and model_version per request.

    With a model and features: soft hurdle prediction.  Without features
    or without a model: fallback, 'mock-v1'.  A request that the model has no
    finite answer for, or raises on, takes the fallback as 'mock-fallback'; so
    do all requests with features if the model does not fit the frame at all.
    """
    looked = scoring_lookup(requests, features)
    fb = fallback_prediction(F.col("prev_month_sales"), F.col("product_id"), seed)
    hit = F.col("has_features")
    if model is None:
        return looked.select(*REQUEST_COLUMNS, "has_features", fb.alias("prediction_score"),
                             F.lit(VERSION_FALLBACK).alias("model_version"))
    try:
        aligned = align_features(looked, model.feature_names, getattr(model, "category", None))
        scored = getattr(model, "predict_soft_lenient", model.predict_soft)(aligned)
    except AnalysisException:  # a column that the model needs is missing or of another type
        scored = looked.withColumn("pred_soft", F.lit(None).cast("double"))
    answer = F.col("pred_soft")
    failed = answer.isNull() | F.isnan(answer) | (F.abs(answer) == F.lit(float("inf")))
    return scored.select(
        *REQUEST_COLUMNS, "has_features",
        F.when(hit & ~failed, answer).otherwise(fb).alias("prediction_score"),
        F.when(~hit, F.lit(VERSION_FALLBACK)).when(failed, F.lit(VERSION_MODEL_ERROR)).otherwise(F.lit(model_version)).alias("model_version"),
    )


def request_payload(cols=REQUEST_COLUMNS) -> Column:
    return F.to_json(F.struct(*[F.col(c) for c in cols]))


def prediction_log(scored: DataFrame, run_ts: str | None = None) -> DataFrame:
    """api_logs rows (+ log_date, the partition column)."""
    ts = F.to_timestamp(F.lit(run_ts)) if run_ts else F.current_timestamp()
    return scored.select(
        ts.alias("timestamp"),
        F.col("product_id").cast("string").alias("user_id"),
        F.lit(SESSION_ID).alias("session_id"),
        request_payload().alias("request_payload"),
        F.col("prediction_score").cast("double").alias("prediction_score"),
        F.col("model_version"),
    ).withColumn("log_date", F.to_date("timestamp"))


def append_prediction_log(log: DataFrame, path: str) -> None:
    """Append to the log table, partitioned by day."""
    from ..sources.lake import rebalance
    rebalance(log, "log_date").write.mode("append").partitionBy("log_date").parquet(path)
