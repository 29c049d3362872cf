"""Sanity reports run after a load."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as X


def report_bronze_rows_per_month(bronze: DataFrame) -> DataFrame:
    return (bronze.groupBy("_load_month").agg(F.count(F.lit(1)).alias("rows"))
                  .orderBy("_load_month"))


def report_silver_rows_per_month(fct: DataFrame) -> DataFrame:
    return (fct.groupBy(X.format_month("event_date").alias("month"))
               .agg(F.count(F.lit(1)).alias("rows")).orderBy("month"))


def report_gold_rows_per_snapshot(product_features: DataFrame) -> DataFrame:
    return (product_features.groupBy("snapshot_date").agg(F.count(F.lit(1)).alias("products"))
                            .orderBy("snapshot_date"))


def report_orphan_products(session_start: DataFrame, product_features: DataFrame) -> DataFrame:
    """Distinct session-start products missing from product features (EXCEPT DISTINCT)."""
    a = session_start.select(F.col("first_product_id").alias("product_id")).distinct()
    b = product_features.select("product_id").distinct()
    return a.subtract(b).agg(F.count(F.lit(1)).alias("orphan_products"))


def report_latest_predictions(log: DataFrame, n: int = 5) -> DataFrame:
    """The n newest log rows (a top-k: the limit is the feature)."""
    return (log.orderBy(F.col("timestamp").desc(), F.col("user_id").desc())
               .limit(n)
               .select("timestamp", F.col("user_id").alias("product_id"), "prediction_score",
                       "model_version"))


def leaderboard_sort(board: DataFrame, metric: str, ascending: bool) -> DataFrame:
    """Sort a leaderboard by its metric, run_name as the tie-break."""
    m = F.col(metric).asc_nulls_last() if ascending else F.col(metric).desc_nulls_last()
    return board.orderBy(m, F.col("run_name").asc())


def leaderboard_rank(board: DataFrame, metric: str, ascending: bool, name: str) -> DataFrame:
    """Each run's place in the sorted leaderboard; a board has one row per configuration."""
    m = F.col(metric).asc_nulls_last() if ascending else F.col(metric).desc_nulls_last()
    return board.withColumn(name, F.row_number().over(Window.orderBy(m, F.col("run_name").asc())).cast("long"))


def best_of(board: DataFrame, metric: str, ascending: bool) -> DataFrame:
    return leaderboard_sort(board, metric, ascending).limit(1)
