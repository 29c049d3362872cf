"""Hurdle combination, baseline, blend search and model comparison."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .metrics import SUM_NAMES, regression_from_sums, regression_sum_exprs

NONZERO_THRESHOLD = 0.5
# Hurdle weights of the blend search, 0, 0.05, ..., 1.
BLEND_WEIGHTS = [round(i / 20, 2) for i in range(0, 21)]


def hurdle_combine(df: DataFrame, p_col: str = "p_nonzero", cnt_col: str = "positive_count",
                   threshold: float = NONZERO_THRESHOLD) -> DataFrame:
    """soft = p * max(cnt, 0); hard = max(cnt, 0) if p >= threshold else 0."""
    p = F.col(p_col).cast("double")
    cnt = F.greatest(F.col(cnt_col).cast("double"), F.lit(0.0))
    return df.select("*", (p * cnt).alias("pred_soft"),
                     F.when(p >= threshold, cnt).otherwise(F.lit(0.0)).alias("pred_hard"))


def baseline_prediction(df: DataFrame, col: str = "product_purchase_count_last_month") -> DataFrame:
    return df.withColumn("pred_baseline", F.col(col).cast("double"))


def _blend(w: float, hard: str, base: str) -> Column:
    return F.greatest(F.lit(w) * F.col(hard) + F.lit(1.0 - w) * F.col(base), F.lit(0.0))


def metric_rows(df: DataFrame, y: str, preds: list[tuple[str, float | None, Column]]) -> DataFrame:
    """Regression metrics of many prediction columns in ONE pass over df.

    All sums are computed side by side in a single aggregate (no row
    fan-out), then the one wide row is unpivoted to one row per prediction.
    """
    aggs = [c.alias(f"{n}_{i}") for i, (_, _, p) in enumerate(preds)
            for n, c in regression_sum_exprs(y, p).items()]
    wide = df.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(label).alias("model"),
                              F.lit(w).cast("double").alias("w_hurdle"),
                              *[F.col(f"{n}_{i}").alias(n) for n in SUM_NAMES])
                     for i, (label, w, _) in enumerate(preds)])
    return wide.select(F.inline(rows)).select("model", "w_hurdle", *regression_from_sums(""))


def _blend_preds(hard: str, base: str, weights) -> list[tuple[str, float, Column]]:
    return [("blend", float(w), _blend(w, hard, base)) for w in weights]


def blend_search(df: DataFrame, y: str = "target_next_period", hard: str = "pred_hard",
                 base: str = "pred_baseline", weights=BLEND_WEIGHTS) -> DataFrame:
    """Metrics of clip(w*hard + (1-w)*baseline, 0) for every w (one pass)."""
    return metric_rows(df, y, _blend_preds(hard, base, weights)).drop("model")


def best_blend(blend: DataFrame) -> DataFrame:
    """Strictly smallest RMSE, the lowest weight on ties."""
    best = blend.agg(F.min_by(F.struct(*blend.columns), F.struct("rmse", "w_hurdle")).alias("b"))
    return best.select("b.*")


def model_comparison(df: DataFrame, y: str = "target_next_period", soft: str = "pred_soft",
                     hard: str = "pred_hard", base: str = "pred_baseline",
                     weights=BLEND_WEIGHTS) -> DataFrame:
    """hurdle_soft / hurdle_hard / baseline / ensemble x MAE, RMSE, RMSLE, WAPE.

    One pass over df: the sums of all 24 prediction columns come out of a
    single aggregate row; the ensemble is the blend with the smallest
    (rmse, w) picked inside that row (array_min over structs).
    """
    fixed = [("hurdle_soft", None, F.col(soft)), ("hurdle_hard", None, F.col(hard)),
             ("baseline", None, F.col(base))]
    preds = fixed + _blend_preds(hard, base, weights)
    aggs = [c.alias(f"{n}_{i}") for i, (_, _, p) in enumerate(preds)
            for n, c in regression_sum_exprs(y, p).items()]
    wide = df.agg(*aggs)

    def metrics_struct(i: int, w) -> Column:
        s = {n: F.col(f"{n}_{i}") for n in SUM_NAMES}
        cnt = s["_n"].cast("double")
        return F.struct(
            F.sqrt(s["_sq"] / cnt).alias("rmse"),
            F.lit(w).cast("double").alias("w_hurdle"),
            (s["_abs"] / cnt).alias("mae"),
            F.sqrt(s["_sqlog"] / cnt).alias("rmsle"),
            F.when(s["_absy"] > 0, s["_abs"] / s["_absy"]).otherwise(F.lit(float("nan"))).alias("wape"),
        )

    blend_best = F.array_min(F.array(*[metrics_struct(i, w) for i, (label, w, _) in enumerate(preds)
                                       if label == "blend"]))
    rows = [F.struct(F.lit(label).alias("model"), metrics_struct(i, None).alias("m"))
            for i, (label, _, _) in enumerate(fixed)]
    rows.append(F.struct(F.lit("ensemble").alias("model"), blend_best.alias("m")))
    out = wide.select(F.inline(F.array(*rows)))
    return out.select("model", "m.w_hurdle", "m.mae", "m.rmse", "m.rmsle", "m.wape")
