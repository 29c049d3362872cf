"""Evaluation metrics as distributed aggregates (one-row DataFrames).

Nothing is collected: regression and confusion metrics are single-pass
sums; ROC-AUC and average precision need cumulative counts over the
score order, computed as a two-pass prefix sum over range partitions
(per-partition totals -> offsets -> local running sums), so no window
ever runs without a partition key over the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _d(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("double")


SUM_NAMES = ("_n", "_abs", "_sq", "_sqlog", "_absy")


def regression_sum_exprs(y, p) -> dict[str, Column]:
    """The five sums every regression metric is derived from."""
    yt, yp = _d(y), _d(p)
    err = yt - yp
    lg = F.log1p(F.greatest(yp, F.lit(0.0))) - F.log1p(F.greatest(yt, F.lit(0.0)))
    return {"_n": F.count(F.lit(1)), "_abs": F.sum(F.abs(err)), "_sq": F.sum(err * err),
            "_sqlog": F.sum(lg * lg), "_absy": F.sum(F.abs(yt))}


def regression_sums(df: DataFrame, y, p) -> list[Column]:
    return [c.alias(n) for n, c in regression_sum_exprs(y, p).items()]


def regression_from_sums(prefix: str = "") -> list[Column]:
    n = F.col("_n").cast("double")
    return [
        (F.col("_abs") / n).alias(f"{prefix}mae"),
        F.sqrt(F.col("_sq") / n).alias(f"{prefix}rmse"),
        F.sqrt(F.col("_sqlog") / n).alias(f"{prefix}rmsle"),
        F.when(F.col("_absy") > 0, F.col("_abs") / F.col("_absy"))
         .otherwise(F.lit(float("nan"))).alias(f"{prefix}wape"),
    ]


def regression_metrics(df: DataFrame, y: str, p: str, prefix: str = "") -> DataFrame:
    """MAE, RMSE, RMSLE (both sides clipped at 0), WAPE (NaN if sum|y| = 0)."""
    return df.agg(*regression_sums(df, y, p)).select(*regression_from_sums(prefix))


def confusion_metrics(df: DataFrame, label: str, prob: str, threshold: float = 0.5,
                      prefix: str = "") -> DataFrame:
    """Accuracy, precision, recall, F1 at prob >= threshold (zero_division = 0)."""
    pred = _d(prob) >= F.lit(threshold)
    pos = F.col(label) == 1
    agg = df.agg(
        F.count_if(pred & pos).alias("tp"), F.count_if(pred & ~pos).alias("fp"),
        F.count_if(~pred & pos).alias("fn"), F.count_if(~pred & ~pos).alias("tn"))
    tp, fp, fn, tn = [F.col(c).cast("double") for c in ("tp", "fp", "fn", "tn")]

    def div(a, b):
        return F.when(b > 0, a / b).otherwise(F.lit(0.0))

    return agg.select(
        div(tp + tn, tp + fp + fn + tn).alias(f"{prefix}accuracy"),
        div(tp, tp + fp).alias(f"{prefix}precision"),
        div(tp, tp + fn).alias(f"{prefix}recall"),
        div(2 * tp, 2 * tp + fp + fn).alias(f"{prefix}f1"),
    )


def score_cumulatives(df: DataFrame, label: str, score: str, partitions: int | None = None) -> DataFrame:
    """Per distinct score (descending): pos, neg, tp/fp = counts with score >= s.

    1. aggregate rows to distinct scores (partial aggregation);
    2. range-partition the distinct scores descending;
    3. per-partition totals (one row per partition) -> exclusive prefix
       offsets over that tiny table -> broadcast back;
    4. running sums inside each partition + offset.

    The range-partitioned distinct-score table is written once as a
    reliable checkpoint (one row per distinct score): the totals and the
    running sums both read the stored partition ids, so they agree by
    construction, also when an executor is lost and work is redone.
    """
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    g = df.groupBy(_d(score).alias("_s")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) != 1).alias("neg"))
    from ..session import materialize
    r = materialize(g.repartitionByRange(n, F.col("_s").desc()).withColumn("_pid", F.spark_partition_id()))
    totals = r.groupBy("_pid").agg(F.sum("pos").alias("_pt"), F.sum("neg").alias("_nt"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "_pid",
        F.coalesce(F.sum("_pt").over(before), F.lit(0)).alias("_po"),
        F.coalesce(F.sum("_nt").over(before), F.lit(0)).alias("_no"))
    local = Window.partitionBy("_pid").orderBy(F.col("_s").desc()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    cum = r.select("_pid", "_s", "pos", "neg",
                   F.sum("pos").over(local).alias("_cp"), F.sum("neg").over(local).alias("_cn"))
    j = cum.join(F.broadcast(offsets), "_pid")
    return j.select(F.col("_s").alias("score"), "pos", "neg",
                    (F.col("_cp") + F.col("_po")).alias("tp"),
                    (F.col("_cn") + F.col("_no")).alias("fp"))


def _ranking_columns(pos: Column, neg: Column) -> dict[str, Column]:
    return {"P": F.sum(pos), "N": F.sum(neg), "_pfp": F.sum(pos * F.col("fp")),
            "_pn": F.sum(pos * neg), "_ap": F.sum(pos * F.col("tp") / (F.col("tp") + F.col("fp")))}


def _ranking_results(prefix: str) -> list[Column]:
    pn = F.col("P") * F.col("N")
    return [
        F.when(pn > 0, (pn - F.col("_pfp") + 0.5 * F.col("_pn")) / pn).alias(f"{prefix}auc_roc"),
        F.when(F.col("P") > 0, F.col("_ap") / F.col("P")).alias(f"{prefix}pr_auc"),
    ]


def ranking_metrics(df: DataFrame, label: str, score: str, prefix: str = "",
                    partitions: int | None = None) -> DataFrame:
    """Exact ROC-AUC (ties count 1/2) and step-wise average precision.

    AUC = (P*N - sum(pos_s * fp_s) + sum(pos_s * neg_s)/2) / (P*N)
    AP  = sum(pos_s * tp_s / (tp_s + fp_s)) / P
    NULL when a class is missing (the metric is undefined).
    """
    c = score_cumulatives(df, label, score, partitions)
    pos, neg = F.col("pos").cast("double"), F.col("neg").cast("double")
    agg = c.agg(*[v.alias(k) for k, v in _ranking_columns(pos, neg).items()])
    return agg.select(*_ranking_results(prefix))


def classification_metrics(df: DataFrame, label: str, prob: str, threshold: float = 0.5,
                           prefix: str = "", partitions: int | None = None) -> DataFrame:
    """auc_roc, pr_auc, accuracy, precision, recall, f1 as one row.

    The confusion counts at the threshold are sums over the same distinct-
    score table (tp = positives with score >= threshold), so everything is
    one aggregate over it.
    """
    return _classification(score_cumulatives(df, label, prob, partitions), threshold, prefix)


def _classification(c: DataFrame, threshold: float, prefix: str, keys: list[str] = []) -> DataFrame:
    """The metrics of a table of cumulative counts, for every value of keys."""
    pos, neg = F.col("pos").cast("double"), F.col("neg").cast("double")
    above = F.col("score") >= F.lit(threshold)
    cols = _ranking_columns(pos, neg)
    cols["_tp"] = F.sum(F.when(above, pos).otherwise(0.0))
    cols["_fp"] = F.sum(F.when(above, neg).otherwise(0.0))
    agg = c.groupBy(*keys).agg(*[v.alias(k) for k, v in cols.items()])
    tp, fp = F.col("_tp"), F.col("_fp")
    fn, tn = F.col("P") - tp, F.col("N") - fp

    def div(a, b):
        return F.when(b > 0, a / b).otherwise(F.lit(0.0))

    return agg.select(
        *keys, *_ranking_results(prefix),
        div(tp + tn, F.col("P") + F.col("N")).alias(f"{prefix}accuracy"),
        div(tp, tp + fp).alias(f"{prefix}precision"),
        div(tp, tp + fn).alias(f"{prefix}recall"),
        div(2 * tp, 2 * tp + fp + fn).alias(f"{prefix}f1"),
    )


def score_cumulatives_by(df: DataFrame, keys: list[str], label: str, score: str, partitions: int | None = None) -> DataFrame:
    """score_cumulatives for every value of keys at once: one range partitioning holds all of them.

    A partition holds a range of (keys, score), so a key with many scores is
    spread over several, and one row per key and partition says what stands
    before it.  The number of jobs does not depend on the number of keys.
    """
    from ..session import materialize
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    g = df.groupBy(*keys, _d(score).alias("_s")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) != 1).alias("neg"))
    r = materialize(g.repartitionByRange(n, *keys, F.col("_s").desc()).withColumn("_pid", F.spark_partition_id()))
    before = Window.partitionBy(*keys).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = r.groupBy(*keys, "_pid").agg(F.sum("pos").alias("_pt"), F.sum("neg").alias("_nt")).select(
        *keys, "_pid", F.coalesce(F.sum("_pt").over(before), F.lit(0)).alias("_po"),
        F.coalesce(F.sum("_nt").over(before), F.lit(0)).alias("_no"))
    local = Window.partitionBy(*keys, "_pid").orderBy(F.col("_s").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cum = r.select(*keys, "_pid", "_s", "pos", "neg", F.sum("pos").over(local).alias("_cp"), F.sum("neg").over(local).alias("_cn"))
    return cum.join(offsets, [*keys, "_pid"]).select(
        *keys, F.col("_s").alias("score"), "pos", "neg",
        (F.col("_cp") + F.col("_po")).alias("tp"), (F.col("_cn") + F.col("_no")).alias("fp"))


def classification_metrics_by(df: DataFrame, keys: list[str], label: str, prob: str, threshold: float = 0.5,
                              partitions: int | None = None) -> DataFrame:
    """The row of classification_metrics for every value of keys, in a constant number of jobs."""
    return _classification(score_cumulatives_by(df, keys, label, prob, partitions), threshold, "", keys)


def regression_metrics_by(df: DataFrame, keys: list[str], y: str, p: str) -> DataFrame:
    """The row of regression_metrics for every value of keys, as one aggregate."""
    return df.groupBy(*keys).agg(*regression_sums(df, y, p)).select(*keys, *regression_from_sums())


def by_split(metrics: DataFrame, run: str = "run_name", split: str = "split") -> DataFrame:
    """One row per run: the metrics of split train and val side by side, with the split as prefix."""
    names = [c for c in metrics.columns if c not in (run, split)]
    return metrics.groupBy(run).agg(*[F.max(F.when(F.col(split) == s, F.col(c))).alias(f"{s}_{c}") for s in ("train", "val") for c in names])
