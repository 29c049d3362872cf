"""Registry of queries: name -> (spark, sf_dir) -> DataFrame.

Each query derives its input from the given tables (fixtures A1/A2/A4),
runs the pipeline step it is named after and returns a DataFrame whose
column names and types match ``oracle.ORACLE_SQL[name]``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import session as S
from .operators import gold, silver
from .sources import fixtures as FX
from .sources import lake as L

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}

# Fixed value: the single-snapshot run date used for fixture A1 queries.
A1_SNAPSHOT = "1998-01-01"
# Fixed value: the snapshots of fixture A3.
A3_SNAPSHOTS = 12


def query(name: str):
    def deco(fn: QueryFn) -> QueryFn:
        def wrapped(spark: SparkSession, sf_dir: str) -> DataFrame:
            S.configure(spark)
            return finalize(fn(spark, sf_dir))
        wrapped.__name__ = name
        wrapped.__doc__ = fn.__doc__
        QUERIES[name] = wrapped
        return wrapped
    return deco


def finalize(df: DataFrame) -> DataFrame:
    """Output types shared with the oracle: decimals as double, ints as bigint."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        cols.append(c.alias(f.name))
    return df.select(*cols)


# ---------------------------------------------------------------- fixtures

def a1_fct(spark, sf_dir, with_loaded_at=False) -> DataFrame:
    return silver.fct_events(FX.a1_bronze(spark, sf_dir), with_loaded_at=with_loaded_at)


def a2_fct(spark, sf_dir, with_loaded_at=False) -> DataFrame:
    return silver.fct_events(FX.a2_bronze(spark, sf_dir), load_month=FX.A2_LOAD_MONTH,
                             with_loaded_at=with_loaded_at)


# ------------------------------------------------------------------ silver

@query("fct_events")
def q_fct_events(spark, sf_dir):
    """P-05: cleaned, typed, deduplicated events of every A1 month."""
    return a1_fct(spark, sf_dir)


@query("product_features_monthly")
def q_product_features_monthly(spark, sf_dir):
    """F-02 (flagship): product snapshot 2024-02-01 of the A2 clickstream month."""
    return gold.product_features_monthly(a2_fct(spark, sf_dir), FX.A2_SNAPSHOT)


# ------------------------------------------------------------ shared inputs

from .functions import scalars as X  # noqa: E402
from .operators import features as FE  # noqa: E402
from .operators import hurdle as H  # noqa: E402
from .operators import metrics as M  # noqa: E402
from .operators import quality as Q  # noqa: E402
from .operators import reports as R  # noqa: E402


def a1_bronze(spark, sf_dir):
    return FX.a1_bronze(spark, sf_dir)


def a1_parsed(spark, sf_dir):
    return silver.parse_events(a1_bronze(spark, sf_dir))


def a1_fct_table(spark, sf_dir) -> DataFrame:
    """Silver events written once to the checkpoint folder (for queries whose
    plan reads silver in several branches, as the lake table would be)."""
    return S.materialize(a1_fct(spark, sf_dir), L.COMPRESSION)


def a1_product_events(spark, sf_dir) -> DataFrame:
    """a1_fct_table with only the columns that product snapshots and the calendar read.

    The identity only breaks ties of time here.  It stands as its bytes, which
    order as their hexadecimal text does and take half its place in shuffles.
    """
    events = a1_fct(spark, sf_dir).withColumn("event_id", F.unhex("event_id"))
    return S.materialize(events.select(*gold.PRODUCT_EVENT_COLUMNS), L.COMPRESSION)


def a1_user_events(spark, sf_dir) -> DataFrame:
    """a1_fct_table with only the columns that user snapshots read."""
    return S.materialize(a1_fct(spark, sf_dir).select(*gold.USER_EVENT_COLUMNS), L.COMPRESSION)


def a1_calendar(spark, sf_dir):
    return silver.calendar_dates(a1_fct(spark, sf_dir))


def a1_sessions(spark, sf_dir):
    return silver.sessions(a1_fct(spark, sf_dir))


def a1_product_backfill(spark, sf_dir):
    return gold.product_features_backfill(a1_product_events(spark, sf_dir))


def a1_training(spark, sf_dir, fct: DataFrame | None = None, backfill: DataFrame | None = None):
    fct = fct if fct is not None else a1_product_events(spark, sf_dir)
    pf = backfill if backfill is not None else gold.product_features_backfill(fct)
    return FE.training_set(pf, silver.calendar_dates(fct))


def a1_features(spark, sf_dir, feature_set="extended", fct: DataFrame | None = None,
                backfill: DataFrame | None = None):
    """Training features, materialized once: the vocabulary, the split and
    the metrics all read the written frame."""
    training = a1_training(spark, sf_dir, fct, backfill)
    engineered = S.materialize(FE.add_engineered(FE.features_base(training), feature_set))
    return FE.one_hot_category(engineered, FE.category_vocabulary(engineered))


def a3_predictions(spark, sf_dir):
    """The last twelve snapshots with stand-in model outputs (fixture A3).

    x = purchases + (views + 2 * carts) / 16 + price / 65536 takes thousands of
    values; p_nonzero = x / (x + 1), positive_count = 1 + x, baseline = purchases.
    """
    engineered = S.materialize(FE.features_base(a1_training(spark, sf_dir)))
    df = FE.with_split(engineered, A3_SNAPSHOTS).where(F.col("split") == "val")
    pc = F.col("product_purchase_count_last_month")
    x = (pc + (F.col("product_view_count_last_month") + 2 * F.col("product_cart_count_last_month")) / 16
         + F.col("product_price") / 65536)
    df = df.select("product_id", "snapshot_date", "target_next_period", pc,
                   (F.col("target_next_period") > 0).cast("int").alias("label"),
                   (x / (x + 1)).alias("p_nonzero"), (x + 1).alias("positive_count"))
    return H.baseline_prediction(H.hurdle_combine(df))


def round_cols(df: DataFrame, cols, digits: int = 9) -> DataFrame:
    return df.select(*[F.round(c, digits).alias(c) if c in cols else F.col(c) for c in df.columns])


# ------------------------------------------------------------ bronze / silver

@query("bronze_load")
def q_bronze_load(spark, sf_dir):
    """S-02: bronze rows with lineage (the ingest clock excluded)."""
    return a1_bronze(spark, sf_dir).drop("_ingested_at")


@query("bronze_month_scan")
def q_bronze_month_scan(spark, sf_dir):
    """S-09: bronze pruned to one load month."""
    return silver.bronze_month_scan(a1_bronze(spark, sf_dir), "1998-01").drop("_ingested_at")


@query("parse_events")
def q_parse_events(spark, sf_dir):
    """P-01: raw strings to typed columns (before validation)."""
    return a1_parsed(spark, sf_dir)


@query("valid_events")
def q_valid_events(spark, sf_dir):
    """P-02: validity filter."""
    return silver.valid_events(a1_parsed(spark, sf_dir))


@query("dedup_events")
def q_dedup_events(spark, sf_dir):
    """W-01: newest valid copy per natural key."""
    return silver.dedup_events(silver.valid_events(a1_parsed(spark, sf_dir)))


@query("event_identity")
def q_event_identity(spark, sf_dir):
    """P-03: hashed event id next to its natural key."""
    return a1_fct(spark, sf_dir).select("event_id", *silver.NATURAL_KEY)


@query("category_levels")
def q_category_levels(spark, sf_dir):
    """P-04: category code split into three levels."""
    return a1_fct(spark, sf_dir).select("category_code", "category_l1", "category_l2", "category_l3").distinct()


@query("window_month_filter")
def q_window_month_filter(spark, sf_dir):
    """P-06: events of the calendar month before the snapshot."""
    fct = a1_fct(spark, sf_dir)
    return fct.where(gold.in_window(A1_SNAPSHOT)).select("event_id", "event_date", "event_type")


@query("history_filter")
def q_history_filter(spark, sf_dir):
    """P-07: purchase events strictly before the snapshot."""
    fct = gold.history(a1_fct(spark, sf_dir), A1_SNAPSHOT)
    return fct.where(F.col("event_type") == "purchase").select("event_id", "event_date", "user_id")


@query("calendar_dates")
def q_calendar_dates(spark, sf_dir):
    """P-08 / J-06: date spine of the events with its attributes."""
    return a1_calendar(spark, sf_dir)


@query("dim_calendar")
def q_dim_calendar(spark, sf_dir):
    """P-09: calendar republished to gold."""
    return silver.dim_calendar(silver.calendar_dates(a2_fct(spark, sf_dir)))


@query("session_event_rank")
def q_session_event_rank(spark, sf_dir):
    """W-02: rank of each event within its session."""
    events = a1_fct(spark, sf_dir).select("event_id", "event_ts", "user_session", "user_id")
    return silver.session_event_rank(events).drop("event_ts")


@query("sessions")
def q_sessions(spark, sf_dir):
    """F-01: session aggregate with the first event's attributes."""
    return a1_sessions(spark, sf_dir)


@query("sessions_clickstream")
def q_sessions_clickstream(spark, sf_dir):
    """F-01 on the A2 clickstream month."""
    return silver.sessions(a2_fct(spark, sf_dir))


@query("session_start")
def q_session_start(spark, sf_dir):
    """J-04: sessions joined to the calendar (hour, weekend)."""
    fct = a1_fct_table(spark, sf_dir)
    return silver.session_start(silver.sessions(fct), silver.calendar_dates(fct))


# ------------------------------------------------------------------ gold

@query("product_features_monthly_a1")
def q_product_features_a1(spark, sf_dir):
    """F-02 / J-01 on the multi-month store, one snapshot."""
    return gold.product_features_monthly(a1_product_events(spark, sf_dir), A1_SNAPSHOT)


@query("user_features_monthly")
def q_user_features(spark, sf_dir):
    """F-03 / J-02: user snapshot of the multi-month store."""
    return gold.user_features_monthly(a1_user_events(spark, sf_dir), A1_SNAPSHOT)


@query("user_features_clickstream")
def q_user_features_a2(spark, sf_dir):
    """F-03 on the A2 clickstream month."""
    return gold.user_features_monthly(a2_fct(spark, sf_dir), FX.A2_SNAPSHOT)


@query("user_product_interactions_monthly")
def q_interactions(spark, sf_dir):
    """F-04 / J-03 / F-06: user-product snapshot with recency score."""
    df = gold.user_product_interactions_monthly(a1_fct(spark, sf_dir), A1_SNAPSHOT)
    return round_cols(df, {"ui_recency_score"})


@query("days_since_last_purchase")
def q_days_since_last_purchase(spark, sf_dir):
    """F-05: recency over the full history (NULL without purchases)."""
    return gold.user_features_monthly(a1_user_events(spark, sf_dir), A1_SNAPSHOT).select(
        "user_id", "days_since_last_purchase")


@query("favorite_category")
def q_favorite_category(spark, sf_dir):
    """W-03: most frequent category tuple per user in the window."""
    fct = a1_fct(spark, sf_dir).where(gold.in_window(A1_SNAPSHOT))
    fc = gold.favorite_category(fct)
    return fc.select("user_id", "_fc.category_l1", "_fc.category_l2", "_fc.category_l3")


@query("favorite_brand")
def q_favorite_brand(spark, sf_dir):
    """W-04: most frequent brand per user in the window."""
    fct = a1_fct(spark, sf_dir).where(gold.in_window(A1_SNAPSHOT))
    return gold.favorite_brand(fct).select("user_id", F.col("_fb.brand").alias("brand"))


@query("backfill_snapshots")
def q_backfill(spark, sf_dir):
    """F-07: product snapshots of every load month in one job."""
    return a1_product_backfill(spark, sf_dir)


@query("target_next_period")
def q_target(spark, sf_dir):
    """W-05: next existing snapshot's purchases per product."""
    from pyspark.sql import Window
    pf = a1_product_backfill(spark, sf_dir)
    w = Window.partitionBy("product_id").orderBy("snapshot_date")
    return pf.select("product_id", "snapshot_date", "product_purchase_count_last_month",
                     F.lead("product_purchase_count_last_month", 1).over(w).alias("target_next_period"))


@query("join_snapshot_calendar")
def q_join_snapshot_calendar(spark, sf_dir):
    """J-05: product snapshots joined to the calendar."""
    fct = a1_product_events(spark, sf_dir)
    j = FE.join_snapshot_calendar(gold.product_features_backfill(fct), silver.calendar_dates(fct))
    return j.select("product_id", "snapshot_date", "month", "week_of_year", "days_to_end_of_month")


# ------------------------------------------------------- single aggregates

def _a1_group(spark, sf_dir, keys, *aggs):
    return a1_fct(spark, sf_dir).groupBy(*keys).agg(*aggs)


@query("agg_countif")
def q_agg_countif(spark, sf_dir):
    """G-01: COUNTIF per product."""
    t = F.col("event_type")
    return _a1_group(spark, sf_dir, ["product_id"], F.count_if(t == "view").alias("views"),
                     F.count_if(t == "cart").alias("carts"), F.count_if(t == "purchase").alias("purchases"))


@query("agg_count_star")
def q_agg_count_star(spark, sf_dir):
    """G-02: COUNT(*) per user."""
    return _a1_group(spark, sf_dir, ["user_id"], F.count(F.lit(1)).alias("events"))


@query("agg_count_distinct")
def q_agg_count_distinct(spark, sf_dir):
    """G-03: COUNT(DISTINCT user_session) per user."""
    return _a1_group(spark, sf_dir, ["user_id"], F.count_distinct("user_session").alias("sessions"))


@query("agg_count_distinct_if")
def q_agg_count_distinct_if(spark, sf_dir):
    """G-04: distinct buyers per product."""
    return _a1_group(spark, sf_dir, ["product_id"], F.count_distinct(
        F.when(F.col("event_type") == "purchase", F.col("user_id"))).alias("buyers"))


@query("agg_avg")
def q_agg_avg(spark, sf_dir):
    """G-05: exact average price per product (NULLs skipped)."""
    from .functions.aggregates import exact_avg
    return _a1_group(spark, sf_dir, ["product_id"], exact_avg("price").alias("avg_price"))


@query("agg_avg_if")
def q_agg_avg_if(spark, sf_dir):
    """G-06: average purchase price per user."""
    from .functions.aggregates import exact_avg
    return _a1_group(spark, sf_dir, ["user_id"], exact_avg(
        F.when(F.col("event_type") == "purchase", F.col("price"))).alias("avg_purchase_price"))


@query("agg_min_max_bounds")
def q_agg_min_max(spark, sf_dir):
    """G-07: global date bounds and per-user time bounds."""
    return _a1_group(spark, sf_dir, ["user_id"], F.min("event_ts").alias("first_ts"),
                     F.max("event_ts").alias("last_ts"), F.min("event_date").alias("first_date"),
                     F.max("event_date").alias("last_date"))


@query("agg_first_event")
def q_agg_first_event(spark, sf_dir):
    """G-08: first event's type and product per session."""
    from .functions.aggregates import first_by
    return _a1_group(spark, sf_dir, ["user_session", "user_id"],
                     first_by(F.struct("event_type", "product_id", "brand"), "event_ts", "event_id").alias("f")
                     ).select("user_session", "user_id", "f.event_type", "f.product_id", "f.brand")


@query("agg_latest_non_null")
def q_agg_latest(spark, sf_dir):
    """G-09: latest non-null brand and price per product."""
    from .functions.aggregates import latest_non_null
    return _a1_group(spark, sf_dir, ["product_id"],
                     latest_non_null("brand", "event_ts", "event_id").alias("brand"),
                     latest_non_null("price", "event_ts", "event_id").alias("price"))


@query("agg_latest_struct")
def q_agg_latest_struct(spark, sf_dir):
    """G-10: latest category tuple per product (when l1 is present)."""
    from .functions.aggregates import latest_when
    return _a1_group(spark, sf_dir, ["product_id"], latest_when(
        F.struct("category_l1", "category_l2", "category_l3"), F.col("category_l1").isNotNull(),
        "event_ts", "event_id").alias("c")).select("product_id", "c.category_l1", "c.category_l2", "c.category_l3")


@query("agg_group_by_struct")
def q_agg_group_by_struct(spark, sf_dir):
    """G-11: grouping on a struct key."""
    return (a1_fct(spark, sf_dir).groupBy(F.struct("category_l1", "category_l2", "category_l3").alias("c"))
            .agg(F.count(F.lit(1)).alias("events"))
            .select("c.category_l1", "c.category_l2", "c.category_l3", "events"))


@query("agg_safe_ratio")
def q_agg_safe_ratio(spark, sf_dir):
    """G-12: purchases / NULLIF(views, 0) per user."""
    t = F.col("event_type")
    return _a1_group(spark, sf_dir, ["user_id"], X.safe_ratio(F.count_if(t == "purchase"),
                                                              F.count_if(t == "view")).alias("conversion"))


@query("agg_weighted_score")
def q_agg_weighted_score(spark, sf_dir):
    """G-13: views*1 + carts*3 + purchases*5 per user and product."""
    t = F.col("event_type")
    return _a1_group(spark, sf_dir, ["user_id", "product_id"],
                     (F.count_if(t == "view") * 1 + F.count_if(t == "cart") * 3
                      + F.count_if(t == "purchase") * 5).alias("score"))


# ---------------------------------------------------------------- reports

@query("report_bronze_rows_per_month")
def q_r1(spark, sf_dir):
    return R.report_bronze_rows_per_month(a1_bronze(spark, sf_dir))


@query("report_silver_rows_per_month")
def q_r2(spark, sf_dir):
    return R.report_silver_rows_per_month(a1_fct(spark, sf_dir))


@query("report_gold_rows_per_snapshot")
def q_r3(spark, sf_dir):
    return R.report_gold_rows_per_snapshot(a1_product_backfill(spark, sf_dir))


@query("report_orphan_products")
def q_r4(spark, sf_dir):
    fct = a1_fct_table(spark, sf_dir)
    ss = silver.session_start(silver.sessions(fct), silver.calendar_dates(fct))
    return R.report_orphan_products(ss, gold.product_features_monthly(fct, A1_SNAPSHOT))


# ------------------------------------------------------------- assertions

def _a1_precheck(spark, sf_dir):
    """Parsed rows before the validity filter, with their (possibly NULL) id."""
    p = a1_parsed(spark, sf_dir)
    return p.withColumn("event_id", X.event_identity(*[F.col(c) for c in silver.NATURAL_KEY]))


@query("assert_events_primary_keys")
def q_a1(spark, sf_dir):
    return Q.assert_events_primary_keys(_a1_precheck(spark, sf_dir))


@query("assert_load_month_in_bronze")
def q_a2(spark, sf_dir):
    return Q.assert_load_month_in_bronze(a1_bronze(spark, sf_dir), "1990-01")


@query("assert_snapshot_date_after_events")
def q_a3(spark, sf_dir):
    return Q.assert_snapshot_date_after_events(a1_fct(spark, sf_dir), A1_SNAPSHOT)


@query("assert_valid_event_types")
def q_a4(spark, sf_dir):
    return Q.assert_valid_event_types(_a1_precheck(spark, sf_dir))


@query("assertion_summary")
def q_a5(spark, sf_dir):
    return Q.assertion_summary(a1_bronze(spark, sf_dir), _a1_precheck(spark, sf_dir), "1998-01", "2002-01-01",
                               dated=a1_fct(spark, sf_dir))


# ------------------------------------------------------- training features

def _round_doubles(df: DataFrame, digits: int = 9) -> DataFrame:
    dbl = {f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)}
    return round_cols(df, dbl, digits)


@query("training_set")
def q_training_set(spark, sf_dir):
    """T-01 / P-10: snapshots + calendar + LEAD target, non-null targets."""
    return a1_training(spark, sf_dir)


@query("features_base")
def q_features_base(spark, sf_dir):
    """T-02: coerced numerics, NULL -> 0.0."""
    return FE.features_base(a1_training(spark, sf_dir))


@query("features_funnel")
def q_features_funnel(spark, sf_dir):
    """T-03: base + funnel ratios and flags."""
    return FE.add_engineered(FE.features_base(a1_training(spark, sf_dir)), "funnel")


@query("features_extended")
def q_features_extended(spark, sf_dir):
    """T-04: funnel + log sales, price delta %, buyers per purchase, sales x conversion."""
    df = FE.add_engineered(FE.features_base(a1_training(spark, sf_dir)), "extended")
    return round_cols(df, {"log_sales_last_month"})


@query("one_hot_category")
def q_one_hot(spark, sf_dir):
    """T-05: category dummies in sorted vocabulary order."""
    base = FE.features_base(a1_training(spark, sf_dir))
    vocab = FE.category_vocabulary(base)
    oh = FE.one_hot_category(base.select("product_id", "snapshot_date", "product_category_l1"), vocab)
    return oh


@query("split_by_snapshots")
def q_split(spark, sf_dir):
    """T-07: last snapshot -> validation, the rest -> train."""
    return FE.with_split(a1_features(spark, sf_dir)).select("product_id", "snapshot_date", "split")


@query("training_profile")
def q_profile(spark, sf_dir):
    """T-08: sizes, dates, zero share and positives per split."""
    df = a1_features(spark, sf_dir)
    return _round_doubles(FE.training_profile(FE.with_split(df), len(FE.feature_columns(df))))


# ---------------------------------------------------------------- metrics

@query("metric_mae")
def q_mae(spark, sf_dir):
    return _round_doubles(M.regression_metrics(a3_predictions(spark, sf_dir), "target_next_period",
                                               "pred_soft").select("mae"))


@query("metric_rmse")
def q_rmse(spark, sf_dir):
    return _round_doubles(M.regression_metrics(a3_predictions(spark, sf_dir), "target_next_period",
                                               "pred_hard").select("rmse"))


@query("metric_rmsle")
def q_rmsle(spark, sf_dir):
    return _round_doubles(M.regression_metrics(a3_predictions(spark, sf_dir), "target_next_period",
                                               "pred_hard").select("rmsle"))


@query("metric_wape")
def q_wape(spark, sf_dir):
    return _round_doubles(M.regression_metrics(a3_predictions(spark, sf_dir), "target_next_period",
                                               "pred_baseline").select("wape"))


@query("regression_metrics")
def q_regression_metrics(spark, sf_dir):
    """M-08: the four regression metrics of the soft prediction, prefixed."""
    return _round_doubles(M.regression_metrics(a3_predictions(spark, sf_dir), "target_next_period",
                                               "pred_soft", "val_"))


@query("metric_confusion")
def q_confusion(spark, sf_dir):
    return _round_doubles(M.confusion_metrics(a3_predictions(spark, sf_dir), "label", "p_nonzero", 0.5))


@query("metric_roc_auc")
def q_auc(spark, sf_dir):
    return _round_doubles(M.ranking_metrics(a3_predictions(spark, sf_dir), "label", "p_nonzero")
                          .select("auc_roc"))


@query("metric_average_precision")
def q_ap(spark, sf_dir):
    return _round_doubles(M.ranking_metrics(a3_predictions(spark, sf_dir), "label", "p_nonzero")
                          .select("pr_auc"))


@query("classification_metrics")
def q_classification_metrics(spark, sf_dir):
    """M-08: all six classification metrics, prefixed."""
    return _round_doubles(M.classification_metrics(a3_predictions(spark, sf_dir), "label", "p_nonzero",
                                                   0.5, "val_"))


# --------------------------------------------------------- hurdle / blend

@query("hurdle_combine")
def q_hurdle(spark, sf_dir):
    """ML-09: soft and hard hurdle predictions from p and count."""
    return a3_predictions(spark, sf_dir).select("product_id", "snapshot_date", "p_nonzero", "positive_count",
                                                "pred_soft", "pred_hard")


@query("baseline_prediction")
def q_baseline(spark, sf_dir):
    """ML-10: last month's purchases as the prediction."""
    return a3_predictions(spark, sf_dir).select("product_id", "snapshot_date", "pred_baseline")


@query("blend_search")
def q_blend(spark, sf_dir):
    """ML-11: metrics for every hurdle weight 0..1 step 0.05."""
    return _round_doubles(H.blend_search(a3_predictions(spark, sf_dir)))


@query("model_comparison")
def q_model_comparison(spark, sf_dir):
    """ML-12: soft / hard / baseline / best-blend ensemble metrics."""
    return _round_doubles(H.model_comparison(a3_predictions(spark, sf_dir)))


@query("validation_predictions")
def q_val_preds(spark, sf_dir):
    """ML-13: product, snapshot, target, p_nonzero, soft and hard predictions."""
    return a3_predictions(spark, sf_dir).select("product_id", "snapshot_date", "target_next_period",
                                                "p_nonzero", "pred_soft", "pred_hard")


# ---------------------------------------------------------------- scoring

def _scoring_inputs(spark, sf_dir, fct: DataFrame | None = None, backfill: DataFrame | None = None):
    from .plans import scoring as SC
    fct = fct if fct is not None else a1_product_events(spark, sf_dir)
    pf = backfill if backfill is not None else gold.product_features_backfill(fct)
    feats = SC.scoring_features(pf, silver.calendar_dates(fct))
    return SC, feats, FX.a4_requests(spark, sf_dir)


def _feature_names(spark, sf_dir, fct: DataFrame | None = None, backfill: DataFrame | None = None):
    return FE.feature_columns(a1_features(spark, sf_dir, fct=fct, backfill=backfill))


def _scoring_with_names(spark, sf_dir):
    """Scoring inputs and training feature names from one silver table and
    one product-snapshot table (both written once, as in the lake)."""
    fct = a1_product_events(spark, sf_dir)
    pf = S.materialize(gold.product_features_backfill(fct))
    SC, feats, req = _scoring_inputs(spark, sf_dir, fct, pf)
    return SC, feats, req, _feature_names(spark, sf_dir, fct, pf)


@query("latest_features_per_product")
def q_latest(spark, sf_dir):
    """W-06: newest snapshot row per product."""
    from .plans import scoring as SC
    return SC.latest_features_per_product(a1_product_backfill(spark, sf_dir))


@query("scoring_features")
def q_scoring_features(spark, sf_dir):
    """SC-01: latest snapshot per product with calendar fields."""
    _, feats, _ = _scoring_inputs(spark, sf_dir)
    return feats


@query("scoring_lookup")
def q_scoring_lookup(spark, sf_dir):
    """SC-02: requests joined to features on the integer product id."""
    SC, feats, req = _scoring_inputs(spark, sf_dir)
    return SC.scoring_lookup(req, feats).select(*SC.REQUEST_COLUMNS, "has_features", "snapshot_date",
                                                "product_purchase_count_last_month")


@query("align_features")
def q_align(spark, sf_dir):
    """SC-03: serving features in the training feature order."""
    SC, feats, req, names = _scoring_with_names(spark, sf_dir)
    looked = SC.scoring_lookup(req, feats).where("has_features")
    out = SC.align_features(looked, names).select("product_id", *names)
    return round_cols(out, {"log_sales_last_month"})


@query("score_requests")
def q_score(spark, sf_dir):
    """SC-04 / SC-05: hurdle prediction or fallback, with model version."""
    from .plans.models import StandInHurdle
    SC, feats, req, names = _scoring_with_names(spark, sf_dir)
    return SC.score_requests(req, feats, StandInHurdle(names))


@query("score_requests_model_errors")
def q_score_errors(spark, sf_dir):
    """SC-04: a model that raises on some rows; those take the fallback, the others their prediction."""
    from .plans.models import RaisingHurdle
    SC, feats, req, names = _scoring_with_names(spark, sf_dir)
    return SC.score_requests(req, feats, RaisingHurdle(names))


@query("fallback_prediction")
def q_fallback(spark, sf_dir):
    """SC-05: requests without a model get the fallback prediction."""
    SC, feats, req = _scoring_inputs(spark, sf_dir)
    return SC.score_requests(req, feats, None).select("product_id", "prev_month_sales", "prediction_score",
                                                      "model_version")


@query("prediction_log")
def q_prediction_log(spark, sf_dir):
    """SC-06: log rows (the request clock excluded)."""
    from .plans.models import StandInHurdle
    SC, feats, req, names = _scoring_with_names(spark, sf_dir)
    scored = SC.score_requests(req, feats, StandInHurdle(names))
    return SC.prediction_log(scored).drop("timestamp", "log_date")


@query("report_latest_predictions")
def q_r5(spark, sf_dir):
    """R-05: the five newest log rows of one scoring run."""
    from .plans.models import StandInHurdle
    SC, feats, req, names = _scoring_with_names(spark, sf_dir)
    scored = SC.score_requests(req, feats, StandInHurdle(names))
    return R.report_latest_predictions(SC.prediction_log(scored, run_ts="2002-01-01 05:00:00"))


@query("leaderboard_sort")
def q_leaderboard(spark, sf_dir):
    """R-06: all blend candidates with their ranks by RMSE (least first) and by WAPE (largest first)."""
    board = H.blend_search(a3_predictions(spark, sf_dir)) \
        .withColumn("run_name", F.format_string("blend_w%.2f", F.col("w_hurdle")))
    ranked = R.leaderboard_rank(R.leaderboard_rank(board, "rmse", True, "rank_rmse"), "wape", False, "rank_wape_desc")
    return _round_doubles(ranked)


# ------------------------------------------------------- scalar functions

def _distinct(df: DataFrame, *cols) -> DataFrame:
    return df.select(*cols).distinct()


@query("fn_parse_ts")
def q_fn_parse_ts(spark, sf_dir):
    """X-01: 'yyyy-MM-dd HH:mm:ss UTC' text to a UTC timestamp (strict)."""
    b = a1_bronze(spark, sf_dir)
    return _distinct(b, "event_time_raw", X.parse_event_ts("event_time_raw").alias("event_ts"))


@query("fn_ts_to_date")
def q_fn_ts_to_date(spark, sf_dir):
    """X-02: DATE(ts) in UTC."""
    return _distinct(a1_parsed(spark, sf_dir), "event_ts", F.to_date("event_ts").alias("event_date"))


@query("fn_clean_text")
def q_fn_clean_text(spark, sf_dir):
    """X-03: TRIM / LOWER / NULLIF(TRIM(x), '')."""
    b = a1_bronze(spark, sf_dir)
    return _distinct(b, "brand_raw", "event_type_raw", X.clean_lower("brand_raw").alias("brand"),
                     F.lower(X.trim_ws("event_type_raw")).alias("event_type"),
                     X.clean_text("user_session_raw").alias("user_session"), "user_session_raw")


@query("fn_safe_cast_int")
def q_fn_safe_cast_int(spark, sf_dir):
    """X-04: SAFE_CAST(text AS INT64), also of the same numbers in hexadecimal, with and without a sign."""
    raw = F.col("product_id_raw")
    digits = F.hex(raw.try_cast("bigint"))
    forms = F.array(raw, F.concat(F.lit("0x"), digits), F.concat(F.lit(" -0X"), F.lower(digits)), F.concat(F.lit("0x00"), digits, F.lit("g")))
    b = a1_bronze(spark, sf_dir).select(F.explode(forms).alias("product_id_raw")).where(raw.isNotNull())
    return _distinct(b, "product_id_raw", X.safe_bigint("product_id_raw").alias("product_id"))


@query("fn_safe_cast_numeric")
def q_fn_safe_cast_numeric(spark, sf_dir):
    """X-05: SAFE_CAST(text AS NUMERIC)."""
    b = a1_bronze(spark, sf_dir)
    return _distinct(b, "price_raw", X.safe_numeric("price_raw").alias("price"))


@query("fn_safe_cast_double")
def q_fn_safe_cast_double(spark, sf_dir):
    """X-06: SAFE_CAST(x AS FLOAT64) of the snapshot counters."""
    pf = a1_product_backfill(spark, sf_dir)
    return _distinct(pf, "product_unique_buyers_last_month",
                     X.safe_double("product_unique_buyers_last_month").alias("buyers_double"))


@query("fn_sha256_hex")
def q_fn_sha256(spark, sf_dir):
    """X-07: lower-case hex SHA-256 of a text."""
    b = a1_bronze(spark, sf_dir)
    return _distinct(b, "user_session_raw", F.sha2("user_session_raw", 256).alias("digest"))


@query("fn_unix_micros")
def q_fn_unix_micros(spark, sf_dir):
    """X-08: microseconds since the epoch."""
    return _distinct(a1_parsed(spark, sf_dir), "event_ts", F.unix_micros("event_ts").alias("micros"))


@query("fn_split_safe_offset")
def q_fn_split(spark, sf_dir):
    """X-09: SPLIT(code, '.')[SAFE_OFFSET(n)] for n = 0..3."""
    p = a1_parsed(spark, sf_dir)
    return _distinct(p, "category_code", *[X.category_level("category_code", i).alias(f"part{i}") for i in range(4)])


@query("fn_parse_month")
def q_fn_parse_month(spark, sf_dir):
    """X-10: PARSE_DATE('%Y-%m', text)."""
    b = a1_bronze(spark, sf_dir)
    return _distinct(b, X.format_month("_load_month").alias("load_month"),
                     X.parse_month(X.format_month("_load_month")).alias("month_date"))


@query("fn_date_parts")
def q_fn_date_parts(spark, sf_dir):
    """X-11: month, ISO week, day of week (Sunday = 1), hour."""
    p = a1_parsed(spark, sf_dir)
    return _distinct(p, "event_ts", F.month("event_ts").alias("month"), F.weekofyear("event_ts").alias("iso_week"),
                     F.dayofweek("event_ts").alias("day_of_week"), F.hour("event_ts").alias("hour"))


@query("fn_is_weekend")
def q_fn_is_weekend(spark, sf_dir):
    """X-12: DAYOFWEEK IN (1, 7)."""
    return _distinct(a1_parsed(spark, sf_dir), "event_date", X.is_weekend("event_date").alias("is_weekend"))


@query("fn_days_to_month_end")
def q_fn_days_to_month_end(spark, sf_dir):
    """X-13: days to the last day of the month."""
    return _distinct(a1_parsed(spark, sf_dir), "event_date",
                     X.days_to_month_end("event_date").alias("days_to_end_of_month"))


@query("fn_date_arith")
def q_fn_date_arith(spark, sf_dir):
    """X-14: date -/+ 7 days, - 1 month, day differences."""
    p = a1_parsed(spark, sf_dir)
    d = F.col("event_date")
    return _distinct(p, "event_date", F.date_sub(d, 7).alias("minus_7"), F.date_add(d, 7).alias("plus_7"),
                     F.add_months(d, -1).alias("minus_month"),
                     F.datediff(F.to_date(F.lit(A1_SNAPSHOT)), d).alias("days_to_snapshot"))


@query("fn_generate_date_array")
def q_fn_gen_dates(spark, sf_dir):
    """X-15: inclusive date arrays, exploded (one row per month of data)."""
    b = a1_bronze(spark, sf_dir).select("_load_month").distinct()
    return b.select("_load_month", F.explode(F.sequence("_load_month", F.last_day("_load_month"))).alias("d"))


@query("fn_conditional")
def q_fn_conditional(spark, sf_dir):
    """X-16: IF / NULLIF / IN / IS NULL / COALESCE."""
    p = a1_parsed(spark, sf_dir)
    return _distinct(
        p, "event_type", "category_code",
        F.when(F.col("event_type") == "purchase", F.lit(1)).otherwise(F.lit(0)).alias("is_purchase"),
        F.nullif(F.col("event_type"), F.lit("view")).alias("not_view"),
        F.col("event_type").isin(*X.VALID_EVENT_TYPES).alias("valid_type"),
        F.col("category_code").isNull().alias("no_category"),
        F.coalesce(F.get(F.split("category_code", r"\."), 0), F.lit("UNKNOWN")).alias("l1_or_unknown"))


@query("fn_exp_decay")
def q_fn_exp(spark, sf_dir):
    """X-17: EXP(-0.05 * days)."""
    p = a1_parsed(spark, sf_dir)
    days = F.datediff(F.to_date(F.lit("2002-01-01")), "event_date")
    return round_cols(_distinct(p, days.alias("days"), X.recency_score(days).alias("score")), {"score"})


@query("fn_format_month")
def q_fn_format_month(spark, sf_dir):
    """X-18: FORMAT_DATE('%Y-%m')."""
    return _distinct(a1_parsed(spark, sf_dir), "event_date", X.format_month("event_date").alias("month"))


@query("fn_replace_concat")
def q_fn_replace_concat(spark, sf_dir):
    """X-19: load id and table-name construction."""
    b = a1_bronze(spark, sf_dir)
    m = X.format_month("_load_month")
    return _distinct(b, m.alias("load_month"), F.concat(F.lit("manual_"), m).alias("load_id"),
                     F.concat(F.lit("raw_events_external_"), F.replace(m, F.lit("-"), F.lit("_"))).alias("external_table"))


@query("fn_to_json_payload")
def q_fn_json(spark, sf_dir):
    """X-20: request payload as JSON text."""
    from .plans.scoring import request_payload
    return FX.a4_requests(spark, sf_dir).select("product_id", request_payload().alias("payload"))


@query("fn_pd_to_numeric")
def q_fn_to_numeric(spark, sf_dir):
    """X-21: numeric coercion, NULL/NaN -> 0.0."""
    pf = a1_product_backfill(spark, sf_dir)
    return _distinct(pf, "product_conversion_rate_last_month",
                     X.to_numeric_or_zero("product_conversion_rate_last_month").alias("conversion0"))


@query("fn_log1p")
def q_fn_log1p(spark, sf_dir):
    """X-22: log1p of purchases."""
    pf = a1_product_backfill(spark, sf_dir)
    return round_cols(_distinct(pf, "product_purchase_count_last_month",
                                F.log1p("product_purchase_count_last_month").alias("log_sales")), {"log_sales"})


# ------------------------------------------------------------ run params

@query("run_params")
def q_run_params(spark, sf_dir):
    """D-01: load month -> snapshot date and source object per loaded month."""
    from .plans.monthly import run_params
    months = a1_bronze(spark, sf_dir).select(X.format_month("_load_month").alias("load_month")).distinct()
    return run_params(months)


# ------------------------------------------------- lake I/O (written tables)

def _scratch(spark, name: str) -> str:
    import uuid
    return S.scratch_path(spark, f"{name}-{uuid.uuid4().hex}")


@query("csv_scan")
def q_csv_scan(spark, sf_dir):
    """S-01: month files written as CSV and read back strictly (9 STRING columns)."""
    from .schemas import RAW_COLUMNS
    from .sources import bronze as B
    raw = a1_bronze(spark, sf_dir).select(
        *[F.col(f"{c}_raw").alias(c) for c in RAW_COLUMNS], F.date_format("_load_month", "yyyy-MM").alias("month"))
    path = _scratch(spark, "csv")
    from .sources.lake import rebalance
    (rebalance(raw, "month").write.option("header", True).option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False).partitionBy("month").csv(path))
    return B.read_events_csv(spark, path).select(*RAW_COLUMNS)


@query("bronze_reload_idempotent")
def q_bronze_reload(spark, sf_dir):
    """S-03: loading every month twice leaves one copy of each month."""
    from .sources import bronze as B
    path = _scratch(spark, "bronze")
    rows = a1_bronze(spark, sf_dir)
    for _ in range(2):
        B.replace_bronze_months(rows, path)
    return B.read_bronze(spark, path).drop("_ingested_at")


@query("silver_upsert")
def q_silver_upsert(spark, sf_dir):
    """S-06: MERGE of all months over a table holding the months before 1999."""
    fct = a1_fct_table(spark, sf_dir)
    path = _scratch(spark, "fct")
    L.upsert(fct.where("_load_month < DATE'1999-01-01'"), path, ["event_id"], "_load_month", written=True)
    L.upsert(fct, path, ["event_id"], "_load_month", written=True)
    return spark.read.parquet(path)


@query("snapshot_upsert")
def q_snapshot_upsert(spark, sf_dir):
    """S-07: one snapshot re-merged into the all-snapshot table."""
    fct = a1_product_events(spark, sf_dir)
    path = _scratch(spark, "pfm")
    L.upsert(gold.product_features_backfill(fct), path, ["snapshot_date", "product_id"], "snapshot_date")
    L.snapshot_upsert(gold.product_features_monthly(fct, A1_SNAPSHOT), path,
                      ["snapshot_date", "product_id"], A1_SNAPSHOT)
    return spark.read.parquet(path)


@query("split_raw_by_month")
def q_split_raw(spark, sf_dir):
    """S-13: one CSV folder per month; rows per month read back."""
    from .schemas import RAW_COLUMNS
    from .sources import bronze as B
    raw = a1_bronze(spark, sf_dir).select(*[F.col(f"{c}_raw").alias(c) for c in RAW_COLUMNS])
    path = _scratch(spark, "split")
    B.split_raw_by_month(raw, path, first_full_month="1995-02")
    back = spark.read.option("header", True).csv(path)
    return back.groupBy("month").agg(F.count(F.lit(1)).alias("rows"))


@query("sample_weights")
def q_sample_weights(spark, sf_dir):
    """ML-06: stage-2 weights 1 + y / mean(y) over the training positives."""
    from .plans.models import sample_weights
    tr = FE.with_split(a1_features(spark, sf_dir)).where("split = 'train' AND target_next_period > 0")
    return _round_doubles(sample_weights(tr).select("product_id", "snapshot_date", "target_next_period", "weight"))


@query("user_features_backfill")
def q_user_backfill(spark, sf_dir):
    """F-07: user snapshots of every load month in one job."""
    return gold.user_features_backfill(a1_user_events(spark, sf_dir))


@query("user_product_interactions_backfill")
def q_interactions_backfill(spark, sf_dir):
    """F-07: user-product snapshots of every load month in one job."""
    df = gold.user_product_interactions_backfill(a1_fct(spark, sf_dir))
    return round_cols(df, {"ui_recency_score"})


@query("materialized_table")
def q_materialized(spark, sf_dir):
    """S-08: sessions rebuilt as a clustered table and read back."""
    path = _scratch(spark, "sessions")
    L.materialize_table(a1_sessions(spark, sf_dir), path, ["user_id", "session_start_date"])
    return spark.read.parquet(path)


@query("training_frame_from_lake")
def q_training_frame(spark, sf_dir):
    """S-10: the training set from stored product snapshots and calendar."""
    from .plans.training import load_training_frame
    fct = a1_product_events(spark, sf_dir)
    pf, cal = _scratch(spark, "pfm"), _scratch(spark, "cal")
    L.rebalance(gold.product_features_backfill(fct), "snapshot_date").write.partitionBy("snapshot_date").parquet(pf)
    L.materialize_table(silver.calendar_dates(fct), cal, ["calendar_date"])
    return load_training_frame(spark, pf, cal)


@query("csv_report")
def q_csv_report(spark, sf_dir):
    """S-12: the blend table written as a CSV report and read back."""
    from .plans.training import write_csv_report
    path = _scratch(spark, "blend")
    board = _round_doubles(H.blend_search(a3_predictions(spark, sf_dir)))
    write_csv_report(board, path)
    return spark.read.option("header", True).schema(board.schema).csv(path)


# The months that monthly_runs loads.
RUN_MONTHS = ("1998-01", "1998-02")
RUN_COLUMNS = ["snapshot_date", "user_id", "user_view_count_last_month", "user_cart_count_last_month",
               "user_purchase_count_last_month", "user_sessions_last_month", "days_since_last_purchase"]


def _month_files(spark, sf_dir, keep=None) -> str:
    """CSV folders of RUN_MONTHS, without the rows of the first month that keep leaves out."""
    from .schemas import RAW_COLUMNS
    from .sources.lake import rebalance
    raw = a1_bronze(spark, sf_dir).select(*[F.col(f"{c}_raw").alias(c) for c in RAW_COLUMNS],
                                          F.date_format("_load_month", "yyyy-MM").alias("month")).where(F.col("month").isin(*RUN_MONTHS))
    files = _scratch(spark, "files")
    if keep is not None:
        raw = raw.where((F.col("month") != RUN_MONTHS[0]) | keep)
    (rebalance(raw, "month").write.option("header", True)
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).partitionBy("month").csv(files))
    return files


@query("monthly_runs")
def q_monthly_runs(spark, sf_dir):
    """D-02, D-04: two months from CSV through bronze, silver, gold and assertions, one after the other.

    All rows of a file have one ingestion time, so columns that depend on
    which of an event's copies wins are left out.
    """
    from .plans import monthly as P
    runs = P.backfill(spark, _scratch(spark, "lake"), [{"load_month": m} for m in RUN_MONTHS], raw_root=_month_files(spark, sf_dir))
    return spark.read.parquet(runs[-1]["paths"]["user_features_monthly"]).select(*RUN_COLUMNS)


@query("reload_month")
def q_reload_month(spark, sf_dir):
    """F-07, S-03, S-07: two months of which the first lacks some users' events, then its corrected file; the change reaches both snapshots."""
    from .plans import monthly as P
    lake = _scratch(spark, "lake")
    partial = _month_files(spark, sf_dir, F.pmod(F.crc32(F.col("user_id").cast("binary")), F.lit(9)) != 0)
    P.backfill(spark, lake, [{"load_month": m} for m in RUN_MONTHS], raw_root=partial)
    P.reload_month(spark, lake, RUN_MONTHS[0], f"{_month_files(spark, sf_dir)}/month={RUN_MONTHS[0]}")
    return spark.read.parquet(P.table_paths(lake)["user_features_monthly"]).select(*RUN_COLUMNS)


def _stand_in_scoring(spark, sf_dir):
    from .plans.models import StandInHurdle
    SC, feats, req, names = _scoring_with_names(spark, sf_dir)
    return SC, S.materialize(feats), req, StandInHurdle(names)


@query("prediction_log_appended")
def q_prediction_log_appended(spark, sf_dir):
    """S-11: the log of two scoring runs, each of other requests, appended to the log table and read back."""
    SC, feats, req, model = _stand_in_scoring(spark, sf_dir)
    path = _scratch(spark, "api_logs")
    for part in ("prev_month_sales <= 25", "prev_month_sales > 25"):
        SC.append_prediction_log(SC.prediction_log(SC.score_requests(req.where(part), feats, model)), path)
    return spark.read.parquet(path).drop("timestamp", "log_date")


# Fixed value: the newest snapshot that the first batch of score_stream_fresh can see.
FIRST_SNAPSHOT = "1997-01-01"


@query("score_stream_fresh")
def q_score_stream_fresh(spark, sf_dir):
    """SC-07: snapshots stored between two batches are seen by the second one, and a replay of the first one does not see them."""
    from .plans import scoring as SC
    from .plans.models import StandInHurdle
    from .streaming.score_stream import score_batch, score_stream
    fct = a1_product_events(spark, sf_dir)
    pf = S.materialize(gold.product_features_backfill(fct))
    names, req = _feature_names(spark, sf_dir, fct, pf), FX.a4_requests(spark, sf_dir)
    requests, log, marks, table, days = (_scratch(spark, n) for n in ("requests", "stream_log", "stream_checkpoint", "product_features", "calendar"))
    silver.calendar_dates(fct).write.parquet(days)
    features, model = SC.SnapshotFeatures(table, days), StandInHurdle(names)
    old = F.col("snapshot_date") <= F.to_date(F.lit(FIRST_SNAPSHOT))
    for rows, snapshots in (("prev_month_sales <= 25", old), ("prev_month_sales > 25", ~old)):
        pf.where(snapshots).write.mode("append").partitionBy("snapshot_date").parquet(table)
        req.where(rows).write.mode("append").json(requests)
        stream = score_stream(spark, requests, features, model, log, marks)
        stream.awaitTermination()
    score_batch(req.where("prev_month_sales <= 25"), 0, features, model, log, stream_id=stream.id)
    return spark.read.parquet(log).select("user_id", "session_id", "request_payload", "prediction_score", "model_version")


@query("score_stream")
def q_score_stream(spark, sf_dir):
    """SC-07: request files scored as a stream of everything that is there; the log as written."""
    from .streaming.score_stream import score_stream
    SC, feats, req, model = _stand_in_scoring(spark, sf_dir)
    requests, log, marks = (_scratch(spark, n) for n in ("requests", "stream_log", "stream_checkpoint"))
    req.write.json(requests)
    running = score_stream(spark, requests, feats, model, log, marks)
    running.awaitTermination()
    return spark.read.parquet(log).drop("timestamp", "log_date", "stream_id", "batch_id")


# ------------------------------------------------ model training (rows-only)
# Iterative model fits have no SQL equivalent: these keys have no oracle and
# are checked on rows and schema only.
ROWS_ONLY = {"stage1_search_logistic", "stage2_search_poisson", "hurdle_training_linear", "stage1_search", "stage2_search",
             "feature_importance_topk"}


def _train_val(spark, sf_dir):
    feats, _ = FE.prepare_features(a1_training(spark, sf_dir))
    train, val, _, _ = FE.split_by_snapshots(feats)
    return train, val, FE.feature_columns(feats)


@query("stage1_search_logistic")
def q_stage1(spark, sf_dir):
    """ML-01..04: the grid's three logistic configurations; leaderboard by val_pr_auc."""
    from .plans import models as MD
    train, val, names = _train_val(spark, sf_dir)
    board, _ = MD.stage1_search(train, val, names, MD.linear_only(MD.classifier_grid()))
    return board.drop("params")


@query("stage2_search_poisson")
def q_stage2(spark, sf_dir):
    """ML-05..08: the grid's six Poisson configurations on positives; leaderboard by val_rmse."""
    from .plans import models as MD
    train, val, names = _train_val(spark, sf_dir)
    board, _ = MD.stage2_search(train, val, names, MD.linear_only(MD.regressor_grid()))
    return board.drop("params")


@query("stage1_search")
def q_stage1_grid(spark, sf_dir):
    """ML-01, 03, 04: the whole stage 1 grid of 30 configurations; leaderboard by val_pr_auc."""
    from .plans import models as MD
    train, val, names = _train_val(spark, sf_dir)
    board, _ = MD.stage1_search(train, val, names, MD.classifier_grid())
    return board.drop("params")


@query("stage2_search")
def q_stage2_grid(spark, sf_dir):
    """ML-05, 07, 08: the whole stage 2 grid of 33 configurations on positives; leaderboard by val_rmse."""
    from .plans import models as MD
    train, val, names = _train_val(spark, sf_dir)
    board, _ = MD.stage2_search(train, val, names, MD.regressor_grid())
    return board.drop("params")


@query("feature_importance_topk")
def q_importances(spark, sf_dir):
    """R-07: mean split gains of each stage's best boosted model, found by the search of the whole grid, the 20 greatest of each."""
    from functools import reduce

    from .plans import models as MD
    from .plans import training as TR
    train, val, names = _train_val(spark, sf_dir)
    parts = []
    for stage, search, grid in (("classifier", MD.stage1_search, MD.classifier_grid()), ("regressor", MD.stage2_search, MD.regressor_grid())):
        board, models = search(train, val, names, grid)
        best = board.where("algo = 'gbt'").first()["run_name"]
        parts.append(TR.feature_importance_topk(models[best]).select(F.lit(stage).alias("stage"), F.lit(best).alias("run_name"), "feature", "importance"))
    return reduce(DataFrame.unionByName, parts)


@query("hurdle_training_linear")
def q_train(spark, sf_dir):
    """ML-14: end-to-end training on the grids' linear configurations; hurdle / baseline / ensemble comparison."""
    from .plans import models as MD
    from .plans import training as TR
    res = TR.train_hurdle_model(a1_training(spark, sf_dir), classifiers=MD.linear_only(MD.classifier_grid()),
                                regressors=MD.linear_only(MD.regressor_grid()))
    return res["comparison"]


@query("fit_optimality")
def q_fit_optimality(spark, sf_dir):
    """ML-02, 04, 06, 08: slopes of the losses at the fitted linear models, and whether the boards' first rows are best."""
    from functools import reduce

    from .plans import models as MD
    train, val, names = _train_val(spark, sf_dir)
    clf, reg = MD.linear_only(MD.classifier_grid()), MD.linear_only(MD.regressor_grid())
    board1, models1 = MD.stage1_search(train, val, names, clf)
    board2, models2 = MD.stage2_search(train, val, names, reg)
    y = F.col("target_next_period").cast("double")
    rows = train.withColumn("label", (y > 0).cast("double"))
    n = rows.count()
    parts = [MD.logistic_gradient(m, rows, n, c["params"]["C"]).withColumn("run_name", F.lit(run))
             for (run, m), c in zip(models1.items(), clf)]
    positive = MD.sample_weights(train.where(y > 0)).withColumn("y", y)
    parts += [MD.poisson_slopes(m, positive).withColumn("run_name", F.lit(run)) for run, m in models2.items()]
    first1, first2 = board1.first(), board2.first()
    best = [("stage1", "first_row", (first1["val_pr_auc"] or 0.0) - (board1.agg(F.max("val_pr_auc")).first()[0] or 0.0)),
            ("stage2", "first_row", (first2["val_rmse"] or 0.0) - (board2.agg(F.min("val_rmse")).first()[0] or 0.0))]
    parts.append(spark.createDataFrame(best, "run_name string, check_name string, residual double"))
    whole = reduce(DataFrame.unionByName, parts)
    return whole.select("run_name", "check_name", F.abs(F.round("residual", 3)).alias("residual"))
