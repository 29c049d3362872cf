"""Gold layer: monthly feature snapshots of products, users and user-product pairs.

Window = the calendar month before snapshot_date; history = every event
before snapshot_date.  A mart aggregates the window, which reads one month of
partitions, and joins what is left of the history: only older events, only the
event type and the columns that the history needs, combined before the shuffle
and already partitioned by the mart's key.  Where a run carries that state from
month to month (``carried``), older events are not read at all.  Rows exist
only for keys with events in the window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as X
from ..functions.aggregates import countif, exact_avg, latest_non_null, latest_when

PRODUCT_COLUMNS = [
    "snapshot_date", "product_id", "product_view_count_last_month",
    "product_purchase_count_last_month", "product_cart_count_last_month",
    "product_conversion_rate_last_month", "product_price", "product_avg_price_last_month",
    "product_unique_buyers_last_month", "product_category_l1", "product_category_l2",
    "product_category_l3", "product_brand",
]

USER_COLUMNS = [
    "snapshot_date", "user_id", "user_purchase_count_last_month", "user_view_count_last_month",
    "user_cart_count_last_month", "user_conversion_rate_last_month", "user_sessions_last_month",
    "user_avg_price_purchased_last_month", "user_favorite_category_l1_last_month",
    "user_favorite_category_l2_last_month", "user_favorite_category_l3_last_month",
    "user_favorite_brand_last_month", "days_since_last_purchase",
    "user_cart_abandon_rate_last_month",
]

INTERACTION_COLUMNS = [
    "snapshot_date", "user_id", "product_id", "ui_view_count_last_month",
    "ui_cart_count_last_month", "ui_purchase_count_last_month", "ui_days_since_last_view",
    "ui_recency_score", "ui_interaction_score_last_month",
]

ORDER = ("event_ts", "event_id")
# Fixed value: the columns of an event that product snapshots and the calendar read.
PRODUCT_EVENT_COLUMNS = [
    "event_id", "event_ts", "event_date", "event_type", "product_id", "category_l1", "category_l2",
    "category_l3", "brand", "price", "user_id",
]
# Fixed value: the columns of an event that user snapshots read.
USER_EVENT_COLUMNS = [
    "event_ts", "event_date", "event_type", "category_l1", "category_l2", "category_l3", "brand", "price",
    "user_id", "user_session",
]


def _snap(snapshot_date) -> Column:
    return F.to_date(F.lit(str(snapshot_date)))


def window_bounds(snapshot_date):
    """[snapshot - 1 month, snapshot): constant-folded, so it prunes partitions."""
    snap = _snap(snapshot_date)
    return F.add_months(snap, -1), snap


def in_window(snapshot_date) -> Column:
    lo, hi = window_bounds(snapshot_date)
    return (F.col("event_date") >= lo) & (F.col("event_date") < hi)


def history(fct: DataFrame, snapshot_date) -> DataFrame:
    return fct.where(F.col("event_date") < _snap(snapshot_date))


def older(fct: DataFrame, snapshot_date) -> DataFrame:
    """Events before the window: the part of the history that the window does not hold."""
    return fct.where(F.col("event_date") < window_bounds(snapshot_date)[0])


def _is(t: str) -> Column:
    return F.col("event_type") == t


def _window_counts(win: Column, prefix: str, suffix: str = "_last_month") -> list[Column]:
    return [
        countif(win & _is("view")).alias(f"{prefix}view_count{suffix}"),
        countif(win & _is("purchase")).alias(f"{prefix}purchase_count{suffix}"),
        countif(win & _is("cart")).alias(f"{prefix}cart_count{suffix}"),
    ]


def _latest_attributes() -> list[Column]:
    return [
        latest_when(F.struct("category_l1", "category_l2", "category_l3"),
                    F.col("category_l1").isNotNull(), *ORDER).alias("_cat"),
        latest_non_null("brand", *ORDER).alias("product_brand"),
        latest_non_null("price", *ORDER).alias("product_price"),
    ]


def product_attributes(events: DataFrame) -> DataFrame:
    """(product_id, _cat, product_brand, product_price): the newest of each that events hold."""
    return events.groupBy("product_id").agg(*_latest_attributes())


def product_features_monthly(fct: DataFrame, snapshot_date, carried: DataFrame | None = None) -> DataFrame:
    """gold.product_features_monthly for one snapshot.

    An attribute comes from the window if it is given there, else from the
    older events, or from carried, product_attributes of the months before.
    """
    every = F.lit(True)
    month = fct.where(in_window(snapshot_date))
    agg = month.groupBy("product_id").agg(
        *_window_counts(every, "product_"), exact_avg("price").alias("product_avg_price_last_month"), *_latest_attributes())
    buyers = month.where(_is("purchase")).groupBy("product_id").agg(
        F.count_distinct("user_id").alias("product_unique_buyers_last_month"))
    names = ("_cat", "product_brand", "product_price")
    before = carried if carried is not None else product_attributes(older(fct, snapshot_date))
    before = before.select("product_id", *[F.col(c).alias(f"_old{c}") for c in names])
    joined = agg.join(buyers, "product_id", "left").join(before, "product_id", "left")
    return _product_output(
        joined.withColumns({c: F.coalesce(c, f"_old{c}") for c in names}).fillna(0, ["product_unique_buyers_last_month"]),
        _snap(snapshot_date))


def _product_output(agg: DataFrame, snapshot: Column) -> DataFrame:
    return agg.select(
        snapshot.alias("snapshot_date"),
        "product_id",
        "product_view_count_last_month",
        "product_purchase_count_last_month",
        "product_cart_count_last_month",
        X.safe_ratio("product_purchase_count_last_month", "product_view_count_last_month")
         .alias("product_conversion_rate_last_month"),
        "product_price",
        "product_avg_price_last_month",
        "product_unique_buyers_last_month",
        F.col("_cat.category_l1").alias("product_category_l1"),
        F.col("_cat.category_l2").alias("product_category_l2"),
        F.col("_cat.category_l3").alias("product_category_l3"),
        "product_brand",
    )


def _top1(df: DataFrame, key, value_cols: list[str], out: str) -> DataFrame:
    """Most frequent value tuple per key; ties -> ascending values, NULLs first.

    After the (key, values) count the top-1 is a min_by over
    (-count, values...), an aggregate with partial combine, so a key with
    very many distinct values never lands in one sorted window partition.
    """
    keys = [key] if isinstance(key, str) else list(key)
    counted = df.groupBy(*keys, *value_cols).agg(F.count(F.lit(1)).alias("_n"))
    order = F.struct((-F.col("_n")).alias("_neg"), *[F.col(c) for c in value_cols])
    return counted.groupBy(*keys).agg(F.min_by(F.struct(*value_cols), order).alias(out))


def favorite_category(windowed: DataFrame, keys=("user_id",)) -> DataFrame:
    return _top1(windowed.where(F.col("category_l1").isNotNull()), list(keys),
                 ["category_l1", "category_l2", "category_l3"], "_fc")


def favorite_brand(windowed: DataFrame, keys=("user_id",)) -> DataFrame:
    return _top1(windowed.where(F.col("brand").isNotNull()), list(keys), ["brand"], "_fb")


CATEGORY_COLS = ["category_l1", "category_l2", "category_l3"]


def favorites(windowed: DataFrame, keys=("user_id",)) -> DataFrame:
    """Favourite category tuple and favourite brand per key in ONE pass.

    Grouping sets count (keys, category tuple) and (keys, brand) from a
    single scan; a second aggregate picks both top-1s with min_by over
    (-count, values) (ties: ascending values, NULLs first).  Rows whose
    category_l1 / brand is NULL form their own group and are dropped, which
    equals filtering them before counting.
    """
    keys = list(keys)
    cols = keys + CATEGORY_COLS + ["brand"]
    counted = (windowed.select(*cols)
               .groupingSets([keys + CATEGORY_COLS, keys + ["brand"]], *cols)
               .agg(F.count(F.lit(1)).alias("_n"), F.grouping("brand").alias("_is_cat")))
    is_cat = (F.col("_is_cat") == 1) & F.col("category_l1").isNotNull()
    is_brand = (F.col("_is_cat") == 0) & F.col("brand").isNotNull()
    neg = (-F.col("_n")).alias("_neg")
    return counted.groupBy(*keys).agg(
        F.min_by(F.struct(*CATEGORY_COLS), F.when(is_cat, F.struct(neg, *CATEGORY_COLS))).alias("_fc"),
        F.min_by(F.struct("brand"), F.when(is_brand, F.struct(neg, "brand"))).alias("_fb"),
    )


def last_purchases(events: DataFrame) -> DataFrame:
    """(user_id, last_purchase_ts) of the purchases that events hold."""
    return events.where(_is("purchase")).groupBy("user_id").agg(F.max("event_ts").alias("last_purchase_ts"))


def user_features_monthly(fct: DataFrame, snapshot_date, carried: DataFrame | None = None) -> DataFrame:
    """gold.user_features_monthly for one snapshot.

    Counts, sessions and prices are one grouped pass over the window, both
    favourites one grouping-sets pass; the last purchase before the window
    comes from older purchases, or from carried, last_purchases of the months
    before.  All sides end hash-partitioned on user_id, so the joins add no
    exchange of their own.
    """
    snap = _snap(snapshot_date)
    month = fct.where(in_window(snapshot_date))
    base = month.groupBy("user_id").agg(
        *_window_counts(F.lit(True), "user_"),
        F.count_distinct("user_session").alias("user_sessions_last_month"),
        exact_avg(F.when(_is("purchase"), F.col("price"))).alias("user_avg_price_purchased_last_month"),
        F.max(F.when(_is("purchase"), F.col("event_ts"))).alias("_last_purchase_ts"),
    )
    before = carried if carried is not None else last_purchases(older(fct, snapshot_date))
    j = (base.join(favorites(month.select("user_id", "category_l1", "category_l2", "category_l3", "brand")), "user_id", "left")
         .join(before, "user_id", "left")
         .withColumn("_last_purchase_ts", F.coalesce("_last_purchase_ts", "last_purchase_ts")))
    return _user_output(j.withColumn("_snap", snap), "_last_purchase_ts")


def _user_output(j: DataFrame, last_purchase: str) -> DataFrame:
    snap = F.col("_snap")
    return j.select(
        snap.alias("snapshot_date"),
        "user_id",
        "user_purchase_count_last_month",
        "user_view_count_last_month",
        "user_cart_count_last_month",
        X.safe_ratio("user_purchase_count_last_month", "user_view_count_last_month")
         .alias("user_conversion_rate_last_month"),
        "user_sessions_last_month",
        "user_avg_price_purchased_last_month",
        F.col("_fc.category_l1").alias("user_favorite_category_l1_last_month"),
        F.col("_fc.category_l2").alias("user_favorite_category_l2_last_month"),
        F.col("_fc.category_l3").alias("user_favorite_category_l3_last_month"),
        F.col("_fb.brand").alias("user_favorite_brand_last_month"),
        X.days_between(snap, last_purchase).alias("days_since_last_purchase"),
        X.safe_ratio(F.col("user_cart_count_last_month") - F.col("user_purchase_count_last_month"),
                     F.col("user_cart_count_last_month")).alias("user_cart_abandon_rate_last_month"),
    )


def last_views(events: DataFrame) -> DataFrame:
    """(user_id, product_id, last_view_ts) of the views that events hold."""
    return events.where(_is("view")).groupBy("user_id", "product_id").agg(F.max("event_ts").alias("last_view_ts"))


def user_product_interactions_monthly(fct: DataFrame, snapshot_date, carried: DataFrame | None = None) -> DataFrame:
    """gold.user_product_interactions_monthly for one snapshot.

    A pair without a view in the window takes its last one from older views,
    or from carried, last_views of the months before.
    """
    month = fct.where(in_window(snapshot_date))
    agg = month.groupBy("user_id", "product_id").agg(
        countif(_is("view")).alias("ui_view_count_last_month"),
        countif(_is("cart")).alias("ui_cart_count_last_month"),
        countif(_is("purchase")).alias("ui_purchase_count_last_month"),
        F.max(F.when(_is("view"), F.col("event_ts"))).alias("_last_view_ts"),
    )
    before = carried if carried is not None else last_views(older(fct, snapshot_date))
    j = (agg.join(before, ["user_id", "product_id"], "left")
         .withColumn("_last_view_ts", F.coalesce("_last_view_ts", "last_view_ts")))
    return _interaction_output(j.withColumn("_snap", _snap(snapshot_date)), "_last_view_ts")


def _interaction_output(agg: DataFrame, last_view: str) -> DataFrame:
    snap = F.col("_snap")
    days = X.days_between(snap, last_view)
    w = X.INTERACTION_WEIGHTS
    return agg.select(
        snap.alias("snapshot_date"), "user_id", "product_id",
        "ui_view_count_last_month", "ui_cart_count_last_month", "ui_purchase_count_last_month",
        days.alias("ui_days_since_last_view"),
        X.recency_score(days).alias("ui_recency_score"),
        (F.col("ui_view_count_last_month") * w["view"]
         + F.col("ui_cart_count_last_month") * w["cart"]
         + F.col("ui_purchase_count_last_month") * w["purchase"]).alias("ui_interaction_score_last_month"),
    )


# ---------------------------------------------------------------------------
# All snapshots in one job (backfill)
# ---------------------------------------------------------------------------

def product_features_backfill(fct: DataFrame, snapshot_dates=None) -> DataFrame:
    """product_features_monthly for every snapshot at once.

    Snapshot S = first day of month m+1 has the window "month m" and the
    history "all months <= m".  Per (product, month) one grouped pass gives
    the window aggregates and the month's latest attributes; a running
    ``last(ignorenulls)`` / ``max`` over the product's months carries the
    history forward.  That window is partitioned by product and holds one
    row per month with events, so its size is bounded by the month count.
    One pass and one more over the purchases replace N rescans of the history.
    Buyers are found apart, from purchases alone: beside the other
    aggregates a distinct count would shuffle all of their states by buyer.
    Their rows, one per buyer, go through the same aggregate as the events, so
    product-months are not shuffled again to be joined.
    Equals the union of the single-snapshot runs (tested).
    """
    month = F.trunc("event_date", "MM")
    events = fct.withColumn("_m", month)
    buyers = events.where(_is("purchase")).select("product_id", "_m", F.col("user_id").alias("_buyer")).distinct()
    per_month = events.unionByName(buyers, allowMissingColumns=True).groupBy("product_id", "_m").agg(
        F.count("_buyer").alias("product_unique_buyers_last_month"),
        *_window_counts(F.lit(True), "product_"),
        exact_avg("price").alias("product_avg_price_last_month"),
        latest_when(F.struct("category_l1", "category_l2", "category_l3"),
                    F.col("category_l1").isNotNull(), *ORDER).alias("_cat_m"),
        latest_non_null("brand", *ORDER).alias("_brand_m"),
        latest_non_null("price", *ORDER).alias("_price_m"),
    )
    running = (Window.partitionBy("product_id").orderBy("_m")
                     .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    carried = per_month.select(
        "*",
        F.last("_cat_m", ignorenulls=True).over(running).alias("_cat"),
        F.last("_brand_m", ignorenulls=True).over(running).alias("product_brand"),
        F.last("_price_m", ignorenulls=True).over(running).alias("product_price"),
    )
    snapshot = F.add_months(F.col("_m"), 1)
    out = _product_output(carried.withColumn("_snap", snapshot), F.col("_snap"))
    return _keep_snapshots(out, snapshot_dates)


def _keep_snapshots(out: DataFrame, snapshot_dates) -> DataFrame:
    if snapshot_dates is None:
        return out
    return out.where(F.col("snapshot_date").isin([F.to_date(F.lit(str(d))) for d in snapshot_dates]))


def user_features_backfill(fct: DataFrame, snapshot_dates=None) -> DataFrame:
    """user_features_monthly for every snapshot in one job.

    Per (user, month): window counts, sessions, purchase price average and
    the month's last purchase; favourites per (user, month); the history
    recency is a running max over the user's months (one row per month with
    events, so the window is bounded by the month count).
    """
    e = fct.withColumn("_m", F.trunc("event_date", "MM"))
    base = e.groupBy("user_id", "_m").agg(
        *_window_counts(F.lit(True), "user_"),
        F.count_distinct("user_session").alias("user_sessions_last_month"),
        exact_avg(F.when(_is("purchase"), F.col("price"))).alias("user_avg_price_purchased_last_month"),
        F.max(F.when(_is("purchase"), F.col("event_ts"))).alias("_lp_m"),
    )
    running = (Window.partitionBy("user_id").orderBy("_m")
                     .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    base = base.withColumn("_last_purchase_ts", F.max("_lp_m").over(running))
    keys = ["user_id", "_m"]
    j = base.join(favorites(e, keys), keys, "left")
    out = _user_output(j.withColumn("_snap", F.add_months("_m", 1)), "_last_purchase_ts")
    return _keep_snapshots(out, snapshot_dates)


def user_product_interactions_backfill(fct: DataFrame, snapshot_dates=None) -> DataFrame:
    """user_product_interactions_monthly for every snapshot in one job."""
    e = fct.withColumn("_m", F.trunc("event_date", "MM"))
    agg = e.groupBy("user_id", "product_id", "_m").agg(
        countif(_is("view")).alias("ui_view_count_last_month"),
        countif(_is("cart")).alias("ui_cart_count_last_month"),
        countif(_is("purchase")).alias("ui_purchase_count_last_month"),
        F.max(F.when(_is("view"), F.col("event_ts"))).alias("_lv_m"),
    )
    running = (Window.partitionBy("user_id", "product_id").orderBy("_m")
                     .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    agg = agg.withColumn("_last_view_ts", F.max("_lv_m").over(running))
    out = _interaction_output(agg.withColumn("_snap", F.add_months("_m", 1)), "_last_view_ts")
    return _keep_snapshots(out, snapshot_dates)
