"""Semantic edge cases on tiny inline frames."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from demandlake.functions import scalars as X
from demandlake.operators import gold, metrics as M, quality as Q, silver
from demandlake.operators import hurdle as H
from demandlake.schemas import BRONZE


def bronze_rows(spark, rows):
    """rows: tuples of the nine raw strings; lineage is filled in."""
    full = [r + ("uri", dt.datetime(2020, 11, 1, 5), "manual_2020-10", dt.date(2020, 10, 1)) for r in rows]
    return spark.createDataFrame(full, BRONZE)


def ev(ts, typ, pid="1", cat="electronics.audio.headphones", brand="acme", price="10.00", uid="7", sess="s1"):
    return (ts, typ, pid, "100", cat, brand, price, uid, sess)


def test_malformed_timestamp_strict_and_lenient(spark):
    b = bronze_rows(spark, [ev("not a time UTC", "view")])
    with pytest.raises(Exception):
        silver.parse_events(b, strict=True).collect()
    assert silver.parse_events(b, strict=False).first()["event_ts"] is None


def test_text_cleaning_tabs_and_blanks(spark):
    b = bronze_rows(spark, [ev("2020-10-01 10:00:00 UTC", "\tVIEW ", brand="\t Acme \n", sess=" \t ",
                               cat="  ")])
    r = silver.parse_events(b).first()
    assert r["event_type"] == "view"
    assert r["brand"] == "acme"
    assert r["user_session"] is None
    assert r["category_code"] is None


def test_safe_casts(spark):
    df = spark.createDataFrame([("12",), ("12.5",), ("1e3",), ("",), (" 12 ",), ("n/a",)], "s string")
    got = [r[0] for r in df.select(X.safe_bigint("s")).collect()]
    assert got == [12, None, None, None, 12, None]


def test_category_levels_one_to_four(spark):
    df = spark.createDataFrame([("a",), ("a.b",), ("a.b.c",), ("a.b.c.d",)], "c string")
    got = df.select(*[X.category_level("c", i).alias(f"l{i}") for i in range(3)]).collect()
    assert [tuple(r) for r in got] == [("a", None, None), ("a", "b", None), ("a", "b", "c"), ("a", "b", "c")]


def test_dedup_prefers_older_valid_copy(spark):
    rows = [ev("2020-10-01 10:00:00 UTC", "view", price="-1.00"),
            ev("2020-10-01 10:00:00 UTC", "view", price="5.00")]
    full = [rows[0] + ("uri", dt.datetime(2020, 11, 1, 5), "m", dt.date(2020, 10, 1)),
            rows[1] + ("uri", dt.datetime(2020, 11, 1, 4), "m", dt.date(2020, 10, 1))]
    b = spark.createDataFrame(full, BRONZE)
    out = silver.fct_events(b).collect()
    assert len(out) == 1 and float(out[0]["price"]) == 5.0


def test_first_event_ties_broken_by_event_id(spark):
    b = bronze_rows(spark, [ev("2020-10-01 10:00:00 UTC", "view", pid="1"),
                            ev("2020-10-01 10:00:00 UTC", "cart", pid="2")])
    fct = silver.fct_events(b)
    s = silver.sessions(fct).first()
    first = fct.orderBy("event_ts", "event_id").first()
    assert s["first_event_type"] == first["event_type"] and s["event_count"] == 2


def test_never_viewed_pair_has_null_recency(spark):
    b = bronze_rows(spark, [ev("2020-10-05 10:00:00 UTC", "cart")])
    r = gold.user_product_interactions_monthly(silver.fct_events(b), "2020-11-01").first()
    assert r["ui_days_since_last_view"] is None and r["ui_recency_score"] is None
    assert r["ui_interaction_score_last_month"] == 3


def test_negative_abandonment(spark):
    b = bronze_rows(spark, [ev("2020-10-05 10:00:00 UTC", "cart", pid="1"),
                            ev("2020-10-05 11:00:00 UTC", "purchase", pid="2"),
                            ev("2020-10-05 12:00:00 UTC", "purchase", pid="3")])
    r = gold.user_features_monthly(silver.fct_events(b), "2020-11-01").first()
    assert r["user_cart_abandon_rate_last_month"] == -1.0
    assert r["days_since_last_purchase"] == 27


@pytest.mark.parametrize("snap,lo", [("2021-01-01", dt.date(2020, 12, 1)), ("2020-03-01", dt.date(2020, 2, 1))])
def test_window_bounds_year_end_and_leap_february(spark, snap, lo):
    lo_c, hi_c = gold.window_bounds(snap)
    r = spark.range(1).select(lo_c.alias("lo"), hi_c.alias("hi")).first()
    assert r["lo"] == lo and r["hi"] == dt.date.fromisoformat(snap)


def test_leap_february_window_counts_the_29th(spark):
    b = bronze_rows(spark, [ev("2020-02-29 23:59:59 UTC", "view"), ev("2020-03-01 00:00:00 UTC", "view")])
    r = gold.product_features_monthly(silver.fct_events(b), "2020-03-01").first()
    assert r["product_view_count_last_month"] == 1


def test_empty_silver(spark):
    empty = silver.fct_events(bronze_rows(spark, []))
    assert silver.calendar_dates(empty).count() == 0
    assert Q.assert_snapshot_date_after_events(empty, "2020-11-01").count() == 0
    assert gold.product_features_monthly(empty, "2020-11-01").count() == 0


def test_backfill_equals_single_runs(spark, sf_dir):
    from demandlake.queries import a1_fct
    fct = a1_fct(spark, sf_dir).cache()
    snaps = ["1996-03-01", "1999-12-01", "2001-01-01"]
    bf = gold.product_features_backfill(fct, snaps)
    single = None
    for s in snaps:
        one = gold.product_features_monthly(fct, s)
        single = one if single is None else single.unionByName(one)
    assert bf.exceptAll(single).count() == 0 and single.exceptAll(bf).count() == 0
    assert bf.count() > 0
    fct.unpersist()


def test_metrics_against_hand_values(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.8), (1, 0.8), (0, 0.1), (1, 0.4)], "label int, p double")
    r = M.classification_metrics(df, "label", "p", 0.5).first()
    # pairs (pos, neg): 0.9>0.8,0.9>0.1, 0.8=0.8 (1/2), 0.8>0.1, 0.4<0.8, 0.4>0.1 -> 4.5/6
    assert r["auc_roc"] == pytest.approx(4.5 / 6)
    # AP: thresholds 0.9 (P=1,R=1/3), 0.8 (P=2/3,R=2/3), 0.4 (P=3/4,R=1)
    assert r["pr_auc"] == pytest.approx(1 / 3 * 1 + 1 / 3 * 2 / 3 + 1 / 3 * 3 / 4)
    assert r["accuracy"] == pytest.approx(3 / 5)
    assert r["precision"] == pytest.approx(2 / 3) and r["recall"] == pytest.approx(2 / 3)
    assert r["f1"] == pytest.approx(2 / 3)


def test_single_class_labels(spark):
    df = spark.createDataFrame([(0, 0.2), (0, 0.7)], "label int, p double")
    r = M.classification_metrics(df, "label", "p").first()
    assert r["auc_roc"] is None and r["pr_auc"] is None
    assert r["precision"] == 0.0 and r["recall"] == 0.0 and r["f1"] == 0.0


def test_zero_wape_denominator(spark):
    df = spark.createDataFrame([(0.0, 1.0), (0.0, 0.0)], "y double, p double")
    r = M.regression_metrics(df, "y", "p").first()
    assert math.isnan(r["wape"]) and r["mae"] == 0.5
    assert r["rmsle"] == pytest.approx(math.sqrt(math.log(2) ** 2 / 2))


def test_hurdle_soft_and_hard(spark):
    df = spark.createDataFrame([(0.7, 3.0), (0.2, 5.0), (0.9, -1.0)], "p_nonzero double, positive_count double")
    r = H.hurdle_combine(df).collect()
    assert [x["pred_soft"] for x in r] == pytest.approx([2.1, 1.0, 0.0])
    assert [x["pred_hard"] for x in r] == [3.0, 0.0, 0.0]


def test_blend_ties_pick_lowest_weight(spark):
    df = spark.createDataFrame([(1.0, 1.0, 1.0)], "target_next_period double, pred_hard double, pred_baseline double")
    best = H.best_blend(H.blend_search(df)).first()
    assert best["w_hurdle"] == 0.0 and best["rmse"] == 0.0


def test_valid_event_types_ignores_null(spark):
    df = spark.createDataFrame([("view",), (None,), ("remove",)], "event_type string")
    assert [r[0] for r in Q.assert_valid_event_types(df).collect()] == ["remove"]


def test_run_params_december_rollover():
    from demandlake.plans.monthly import compute_run_params
    assert compute_run_params("2020-12")["snapshot_date"] == "2021-01-01"
    with pytest.raises(ValueError):
        compute_run_params("2020-1")


def test_one_hot_unseen_category_is_all_zero(spark):
    from demandlake.operators import features as FE
    df = spark.createDataFrame([("x",), (None,)], "product_category_l1 string")
    out = FE.one_hot_category(df, ["UNKNOWN", "a"]).collect()
    assert [tuple(r) for r in out] == [(0, 0), (1, 0)]


def test_lead_target_skips_calendar_gaps(spark):
    """A product without events in a month has no snapshot row; LEAD takes
    the next existing snapshot, not the next calendar month."""
    from demandlake.operators import features as FE
    b = bronze_rows(spark, [ev("2020-01-10 10:00:00 UTC", "purchase"),
                            ev("2020-03-10 10:00:00 UTC", "purchase"),
                            ev("2020-03-11 10:00:00 UTC", "purchase", sess="s2"),
                            ev("2020-04-10 10:00:00 UTC", "view")])
    fct = silver.fct_events(b)
    pf = gold.product_features_backfill(fct)
    ts = FE.training_set(pf, silver.calendar_dates(fct)).orderBy("snapshot_date").collect()
    assert [(str(r["snapshot_date"]), r["target_next_period"]) for r in ts] == [
        ("2020-02-01", 2), ("2020-04-01", 0)]


def test_backfill_latest_attributes_carry_over_gaps(spark):
    b = bronze_rows(spark, [ev("2020-01-10 10:00:00 UTC", "view", brand="old"),
                            ev("2020-02-10 10:00:00 UTC", "view", brand="  ", price=""),
                            ev("2020-05-10 10:00:00 UTC", "view", brand="", cat="")])
    fct = silver.fct_events(b)
    bf = {str(r["snapshot_date"]): r for r in gold.product_features_backfill(fct).collect()}
    assert bf["2020-06-01"]["product_brand"] == "old"
    assert bf["2020-06-01"]["product_category_l1"] == "electronics"
    assert float(bf["2020-03-01"]["product_price"]) == 10.0
    single = gold.product_features_monthly(fct, "2020-06-01").first()
    assert single["product_brand"] == "old" and single["product_category_l1"] == "electronics"


def test_equal_timestamps_dedup_only_exact_copies(spark):
    b = bronze_rows(spark, [ev("2020-10-01 10:00:00 UTC", "view", pid="1"),
                            ev("2020-10-01 10:00:00 UTC", "view", pid="1"),
                            ev("2020-10-01 10:00:00 UTC", "view", pid="2")])
    assert silver.fct_events(b).count() == 2


@pytest.mark.parametrize("one_job,single", [
    (gold.user_features_backfill, gold.user_features_monthly),
    (gold.user_product_interactions_backfill, gold.user_product_interactions_monthly),
])
def test_user_backfills_equal_single_runs(spark, sf_dir, one_job, single):
    from demandlake.queries import a1_fct
    fct = a1_fct(spark, sf_dir).cache()
    snaps = ["1996-03-01", "2000-07-01"]
    bf = one_job(fct, snaps)
    runs = single(fct, snaps[0]).unionByName(single(fct, snaps[1]))
    assert bf.count() > 0
    assert bf.exceptAll(runs).count() == 0 and runs.exceptAll(bf).count() == 0
    fct.unpersist()


def test_a_model_that_does_not_fit_gives_the_fallback(spark):
    from demandlake.plans import scoring as SC

    class Broken:
        feature_names = ["product_price"]

        def predict_soft(self, df):
            return df.select("no_such_column")

    req = spark.createDataFrame([("1", "b", "c", 1.0, 10), ("x", "b", "c", 1.0, 10)],
                                "product_id string, brand string, category string, price double, prev_month_sales long")
    feats = spark.createDataFrame([(1,)], "product_id long").select(
        *[F.col("product_id") if c == "product_id" else F.lit(None).cast("double").alias(c) for c in SC.SCORING_FEATURE_COLUMNS])
    got = {r.product_id: r.model_version for r in SC.score_requests(req, feats, Broken()).collect()}
    assert got == {"1": "mock-fallback", "x": "mock-v1"}
