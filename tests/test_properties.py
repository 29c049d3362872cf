"""Distributed metrics against brute-force definitions on random data."""

import json
import os
import subprocess
import sys

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from demandlake.operators import metrics as M

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def brute_auc(rows):
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    if not pos or not neg:
        return None
    wins = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p in pos for n in neg)
    return wins / (len(pos) * len(neg))


def brute_ap(rows):
    npos = sum(y for y, _ in rows)
    if npos == 0:
        return None
    ap, prev_recall = 0.0, 0.0
    for t in sorted({s for _, s in rows}, reverse=True):
        sel = [y for y, s in rows if s >= t]
        tp = sum(sel)
        recall, precision = tp / npos, tp / len(sel)
        ap += (recall - prev_recall) * precision
        prev_recall = recall
    return ap


def brute_confusion(rows, thr=0.5):
    tp = sum(1 for y, s in rows if s >= thr and y == 1)
    fp = sum(1 for y, s in rows if s >= thr and y == 0)
    fn = sum(1 for y, s in rows if s < thr and y == 1)
    tn = len(rows) - tp - fp - fn
    d = lambda a, b: a / b if b else 0.0
    return {"accuracy": d(tp + tn, len(rows)), "precision": d(tp, tp + fp),
            "recall": d(tp, tp + fn), "f1": d(2 * tp, 2 * tp + fp + fn)}


rows_strategy = st.lists(
    st.tuples(st.integers(0, 1), st.sampled_from([0.0, 0.1, 0.25, 0.5, 0.5, 0.7, 0.9, 1.0])),
    min_size=1, max_size=40)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=rows_strategy, parts=st.integers(1, 5))
def test_classification_metrics_match_brute_force(spark, rows, parts):
    df = spark.createDataFrame(rows, "label int, p double").repartition(parts)
    got = M.classification_metrics(df, "label", "p", 0.5, partitions=parts).first().asDict()
    auc, ap = brute_auc(rows), brute_ap(rows)
    assert (got["auc_roc"] is None) == (auc is None)
    if auc is not None:
        assert got["auc_roc"] == pytest.approx(auc, abs=1e-12)
    assert (got["pr_auc"] is None) == (ap is None)
    if ap is not None:
        assert got["pr_auc"] == pytest.approx(ap, abs=1e-12)
    for k, v in brute_confusion(rows).items():
        assert got[k] == pytest.approx(v, abs=1e-12)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.tuples(st.integers(0, 6), st.integers(0, 6), st.integers(0, 6)), min_size=1, max_size=30))
def test_best_blend_is_the_brute_force_argmin(spark, rows):
    from demandlake.operators import hurdle as H
    df = spark.createDataFrame([tuple(float(x) for x in r) for r in rows],
                               "target_next_period double, pred_hard double, pred_baseline double")
    best = H.best_blend(H.blend_search(df)).first()

    def rmse(w):
        errs = [(y - max(w * h + (1 - w) * b, 0.0)) ** 2 for y, h, b in rows]
        return (sum(errs) / len(errs)) ** 0.5

    scores = [(rmse(w), w) for w in H.BLEND_WEIGHTS]
    lo = min(s for s, _ in scores)
    # the chosen weight is optimal (up to floating noise) and the lowest among equals
    assert best["rmse"] == pytest.approx(lo, abs=1e-9)
    assert best["w_hurdle"] == min(w for s, w in scores if abs(s - best["rmse"]) <= 1e-9)


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_RUNS="1",
               BENCH_QUERIES="product_features_monthly", BENCH_CPUS="2")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env, capture_output=True,
                         text=True, timeout=600)
    lines = [line for line in out.stdout.splitlines() if line.strip()]
    assert len(lines) == 1, out.stderr[-2000:]
    d = json.loads(lines[0])
    assert {"metric", "value", "unit", "queries", "sf"} <= set(d)
    assert d["unit"] == "sec" and d["queries"]["product_features_monthly"] > 0
