"""Spark ML hurdle training on fixture A1 (small grid) and model round trip."""

import os

import numpy as np
from pyspark.sql import functions as F

from demandlake.plans import models as MD
from demandlake.plans import training as TR


def _short(cfg):
    """A boosted configuration with few trees: tests only."""
    return {"algo": cfg["algo"], "params": {**cfg["params"], "n_estimators": 5}}


def test_grids_are_whole(spark):
    clf, reg = MD.classifier_grid(), MD.regressor_grid()
    assert len(clf) == 30 and len(reg) == 33
    assert {c["params"]["max_iter"] for c in MD.linear_only(reg)} == {500, 800}
    assert {MD.logistic_pipeline(c, ["x"], 10).getStages()[-1].getMaxIter() for c in MD.linear_only(clf)} == {1000}


def test_five_thousand_categories(spark):
    from demandlake.operators import features as FE
    df = spark.range(20_000).selectExpr("id", "concat('c', lpad(id % 5000, 4, '0')) as product_category_l1")
    encoding = FE.CategoryEncoding.fit(df)
    assert encoding.size == 5000
    assert [tuple(r) for r in encoding.index.orderBy("label").limit(3).collect()] == [("c0000", 0), ("c0001", 1), ("c0002", 2)]
    rows = encoding.transform(df.union(spark.createDataFrame([(-1, "new")], "id long, product_category_l1 string"))).collect()
    for r in rows:
        v = r["category_vector"]
        assert v.size == 5000 and (list(v.indices) == [r["id"] % 5000] if r["id"] >= 0 else len(v.indices) == 0)
    train = encoding.transform(df).withColumn("target_next_period", 1.0 + F.col("id") % 5000 % 7).withColumn("x", F.col("id") % 11)
    board, models = MD.stage2_search(train, train, ["x", "category_vector"], MD.linear_only(MD.regressor_grid())[::2])
    assert board.count() == 3
    rows = MD.sample_weights(train).withColumn("y", F.col("target_next_period"))
    for model in models.values():
        slopes = MD.poisson_slopes(model, rows)
        assert slopes.count() == 5002 and slopes.agg(F.max(F.abs("residual"))).first()[0] < 1e-7


def test_importances_are_those_of_the_searches_best_boosted_models(spark, sf_dir, monkeypatch):
    from demandlake import queries as Q
    from demandlake.plans import boosting as B
    from demandlake.plans import chunks as C
    asked = []

    def search(prefix, features):
        def run(train, val, names, grid, *rest):
            runs = MD.run_names(grid, prefix)
            asked.append([c["algo"] for c in grid])
            gain = B.Tree(*(np.array(a) for a in ([0, -1, -1], [0.0, 0, 0], [0.0, 1, 2], [2.0, 0, 0])))
            models = {r: B.Boosted("logistic", 0.0, C.Features((f"{features}{i}",), 0), (gain,)) for i, r in enumerate(runs)}
            order = [runs[0], runs[-2], *runs[1:-2], runs[-1]]  # a linear model leads, the last but one is the best boosted one
            board = spark.createDataFrame([(k, r, r.split("_")[1]) for k, r in enumerate(order)], "k int, run_name string, algo string").orderBy("k")
            return board, models
        return run

    monkeypatch.setattr(Q, "_train_val", lambda *a: (None, None, []))
    monkeypatch.setattr(MD, "stage1_search", search("clf", "a"))
    monkeypatch.setattr(MD, "stage2_search", search("reg", "b"))
    got = [tuple(r) for r in Q.QUERIES["feature_importance_topk"](spark, sf_dir).collect()]
    assert [len(a) for a in asked] == [30, 33]
    assert sorted(got) == [("classifier", "clf_gbt_29", "a28", 1.0), ("regressor", "reg_gbt_32", "b31", 1.0)]


def test_hurdle_training_small_grid(spark, sf_dir, tmp_lake):
    from demandlake.queries import a1_training
    clf, reg = MD.classifier_grid(), MD.regressor_grid()
    res = TR.train_hurdle_model(a1_training(spark, sf_dir), out_dir=tmp_lake, classifiers=[clf[1], _short(clf[3])],
                                regressors=[reg[2], _short(reg[6])])
    assert res["stage1"].count() == 2 and res["stage2"].count() == 2
    assert res["comparison"].count() == 4 and res["blend"].count() == 21
    preds = res["validation_predictions"]
    n_val = preds.count()
    assert n_val > 0
    assert preds.where((F.col("p_nonzero") < 0) | (F.col("p_nonzero") > 1)).count() == 0
    assert preds.where(F.col("pred_soft") < 0).count() == 0
    loaded = MD.SparkHurdleModel.load(os.path.join(tmp_lake, "hurdle_model"))
    assert loaded.feature_names == res["feature_columns"]
    from demandlake.operators import features as FE
    feats, _ = FE.prepare_features(a1_training(spark, sf_dir), "extended", loaded.category)
    _, val, _, _ = FE.split_by_snapshots(feats)
    a = res["model"].predict_soft(val).select("product_id", "pred_soft")
    b = loaded.predict_soft(val).select("product_id", "pred_soft")
    assert a.exceptAll(b).count() == 0
    gbt = [m for name, m in res["classifiers"].items() if "gbt" in name][0]
    top = TR.feature_importance_topk(gbt, k=5).collect()
    assert len(top) == 5 and top[0]["importance"] >= top[-1]["importance"]
    assert TR.feature_importance_topk(res["classifiers"]["clf_logreg_01"]) is None


def test_logistic_fits_of_many_rows_run_one_after_another():
    assert MD.fit_threads(MD.SIDE_BY_SIDE_ROWS) == MD.FIT_THREADS > 1 == MD.fit_threads(MD.SIDE_BY_SIDE_ROWS + 1)


def test_models_are_applied_to_their_features_and_the_columns_that_are_kept(spark, monkeypatch):
    from demandlake.plans import boosting as B
    from demandlake.plans import chunks as C
    stump = B.Tree(*(np.array(a) for a in ([0, -1, -1, -1], [0.5, 0, 0, 0], [0.0, -1, 1, 0], [2.0, 0, 0, 0])))
    models = [B.Boosted("logistic", 0.0, C.Features(("a",), 0), (stump,) * k) for k in (1, 3)]
    df = spark.range(4).selectExpr("id % 2 AS a", "id AS label", "repeat('x', 100) AS wide")
    seen, real = [], C.scored
    monkeypatch.setattr(C, "scored", lambda d, f, r, n, keep=None: seen.append(keep) or real(d, f, r, n, keep))
    got = MD._predictions(df, models, ["label"], None).orderBy("label").collect()
    assert seen == [["label"]] and [r["label"] for r in got] == [0, 1, 2, 3]
    for r in got:
        margin = 1.0 if r["label"] % 2 else -1.0
        assert np.allclose(r["scores"], [1 / (1 + np.exp(-margin)), 1 / (1 + np.exp(-3 * margin))])


def test_training_does_not_keep_the_training_rows_twice(spark, monkeypatch):
    import pytest
    from pyspark import StorageLevel

    from demandlake.operators import features as FE

    class Searched(Exception):
        pass

    def search(train, val, *rest):
        assert train.storageLevel == StorageLevel.NONE and val.storageLevel != StorageLevel.NONE
        raise Searched

    rows = spark.createDataFrame([("2020-01-01", 1.0), ("2020-02-01", 2.0)], "d string, x double").selectExpr("cast(d AS date) AS snapshot_date", "x")
    monkeypatch.setattr(FE, "prepare_features", lambda *a: (rows, None))
    monkeypatch.setattr(MD, "stage1_search", search)
    with pytest.raises(Searched):
        TR.train_hurdle_model(rows)
