"""Hurdle model: P(demand > 0) x E[demand | demand > 0].

Stage 1: logistic regressions of Spark ML and boosted trees with log loss.
Stage 2: Poisson regressions and boosted trees with Poisson loss.  A boosted
configuration is a stage of the fit with the grid's most trees, and all runs of
a search are ranked in one job.  The chosen pair is saved with JSON metadata
(ordered feature names, category index, threshold).
"""

from __future__ import annotations

import itertools
import json
import os

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import OneHotEncoderModel, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import metrics as M
from ..operators.features import CategoryEncoding
from . import boosting as B
from . import chunks as C
from . import poisson as P

SEED = 42


# ----------------------------------------------------------------- grids

# The configuration grids of the two search stages.
# Stage 1 (is demand > 0): logistic regression inverse strengths, then
# boosted trees over tree counts x depths x learning rates; row and
# feature sampling 0.8.
LOGREG_C = [0.1, 1.0, 10.0]
LOGREG_MAX_ITER = 1000
CLF_TREES = [100, 200, 300]
CLF_DEPTHS = [5, 6, 7]
CLF_LEARNING_RATES = [0.05, 0.07, 0.02]
# Stage 2 (how much, positives only): Poisson GLM strengths x iteration
# caps, then boosted trees over tree counts x depths x learning rates.
POISSON_ALPHA = [0.1, 1.0, 5.0]
POISSON_MAX_ITER = [500, 800]
REG_TREES = [300, 600, 80]
REG_DEPTHS = [4, 6, 8]
REG_LEARNING_RATES = [0.03, 0.05, 0.001]


def _gbt(n: int, depth: int, lr: float) -> dict:
    return {"algo": "gbt", "params": {"n_estimators": n, "max_depth": depth, "learning_rate": lr,
                                      "subsample": B.ROW_SHARE, "colsample": B.FEATURE_SHARE, "leaf_penalty": B.LEAF_PENALTY}}


def classifier_grid() -> list[dict]:
    """All 30 configurations: 3 logistic, then 27 boosted."""
    linear = [{"algo": "logreg", "params": {"C": c, "max_iter": LOGREG_MAX_ITER}} for c in LOGREG_C]
    return linear + [_gbt(n, d, lr) for n, d, lr in itertools.product(CLF_TREES, CLF_DEPTHS, CLF_LEARNING_RATES)]


def regressor_grid() -> list[dict]:
    """All 33 configurations: 6 Poisson, then 27 boosted."""
    linear = [{"algo": "poisson", "params": {"alpha": a, "max_iter": it}}
              for a, it in itertools.product(POISSON_ALPHA, POISSON_MAX_ITER)]
    return linear + [_gbt(n, d, lr) for n, d, lr in itertools.product(REG_TREES, REG_DEPTHS, REG_LEARNING_RATES)]


def linear_only(grid: list[dict]) -> list[dict]:
    """The grid's linear configurations, for runs that name them."""
    return [c for c in grid if c["algo"] != "gbt"]


# ------------------------------------------------------------------ fits

def _assembler(feature_cols: list[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=feature_cols, outputCol="features_raw", handleInvalid="keep")


def logistic_pipeline(cfg: dict, feature_cols: list[str], n_train: int) -> Pipeline:
    p = cfg["params"]
    # sklearn minimises C*sum(loss) + |w|^2/2; Spark mean(loss) + reg/2*|w|^2
    reg = 1.0 / (p["C"] * max(n_train, 1))
    return Pipeline(stages=[
        _assembler(feature_cols),
        # Not centred, which keeps sparse rows sparse; the intercept is not penalised and takes it up.
        StandardScaler(inputCol="features_raw", outputCol="features", withMean=False, withStd=True),
        LogisticRegression(featuresCol="features", labelCol="label", regParam=reg, elasticNetParam=0.0,
                           standardization=False, maxIter=p["max_iter"]),
    ])


#: Columns that a logistic pipeline adds.
_PIPELINE_COLUMNS = ("features_raw", "features", "rawPrediction", "probability", "prediction")


def p_nonzero(model, df: DataFrame, name: str = "p_nonzero", lenient: bool = False) -> DataFrame:
    """df with the probability of a positive target by a stage 1 model of either kind."""
    if not isinstance(model, PipelineModel):
        return model.predicted(df, name, lenient)
    return model.transform(df).withColumn(name, vector_to_array("probability")[1]).drop(*_PIPELINE_COLUMNS)


def positive_count(model, df: DataFrame, name: str = "positive_count", lenient: bool = False) -> DataFrame:
    """df with the mean of a positive target by a stage 2 model of either kind."""
    return model.predicted(df, name, lenient).withColumn(name, F.greatest(F.col(name), F.lit(0.0)))


def sample_weights(df: DataFrame, y: str = "target_next_period") -> DataFrame:
    """weight = 1 + y / mean(y); the mean is one scalar aggregate."""
    mean = df.agg(F.avg(F.col(y).cast("double"))).first()[0] or 1.0
    return df.withColumn("weight", F.lit(1.0) + F.col(y).cast("double") / F.lit(float(mean)))


def run_names(grid: list[dict], prefix: str) -> list[str]:
    return [f"{prefix}_{cfg['algo']}_{i:02d}" for i, cfg in enumerate(grid, 1)]


# --------------------------------------------------------------- searches

#: Logistic fits that run side by side; each is a distributed job of its own.
FIT_THREADS = 3
#: Rows up to which they do.  A fit keeps all its rows as blocks, about 270 bytes a row; what memory does not hold goes to disk.
SIDE_BY_SIDE_ROWS = 1 << 22


def fit_threads(rows: int) -> int:
    """How many logistic fits run side by side."""
    return FIT_THREADS if rows <= SIDE_BY_SIDE_ROWS else 1


def _boosted(table: DataFrame, train: DataFrame, features: C.Features, grid: list[dict], objective: str, base: float) -> dict[int, B.Boosted]:
    """The model of each boosted configuration, by its place in grid.

    Configurations that differ in their number of trees alone are stages of
    one fit; all fits share their jobs.
    """
    stages: dict[tuple, dict[int, int]] = {}
    for i, cfg in enumerate(grid):
        if cfg["algo"] == "gbt":
            p = cfg["params"]
            stages.setdefault((p["max_depth"], p["learning_rate"]), {})[i] = p["n_estimators"]
    if not stages:
        return {}
    p = next(cfg["params"] for cfg in grid if cfg["algo"] == "gbt")
    runs = [B.Run(depth, rate, max(trees.values())) for (depth, rate), trees in stages.items()]
    fitted = B.fit(table, features, B.cuts(train, features), runs, objective, base,
                   row_share=p["subsample"], feature_share=p["colsample"], penalty=p["leaf_penalty"])
    return {i: model.first(k) for model, trees in zip(fitted, stages.values()) for i, k in trees.items()}


def _predictions(df: DataFrame, models: list, keep: list[str], score) -> DataFrame:
    """keep and `scores`, an array of every model's prediction in order.

    Models of one kind and feature layout are applied together.
    """
    named = df
    boosted = [i for i, m in enumerate(models) if isinstance(m, B.Boosted)]
    linear = [i for i, m in enumerate(models) if isinstance(m, P.Poisson)]
    columns: dict[int, object] = {}
    for i, m in enumerate(models):
        if i not in boosted and i not in linear:
            named = score(m, named, f"_p{i}")
            columns[i] = F.col(f"_p{i}")
    if linear:
        named = P.with_models(named, [models[i] for i in linear], "_linear")
        columns |= {i: F.col("_linear")[k] for k, i in enumerate(linear)}
    if boosted:
        # Stages of one fit share their first trees: the longest is walked once.
        chains: dict[tuple, list[int]] = {}
        for i in boosted:
            chains.setdefault((id(models[i].trees[0]) if models[i].trees else -i,), []).append(i)
        order, staged = [], []
        for members in chains.values():
            longest = max((models[i] for i in members), key=lambda m: len(m.trees))
            staged.append((longest, [len(models[i].trees) for i in members]))
            order += members
        named = B.with_stages(named, staged, "_boosted", [c for c in named.columns if c in keep or c == "_linear" or c in {f"_p{i}" for i in columns}])
        columns |= {i: F.col("_boosted")[k] for k, i in enumerate(order)}
    return named.select(*keep, F.array(*[columns[i] for i in range(len(models))]).alias("scores"))


def _long(predicted: DataFrame, runs: list[str], keep: list[str]) -> DataFrame:
    """One row per row and run."""
    return predicted.select(*keep, F.posexplode("scores").alias("_run", "score")).withColumn(
        "run_name", F.element_at(F.array(*map(F.lit, runs)), F.col("_run") + 1)).drop("_run")


def _board(spark: SparkSession, metrics: DataFrame, runs: list[str], grid: list[dict]) -> DataFrame:
    """run_name, algo, params and the metrics of both splits; written once.  A run whose metrics are undefined has nulls."""
    from ..session import materialize
    rows = [(run, cfg["algo"], json.dumps(cfg["params"])) for run, cfg in zip(runs, grid)]
    table = spark.createDataFrame(rows, "run_name string, algo string, params string")
    return materialize(table.join(M.by_split(metrics), "run_name", "left"))


#: Rows that a part of a cached frame holds at most, about.
CACHED_ROWS = 1 << 18


def spread(df: DataFrame) -> DataFrame:
    """df for the cache, in parts of about CACHED_ROWS rows.

    A frame read from files has parts of equal file size, and a part of small,
    well compressed files is many times larger in memory.
    """
    parts = -(-df.count() // CACHED_ROWS)
    return df.repartition(parts, "product_id", "snapshot_date") if parts > 1 else df


def stage1_search(train: DataFrame, val: DataFrame, feature_cols: list[str], grid: list[dict],
                  threshold: float = 0.5):
    """Fit each classifier config; leaderboard sorted by val_pr_auc desc."""
    from concurrent.futures import ThreadPoolExecutor
    spark = train.sparkSession
    label = (F.col("target_next_period") > 0).cast("double")
    tr, va = spread(train).withColumn("label", label).cache(), spread(val).withColumn("label", label).cache()
    runs = run_names(grid, "clf")
    try:
        n_train, base = tr.agg(F.count(F.lit(1)), F.avg("label")).first()
        models: list = [None] * len(grid)
        with ThreadPoolExecutor(fit_threads(n_train)) as pool:
            fits = {i: pool.submit(logistic_pipeline(cfg, feature_cols, n_train).fit, tr) for i, cfg in enumerate(grid) if cfg["algo"] == "logreg"}
        for i, f in fits.items():
            models[i] = f.result()
        if any(cfg["algo"] == "gbt" for cfg in grid):
            features = C.layout(tr, feature_cols)
            table = C.packed(tr, features, F.col("label"), F.lit(1.0))
            for i, m in _boosted(table, tr, features, grid, "logistic", min(max(base or 0.0, 1e-6), 1 - 1e-6)).items():
                models[i] = m
        parts = [_predictions(d.withColumn("split", F.lit(s)), models, ["split", "label"], p_nonzero) for s, d in (("train", tr), ("val", va))]
        metrics = M.classification_metrics_by(_long(parts[0].unionByName(parts[1]), runs, ["split", "label"]),
                                              ["run_name", "split"], "label", "score", threshold)
        board = _board(spark, metrics, runs, grid)
    finally:
        tr.unpersist()
        va.unpersist()
    return board.orderBy(F.col("val_pr_auc").desc_nulls_last(), "run_name"), dict(zip(runs, models))


def stage2_search(train: DataFrame, val: DataFrame, feature_cols: list[str], grid: list[dict]):
    """Fit each regressor on positives only; leaderboard sorted by val_rmse asc."""
    spark = train.sparkSession
    y = F.col("target_next_period").cast("double")
    tr = sample_weights(spread(train.where(y > 0))).withColumn("y", y).cache()
    va = spread(val.where(y > 0)).withColumn("y", y).withColumn("weight", F.lit(1.0)).cache()
    runs = run_names(grid, "reg")
    try:
        base = tr.agg(F.sum(F.col("weight") * F.col("y")) / F.sum("weight")).first()[0] or 1.0
        features = C.layout(tr, feature_cols)
        table = C.packed(tr, features, F.col("y"), F.col("weight"))
        models: list = [None] * len(grid)
        linear = [(i, cfg["params"]) for i, cfg in enumerate(grid) if cfg["algo"] == "poisson"]
        if linear:
            alphas = sorted({p["alpha"] for _, p in linear})
            caps = sorted({p["max_iter"] for _, p in linear})
            fitted = P.fit(table, features, alphas, caps)
            for i, p in linear:
                models[i] = fitted[alphas.index(p["alpha"])][caps.index(p["max_iter"])]
        for i, m in _boosted(table, tr, features, grid, "poisson", base).items():
            models[i] = m
        parts = [_predictions(d.withColumn("split", F.lit(s)), models, ["split", "y"], positive_count) for s, d in (("train", tr), ("val", va))]
        scored = _long(parts[0].unionByName(parts[1]), runs, ["split", "y"]).withColumn("score", F.greatest(F.col("score"), F.lit(0.0)))
        board = _board(spark, M.regression_metrics_by(scored, ["run_name", "split"], "y", "score"), runs, grid)
    finally:
        tr.unpersist()
        va.unpersist()
    return board.orderBy(F.col("val_rmse").asc_nulls_last(), "run_name"), dict(zip(runs, models))


def logistic_gradient(model: PipelineModel, rows: DataFrame, n_rows: int, c: float) -> DataFrame:
    """(check_name, residual): the loss's slope in each coefficient at the fitted model; zero at the optimum.

    The loss is the mean log loss and half the squared coefficients over
    c * n_rows.  A row adds its vector to weighted sums, which costs its filled
    places alone; weights must not be negative, so two is added to each and
    taken off the sums again.
    """
    fitted = model.stages[-1]
    slope = F.col("p") - F.col("label")
    scored = model.transform(rows).select(vector_to_array("probability")[1].alias("p"), "label", "features")
    sums = scored.agg(vector_to_array(Summarizer.sum(F.col("features"), slope + 2)).alias("raised"),
                      vector_to_array(Summarizer.sum(F.col("features"))).alias("plain"),
                      F.avg(slope).alias("outer"), F.count(F.lit(1)).alias("n"))
    weights = F.array(*[F.lit(float(w)) for w in fitted.coefficients.toArray()])
    mean = F.zip_with("raised", "plain", lambda r, x: (r - 2 * x) / F.col("n"))
    slopes = F.zip_with(mean, weights, lambda g, w: g + w / (c * n_rows))
    inner = sums.select(F.posexplode(slopes).alias("pos", "residual")).select(
        F.concat(F.lit("coefficient_"), F.col("pos").cast("string")).alias("check_name"), "residual")
    outer = sums.select(F.lit("intercept").alias("check_name"), F.col("outer").alias("residual"))
    return inner.unionByName(outer)


def poisson_slopes(model: P.Poisson, rows: DataFrame) -> DataFrame:
    """(check_name, residual): the loss's slope in each coefficient at the fitted model; zero at the optimum.

    rows hold y and weight.
    """
    table = C.packed(rows, model.features, F.col("y"), F.col("weight"))
    return rows.sparkSession.createDataFrame(model.slopes(table), "check_name string, residual double")


# ------------------------------------------------------------ the model

def _save(model, path: str) -> str:
    """Save a model of any kind; returns the name of its kind."""
    if isinstance(model, PipelineModel):
        model.write().overwrite().save(path)
    else:
        model.save(path)
    return type(model).__name__


_KINDS = {c.__name__: c for c in (PipelineModel, B.Boosted, P.Poisson)}


class SparkHurdleModel:
    """A stage 1 and a stage 2 model + the ordered feature names."""

    def __init__(self, classifier, regressor, feature_names: list[str],
                 category: CategoryEncoding | None = None, threshold: float = 0.5):
        self.classifier = classifier
        self.regressor = regressor
        self.feature_names = list(feature_names)
        self.category = category
        self.threshold = threshold

    def predict_components(self, df: DataFrame, lenient: bool = False) -> DataFrame:
        return positive_count(self.regressor, p_nonzero(self.classifier, df, lenient=lenient), lenient=lenient)

    def predict_soft(self, df: DataFrame) -> DataFrame:
        from ..operators.hurdle import hurdle_combine
        return hurdle_combine(self.predict_components(df), threshold=self.threshold)

    def predict_soft_lenient(self, df: DataFrame) -> DataFrame:
        """predict_soft, but a row that a model can't predict has no prediction, instead of failing the job."""
        from ..operators.hurdle import hurdle_combine
        return hurdle_combine(self.predict_components(df, lenient=True), threshold=self.threshold)

    def save(self, path: str) -> None:
        kinds = [_save(m, os.path.join(path, name)) for m, name in ((self.classifier, "classifier"), (self.regressor, "regressor"))]
        spark = SparkSession.getActiveSession()
        if self.category:
            self.category.encoder.write().overwrite().save(os.path.join(path, "category_encoder"))
            self.category.index.write.mode("overwrite").parquet(os.path.join(path, "category_index"))
        meta = {"feature_names": self.feature_names, "category": self.category is not None, "threshold": self.threshold, "kinds": kinds}
        spark.createDataFrame([(json.dumps(meta),)], "meta string").coalesce(1) \
             .write.mode("overwrite").text(os.path.join(path, "metadata"))

    @classmethod
    def load(cls, path: str) -> "SparkHurdleModel":
        spark = SparkSession.getActiveSession()
        meta = json.loads(spark.read.text(os.path.join(path, "metadata")).first()[0])
        category = CategoryEncoding(spark.read.parquet(os.path.join(path, "category_index")), OneHotEncoderModel.load(
            os.path.join(path, "category_encoder"))) if meta["category"] else None
        first, second = (_KINDS[k].load(os.path.join(path, name)) for k, name in zip(meta["kinds"], ("classifier", "regressor")))
        return cls(first, second, meta["feature_names"], category, meta.get("threshold", 0.5))


class StandInHurdle:
    """A deterministic stand-in model (fixture A3) with the model interface:
    p_nonzero = purchases/(purchases+1), positive_count = 1 + purchases."""

    def __init__(self, feature_names: list[str], threshold: float = 0.5):
        self.feature_names = list(feature_names)
        self.threshold = threshold

    def predict_soft(self, df: DataFrame) -> DataFrame:
        from ..operators.hurdle import hurdle_combine
        pc = F.col("product_purchase_count_last_month")
        out = df.select("*", (pc / (pc + 1)).alias("p_nonzero"), (pc + 1).alias("positive_count"))
        return hurdle_combine(out, threshold=self.threshold)


class RaisingHurdle(StandInHurdle):
    """The stand-in with a stage 1 model that raises on rows whose purchases leave the remainder 1 by 3."""

    def _predicted(self, df: DataFrame, lenient: bool) -> DataFrame:
        from ..operators.hurdle import hurdle_combine

        def respond(x, category):
            if (x[:, 0] % 3 == 1).any():
                raise ArithmeticError("no answer for this row")
            return x / (x + 1)

        pc = F.col("product_purchase_count_last_month")
        layout = C.Features(("product_purchase_count_last_month",), 0)
        scored = C.scored(df, layout, C.lenient(respond, 1) if lenient else respond, "_p")
        return hurdle_combine(scored.select("*", F.col("_p")[0].alias("p_nonzero"), (pc + 1).alias("positive_count")).drop("_p"),
                              threshold=self.threshold)

    def predict_soft(self, df: DataFrame) -> DataFrame:
        return self._predicted(df, lenient=False)

    def predict_soft_lenient(self, df: DataFrame) -> DataFrame:
        return self._predicted(df, lenient=True)
