"""Visit-level purchase propensity: folds, boosted trees, CV AUC, search.

The boosted trees are grown by ``boosting``: all fits that are asked for
together (folds, trials x folds) share the scans of one binned table. Folds are
assigned by a stratified, keyed global rank so each class is split evenly
(within one row) and the assignment is reproducible in SQL. The AUC of all
held-out folds of all trials is the exact tie-aware AUC of one grouped job.
The hyper-parameter search suggests its trials by Parzen estimators (``tpe``)
in batches; each batch's trials x folds are one shared fit. The compared linear
model and forest are Spark ML pipelines; plain gradient boosting grows Spark ML's
trees in the shared scans.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.concurrency import run_concurrently
from . import tpe
from .boosting import BoostedTrees, Binned, Fit, bin_plain, bin_table, fit_many, held_out_scores
from .dataset import FEATURE_COLS, KEY, TARGET
from .evaluation import auc
from .ranking import global_row_number

N_FOLDS = 5
SEED = 42
# The reference's search ranges (name: (low, high, kind)).
SEARCH_SPACE = {
    "n_estimators": (50, 300, "int"),
    "learning_rate": (0.01, 0.3, "log"),
    "max_depth": (2, 6, "int"),
    "min_child_samples": (10, 60, "int"),
    "subsample": (0.5, 1.0, "float"),
    "colsample_bytree": (0.5, 1.0, "float"),
    "reg_alpha": (1e-3, 10.0, "log"),
    "reg_lambda": (1e-3, 10.0, "log"),
}


def add_folds(table: DataFrame, n_folds: int = N_FOLDS, seed: int = SEED,
              key: str = KEY, label: str = TARGET, keys: DataFrame | None = None) -> DataFrame:
    """``fold`` = (rank within class by md5(key || seed), key) mod n_folds.

    Only (class, hash, key) are ranked and written; the wide rows get their
    fold by a join on the key. ``keys`` is a narrower table with the same keys
    and classes (the visits), so that the wide rows are not built for it.
    """
    return table.join(fold_numbers(table if keys is None else keys, n_folds, seed, key, label), key)


def fold_numbers(keys: DataFrame, n_folds: int = N_FOLDS, seed: int = SEED, key: str = KEY, label: str = TARGET) -> DataFrame:
    """(key, fold) of every row; the rows are ranked and written here."""
    hashed = keys.select(label, key, F.md5(F.concat(F.col(key).cast("string"), F.lit(str(seed)))).alias("_h"))
    ranked = global_row_number(hashed, ["_h", key], alias="_r", group_cols=[label])
    return ranked.select(key, ((F.col("_r") - 1) % n_folds).cast("int").alias("fold"))


def assembler(columns: list[str] = FEATURE_COLS) -> VectorAssembler:
    return VectorAssembler(inputCols=columns, outputCol="features", handleInvalid="keep")


def binned_table(table: DataFrame, columns: list[str] = FEATURE_COLS) -> Binned:
    """The training table in binned blocks; with a ``fold`` column, fits can leave folds out."""
    return bin_table(table, columns, TARGET, KEY, "fold" if "fold" in table.columns else None)


def fit(table: DataFrame, params: dict | None = None, seed: int = SEED, binned: Binned | None = None) -> BoostedTrees:
    """The final model: boosted trees with the given parameters on every row."""
    return fit_many(binned or binned_table(table), [Fit(params or {}, None, seed)])[0]


def score(model: BoostedTrees | PipelineModel, df: DataFrame) -> DataFrame:
    """Add ``score`` = P(class 1)."""
    if isinstance(model, BoostedTrees):
        return model.transform(df)
    out = model.transform(df).withColumn("score", vector_to_array("probability")[1])
    return out.drop("features", "features_scaled", "rawPrediction", "probability", "prediction")


def held_out(binned: Binned, params: dict, n_folds: int = N_FOLDS, seed: int = SEED) -> DataFrame:
    """(fit, fold, y, score): every row scored by the model that didn't see its fold."""
    fits = [Fit(params, f, seed) for f in range(n_folds)]
    return held_out_scores(binned, fit_many(binned, fits), fits)


def fit_and_hold_out(binned: Binned, params: dict, n_folds: int = N_FOLDS, seed: int = SEED) -> tuple[BoostedTrees, DataFrame]:
    """The model on every row and the scores of ``held_out``, all fits in the same scans."""
    fits = [Fit(params, f, seed) for f in range(n_folds)]
    *without, whole = fit_many(binned, [*fits, Fit(params, None, seed)])
    return whole, held_out_scores(binned, without, fits)


def trial_aucs(binned: Binned, trials: list[dict], n_folds: int = N_FOLDS, seed: int = SEED) -> DataFrame:
    """(trial, fold, auc): every trial fitted without each fold, in shared scans, and its exact AUC on that fold."""
    fits = [Fit(p, f, seed) for p in trials for f in range(n_folds)]
    held = held_out_scores(binned, fit_many(binned, fits), fits)
    held = held.withColumn("trial", F.floor(F.col("fit") / n_folds).cast("int"))
    return auc(held, "score", "y", group_cols=["trial", "fold"])


def cv_auc(table: DataFrame, params: dict | None = None, n_folds: int = N_FOLDS, seed: int = SEED,
           binned: Binned | None = None) -> DataFrame:
    """(fold, auc) of boosted trees with the given parameters."""
    return trial_aucs(binned or binned_table(table), [params or {}], n_folds, seed).select("fold", "auc")


def pipeline_cv_auc(table: DataFrame, make_pipeline, n_folds: int = N_FOLDS,
                    parallelism: int | None = None) -> DataFrame:
    """(fold, auc) of a Spark ML pipeline: fit on the other folds, exact AUC on the held-out fold.

    The fold fits are independent jobs, submitted concurrently; the held-out
    predictions of all folds go through ONE grouped AUC job.
    """
    fits = [lambda f=f: make_pipeline().fit(table.where(F.col("fold") != f)) for f in range(n_folds)]
    models = run_concurrently(table.sparkSession, fits, parallelism)
    held = None
    for f, model in enumerate(models):
        pred = score(model, table.where(F.col("fold") == f)).select("fold", TARGET, "score")
        held = pred if held is None else held.unionByName(pred)
    return auc(held, "score", TARGET, group_cols=["fold"])


def cv_summary(fold_auc: DataFrame) -> DataFrame:
    """Mean and population standard deviation of the fold AUCs."""
    return fold_auc.agg(F.avg("auc").alias("auc_mean"), F.stddev_pop("auc").alias("auc_std"),
                        F.count(F.lit(1)).alias("n_folds"))


def search(table: DataFrame, n_trials: int = 50, n_folds: int = N_FOLDS, seed: int = SEED,
           space: dict = SEARCH_SPACE, batch: int = 10, binned: Binned | None = None) -> list[tuple[dict, float]]:
    """(parameters, mean CV AUC) of every trial, in order; ``batch`` trials are suggested and fitted together."""
    binned = binned or binned_table(table)

    def values(trials: list[dict]) -> list[float]:
        means = trial_aucs(binned, trials, n_folds, seed).groupBy("trial").agg(F.avg("auc").alias("v")).collect()
        found = {r["trial"]: r["v"] for r in means}  # one number a trial
        return [found[k] if found.get(k) is not None else 0.0 for k in range(len(trials))]

    return tpe.optimise(values, n_trials, space, seed, batch)


def best_trial(results: list[tuple[dict, float]]) -> tuple[dict, float]:
    """Highest mean AUC; the earliest trial on ties."""
    best_i = max(range(len(results)), key=lambda i: (results[i][1], -i))
    return results[best_i]


def comparison_models(n_rows: int, n_trees: int = 100, seed: int = SEED) -> dict:
    """The reference's model families with default-like settings.

    LogisticRegression: C=1 in the reference means regParam = 1/n here; it
    gets standardised features. The boosted families are added by
    ``compare_models``.
    """
    lr = Pipeline(stages=[assembler(), StandardScaler(inputCol="features", outputCol="features_scaled",
                                                      withMean=True, withStd=True),
                          LogisticRegression(labelCol=TARGET, featuresCol="features_scaled", maxIter=1000,
                                             regParam=1.0 / max(n_rows, 1))])
    rf = Pipeline(stages=[assembler(), RandomForestClassifier(labelCol=TARGET, featuresCol="features",
                                                              numTrees=n_trees, seed=seed)])
    return {"Logistic Regression": lr, "Random Forest": rf}


# Spark ML's defaults of gradient boosting.
PLAIN_PARAMS = {"learning_rate": 0.1, "max_depth": 5, "min_child_samples": 1}


def plain_cv_auc(table: DataFrame, n_trees: int = 100, n_folds: int = N_FOLDS, seed: int = SEED) -> DataFrame:
    """(fold, auc) of plain gradient boosting with Spark ML's settings, all folds in the same scans."""
    binned, fits = bin_plain(table, FEATURE_COLS, TARGET, KEY, "fold", {**PLAIN_PARAMS, "n_estimators": n_trees}, n_folds, seed)
    return auc(held_out_scores(binned, fit_many(binned, fits), fits), "score", "y", group_cols=["fold"])


def compare_models(table: DataFrame, n_trees: int = 100, n_folds: int = N_FOLDS) -> DataFrame:
    """(modelo, auc_mean, auc_std) sorted by mean AUC, highest first."""
    n = table.count()
    models = comparison_models(n, n_trees)
    # the families are independent: their fold fits are submitted together
    folds = run_concurrently(table.sparkSession,
                             [lambda: cv_auc(table, {"n_estimators": n_trees}, n_folds), lambda: plain_cv_auc(table, n_trees, n_folds),
                              *[lambda p=pipe: pipeline_cv_auc(table, lambda: p, n_folds) for pipe in models.values()]])
    out = None
    for name, fold_auc in zip(["Histogram Boosting", "Gradient Boosting", *models], folds):
        s = cv_summary(fold_auc).select(F.lit(name).alias("modelo"), "auc_mean", "auc_std")
        out = s if out is None else out.unionByName(s)
    return out.orderBy(F.desc("auc_mean"))


def feature_importances(spark, model: BoostedTrees) -> DataFrame:
    """The trees' split-gain importances, one row per feature."""
    return spark.createDataFrame(model.importances(), "feature string, importance double").orderBy(F.desc("importance"), "feature")
