"""Model training and scoring with Spark ML.

* baseline: weighted logistic regression whose optimum equals an L2 (C=1)
  logistic fit with balanced class weights: ``regParam = 1 / sum(w)``, no
  standardisation, intercept unpenalised;
* boosted trees: ``GBTClassifier`` with positive rows weighted by the class
  ratio (a different learner from leaf-wise boosting: compare by metrics); a fit
  whose rows fit a task runs in one, by the same algorithm (``boosting``);
* search: seeded random search over the same nine ranges, each trial scored by
  the mean fold AUC of stratified folds (``fold`` from the split); trials run
  as concurrent driver threads sharing one checkpointed train frame; inside a
  fold, early stopping keeps the round with the highest AUC on the held-out fold
  unless 50 rounds pass without improvement, and that AUC is the fold's score;
  Spark's tolerance rule is the alternative;
* refit of the best trial on all train rows, with no early stopping (Q7).
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
from pyspark.ml.classification import (GBTClassificationModel, GBTClassifier,
                                       LogisticRegression, LogisticRegressionModel)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..session import scratch_path
from . import boosting
from .metrics import class_ratio, mean_over_folds, positive_weight, ranking_metrics
from .stages import ranked_scores, stopping_rounds, tree_stages
from .trials import TrialTable, data_digest, trial_digest

# Search ranges (fixed values: name, low, high, log scale, integer).
SEARCH_SPACE = (
    ("n_estimators", 100, 1000, False, True),
    ("learning_rate", 0.01, 0.3, True, False),
    ("max_depth", 3, 8, False, True),
    ("num_leaves", 20, 256, False, True),
    ("min_child_samples", 20, 100, False, True),
    ("subsample", 0.6, 1.0, False, False),
    ("colsample_bytree", 0.6, 1.0, False, False),
    ("reg_alpha", 1e-8, 10.0, True, False),
    ("reg_lambda", 1e-8, 10.0, True, False),
)


def _label_double(df: DataFrame, label: str) -> DataFrame:
    return df.withColumn("__label", F.col(label).cast("double"))


# --- I8: baseline -----------------------------------------------------------

def balanced_weight(df: DataFrame, label: str = K.LABEL) -> tuple[F.Column, float]:
    """n / (2 n_c) per row, and the sum of weights (= n)."""
    r = df.agg(F.count_if(F.col(label) == 0).alias("n0"), F.count_if(F.col(label) == 1).alias("n1")).first()
    n0, n1 = int(r["n0"]), int(r["n1"])
    n = n0 + n1
    w1 = n / (2.0 * n1) if n1 else 0.0
    w0 = n / (2.0 * n0) if n0 else 0.0
    w = F.when(F.col(label) == 1, F.lit(w1)).otherwise(F.lit(w0))
    return w, float(n0 * w0 + n1 * w1)


def train_baseline(train: DataFrame, features: str = "features", label: str = K.LABEL,
                   max_iter: int = 1000, tol: float = 1e-6) -> LogisticRegressionModel:
    w, total = balanced_weight(train, label)
    data = _label_double(train, label).withColumn("__w", w)
    lr = LogisticRegression(featuresCol=features, labelCol="__label", weightCol="__w",
                            regParam=1.0 / total if total else 0.0, elasticNetParam=0.0,
                            standardization=False, fitIntercept=True, maxIter=max_iter, tol=tol)
    return lr.fit(data)


# --- I9: boosted trees --------------------------------------------------------

def gbt_params(params: dict) -> dict:
    """Map the searched ranges onto GBTClassifier parameters.

    n_estimators -> maxIter, learning_rate -> stepSize, max_depth -> maxDepth,
    min_child_samples -> minInstancesPerNode, subsample -> subsamplingRate,
    colsample_bytree -> featureSubsetStrategy (a fraction, per node).
    num_leaves, reg_alpha, reg_lambda have no counterpart and are recorded only.
    """
    frac = float(params.get("colsample_bytree", 1.0))
    return dict(
        maxIter=int(params.get("n_estimators", 100)),
        stepSize=float(params.get("learning_rate", 0.1)),
        maxDepth=int(params.get("max_depth", 5)),
        minInstancesPerNode=int(params.get("min_child_samples", 1)),
        subsamplingRate=float(params.get("subsample", 1.0)),
        featureSubsetStrategy="all" if frac >= 1.0 else str(frac),
    )


def in_a_task(df: DataFrame, features: str) -> tuple[int, int] | None:
    """(rows, features) of a frame that one task can fit on."""
    n, m = boosting.shape(df, features)
    return (n, m) if 0 < n * m <= boosting.LOCAL_CELLS else None


def train_gbt(train: DataFrame, params: dict, ratio: float, features: str = "features",
              label: str = K.LABEL, validation: str | None = None, seed: int = K.RANDOM_STATE) -> GBTClassificationModel:
    gbt = GBTClassifier(featuresCol=features, labelCol="__label", weightCol="__w", seed=seed, **gbt_params(params))
    size = None if validation else in_a_task(train, features)
    if size:
        nodes = boosting.grown_nodes(train, gbt_params(params), ratio, size, features, label, seed)
        return boosting.as_model(nodes, gbt, size[1], scratch_path(train.sparkSession, f"grown/{uuid.uuid4().hex}"))
    data = _label_double(train, label).withColumn("__w", positive_weight(label, ratio))
    if validation:
        gbt = gbt.setValidationIndicatorCol(validation)
    return gbt.fit(data)


# --- I13: scoring --------------------------------------------------------------

def predict_proba(model, df: DataFrame, keep: Sequence[str] = (K.KEY, K.LABEL, "split")) -> DataFrame:
    """Probability of class 1 per row."""
    out = model.transform(df)
    cols = [c for c in keep if c in df.columns]
    return out.select(*cols, vector_to_array(F.col("probability"))[1].alias("probability"))


# --- I10 / I11 / D19 / F7: search ------------------------------------------------

def sample_trials(n_trials: int = K.N_TRIALS, seed: int = K.RANDOM_STATE,
                  space: Sequence[tuple] = SEARCH_SPACE) -> list[dict]:
    """Seeded random search over ``space`` (log-uniform where marked)."""
    rng = np.random.default_rng(seed)
    trials = []
    for _ in range(n_trials):
        p = {}
        for name, lo, hi, log, integer in space:
            if integer:
                p[name] = int(rng.integers(lo, hi + 1))
            elif log:
                p[name] = float(math.exp(rng.uniform(math.log(lo), math.log(hi))))
            else:
                p[name] = float(rng.uniform(lo, hi))
        trials.append(p)
    return trials


@dataclass
class SearchResult:
    trials: DataFrame       # trial, fold, auc_roc
    summary: DataFrame      # trial, mean_auc_roc, params...
    best_params: dict
    best_value: float


def _fold_score(base: DataFrame, params: dict, ratio: float, k: int, features: str, label: str,
                fold_col: str, seed: int, early_stopping: str,
                patience: int) -> tuple[float | None, int, int]:
    """AUC on fold ``k``, trees kept, trees grown."""
    spark = base.sparkSession
    val = base.where(F.col(fold_col) == k)
    if early_stopping == "tolerance":
        data = base.withColumn("__val", F.col(fold_col) == k)
        model = train_gbt(data, params, ratio, features, label, validation="__val", seed=seed)
        pred = predict_proba(model, val, keep=(K.KEY, label))
        auc = ranking_metrics(pred, "probability", label).first()["auc_roc"]
        return auc, model.getNumTrees, model.getNumTrees
    data = base.where(F.col(fold_col).isNotNull()).withColumn("__held", F.col(fold_col) == k)
    size = in_a_task(data, features)
    if size:  # grown until patience is out
        held = val.coalesce(1).select(label, vector_to_array(F.col(features)).alias("x"))
        nodes = boosting.grown_nodes(data, gbt_params(params), ratio, size, features, label, seed, "__held", patience)
        stop, grown = _stop(held, nodes, label, patience)
    else:  # Spark ML cannot go on with a model: twice as many rounds anew (the first ones are the same), until patience is out
        held = val.select(label, vector_to_array(F.col(features)).alias("x"))
        asked, rounds = gbt_params(params)["maxIter"], max(2 * patience, boosting.LOOK)
        while True:
            some = {**params, "n_estimators": min(rounds, asked)}
            model = train_gbt(data.where(~F.col("__held")), some, ratio, features, label, seed=seed)
            stop, grown = _stop(held, tree_nodes(spark, save_model(spark, model, f"search/{uuid.uuid4().hex}")), label, patience)
            if rounds >= asked or stop is None or stop["fired"]:
                break
            rounds *= 2
    if stop is None:  # an empty fold
        return None, grown, grown
    return stop["best_auc"], stop["best_round"], grown


def _stop(held: DataFrame, nodes: DataFrame, label: str, patience: int) -> tuple:
    """Where early stopping ends on the rounds of a node table, and how many there are.

    Every round's margin of the held-out fold is ranked in one job; the round kept
    is the one of highest AUC before patience runs out, and its AUC counts."""
    stages = tree_stages(nodes)
    return stopping_rounds(ranked_scores(held, "x", stages, label), patience).first(), len(stages.value)


def search(train: DataFrame, ratio: float, n_trials: int = K.N_TRIALS, n_folds: int = K.N_FOLDS,
           features: str = "features", label: str = K.LABEL, fold_col: str = "fold",
           parallelism: int | None = None, seed: int = K.RANDOM_STATE, early_stopping: str = "rounds",
           patience: int = K.EARLY_STOPPING_ROUNDS, space: Sequence[tuple] = SEARCH_SPACE,
           trial_path: str | None = None) -> SearchResult:
    """Each trial: for every fold k, fit on the other folds, keep the rounds
    early stopping chooses on fold k, score fold k, and average the fold AUCs.

    ``early_stopping="rounds"``: patience in rounds on the AUC of the held-out fold,
    which is scored by the ensemble cut at the best round; ``"tolerance"``: Spark's
    ``validationIndicatorCol`` rule.

    ``parallelism``: trials side by side; a fit is one task at a time, so as many as
    there are slots, if not given.

    ``trial_path``: a shared folder for the table of finished fits; a search
    started again over it fits only what is missing.
    """
    spark = train.sparkSession
    base = train.select(K.KEY, label, fold_col, features)  # read once per fit: pass a written table
    trials = sample_trials(n_trials, seed, space)
    table = TrialTable(spark, trial_path) if trial_path else None
    done = table.done() if table else {}
    data = data_digest(base, K.KEY, label, fold_col) if table else ""

    def run(i: int) -> list[tuple]:
        out = []
        digest = trial_digest(params=trials[i], ratio=ratio, folds=n_folds, seed=seed, stop=early_stopping,
                              patience=patience, data=data)
        for k in range(n_folds):
            if (digest, k) in done:
                out.append((i, k, *done[digest, k]))
                continue
            auc, n_keep, n_grown = _fold_score(base, trials[i], ratio, k, features, label, fold_col,
                                               seed, early_stopping, patience)
            out.append((i, k, float(auc) if auc is not None else None, int(n_keep), int(n_grown)))
            if table:
                table.add(digest, *out[-1])
        return out

    side_by_side = spark.sparkContext.defaultParallelism if parallelism is None else parallelism
    with ThreadPoolExecutor(max_workers=max(1, min(side_by_side, n_trials))) as ex:
        rows = [r for part in ex.map(run, range(n_trials)) for r in part]
    per_fold = spark.createDataFrame(rows, "trial int, fold int, auc_roc double, best_iteration int, n_trees int")
    cols = ", ".join(f"{name} double" for name, *_ in space)
    params = spark.createDataFrame(
        [(t, *[float(trials[t][name]) for name, *_ in space]) for t in range(n_trials)],
        f"trial int, {cols}")
    # Mean fold AUC per trial; F7: the best trial (ties: lowest id)
    means = mean_over_folds(per_fold, "auc_roc", by=["trial"]).drop("n_folds")
    summary = params.join(means, "trial", "left").select("trial", "mean_auc_roc", *params.columns[1:])
    best = best_trial(summary).first()
    best_t = int(best["trial"]) if best is not None else 0
    best_v = best["mean_auc_roc"] if best is not None and best["mean_auc_roc"] is not None else float("nan")
    return SearchResult(trials=per_fold, summary=summary, best_params=trials[best_t], best_value=best_v)


def best_trial(summary: DataFrame) -> DataFrame:
    """the trial with the highest mean CV AUC (ties: lowest trial id)."""
    return summary.agg(F.max_by(F.struct(*summary.columns),
                                F.struct(F.col("mean_auc_roc"), -F.col("trial"))).alias("b")).select("b.*")


# --- I14: comparison -----------------------------------------------------------

def model_metrics(scored: dict[str, DataFrame], label: str = K.LABEL) -> DataFrame:
    """Long (model, metric, value) table of AUC, AP, KS and Gini on each frame."""
    parts = []
    for name, df in scored.items():
        m = ranking_metrics(df, "probability", label)
        parts.append(m.select(F.lit(name).alias("model"), "auc_roc", "pr_auc", "ks_statistic", "gini"))
    wide = parts[0]
    for p in parts[1:]:
        wide = wide.unionByName(p)
    return wide.unpivot(["model"], ["auc_roc", "pr_auc", "ks_statistic", "gini"], "metric", "value")


def comparison_table(long: DataFrame) -> DataFrame:
    """Metric rows, one column per model."""
    return long.groupBy("metric").pivot("model").agg(F.first("value"))


# --- I15: split-count importance -------------------------------------------------

def save_model(spark, model, name: str, path: str | None = None) -> str:
    """A10: ML persistence into the shared folder (or ``path``)."""
    path = path or scratch_path(spark, name)
    model.write().overwrite().save(path)
    return path


def tree_nodes(spark, model_path: str) -> DataFrame:
    """Saved tree nodes: treeID, node id, children, split, cover, prediction, tree weight."""
    d = spark.read.parquet(f"{model_path}/data")
    w = spark.read.parquet(f"{model_path}/treesMetadata").select(
        F.col("_1").alias("treeID"), F.col("_3").alias("tree_weight"))
    n = d.select(
        "treeID",
        F.col("nodeData.id").alias("node"),
        F.col("nodeData.prediction").alias("prediction"),
        F.get(F.col("nodeData.impurityStats"), 0).alias("cover"),
        F.col("nodeData.gain").alias("gain"),
        F.col("nodeData.leftChild").alias("left"),
        F.col("nodeData.rightChild").alias("right"),
        F.col("nodeData.split.featureIndex").alias("feature_index"),
        F.get(F.col("nodeData.split.leftCategoriesOrThreshold"), 0).alias("threshold"),
    )
    return n.join(F.broadcast(w), "treeID")


def split_importance(spark, model_path: str, feature_names: Sequence[str]) -> DataFrame:
    """Split count per feature (the importance the plots show) and total gain."""
    return importance_of(tree_nodes(spark, model_path), feature_names)


def importance_of(nodes: DataFrame, feature_names: Sequence[str]) -> DataFrame:
    """``split_importance`` of a node table."""
    spark, n = nodes.sparkSession, nodes.where(F.col("left") >= 0)
    names = spark.createDataFrame(list(enumerate(feature_names)), "feature_index int, feature string")
    counts = n.groupBy("feature_index").agg(F.count(F.lit(1)).alias("split_count"),
                                            F.sum("gain").alias("total_gain"))
    return (names.join(counts, "feature_index", "left")
            .select("feature", F.coalesce("split_count", F.lit(0)).cast("long").alias("split_count"),
                    F.coalesce("total_gain", F.lit(0.0)).alias("total_gain")))


def top_features(importance: DataFrame, k: int = K.TOP_FEATURES_PLOT,
                 by: str = "split_count") -> DataFrame:
    """the k most important features."""
    return importance.orderBy(F.desc(by), F.asc("feature")).limit(k)


def ratio_of(train: DataFrame, label: str = K.LABEL) -> float:
    r = class_ratio(train, label).first()
    return float(r["scale_pos_weight"]) if r and r["scale_pos_weight"] is not None else 1.0
