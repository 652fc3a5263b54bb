"""Registered model queries (no SQL oracle: training and search are iterative;
each is checked by property tests instead)."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import constants as K
from ..operators import explain, monitor, train
from ..session import materialize
from .modeling import cached_run, margins, shap_frame
from .queries import rounded


def q_model_comparison(spark, sf_dir):
    """AUC, AP, KS and Gini of both models on the test split, plus the
    best mean CV AUC of the search."""
    run = cached_run(spark, sf_dir)
    test = {m: s.where(F.col("split") == "test") for m, s in run.scores.items()}
    long = train.model_metrics(test)
    best = spark.createDataFrame([("gbt", "best_cv_auc", float(run.search.best_value))],
                                 "model string, metric string, value double")
    return rounded(long.unionByName(best))


def q_model_comparison_wide(spark, sf_dir):
    """I14 + G2: metric rows, one column per model."""
    run = cached_run(spark, sf_dir)
    test = {m: s.where(F.col("split") == "test") for m, s in run.scores.items()}
    return rounded(train.comparison_table(train.model_metrics(test)))


def q_model_roc_curves(spark, sf_dir):
    """E1 + G2: ROC points of both models, stacked with a ``model`` column."""
    from ..operators.metrics import roc_curve
    run = cached_run(spark, sf_dir)
    stacked = None
    for m, s in run.scores.items():
        part = s.where(F.col("split") == "test").withColumn("model", F.lit(m))
        stacked = part if stacked is None else stacked.unionByName(part)
    return rounded(roc_curve(stacked, "probability", K.LABEL, by=["model"]))


def q_model_scores(spark, sf_dir):
    """I13 + H1 + H2: boosted-model scores for every labelled applicant."""
    return rounded(cached_run(spark, sf_dir).scores["gbt"])


def q_model_deciles(spark, sf_dir):
    s = cached_run(spark, sf_dir).scores["gbt"].where(F.col("split") == "test")
    return rounded(monitor.decile_table(s))


def q_model_psi(spark, sf_dir):
    s = cached_run(spark, sf_dir).scores["gbt"]
    t = monitor.psi_by_split(s)
    return rounded(monitor.psi_summary(t))


def q_feature_importance(spark, sf_dir):
    """I15 + F2: split counts per feature, top 20."""
    run = cached_run(spark, sf_dir)
    imp = train.split_importance(spark, run.gbt_path, run.names)
    return rounded(train.top_features(imp, K.TOP_FEATURES_PLOT))


def q_search_trials(spark, sf_dir):
    """I10 + D19: one row per trial with its mean fold AUC and parameters."""
    return rounded(cached_run(spark, sf_dir).search.summary)


def q_best_trial(spark, sf_dir):
    """F7."""
    return rounded(train.best_trial(cached_run(spark, sf_dir).search.summary))


def q_shap_values(spark, sf_dir):
    """I16 + I17: long attribution rows for the explanation sample."""
    run = cached_run(spark, sf_dir)
    shap, _ = shap_frame(run, spark)
    return rounded(shap)


def q_shap_global(spark, sf_dir):
    """D20 + F6."""
    run = cached_run(spark, sf_dir)
    shap, _ = shap_frame(run, spark)
    return rounded(explain.top_attribution(shap, K.TOP_FEATURES_PLOT))


def q_shap_spread(spark, sf_dir):
    """(value, shap) pairs of the top 20 features."""
    run = cached_run(spark, sf_dir)
    shap = materialize(shap_frame(run, spark)[0])  # read for the top features and for their rows
    return rounded(explain.attribution_spread(shap, K.TOP_FEATURES_PLOT))


def q_shap_waterfall(spark, sf_dir):
    """F4 + F5 + I18: waterfalls of the first sampled defaulter and non-defaulter."""
    run = cached_run(spark, sf_dir)
    sample = explain.explanation_sample(run.test)
    firsts = explain.first_per_class(sample).select(K.KEY)
    shap, lt = shap_frame(run, spark, sample.join(F.broadcast(firsts), K.KEY, "left_semi"))  # two rows are attributed
    return rounded(explain.waterfall(shap, lt.base, K.WATERFALL_REPORT))


def q_shap_additivity(spark, sf_dir):
    """I18 check: base + sum(phi) against the model's log-odds margin, per row."""
    run = cached_run(spark, sf_dir)
    shap, lt = shap_frame(run, spark)
    sample = explain.explanation_sample(run.test)
    total = shap.groupBy(K.KEY).agg(F.sum("shap").alias("sum_shap"))
    m = margins(run, sample)
    j = total.join(m, K.KEY)
    return j.select(K.KEY, "margin", (F.lit(lt.base) + F.col("sum_shap")).alias("explained"),
                    F.abs(F.lit(lt.base) + F.col("sum_shap") - F.col("margin")).alias("abs_error"))


MODEL_QUERIES = {
    "model_comparison": q_model_comparison,
    "model_comparison_wide": q_model_comparison_wide,
    "model_roc_curves": q_model_roc_curves,
    "model_scores": q_model_scores,
    "model_deciles": q_model_deciles,
    "model_psi": q_model_psi,
    "model_feature_importance": q_feature_importance,
    "search_trials": q_search_trials,
    "best_trial": q_best_trial,
    "model_shap_values": q_shap_values,
    "model_shap_global": q_shap_global,
    "model_shap_spread": q_shap_spread,
    "model_shap_waterfall": q_shap_waterfall,
    "model_shap_additivity": q_shap_additivity,
}
