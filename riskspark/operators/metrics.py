"""Tie-aware ranking metrics as grouped Spark aggregates.

Rows are first reduced to one row per distinct risk value (positives,
negatives); running sums in descending risk order come from
``running_totals``, never from a one-task window.  With ``cp``, ``cn`` the
inclusive running counts from the top and ``P``, ``N`` the totals:

  AUC = sum(pos * (N - cn + neg / 2)) / (P * N)
  AP  = sum(pos / P * cp / (cp + cn))
  KS  = max(|cp / P - cn / N|)

and each is null when one class is absent.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.formatting import report_round
from .cumulative import running_totals


def _counts(df: DataFrame, score: str, label: str, by: Sequence[str]) -> DataFrame:
    y = F.col(label)
    return (df.where(y.isNotNull() & F.col(score).isNotNull() & ~F.isnan(F.col(score).cast("double")))
            .select(*by, F.col(score).cast("double").alias("__p"),
                    y.cast("long").alias("pos"), (F.lit(1) - y).cast("long").alias("neg")))


def ranked_counts(df: DataFrame, score: str, label: str = K.LABEL,
                  by: Sequence[str] = ()) -> DataFrame:
    """Per (by, distinct score): pos, neg, cp, cn (from the top), P, N."""
    by = list(by)
    rt = running_totals(_counts(df, score, label, by), "__p", ["pos", "neg"], by)
    return rt.select(
        *by, F.col("__p").alias("threshold"), "pos", "neg",
        (F.col("total_pos") - F.col("cum_pos") + F.col("pos")).alias("cp"),
        (F.col("total_neg") - F.col("cum_neg") + F.col("neg")).alias("cn"),
        F.col("total_pos").alias("P"), F.col("total_neg").alias("N"),
    )


def ranking_metrics(df: DataFrame, score: str, label: str = K.LABEL,
                    by: Sequence[str] = (), with_counts: bool = False) -> DataFrame:
    """One row per group: auc_roc, pr_auc (average precision), ks_statistic,
    gini; with ``with_counts`` also n_pos and n_neg (rows with a score)."""
    by = list(by)
    rc = ranked_counts(df, score, label, by)
    P = F.col("P").cast("double")
    N = F.col("N").cast("double")
    auc_term = F.col("pos") * (F.col("N") - F.col("cn") + F.col("neg") / F.lit(2.0))
    # try_divide: null instead of an ANSI error when a class is absent
    ap_term = F.try_divide(F.col("pos"), P) * F.try_divide(F.col("cp"), F.col("cp") + F.col("cn"))
    ks_term = F.abs(F.try_divide(F.col("cp"), P) - F.try_divide(F.col("cn"), N))
    agg = rc.groupBy(*by).agg(
        F.first("P").alias("P"), F.first("N").alias("N"),
        F.sum(auc_term).alias("__auc_num"),
        F.sum(ap_term).alias("__ap"),
        F.max(ks_term).alias("__ks"),
    )
    ok = (F.col("P") > 0) & (F.col("N") > 0)
    auc = F.when(ok, F.try_divide(F.col("__auc_num"), F.col("P").cast("double") * F.col("N")))
    counts = [F.col("P").alias("n_pos"), F.col("N").alias("n_neg")] if with_counts else []
    return agg.select(
        *by,
        auc.alias("auc_roc"),
        F.when(ok, F.col("__ap")).alias("pr_auc"),
        F.when(ok, F.col("__ks")).alias("ks_statistic"),
        (F.lit(2.0) * auc - F.lit(1.0)).alias("gini"),
        *counts,
    )


def roc_curve(df: DataFrame, score: str, label: str = K.LABEL,
              by: Sequence[str] = ()) -> DataFrame:
    """One point per distinct score (descending), plus the origin."""
    by = list(by)
    rc = ranked_counts(df, score, label, by)
    pts = rc.select(*by, "threshold",
                    F.try_divide(F.col("cn"), F.col("N")).alias("fpr"),
                    F.try_divide(F.col("cp"), F.col("P")).alias("tpr"))
    origin = rc.groupBy(*by).agg(F.lit(None).cast("double").alias("threshold"),
                                 F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return pts.unionByName(origin)


def pr_curve(df: DataFrame, score: str, label: str = K.LABEL,
             by: Sequence[str] = ()) -> DataFrame:
    """E5: precision and recall per threshold, plus the end point (0, 1)."""
    by = list(by)
    rc = ranked_counts(df, score, label, by)
    pts = rc.select(*by, "threshold",
                    F.try_divide(F.col("cp"), F.col("cp") + F.col("cn")).alias("precision"),
                    F.try_divide(F.col("cp"), F.col("P")).alias("recall"))
    end = rc.groupBy(*by).agg(F.lit(None).cast("double").alias("threshold"),
                              F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"))
    return pts.unionByName(end)


def base_rate(df: DataFrame, label: str = K.LABEL, by: Sequence[str] = ()) -> DataFrame:
    """Mean label."""
    return df.groupBy(*by).agg(F.avg(F.col(label).cast("double")).alias("base_rate"))


def class_balance(df: DataFrame, label: str = K.LABEL, by: Sequence[str] = ("split",)) -> DataFrame:
    """Positives, total and percent positive per group."""
    return df.where(F.col(label).isNotNull()).groupBy(*by).agg(
        F.sum(F.col(label).cast("long")).alias("n_pos"),
        F.count(F.lit(1)).alias("n_total"),
    ).withColumn("pct_pos", report_round(F.col("n_pos") / F.col("n_total") * F.lit(100.0), 2))


def class_ratio(df: DataFrame, label: str = K.LABEL) -> DataFrame:
    """Negatives / positives, the weight given to each positive row."""
    y = F.col(label)
    return df.where(y.isNotNull()).agg(
        F.count_if(y == 0).alias("n_neg"), F.count_if(y == 1).alias("n_pos"),
    ).withColumn("scale_pos_weight",
                 F.try_divide(F.col("n_neg"), F.col("n_pos")))


def positive_weight(label: str, ratio: float) -> F.Column:
    """Row weight: ``ratio`` for positives, 1 for negatives."""
    return F.when(F.col(label) == 1, F.lit(float(ratio))).otherwise(F.lit(1.0))


def mean_over_folds(df: DataFrame, metric: str = "auc_roc", by: Sequence[str] = ("trial",)) -> DataFrame:
    """Average a per-fold metric."""
    return df.groupBy(*by).agg(F.avg(metric).alias(f"mean_{metric}"),
                               F.count(F.lit(1)).alias("n_folds"))
