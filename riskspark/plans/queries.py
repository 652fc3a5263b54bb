"""Registered queries: one builder per operator group, ``(spark, sf_dir) -> DataFrame``.

Every builder reads the fixture tables (or frames Spark derives from them),
over whole tables.  Report outputs round doubles to 6 decimals so engines that
add in different orders agree; library functions themselves never round.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import constants as K
from ..functions.formatting import report_round
from ..operators import audit, marts, metrics, monitor, quality, report
from ..operators.encode import ColumnGroups, fit_preprocessor
from ..operators.explain import explanation_sample
from ..sources.fixtures import LEAK_COLUMNS, Tables, document_application
from ..sources.io import catalog_summary
from ..session import TABLES, materialize
from .scoring import formula_probability, formula_scores, split_assignment, split_features

REPORT_DIGITS = 6


def rounded(df: DataFrame, digits: int = REPORT_DIGITS) -> DataFrame:
    """Round every double column (report precision)."""
    return df.select(*[
        report_round(F.col(f.name), digits).alias(f.name) if isinstance(f.dataType, T.DoubleType)
        else F.col(f.name) for f in df.schema.fields])


def _t(spark: SparkSession, sf_dir: str) -> Tables:
    return Tables(spark, sf_dir)


# --- marts and features ----------------------------------------------------------

def q_features(spark, sf_dir):
    return rounded(marts.build_features(_t(spark, sf_dir)))


def q_mart_bureau(spark, sf_dir):
    return rounded(marts.bureau_features(_t(spark, sf_dir)))


def q_mart_previous_app(spark, sf_dir):
    return rounded(marts.previous_app_features(_t(spark, sf_dir)))


def q_mart_installments(spark, sf_dir):
    return rounded(marts.installments_features(_t(spark, sf_dir)))


def q_mart_pos_cash(spark, sf_dir):
    return rounded(marts.pos_cash_features(_t(spark, sf_dir)))


def q_mart_credit_card(spark, sf_dir):
    return rounded(marts.credit_card_features(_t(spark, sf_dir)))


# --- quality reports ---------------------------------------------------------------

def q_sentinel_counts(spark, sf_dir):
    return quality.sentinel_counts(marts.build_features(_t(spark, sf_dir), replace_sentinel=False))


def q_missingness(spark, sf_dir):
    return quality.missingness(marts.build_features(_t(spark, sf_dir)))


def q_top_missing(spark, sf_dir):
    return quality.top_missing(marts.build_features(_t(spark, sf_dir)))


def q_target_distribution(spark, sf_dir):
    return quality.target_distribution(marts.build_features(_t(spark, sf_dir)))


def q_column_cardinality(spark, sf_dir):
    f = marts.build_features(_t(spark, sf_dir))
    return quality.column_cardinality(f, quality.categorical_columns(f))


def q_leakage_audit(spark, sf_dir):
    return rounded(audit.leakage_audit(materialize(marts.build_features(_t(spark, sf_dir)))))


def q_document_cardinality(spark, sf_dir):
    """Distinct counts need no label: every document is counted."""
    return quality.column_cardinality(_t(spark, sf_dir).documents, ["lang", "source"])


def q_document_leakage_audit(spark, sf_dir):
    return rounded(audit.leakage_audit(materialize(document_application(_t(spark, sf_dir)))))


def q_catalog_summary(spark, sf_dir):
    t = _t(spark, sf_dir)
    s = catalog_summary({name: getattr(t, name) for name in TABLES})
    return s.withColumn("n_columns", F.col("n_columns").cast("long"))


# --- split -----------------------------------------------------------------------------

def q_split_assignment(spark, sf_dir):
    return split_assignment(_t(spark, sf_dir)).select(K.KEY, K.LABEL, "split", "fold")


def q_class_balance(spark, sf_dir):
    return metrics.class_balance(split_assignment(_t(spark, sf_dir)))


def q_class_ratio(spark, sf_dir):
    s = split_assignment(_t(spark, sf_dir))
    return rounded(metrics.class_ratio(s.where(F.col("split") == "train")))


# --- scores and monitoring ------------------------------------------------------------

def _scores(spark, sf_dir):
    return formula_scores(_t(spark, sf_dir))


def _test(spark, sf_dir):
    return _scores(spark, sf_dir).where(F.col("split") == "test")


def q_formula_scores(spark, sf_dir):
    return rounded(_scores(spark, sf_dir))


def q_score_deciles(spark, sf_dir):
    return rounded(monitor.decile_table(_test(spark, sf_dir)))


def q_score_monotonicity(spark, sf_dir):
    return monitor.is_monotone(monitor.decile_table(_test(spark, sf_dir)))


def q_score_summary(spark, sf_dir):
    return rounded(monitor.score_summary(_scores(spark, sf_dir)))


def q_band_distribution(spark, sf_dir):
    return monitor.band_distribution(_test(spark, sf_dir))


def q_band_value_counts(spark, sf_dir):
    return monitor.band_value_counts(_test(spark, sf_dir))


def q_score_histogram(spark, sf_dir):
    return rounded(monitor.histogram(_scores(spark, sf_dir), "score", "split", K.HIST_BINS, joint=False))


def q_score_histogram_joint(spark, sf_dir):
    h = monitor.histogram(_scores(spark, sf_dir), "score", "split", K.HIST_BINS, joint=True)
    return rounded(h.drop("density"))


def _psi(spark, sf_dir):
    return monitor.psi_by_split(_scores(spark, sf_dir))


def q_psi_bins(spark, sf_dir):
    return _psi(spark, sf_dir).drop("psi_raw")


def q_psi_summary(spark, sf_dir):
    return rounded(monitor.psi_summary(_psi(spark, sf_dir)))


# --- ranking metrics -----------------------------------------------------------------------

def q_ranking_metrics(spark, sf_dir):
    s = _scores(spark, sf_dir)
    m = metrics.ranking_metrics(s, "probability", K.LABEL, by=["split"])
    b = metrics.base_rate(s, K.LABEL, by=["split"])
    return rounded(m.join(b, "split"))


def q_score_ranking_metrics(spark, sf_dir):
    """The same metrics on the integer score (heavy ties), risk = -score."""
    s = _test(spark, sf_dir).withColumn("risk", -F.col("score"))
    return rounded(metrics.ranking_metrics(s, "risk", K.LABEL))


def q_roc_curve(spark, sf_dir):
    return rounded(metrics.roc_curve(_test(spark, sf_dir), "probability", K.LABEL))


def q_pr_curve(spark, sf_dir):
    return rounded(metrics.pr_curve(_test(spark, sf_dir), "probability", K.LABEL))


# --- encoders ----------------------------------------------------------------------------

def _model_frame(spark, sf_dir):
    """Split feature table minus the planted leak.  ``split_features`` returns
    a written table, so routing, fitting and transform each read it (the marts
    run a single time)."""
    return split_features(_t(spark, sf_dir)).drop(*LEAK_COLUMNS)


def _groups(df: DataFrame) -> ColumnGroups:
    from ..operators.encode import identify_column_types
    return identify_column_types(df, exclude=(K.KEY, K.LABEL, "split", "fold"))


def _fitted(spark, sf_dir):
    f = _model_frame(spark, sf_dir)
    groups = _groups(f)
    pre = fit_preprocessor(f.where(F.col("split") == "train"), groups, checkpoint=False)
    return f, pre


def q_numeric_params(spark, sf_dir):
    _, pre = _fitted(spark, sf_dir)
    return rounded(pre.params_frame(spark))


def q_onehot_levels(spark, sf_dir):
    _, pre = _fitted(spark, sf_dir)
    rows = [(c, v, i) for c, vals in pre.categories.items() for i, v in enumerate(vals)]
    return spark.createDataFrame(rows, "column_name string, category string, position int")


def q_target_encoding(spark, sf_dir):
    _, pre = _fitted(spark, sf_dir)
    parts = [te.full.select(F.lit(c).alias("column_name"), F.col("cat").alias("category"),
                            F.lit(None).cast("int").alias("fold"), F.col("enc").alias("encoding"))
             .unionByName(te.oof.select(F.lit(c).alias("column_name"), F.col("cat").alias("category"),
                                        F.col("fold").cast("int").alias("fold"),
                                        F.col("enc").alias("encoding")))
             for c, te in pre.target.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return rounded(out)


def q_encoded_features(spark, sf_dir):
    f, pre = _fitted(spark, sf_dir)
    return rounded(pre.transform(f))


# --- report tables -------------------------------------------------------------------------

def q_applicant_cards(spark, sf_dir):
    """Scores, outcome and card fields; the plan reads only the columns a card shows."""
    t = _t(spark, sf_dir)
    f = marts.build_features(t).join(split_assignment(t).drop(K.LABEL), K.KEY, "left")
    f = f.withColumn("probability", formula_probability(f))
    s = monitor.score_table(f, keep=[K.LABEL, "split", *[c for _, c, _ in report.CARD_FIELDS]])
    return report.applicant_cards(s.where(F.col("split") == "test")).transform(rounded)


def q_first_ids(spark, sf_dir):
    return report.first_ids(_test(spark, sf_dir))


def q_explain_sample(spark, sf_dir):
    return explanation_sample(_test(spark, sf_dir)).select(K.KEY, K.LABEL)


def q_sample_membership(spark, sf_dir):
    s = _scores(spark, sf_dir)
    sample = explanation_sample(s.where(F.col("split") == "test"))
    return report.sample_membership(s, sample)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "features": q_features,
    "mart_bureau": q_mart_bureau,
    "mart_previous_app": q_mart_previous_app,
    "mart_installments": q_mart_installments,
    "mart_pos_cash": q_mart_pos_cash,
    "mart_credit_card": q_mart_credit_card,
    "sentinel_counts": q_sentinel_counts,
    "missingness": q_missingness,
    "top_missing": q_top_missing,
    "target_distribution": q_target_distribution,
    "column_cardinality": q_column_cardinality,
    "leakage_audit": q_leakage_audit,
    "document_cardinality": q_document_cardinality,
    "document_leakage_audit": q_document_leakage_audit,
    "catalog_summary": q_catalog_summary,
    "split_assignment": q_split_assignment,
    "class_balance": q_class_balance,
    "class_ratio": q_class_ratio,
    "formula_scores": q_formula_scores,
    "score_deciles": q_score_deciles,
    "score_monotonicity": q_score_monotonicity,
    "score_summary": q_score_summary,
    "band_distribution": q_band_distribution,
    "band_value_counts": q_band_value_counts,
    "score_histogram": q_score_histogram,
    "score_histogram_joint": q_score_histogram_joint,
    "psi_bins": q_psi_bins,
    "psi_summary": q_psi_summary,
    "ranking_metrics": q_ranking_metrics,
    "score_ranking_metrics": q_score_ranking_metrics,
    "roc_curve": q_roc_curve,
    "pr_curve": q_pr_curve,
    "numeric_params": q_numeric_params,
    "onehot_levels": q_onehot_levels,
    "target_encoding": q_target_encoding,
    "encoded_features": q_encoded_features,
    "applicant_cards": q_applicant_cards,
    "first_ids": q_first_ids,
    "explain_sample": q_explain_sample,
    "sample_membership": q_sample_membership,
}
