"""The dashboard's two tabs as result functions.

The original serves them from a long-running web page; here they are plain
functions returning DataFrames, to be shown by any client.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..operators import explain, monitor, report, train


def applicant_view(cards: DataFrame, shap: DataFrame, base: float, applicant_id: int,
                   key: str = K.KEY) -> dict[str, DataFrame]:
    """Tab 1: the card (empty when unknown), the 12-row waterfall when the
    applicant is in the explained sample, and a one-row ``status`` with a
    code: ``ok``, ``not_found`` or ``not_explained`` (Q10)."""
    spark = cards.sparkSession
    card = report.applicant_card(cards, applicant_id, key)
    mine = shap.where(F.col(key) == F.lit(int(applicant_id)))
    found = card.limit(1).count() > 0
    explained = mine.limit(1).count() > 0
    code = "not_found" if not found else "ok" if explained else "not_explained"
    status = spark.createDataFrame([(int(applicant_id), found, explained, code)],
                                   f"{key} long, found boolean, explained boolean, status string")
    return {"card": card, "waterfall": explain.waterfall(mine, base, K.WATERFALL_DASHBOARD, key),
            "status": status}


def portfolio_report(scores: DataFrame, metrics_long: DataFrame, importance: DataFrame) -> dict[str, DataFrame]:
    """Tab 2: score histogram overlay, band breakdown, PSI with verdict, model
    comparison and the 15 most important features."""
    test_s = scores.where(F.col("split") == "test")
    psi = monitor.psi_by_split(scores)
    return {
        "histogram": monitor.histogram(scores, "score", "split", K.HIST_BINS, joint=True),
        "bands": monitor.band_value_counts(test_s),
        "psi_bins": psi.drop("psi_raw"),
        "psi": monitor.psi_summary(psi),
        "comparison": train.comparison_table(metrics_long),
        "importance": train.top_features(importance, K.TOP_FEATURES_DASHBOARD),
    }
