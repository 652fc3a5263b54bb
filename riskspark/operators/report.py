"""Dashboard result tables (C3, C6, F3, H4-H6), as DataFrames.

The original serves these from a long-running web page; here each tab is a
function that returns a frame, for one applicant or for all of them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.formatting import age_years, currency_text, outcome_label, percent_text

# Card fields for the fixture data model: (label, column, kind); kind is
# "currency", "age" (a negative day count shown in years) or "plain".
CARD_FIELDS = (
    ("Balance", "c_acctbal", "currency"),
    ("Orders", "PREV_N_ORDERS", "plain"),
    ("Average order", "PREV_AVG_PRICE", "currency"),
    ("Years since first order", "PREV_DAYS_FIRST_ORDER", "age"),
)


def _field_text(col: str, kind: str) -> F.Column:
    c = F.col(col)
    txt = {"currency": currency_text(c), "age": age_years(c).cast("string"),
           "plain": c.cast("string")}[kind]
    return F.coalesce(txt, F.lit("N/A"))


def applicant_cards(scores: DataFrame, labels: DataFrame | None = None,
                    features: DataFrame | None = None,
                    fields: Sequence[tuple[str, str, str]] = CARD_FIELDS,
                    key: str = K.KEY, label: str = K.LABEL) -> DataFrame:
    """Score row + actual outcome + raw attributes, by key.

    Outcome and fields are left-joined from ``labels`` / ``features`` when
    given (separate tables, as the original's files), else read from the
    score frame itself (no join).
    """
    j = scores
    if labels is not None:
        j = j.drop(label).join(labels.select(key, label), key, "left")
    if features is not None:
        names = [c for _, c, _ in fields]
        j = j.drop(*[c for c in names if c in j.columns]).join(features.select(key, *names), key, "left")
    j = j.withColumn("__y", F.col(label))
    return j.select(
        key, "score", "risk_band", "probability",
        percent_text("probability").alias("probability_text"),
        outcome_label(F.col("__y")).alias("outcome"),
        *[_field_text(c, kind).alias(name.lower().replace(" ", "_")) for name, c, kind in fields],
    )


def applicant_card(cards: DataFrame, applicant_id: int, key: str = K.KEY) -> DataFrame:
    """One applicant; an empty frame means "not found" (not an error).

    With the score table sorted or bucketed on the key, the equality filter
    skips files through Parquet statistics.
    """
    return cards.where(F.col(key) == F.lit(int(applicant_id)))


def first_ids(scores: DataFrame, n: int = K.FIRST_IDS, key: str = K.KEY) -> DataFrame:
    """example ids, with the order made explicit (top-k, no full sort)."""
    return scores.select(key).orderBy(key).limit(n)


def sample_membership(scores: DataFrame, sample: DataFrame, key: str = K.KEY) -> DataFrame:
    """Whether each scored applicant is in the explained sample."""
    # the sample is bounded by its size parameter (5,000 rows): broadcast
    s = sample.select(key).withColumn("__in", F.lit(True))
    return scores.select(key).join(F.broadcast(s), key, "left").select(
        key, F.coalesce(F.col("__in"), F.lit(False)).alias("explained"))


def not_explained(scores: DataFrame, sample: DataFrame, key: str = K.KEY) -> DataFrame:
    """Scored applicants outside the sample (left anti join)."""
    return scores.select(key).join(sample.select(key), key, "left_anti")
