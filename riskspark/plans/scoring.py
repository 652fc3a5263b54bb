"""Scored-applicant plans over the fixture tables.

Before a model exists, a fixed logistic formula of two mart columns stands in
for the default probability so both engines can compute every downstream
report exactly (FIXTURES §3, first slice):

  p = 1 / (1 + exp(-(-2.2 - 0.25 * (n_orders - 10) + 0.00001 * (avg_price - 250000))))
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.scoring import logistic
from ..operators.marts import build_features, previous_app_features
from ..operators.monitor import score_table
from ..operators.split import stratified_split
from ..session import materialize
from ..sources.fixtures import Tables, applicant_labels

# Fixed values of the stand-in formula (FIXTURES §3).
FORMULA_INTERCEPT = -2.2
FORMULA_ORDERS_COEF = -0.25
FORMULA_ORDERS_CENTER = 10
FORMULA_PRICE_COEF = 0.00001
FORMULA_PRICE_CENTER = 250000


def formula_probability(features: DataFrame) -> F.Column:
    z = (F.lit(FORMULA_INTERCEPT)
         + F.lit(FORMULA_ORDERS_COEF) * (F.col("PREV_N_ORDERS") - F.lit(FORMULA_ORDERS_CENTER))
         + F.lit(FORMULA_PRICE_COEF) * (F.col("PREV_AVG_PRICE") - F.lit(FORMULA_PRICE_CENTER)))
    return logistic(z)


def split_assignment(t: Tables) -> DataFrame:
    """Key, label, ``split`` and ``fold`` (E9, E10) from key and label alone."""
    return stratified_split(applicant_labels(t))


def split_features(t: Tables) -> DataFrame:
    """Feature table with ``split`` and ``fold``, for the encoders, which read it
    several times: written once, its readers take the columns they need."""
    return materialize(build_features(t).join(split_assignment(t).drop(K.LABEL), K.KEY, "left"))


def formula_scores(t: Tables) -> DataFrame:
    """Score table of every applicant: key, probability, score, band, label, split.

    Only the roll-up of orders that the formula reads is joined to the split;
    the narrow result is written, as reports read it more than once."""
    f = split_assignment(t).join(previous_app_features(t), K.KEY, "left")
    f = f.withColumn("probability", formula_probability(f))
    return materialize(score_table(f, keep=[K.LABEL, "split"]))
