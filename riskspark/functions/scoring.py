"""Column expressions for probability -> points score -> risk band.

All of these are built-in Catalyst expressions, so they stay inside
whole-stage codegen and also work unchanged on a streaming frame.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as K


@dataclass(frozen=True)
class Scorecard:
    """Points-to-double-the-odds parameters (the reference's constant dict)."""

    base_score: float = K.BASE_SCORE
    base_odds: float = K.BASE_ODDS
    pdo: float = K.PDO
    p_min: float = K.P_MIN
    p_max: float = K.P_MAX

    @property
    def factor(self) -> float:
        return self.pdo / math.log(2)

    @property
    def offset(self) -> float:
        return self.base_score - self.factor * math.log(self.base_odds)

    def as_rows(self) -> list[tuple[str, float]]:
        return [("base_score", float(self.base_score)), ("base_odds", float(self.base_odds)),
                ("pdo", float(self.pdo)), ("factor", self.factor), ("offset", self.offset)]


DEFAULT_SCORECARD = Scorecard()


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_missing(c) -> Column:
    """Null or NaN: pandas treats both as missing, Spark only the first."""
    c = _col(c)
    return c.isNull() | F.isnan(c)


def clip_probability(p, card: Scorecard = DEFAULT_SCORECARD) -> Column:
    """Clip into [p_min, p_max]; null and NaN stay null (trap T3)."""
    p = _col(p)
    return F.when(is_missing(p), F.lit(None).cast("double")).otherwise(
        F.greatest(F.lit(card.p_min), F.least(F.lit(card.p_max), p.cast("double"))))


def log_odds_good(p) -> Column:
    """ln((1 - p) / p), the good:bad log odds."""
    p = _col(p)
    return F.log((F.lit(1.0) - p) / p)


def probability_to_score(p, card: Scorecard = DEFAULT_SCORECARD) -> Column:
    """offset + factor * ln((1-p)/p) on the clipped p, rounded half to even."""
    clipped = clip_probability(p, card)
    raw = F.lit(card.offset) + F.lit(card.factor) * log_odds_good(clipped)
    return F.rint(raw).cast("int")


def risk_band(score) -> Column:
    """Band by score; a missing score is "Unknown"."""
    s = _col(score)
    e1, e2, e3, e4 = K.BAND_EDGES
    n1, n2, n3, n4, n5 = K.BAND_NAMES
    return (F.when(s.isNull(), F.lit(K.BAND_UNKNOWN))
            .when(s < e1, F.lit(n1))
            .when(s < e2, F.lit(n2))
            .when(s < e3, F.lit(n3))
            .when(s < e4, F.lit(n4))
            .otherwise(F.lit(n5)))


def logistic(z) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-_col(z)))
