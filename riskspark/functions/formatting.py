"""Report text and rounding expressions (H4-H9)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as K


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def age_years(days) -> Column:
    """abs(day count) / 365.25 to one decimal (H4)."""
    return report_round(F.abs(_col(days)) / F.lit(K.DAYS_PER_YEAR), 1)


def currency_text(x) -> Column:
    """Thousands separators, no decimals, half to even (H5)."""
    return F.format_number(_col(x).cast("double"), 0)


def percent_text(x) -> Column:
    """A share as percent text with two decimals (H5)."""
    return F.concat(F.format_number(_col(x).cast("double") * F.lit(100.0), 2), F.lit("%"))


def outcome_label(target) -> Column:
    """1 Defaulted, 0 Repaid, absent Unknown (H6)."""
    t = _col(target)
    return (F.when(t == 1, F.lit(K.OUTCOME_DEFAULTED))
            .when(t == 0, F.lit(K.OUTCOME_REPAID))
            .otherwise(F.lit(K.OUTCOME_UNKNOWN)))


def whole_number_text(x) -> Column:
    """Whole number text rounded half to even, like Python's ``{:.0f}``."""
    return F.rint(_col(x)).cast("long").cast("string")


def bin_label(lo, hi) -> Column:
    """"low–high" with no decimals (H7); not format_string, see trap T9."""
    return F.concat(whole_number_text(lo), F.lit("–"), whole_number_text(hi))


def fold_auc(auc) -> Column:
    """max(auc, 1 - auc) (H8)."""
    a = _col(auc)
    return F.when(a.isNotNull(), F.greatest(a, F.lit(1.0) - a))


def report_round(x, digits: int) -> Column:
    """Report rounding (H9) as numpy does it: rint(x * 10^d) / 10^d, ties to
    even on the scaled value.  Two decimals on percent, four on PSI."""
    scale = float(10 ** digits)
    # "+ 0.0" turns a rounded -0.0 into 0.0, so equal values print and hash alike
    return F.rint(_col(x) * F.lit(scale)) / F.lit(scale) + F.lit(0.0)
