"""Score monitoring (D11-D17, E7, E8, C5) over a score table.

A score table has one row per applicant with ``score`` (int), ``TARGET`` and
usually ``split``.  Scores are clipped to a bounded integer range (288-686 under
the default card), so exact ``percentile`` over them keeps at most a few hundred
distinct values per aggregation buffer.  Bin edges (deciles, histogram, PSI)
are bounded parameter lists: computed by one small aggregate, brought to the
driver and applied as literals, so every row's bin is a pure expression.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.formatting import report_round
from ..functions.binning import (decile_probabilities, edges_literal, equal_width_edges,
                                 histogram_bin, quantile_bin)
from ..functions.formatting import bin_label
from .joins import broadcast_checked
from ..session import materialize
from ..functions.scoring import DEFAULT_SCORECARD, Scorecard, probability_to_score, risk_band


def score_table(df: DataFrame, probability: str = "probability", key: str = K.KEY,
                card: Scorecard = DEFAULT_SCORECARD, keep: Sequence[str] = ()) -> DataFrame:
    """H1 + H2: key, probability, score, risk band (plus ``keep`` columns)."""
    s = probability_to_score(probability, card)
    return df.select(
        F.col(key).cast("long").alias(key),
        F.col(probability).cast("double").alias("probability"),
        s.alias("score"),
        risk_band(s).alias("risk_band"),
        *keep,
    )


# --- E8 / D11 / E7: deciles ----------------------------------------------------

def decile_edges(scores: DataFrame, score: str = "score", n: int = 10) -> list[float]:
    """Linear-interpolated quantile edges, repeated edges dropped."""
    row = scores.where(F.col(score).isNotNull()).agg(
        F.percentile(F.col(score).cast("double"), decile_probabilities(n)).alias("e")).first()
    edges = row["e"] if row and row["e"] is not None else []
    out: list[float] = []
    for e in edges:
        if not out or e != out[-1]:
            out.append(float(e))
    return out


def with_decile(scores: DataFrame, score: str = "score", n: int = 10) -> DataFrame:
    edges = decile_edges(scores, score, n)
    return scores.withColumn("decile", quantile_bin(score, edges_literal(edges) if edges
                                                    else F.array().cast("array<double>")))


def decile_table(scores: DataFrame, score: str = "score", label: str = K.LABEL,
                 n: int = 10, tolerance: float = K.MONOTONE_TOLERANCE) -> DataFrame:
    """Per decile: count, defaults, rate, min/max/avg score, and the E7 flag
    (rate above the previous decile's rate by more than ``tolerance``).

    The lag runs over the aggregated table (at most ``n`` rows).
    """
    d = with_decile(scores, score, n).where(F.col("decile").isNotNull())
    y = F.col(label)
    t = d.groupBy("decile").agg(
        F.count(y).alias("count"),
        F.sum(y).cast("long").alias("default_count"),
        F.avg(y.cast("double")).alias("default_rate"),
        F.min(score).alias("min_score"),
        F.max(score).alias("max_score"),
        F.avg(F.col(score).cast("double")).alias("avg_score"),
    )
    return flag_monotonicity(t, tolerance)


def flag_monotonicity(deciles: DataFrame, tolerance: float = K.MONOTONE_TOLERANCE) -> DataFrame:
    """A decile breaks monotonicity when its rate exceeds the previous
    decile's rate by more than ``tolerance`` (window over <= n rows)."""
    prev = F.lag("default_rate").over(Window.orderBy("decile"))
    return deciles.withColumn("monotone_violation",
                              F.coalesce(F.col("default_rate") > prev + F.lit(tolerance), F.lit(False)))


def is_monotone(deciles: DataFrame) -> DataFrame:
    """E7 verdict: no decile breaks the tolerance."""
    return deciles.agg(F.coalesce(F.bool_and(~F.col("monotone_violation")), F.lit(True))
                       .alias("is_monotone"))


# --- D12 / D13: summaries ------------------------------------------------------

def score_summary(scores: DataFrame, score: str = "score", by: Sequence[str] = ("split",)) -> DataFrame:
    """min, max, mean, population std, p25/p50/p75 (linear) per group."""
    s = F.col(score).cast("double")
    q = F.percentile(s, [0.25, 0.5, 0.75])
    return (scores.where(F.col(score).isNotNull()).groupBy(*by)
            .agg(F.min(score).alias("min_score"), F.max(score).alias("max_score"),
                 F.avg(s).alias("mean_score"), F.stddev_pop(s).alias("std_score"),
                 q.alias("__q"))
            .select(*by, "min_score", "max_score", "mean_score", "std_score",
                    F.col("__q")[0].alias("p25"), F.col("__q")[1].alias("p50"),
                    F.col("__q")[2].alias("p75")))


BAND_ORDER = tuple(reversed(K.BAND_NAMES)) + (K.BAND_UNKNOWN,)


def band_distribution(scores: DataFrame, band: str = "risk_band") -> DataFrame:
    """Count and percent per band; every band listed, zero when empty."""
    spark = scores.sparkSession
    grid = spark.createDataFrame([(b, i) for i, b in enumerate(BAND_ORDER)],
                                 f"{band} string, band_order int")
    counts = scores.groupBy(band).agg(F.count(F.lit(1)).alias("count"))
    # every row is in exactly one group (null included): the total is the sum of
    # the group counts, taken over that handful of rows (full outer keeps
    # groups outside the grid in the total)
    out = grid.join(counts, band, "full_outer") \
        .withColumn("__total", F.sum(F.coalesce("count", F.lit(0))).over(Window.partitionBy())) \
        .where(F.col("band_order").isNotNull()) \
        .withColumn("count", F.coalesce("count", F.lit(0)).cast("long"))
    return out.select(band, "band_order", "count",
                      F.when(F.col("__total") > 0,
                             report_round(F.col("count") / F.col("__total") * F.lit(100.0), 2))
                      .otherwise(F.lit(0.0)).alias("pct"))


def band_value_counts(scores: DataFrame, band: str = "risk_band") -> DataFrame:
    """Plain value counts, descending (the dashboard's pie)."""
    return scores.groupBy(band).agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), band)


# --- D14 / D15 / C5: histograms ------------------------------------------------

def _edges(lo: F.Column, hi: F.Column, n_bins: int) -> F.Column:
    """``equal_width_edges`` of columns; a range of zero width is widened by 0.5 each side (numpy)."""
    flat = lo == hi
    lo, hi = F.when(flat, lo - 0.5).otherwise(lo), F.when(flat, hi + 0.5).otherwise(hi)
    return F.transform(F.sequence(F.lit(0), F.lit(n_bins)),
                       lambda i: F.when(i == n_bins, hi).otherwise(i * ((hi - lo) / n_bins) + lo))


def histogram(df: DataFrame, value: str = "score", by: str = "split",
              n_bins: int = K.HIST_BINS, joint: bool = False) -> DataFrame:
    """Equal-width counts per group, every bin present (C5), with density.

    ``joint=False``: each group on its own range (the static plot);
    ``joint=True``: one range over all groups (the dashboard overlay).
    Ranges and edges are a table with a row per group, joined back (a null group
    is a group of its own); no group passes the driver.
    """
    v = F.col(value).cast("double")
    groups = materialize(df.where(F.col(value).isNotNull()).groupBy(F.col(by).alias("__by"))
                         .agg(F.min(v).alias("lo"), F.max(v).alias("hi")))
    lo, hi = F.col("lo"), F.col("hi")
    if joint:
        r = groups.agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).first()
        lo, hi = (F.lit(r[c]).cast("double") for c in ("lo", "hi"))
    table = groups.select("__by", _edges(lo, hi, n_bins).alias("__edges"))
    binned = (df.where(F.col(value).isNotNull()).select(by, v.alias("__v"))
              .join(broadcast_checked(table), F.col(by).eqNullSafe(F.col("__by")))
              .select(by, histogram_bin(F.col("__v"), F.col("__edges"), n_bins).alias("bin")))
    counts = (binned.groupBy(by, "bin").agg(F.count(F.lit(1)).alias("count"))
              .select(F.col(by).alias("__by"), F.col("bin").alias("__bin"), "count"))
    grid = (table.select(F.col("__by").alias(by), "__edges", F.explode(F.sequence(F.lit(0), F.lit(n_bins - 1))).alias("bin"))
            .select(by, "bin", F.get("__edges", F.col("bin")).alias("lo"), F.get("__edges", F.col("bin") + 1).alias("hi")))
    # every binned row is in one bin: totals are sums over the (groups x bins)
    # grid, a window over that small frame, so the counts are read once
    out = (grid.join(counts, F.col(by).eqNullSafe(F.col("__by")) & (F.col("bin") == F.col("__bin")), "left")
           .withColumn("count", F.coalesce("count", F.lit(0)).cast("long"))
           .withColumn("__total", F.sum("count").over(Window.partitionBy(by))))
    width = F.col("hi") - F.col("lo")
    dens = F.when(width > 0, F.try_divide(F.col("count"), F.col("__total") * width))
    return out.select(by, "bin", "lo", "hi", "count", dens.alias("density"))


# --- D16 / D17: population stability -------------------------------------------

def psi_table(expected: DataFrame, actual: DataFrame, value: str = "score",
              n_bins: int = K.PSI_BINS, floor: float = K.PSI_FLOOR) -> DataFrame:
    """Per-bin PSI between two samples on a joint equal-width grid.

    Shares are floored at ``floor`` and not rescaled (Q13).  Columns: bin,
    bin_label ("lo–hi"), expected_pct, actual_pct (two decimals), psi (four
    decimals) and the unrounded ``psi_raw`` used for the total.
    """
    e = expected.where(F.col(value).isNotNull()).select(F.col(value).cast("double").alias("v"),
                                                        F.lit("e").alias("side"))
    a = actual.where(F.col(value).isNotNull()).select(F.col(value).cast("double").alias("v"),
                                                      F.lit("a").alias("side"))
    return _psi_from_sides(e.unionByName(a), n_bins, floor)


def psi_by_split(scores: DataFrame, value: str = "score", split_col: str = "split",
                 expected: str = "train", actual: str = "test", n_bins: int = K.PSI_BINS,
                 floor: float = K.PSI_FLOOR) -> DataFrame:
    """``psi_table`` for two groups of one frame, in a single pass over it
    (the side of a row is a column expression, not a second scan)."""
    side = F.when(F.col(split_col) == expected, F.lit("e")).when(F.col(split_col) == actual, F.lit("a"))
    both = scores.select(F.col(value).cast("double").alias("v"), side.alias("side")) \
        .where(F.col("v").isNotNull() & F.col("side").isNotNull())
    return _psi_from_sides(both, n_bins, floor)


def _psi_from_sides(both: DataFrame, n_bins: int, floor: float) -> DataFrame:
    spark = both.sparkSession
    r = both.agg(F.min("v").alias("lo"), F.max("v").alias("hi")).first()
    if r is None or r["lo"] is None:
        return spark.createDataFrame(
            [], "bin int, bin_label string, expected_pct double, actual_pct double, "
                "psi double, psi_raw double")
    edges = equal_width_edges(r["lo"], r["hi"], n_bins)
    binned = both.select("side", histogram_bin("v", edges_literal(edges), n_bins).alias("bin"))
    counts = binned.groupBy("bin").agg(
        F.count_if(F.col("side") == "e").alias("n_e"),
        F.count_if(F.col("side") == "a").alias("n_a"))
    grid = spark.createDataFrame([(i, edges[i], edges[i + 1]) for i in range(n_bins)],
                                 "bin int, lo double, hi double")
    # every row falls in one bin of the [lo, hi] grid, so the totals are sums
    # over the grid: a window over n_bins rows, reading the counts only once
    all_bins = Window.partitionBy()
    g = (grid.join(counts, "bin", "left")
         .withColumn("t_e", F.sum(F.coalesce("n_e", F.lit(0))).over(all_bins))
         .withColumn("t_a", F.sum(F.coalesce("n_a", F.lit(0))).over(all_bins)))
    ep = F.greatest(F.try_divide(F.coalesce("n_e", F.lit(0)), F.col("t_e")), F.lit(floor))
    ap = F.greatest(F.try_divide(F.coalesce("n_a", F.lit(0)), F.col("t_a")), F.lit(floor))
    g = g.select("bin", "lo", "hi", ep.alias("ep"), ap.alias("ap"))
    psi = (F.col("ap") - F.col("ep")) * F.log(F.col("ap") / F.col("ep"))
    return g.select(
        "bin", bin_label("lo", "hi").alias("bin_label"),
        report_round(F.col("ep") * F.lit(100.0), 2).alias("expected_pct"),
        report_round(F.col("ap") * F.lit(100.0), 2).alias("actual_pct"),
        report_round(psi, 4).alias("psi"),
        psi.alias("psi_raw"),
    )


def psi_verdict(psi: F.Column) -> F.Column:
    """Below 0.1 stable, below 0.25 moderate, else significant."""
    s, m, x = K.PSI_VERDICTS
    return (F.when(psi < K.PSI_STABLE, F.lit(s))
            .when(psi < K.PSI_MODERATE, F.lit(m)).otherwise(F.lit(x)))


def psi_summary(table: DataFrame) -> DataFrame:
    """Total PSI (sum of unrounded bin terms) and its verdict."""
    t = table.agg(F.sum("psi_raw").alias("psi_total"))
    return t.select("psi_total", psi_verdict(F.col("psi_total")).alias("verdict"))
