"""Score mapping, bands, deciles, histograms and PSI on hand-made inputs."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskspark.functions.scoring import DEFAULT_SCORECARD, probability_to_score, risk_band
from riskspark.operators import monitor


def test_score_constants():
    assert DEFAULT_SCORECARD.factor == pytest.approx(28.853900817779, abs=1e-9)
    assert DEFAULT_SCORECARD.offset == pytest.approx(487.122876204505, abs=1e-9)


def test_probability_edges(spark):
    df = spark.createDataFrame([(None,), (float("nan"),), (0.0,), (1.0,), (0.5,)], "p double")
    out = [r["s"] for r in df.select(probability_to_score("p").alias("s")).collect()]
    assert out[0] is None and out[1] is None
    card = DEFAULT_SCORECARD
    hi = round(card.offset + card.factor * math.log(0.999 / 0.001))
    lo = round(card.offset + card.factor * math.log(0.001 / 0.999))
    assert out[2] == hi == 686 and out[3] == lo == 288
    assert out[4] == round(card.offset)


def test_score_falls_as_p_rises(spark):
    ps = [i / 100 for i in range(1, 100)]
    df = spark.createDataFrame([(p,) for p in ps], "p double")
    s = [r["s"] for r in df.select(probability_to_score("p").alias("s")).collect()]
    assert all(a >= b for a, b in zip(s, s[1:]))


def test_rint_half_even(spark):
    df = spark.createDataFrame([(0.5,), (1.5,), (2.5,), (-2.5,)], "x double")
    assert [r[0] for r in df.select(F.rint("x")).collect()] == [0.0, 2.0, 2.0, -2.0]


def test_band_edges(spark):
    scores = [449, 450, 549, 550, 649, 650, 749, 750, None]
    df = spark.createDataFrame([(s,) for s in scores], "s int")
    got = [r[0] for r in df.select(risk_band("s")).collect()]
    assert got == ["Very High Risk", "High Risk", "High Risk", "Medium Risk", "Medium Risk",
                   "Low Risk", "Low Risk", "Very Low Risk", "Unknown"]


def _qcut_ref(x):
    return pd.qcut(pd.Series(x), 10, labels=False, duplicates="drop")


def test_deciles_heavy_ties(spark):
    x = [5] * 60 + list(range(40))
    y = [i % 2 for i in range(len(x))]
    df = spark.createDataFrame(list(zip(x, y)), "score int, TARGET int")
    d = monitor.with_decile(df).toPandas()
    ref = _qcut_ref(d.score)
    assert list(d.decile) == list(ref.astype(int))
    table = monitor.decile_table(df).toPandas()
    assert len(table) == ref.nunique()


def test_deciles_all_equal_is_empty(spark):
    df = spark.createDataFrame([(500, 0)] * 20, "score int, TARGET int")
    assert monitor.decile_table(df).count() == 0


def test_monotone_tolerance(spark):
    # rates rising by 0.004 (within tolerance) then by 0.006 (violation)
    t = spark.createDataFrame([(0, 0.100), (1, 0.104), (2, 0.110)], "decile int, default_rate double")
    flags = monitor.flag_monotonicity(t).orderBy("decile").toPandas()
    assert list(flags.monotone_violation) == [False, False, True]
    assert monitor.is_monotone(monitor.flag_monotonicity(t)).first()[0] is False


def test_histogram_matches_numpy(spark):
    rng = np.random.default_rng(1)
    x = rng.integers(300, 700, 500).astype(float)
    df = spark.createDataFrame(pd.DataFrame({"score": x, "split": "train"}))
    h = monitor.histogram(df, "score", "split", 50).orderBy("bin").toPandas()
    ref, edges = np.histogram(x, bins=50)
    assert list(h["count"]) == list(ref)
    assert h.lo.tolist() == pytest.approx(edges[:-1].tolist())
    dens, _ = np.histogram(x, bins=50, density=True)
    assert h.density.tolist() == pytest.approx(dens.tolist())


def test_histogram_lo_equals_hi(spark):
    df = spark.createDataFrame([(500.0, "t")] * 20, "score double, split string")
    h = monitor.histogram(df, "score", "split", 10).orderBy("bin").toPandas()
    ref, _ = np.histogram(np.full(20, 500.0), bins=10)
    assert list(h["count"]) == list(ref)


def _psi_ref(e, a, n=10):
    lo, hi = min(e.min(), a.min()), max(e.max(), a.max())
    bins = np.linspace(lo, hi, n + 1)
    ec, _ = np.histogram(e, bins=bins)
    ac, _ = np.histogram(a, bins=bins)
    ep = np.clip(ec / len(e), 0.0001, None)
    ap = np.clip(ac / len(a), 0.0001, None)
    return float(np.sum((ap - ep) * np.log(ap / ep)))


def test_psi_matches_numpy_and_self_is_zero(spark):
    rng = np.random.default_rng(5)
    e = rng.normal(550, 30, 800).round()
    a = rng.normal(560, 35, 300).round()
    a[:5] = 900  # leaves empty bins in between: floor applies
    E = spark.createDataFrame(pd.DataFrame({"score": e}))
    A = spark.createDataFrame(pd.DataFrame({"score": a}))
    t = monitor.psi_table(E, A)
    got = monitor.psi_summary(t).first()["psi_total"]
    assert got == pytest.approx(_psi_ref(e, a), abs=1e-12)
    same = monitor.psi_summary(monitor.psi_table(E, E)).first()
    assert same["psi_total"] == pytest.approx(0.0, abs=1e-15)
    assert same["verdict"] == "Stable"
    labels = [r["bin_label"] for r in t.orderBy("bin").collect()]
    assert all("–" in s for s in labels)


def test_band_distribution_lists_all(spark):
    df = spark.createDataFrame([("High Risk",)] * 3 + [("Low Risk",)], "risk_band string")
    t = {r["risk_band"]: (r["count"], r["pct"]) for r in monitor.band_distribution(df).collect()}
    assert t["Very Low Risk"] == (0, 0.0)
    assert t["High Risk"] == (3, 75.0)
    assert len(t) == 6
