"""Ranking metrics, running totals and quantiles against brute force."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from riskspark.operators.cumulative import exact_quantiles, running_totals
from riskspark.operators.metrics import pr_curve, ranking_metrics, roc_curve


def brute(p, y):
    p, y = np.asarray(p, float), np.asarray(y, int)
    pos, neg = p[y == 1], p[y == 0]
    P, N = len(pos), len(neg)
    if P == 0 or N == 0:
        return None, None, None
    gt = (pos[:, None] > neg[None, :]).sum()
    eq = (pos[:, None] == neg[None, :]).sum()
    auc = (gt + 0.5 * eq) / (P * N)
    order = np.unique(p)[::-1]
    ap, ks, prev_r = 0.0, 0.0, 0.0
    for t in order:
        tp = ((p >= t) & (y == 1)).sum()
        fp = ((p >= t) & (y == 0)).sum()
        r = tp / P
        ap += (r - prev_r) * tp / (tp + fp)
        prev_r = r
        ks = max(ks, abs(tp / P - fp / N))
    return auc, ap, ks


@pytest.fixture(scope="module")
def tied(spark):
    rng = np.random.default_rng(7)
    n = 3000
    p = np.round(rng.random(n), 2)  # heavy ties
    y = (rng.random(n) < 0.2 + 0.5 * p).astype(int)
    pdf = pd.DataFrame({"p": p, "TARGET": y, "g": rng.integers(0, 3, n)})
    return spark.createDataFrame(pdf), pdf


def test_metrics_match_brute_force(tied):
    df, pdf = tied
    r = ranking_metrics(df, "p").first()
    auc, ap, ks = brute(pdf.p, pdf.TARGET)
    assert r["auc_roc"] == pytest.approx(auc, abs=1e-12)
    assert r["pr_auc"] == pytest.approx(ap, abs=1e-12)
    assert r["ks_statistic"] == pytest.approx(ks, abs=1e-12)
    assert r["gini"] == pytest.approx(2 * auc - 1, abs=1e-12)


def test_metrics_by_group(tied):
    df, pdf = tied
    rows = {r["g"]: r for r in ranking_metrics(df, "p", by=["g"]).collect()}
    for g, sub in pdf.groupby("g"):
        auc, ap, ks = brute(sub.p, sub.TARGET)
        assert rows[g]["auc_roc"] == pytest.approx(auc, abs=1e-12)
        assert rows[g]["pr_auc"] == pytest.approx(ap, abs=1e-12)


def test_swap_and_monotone(tied):
    df, _ = tied
    a = ranking_metrics(df, "p").first()["auc_roc"]
    swapped = df.withColumn("TARGET", 1 - F.col("TARGET"))
    assert ranking_metrics(swapped, "p").first()["auc_roc"] == pytest.approx(1 - a, abs=1e-12)
    mono = df.withColumn("q", F.exp(F.col("p") * 3) - 7)
    assert ranking_metrics(mono, "q").first()["auc_roc"] == pytest.approx(a, abs=1e-12)


def test_one_class_is_null(spark):
    df = spark.createDataFrame([(float(i), 1) for i in range(10)], "p double, TARGET int")
    r = ranking_metrics(df, "p").first()
    assert r["auc_roc"] is None and r["pr_auc"] is None and r["ks_statistic"] is None


def test_curves_end_points(tied):
    df, pdf = tied
    roc = roc_curve(df, "p").toPandas()
    assert len(roc) == pdf.p.nunique() + 1
    assert roc.tpr.max() == pytest.approx(1.0) and roc.fpr.max() == pytest.approx(1.0)
    pr = pr_curve(df, "p").toPandas()
    assert ((pr.recall == 0) & (pr.precision == 1)).any()


def test_running_totals_equal_one_task_window(spark):
    li = spark.read.parquet("/root/testdata/sf0.01/lineitem.parquet") \
        .select(F.col("l_extendedprice").alias("v"), F.lit(1).cast("long").alias("c"))
    rt = running_totals(li, "v", ["c"], buckets=16)
    w = Window.orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    ref = li.groupBy("v").agg(F.sum("c").alias("c")).withColumn("ref", F.sum("c").over(w))
    diff = rt.join(ref.select("v", "ref"), "v").where(F.col("cum_c") != F.col("ref")).count()
    assert diff == 0
    assert rt.count() == ref.count()
    plan = rt._jdf.queryExecution().executedPlan().toString().splitlines()
    # the only single-task exchange is over the bucket totals (<= k rows),
    # never over the data rows
    for i, line in enumerate(plan):
        if "Exchange SinglePartition" in line:
            assert "HashAggregate(keys=[__bucket" in plan[i + 1]


def test_exact_quantiles_match_numpy(spark):
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(size=500), np.repeat(1.5, 60)])
    g = rng.integers(0, 2, len(x))
    df = spark.createDataFrame(pd.DataFrame({"x": x, "g": g}))
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]
    got = {(r["g"], r["q"]): r["quantile"] for r in exact_quantiles(df, "x", probs, by=["g"]).collect()}
    for k in (0, 1):
        ref = np.quantile(x[g == k], probs)
        for q, v in zip(probs, ref):
            assert got[(k, q)] == pytest.approx(v, abs=1e-12)


def test_exact_quantiles_bracketed_large_groups(spark, monkeypatch):
    from riskspark.operators import cumulative

    def no_fallback(*a, **k):
        raise AssertionError("bracket missed the order statistics")

    monkeypatch.setattr(cumulative, "_exact_quantiles_full", no_fallback)
    rng = np.random.default_rng(12)
    n = 40000
    x = np.concatenate([np.round(rng.normal(size=n), 3), np.repeat(0.0, 5000)])
    g = rng.integers(0, 3, len(x))
    df = spark.createDataFrame(pd.DataFrame({"x": x, "g": g}))
    probs = [0.1, 0.5, 0.9]
    got = {(r["g"], r["q"]): r["quantile"] for r in cumulative.exact_quantiles(df, "x", probs, by=["g"]).collect()}
    for k in range(3):
        ref = np.quantile(x[g == k], probs)
        for q, v in zip(probs, ref):
            assert got[(k, q)] == pytest.approx(v, abs=1e-12)
    # no grouping column, a single value, and a tiny group
    one = spark.createDataFrame([(2.5,)], "x double")
    assert cumulative.exact_quantiles(one, "x", [0.5]).first()["quantile"] == 2.5
    small = spark.createDataFrame([(float(v),) for v in [4, 1, 3, 2]], "x double")
    assert cumulative.exact_quantiles(small, "x", [0.5]).first()["quantile"] == 2.5


def test_more_groups_than_are_broadcast(spark, monkeypatch):
    """Running totals and exact quantiles of many groups take the shuffled way, with equal results."""
    from riskspark.operators import cumulative
    rng = np.random.default_rng(3)
    rows = [(int(i % 40), float(rng.integers(0, 30)), 1) for i in range(2000)]
    df = spark.createDataFrame(rows, "g int, v double, n long")
    few = sorted(cumulative.running_totals(df, "v", ["n"], ["g"]).collect())
    exact = sorted(cumulative.exact_quantiles(df, "v", [0.25, 0.5], ["g"]).select("g", "q", "quantile").collect())
    monkeypatch.setattr(cumulative, "MAX_GROUPS", 3)
    assert sorted(cumulative.running_totals(df, "v", ["n"], ["g"]).collect()) == few
    many = sorted(cumulative.exact_quantiles(df, "v", [0.25, 0.5], ["g"]).select("g", "q", "quantile").collect())
    assert [tuple(r) for r in many] == [tuple(r) for r in exact]
    for g in range(40):
        own = [v for k, v, _ in rows if k == g]
        assert exact[2 * g + 1][2] == np.quantile(own, 0.5)
