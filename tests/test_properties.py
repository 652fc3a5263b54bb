"""Property tests: metrics against brute force on random inputs; encoders
fitted on train never depend on test rows."""

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from riskspark.operators import encode, metrics
from test_metrics import brute


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 6), st.integers(0, 1)), min_size=2, max_size=60))
def test_metrics_equal_brute_force(spark, rows):
    pdf = pd.DataFrame(rows, columns=["p", "TARGET"]).astype({"p": float})
    auc, ap, ks = brute(pdf.p, pdf.TARGET)
    r = metrics.ranking_metrics(spark.createDataFrame(pdf), "p").first()
    if auc is None:
        assert r["auc_roc"] is None
    else:
        assert r["auc_roc"] == pytest.approx(auc, abs=1e-12)
        assert r["pr_auc"] == pytest.approx(ap, abs=1e-12)
        assert r["ks_statistic"] == pytest.approx(ks, abs=1e-12)


def test_encoders_never_read_test_rows(spark):
    rng = np.random.default_rng(4)
    n = 300
    pdf = pd.DataFrame({
        "SK_ID_CURR": np.arange(n), "TARGET": rng.integers(0, 2, n),
        "x": rng.normal(size=n), "seg": rng.choice(list("abc"), n),
        "cat": rng.choice([f"c{i}" for i in range(12)], n),
        "split": np.where(np.arange(n) < 240, "train", "test"),
        "fold": np.where(np.arange(n) < 240, np.arange(n) % 5, -1)})
    df = spark.createDataFrame(pdf).withColumn("fold", F.when(F.col("fold") >= 0, F.col("fold")))
    groups = encode.ColumnGroups(numeric=["x"], low_card=["seg"], high_card=["cat"])
    a = encode.fit_preprocessor(df.where("split = 'train'"), groups)
    # change every test row beyond recognition, then fit again on the train rows
    wild = df.withColumn("x", F.when(F.col("split") == "test", F.lit(1e9)).otherwise(F.col("x"))) \
        .withColumn("seg", F.when(F.col("split") == "test", F.lit("zzz")).otherwise(F.col("seg")))
    b = encode.fit_preprocessor(wild.where("split = 'train'"), groups)
    assert a.medians == b.medians and a.means == b.means and a.scales == b.scales
    assert a.categories == b.categories
    ta = sorted(a.target["cat"].full.collect())
    tb = sorted(b.target["cat"].full.collect())
    assert ta == tb
    # test rows are encoded with the full fit, train rows out of fold
    out = a.transform(df).toPandas().set_index("SK_ID_CURR")
    full = {r["cat"]: r["enc"] for r in a.target["cat"].full.collect()}
    test_ids = pdf[pdf.split == "test"].SK_ID_CURR
    for i in test_ids[:20]:
        assert out.loc[i, "cat"] == pytest.approx(full[pdf.loc[i, "cat"]])
