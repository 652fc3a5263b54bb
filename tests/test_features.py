"""Marts, sentinels, quality reports, split and encoders."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import SF01
from riskspark.operators import audit, encode, quality, split
from riskspark.operators.marts import build_features
from riskspark.sources.fixtures import Tables


def test_marts_keep_row_count(spark):
    t = Tables(spark, SF01)
    f = build_features(t)
    assert f.count() == t.customer.count()
    assert f.select("SK_ID_CURR").distinct().count() == f.count()


def test_sentinel_names(spark):
    df = spark.createDataFrame([(365243, 365243, 365243), (1, 2, 3)], "DAYS_X int, A_DAYS_X int, DAYSX int")
    out = quality.replace_sentinels(df).collect()
    assert out[0]["DAYS_X"] is None and out[0]["A_DAYS_X"] is None and out[0]["DAYSX"] == 365243
    counts = {r["column_name"]: r["n_sentinel"] for r in quality.sentinel_counts(df).collect()}
    assert counts == {"DAYS_X": 1, "A_DAYS_X": 1}


def test_fixture_sentinels(spark):
    f = build_features(Tables(spark, SF01), replace_sentinel=False)
    counts = {r["column_name"]: r["n_sentinel"] for r in quality.sentinel_counts(f).collect()}
    assert counts["DAYS_SINCE_EVENT"] == 1350


def test_missingness_counts_nan(spark):
    df = spark.createDataFrame([(1.0, "a"), (float("nan"), None), (None, "b"), (2.0, "c")], "x double, s string")
    m = {r["column_name"]: (r["n_missing"], r["pct_missing"]) for r in quality.missingness(df).collect()}
    assert m == {"x": (2, 50.0), "s": (1, 25.0)}


def test_cardinality_cut(spark):
    rows = [(f"a{i % 9}", f"b{i % 10}") for i in range(20)]
    df = spark.createDataFrame(rows, "nine string, ten string")
    c = {r["column_name"]: (r["n_distinct"], r["cardinality"]) for r in quality.column_cardinality(df).collect()}
    assert c == {"nine": (9, "low"), "ten": (10, "high")}


def test_audit_min_values_and_planted_leak(spark):
    rng = np.random.default_rng(0)
    y = rng.integers(0, 2, 200)
    pdf = pd.DataFrame({"SK_ID_CURR": np.arange(200), "TARGET": y,
                        "leak": y * 10.0 + rng.random(200),
                        "c99": np.where(np.arange(200) < 99, rng.random(200), np.nan),
                        "c100": np.where(np.arange(200) < 100, rng.random(200), np.nan)})
    a = {r["column_name"]: r for r in audit.leakage_audit(spark.createDataFrame(pdf)).collect()}
    assert a["leak"]["suspicious"] and a["leak"]["auc_folded"] == pytest.approx(1.0)
    assert a["c99"]["status"] == "too_few_values" and a["c99"]["auc"] is None
    assert a["c100"]["status"] == "ok" and a["c100"]["n_values"] == 100


def test_fixture_audit_finds_only_the_leak(spark):
    a = audit.leakage_audit(build_features(Tables(spark, SF01)))
    flagged = [r["column_name"] for r in a.where("suspicious").collect()]
    assert flagged == ["c_acctbal"]


def test_split_properties(spark):
    f = build_features(Tables(spark, SF01))
    s = split.stratified_split(f).select("SK_ID_CURR", "TARGET", "split", "fold").toPandas()
    assert len(s) == f.count() and s.SK_ID_CURR.is_unique
    for y, g in s.groupby("TARGET"):
        n_test = (g.split == "test").sum()
        assert abs(n_test - 0.2 * len(g)) <= 1
        folds = g[g.split == "train"].fold.value_counts()
        assert folds.max() - folds.min() <= 1 and set(folds.index) == set(range(5))
    assert s[s.split == "test"].fold.isna().all()
    again = split.stratified_split(f).select("SK_ID_CURR", "split").toPandas()
    assert again.set_index("SK_ID_CURR").split.equals(s.set_index("SK_ID_CURR").split.loc[again.SK_ID_CURR])


def _te_ref(cats, y, M=None, V=None):
    y = np.asarray(y, float)
    M = y.mean() if M is None else M
    V = y.var() if V is None else V
    out = {}
    for c in set(cats):
        yy = y[np.asarray(cats) == c]
        n, m, s2 = len(yy), yy.mean(), yy.var()
        d = V * n + s2
        out[c] = M if d == 0 else (V * n / d) * m + (1 - V * n / d) * M
    return out


def test_target_encoding_full_and_oof(spark):
    rng = np.random.default_rng(2)
    n = 400
    cats = rng.choice(list("abcdefghijkl") + [None], n)
    y = rng.integers(0, 2, n)
    fold = rng.integers(0, 5, n)
    pdf = pd.DataFrame({"SK_ID_CURR": np.arange(n), "TARGET": y, "cat": cats, "fold": fold,
                        "split": "train"})
    df = spark.createDataFrame(pdf)
    groups = encode.ColumnGroups(numeric=[], low_card=[], high_card=["cat"])
    pre = encode.fit_preprocessor(df, groups)
    key = [c if c is not None else encode.NULL_CATEGORY for c in cats]
    full = {r["cat"]: r["enc"] for r in pre.target["cat"].full.collect()}
    ref = _te_ref(key, y)
    for c, v in ref.items():
        assert full[c] == pytest.approx(v, abs=1e-12)
    out = pre.transform(df).toPandas().set_index("SK_ID_CURR")
    for k in range(5):
        mask = fold != k
        ref_k = _te_ref(np.array(key, dtype=object)[mask], y[mask])
        rows = np.where(fold == k)[0]
        for i in rows[:20]:
            exp = ref_k.get(key[i], y[mask].mean())
            assert out.loc[i, "cat"] == pytest.approx(exp, abs=1e-12)
    test = df.withColumn("split", F.lit("test")).withColumn("cat", F.lit("unseen"))
    assert pre.transform(test).first()["cat"] == pytest.approx(y.mean(), abs=1e-12)


def test_numeric_and_onehot(spark):
    pdf = pd.DataFrame({"SK_ID_CURR": range(5), "TARGET": [0, 1, 0, 1, 0],
                        "allnull": [None] * 5, "const": [3.0] * 5, "x": [1.0, 2.0, 3.0, 4.0, None],
                        "seg": ["b", "a", None, "a", "c"], "split": "train", "fold": [0, 1, 2, 3, 4]})
    df = spark.createDataFrame(pdf, "SK_ID_CURR long, TARGET int, allnull double, const double, x double, "
                                    "seg string, split string, fold int")
    groups = encode.ColumnGroups(numeric=["allnull", "const", "x"], low_card=["seg"], high_card=[])
    pre = encode.fit_preprocessor(df, groups)
    assert "allnull" not in pre.medians
    assert pre.medians["x"] == 2.5 and pre.scales["const"] == 1.0
    xs = np.array([1, 2, 3, 4, 2.5])
    assert pre.means["x"] == pytest.approx(xs.mean()) and pre.scales["x"] == pytest.approx(xs.std())
    assert pre.categories["seg"] == ["a", "b", "c", "missing"]
    assert pre.feature_names() == ["const", "x", "seg_a", "seg_b", "seg_c", "seg_missing"]
    unseen = spark.createDataFrame([(9, 0, None, 3.0, 1.0, "zzz", "test", None)], df.schema)
    row = pre.transform(unseen).first()
    assert [row[f"seg_{c}"] for c in "abc"] + [row["seg_missing"]] == [0.0, 0.0, 0.0, 0.0]


def test_preprocessor_round_trip(spark):
    import tempfile
    rng = np.random.default_rng(8)
    n = 120
    pdf = pd.DataFrame({"SK_ID_CURR": np.arange(n), "TARGET": rng.integers(0, 2, n),
                        "x": rng.normal(size=n), "seg": rng.choice(list("ab"), n),
                        "cat": rng.choice([f"c{i}" for i in range(11)], n), "split": "train",
                        "fold": np.arange(n) % 5})
    df = spark.createDataFrame(pdf)
    pre = encode.fit_preprocessor(df, encode.ColumnGroups(["x"], ["seg"], ["cat"]))
    path = pre.save(tempfile.mkdtemp(prefix="riskspark-pre-"))
    back = encode.load_preprocessor(spark, path)
    assert back.feature_names() == pre.feature_names()
    a = sorted(pre.transform(df).collect())
    b = sorted(back.transform(df).collect())
    assert a == b


def test_split_keeps_unlabelled_rows(spark):
    rows = [(i, None if i % 7 == 0 else i % 2) for i in range(70)]
    df = spark.createDataFrame(rows, "SK_ID_CURR long, TARGET int")
    s = split.stratified_split(df).toPandas()
    assert len(s) == 70
    assert s[s.TARGET.isna()].split.isna().all() and s[s.TARGET.isna()].fold.isna().all()
    assert s[s.TARGET.notna()].split.notna().all()
