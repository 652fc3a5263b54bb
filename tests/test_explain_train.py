"""Training invariants and Tree SHAP against brute-force Shapley values."""

import itertools
import math

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from riskspark.operators import explain, stages, train
from riskspark.session import scratch_path


def small_space(lo: int, hi: int) -> tuple:
    """The library's ranges with few trees per model."""
    return tuple(("n_estimators", lo, hi, False, True) if s[0] == "n_estimators" else s for s in train.SEARCH_SPACE)


@pytest.fixture(scope="module")
def small_model(spark):
    rng = np.random.default_rng(11)
    n = 600
    X = rng.normal(size=(n, 3))
    z = 1.5 * X[:, 0] - X[:, 1] + 0.5 * X[:, 0] * X[:, 2]
    y = (rng.random(n) < 1 / (1 + np.exp(-z))).astype(int)
    rows = [(i, int(y[i]), Vectors.dense(X[i].tolist())) for i in range(n)]
    df = spark.createDataFrame(rows, ["SK_ID_CURR", "TARGET", "features"])
    model = train.train_gbt(df, {"n_estimators": 8, "max_depth": 3, "learning_rate": 0.3,
                                 "min_child_samples": 5}, ratio=1.0)
    path = train.save_model(spark, model, "tests/gbt-small", path=scratch_path(spark, "tests/gbt-small"))
    return df, model, path, X


def _tree_expect(nodes, x, subset):
    """Path-dependent conditional expectation of one tree (cover weighted)."""
    def rec(nid):
        nd = nodes[nid]
        if nd["left"] < 0:
            return nd["value"]
        f, thr = nd["feature_index"], nd["threshold"]
        if f in subset:
            return rec(nd["left"] if x[f] <= thr else nd["right"])
        l, r = nodes[nd["left"]], nodes[nd["right"]]
        return (l["cover"] * rec(nd["left"]) + r["cover"] * rec(nd["right"])) / nd["cover"]
    return rec(0)


def test_tree_shap_equals_brute_force(spark, small_model):
    df, model, path, X = small_model
    lt = explain.leaf_table(train.tree_nodes(spark, path))
    nodes_df = train.tree_nodes(spark, path).toPandas()
    trees = {}
    for tid, g in nodes_df.groupby("treeID"):
        w = float(g.tree_weight.iloc[0])
        trees[tid] = {int(r.node): {"left": int(r.left), "right": int(r.right),
                                    "feature_index": int(r.feature_index) if r.left >= 0 else -1,
                                    "threshold": r.threshold, "cover": r.cover,
                                    "value": 2 * w * r.prediction} for r in g.itertuples()}
    M = 3
    got = explain.shap_values(df.where("SK_ID_CURR < 40"), lt, ["0", "1", "2"], leaf_block=5, row_block=7)
    phi = {(r["SK_ID_CURR"], int(r["feature"])): r["shap"] for r in got.collect()}
    for i in range(40):
        x = X[i]
        for j in range(M):
            ref = 0.0
            others = [k for k in range(M) if k != j]
            for s in range(M):
                for S in itertools.combinations(others, s):
                    wgt = math.factorial(s) * math.factorial(M - s - 1) / math.factorial(M)
                    with_j = sum(_tree_expect(t, x, set(S) | {j}) for t in trees.values())
                    without = sum(_tree_expect(t, x, set(S)) for t in trees.values())
                    ref += wgt * (with_j - without)
            assert phi[i, j] == pytest.approx(ref, abs=1e-9)  # blocks of leaves and rows add up


def test_shap_additivity_and_base(spark, small_model):
    df, model, path, X = small_model
    lt = explain.leaf_table(train.tree_nodes(spark, path))
    shap = explain.shap_values(df, lt, ["a", "b", "c"])
    total = shap.groupBy("SK_ID_CURR").agg(F.sum("shap").alias("s"))
    m = model.transform(df).select("SK_ID_CURR", (2 * vector_to_array("rawPrediction")[1]).alias("margin"))
    err = total.join(m, "SK_ID_CURR").select(F.max(F.abs(F.col("s") + lt.base - F.col("margin")))).first()[0]
    assert err < 1e-9
    assert shap.count() == 3 * df.count()


def test_split_importance_counts_internal_nodes(spark, small_model):
    _, _, path, _ = small_model
    imp = train.split_importance(spark, path, ["a", "b", "c"]).toPandas()
    n_internal = train.tree_nodes(spark, path).where("left >= 0").count()
    assert imp.split_count.sum() == n_internal


def test_baseline_balanced_weights(spark, small_model):
    df, _, _, _ = small_model
    w, total = train.balanced_weight(df)
    assert total == pytest.approx(df.count())
    lr = train.train_baseline(df, max_iter=200)
    p = train.predict_proba(lr, df).agg(F.min("probability"), F.max("probability")).first()
    assert 0 < p[0] < p[1] < 1


def test_search_is_seeded(spark):
    a = train.sample_trials(5, seed=42)
    b = train.sample_trials(5, seed=42)
    assert a == b
    for t in a:
        assert 100 <= t["n_estimators"] <= 1000 and 0.01 <= t["learning_rate"] <= 0.3
        assert 3 <= t["max_depth"] <= 8 and 0.6 <= t["subsample"] <= 1.0


def test_waterfall_folds_remainder(spark):
    rows = [(1, f"f{i}", float(i), float((-1) ** i * i)) for i in range(20)]
    shap = spark.createDataFrame(rows, "SK_ID_CURR long, feature string, value double, shap double")
    w = explain.waterfall(shap, base=0.5, k=15).orderBy("rank").toPandas()
    assert len(w) == 15 and w.iloc[-1].feature == "6 other features"
    assert w.shap.sum() == pytest.approx(sum(r[3] for r in rows))
    assert w.output_margin.iloc[0] == pytest.approx(0.5 + sum(r[3] for r in rows))


def test_sample_prefilter_is_exact(spark):
    df = spark.range(20000).withColumnRenamed("id", "SK_ID_CURR")
    got = sorted(r[0] for r in explain.explanation_sample(df, size=500).collect())
    h = explain.id_hash("SK_ID_CURR", 43)
    ref = sorted(r[0] for r in df.withColumn("h", h).orderBy("h", "SK_ID_CURR").limit(500).collect())
    assert got == ref
    assert explain.explanation_sample(df, size=30000).count() == 20000


def test_stages_end_in_the_model(spark, small_model):
    """The last of the cumulative margins is the model's; each stage adds one tree."""
    df, model, path, X = small_model
    nodes = train.tree_nodes(spark, path)
    scorer = stages.tree_stages(nodes)
    rows = df.select("SK_ID_CURR", vector_to_array("features").alias("x"))
    m = stages.last_scores(rows, "SK_ID_CURR", "x", scorer)
    ref = model.transform(df).select("SK_ID_CURR", (2 * vector_to_array("rawPrediction")[1]).alias("r"))
    err = m.join(ref, "SK_ID_CURR").select(F.max(F.abs(F.col("score") - F.col("r")))).first()[0]
    assert err < 1e-9
    every = scorer(X)
    for t in range(model.getNumTrees):
        one = stages.tree_stages(nodes.where(F.col("treeID") == t))(X)[:, 0]
        assert np.allclose(every[:, t] - (every[:, t - 1] if t else 0), one)


def test_leaf_paths_cover_every_row_once(spark, small_model):
    """Each row lies in one leaf of every tree, and the leaves' shares of the cover sum to one."""
    _, model, path, X = small_model
    leaves = explain.leaf_paths(train.tree_nodes(spark, path)).collect()
    inside = np.zeros((len(X), model.getNumTrees), int)
    share = np.zeros(model.getNumTrees)
    for r in leaves:
        ok = np.ones(len(X), bool)
        for s in r["path"]:
            ok &= (X[:, s["f"]] > s["lo"]) & (X[:, s["f"]] <= s["hi"])
        inside[:, r["treeID"]] += ok
        share[r["treeID"]] += math.prod(s["r"] for s in r["path"])
    assert (inside == 1).all() and np.allclose(share, 1)


def test_attribution_of_stumps_and_empty_frames(spark):
    """A tree without a split moves the base value only; no rows, no attribution."""
    nodes = spark.createDataFrame([(0, 0, 0.25, 10.0, 0.0, -1, -1, -1, None, 1.0)],
                                  "treeID int, node int, prediction double, cover double, gain double, left int, right int, "
                                  "feature_index int, threshold double, tree_weight double")
    lt = explain.leaf_table(nodes)
    assert lt.base == 0.5
    rows = spark.createDataFrame([(1, [1.0, 2.0])], "SK_ID_CURR long, x array<double>")
    assert [tuple(r) for r in explain.shap_values(rows, lt, ["a", "b"], "x").orderBy("feature").collect()] == \
        [(1, "a", 1.0, 0.0), (1, "b", 2.0, 0.0)]
    assert explain.shap_values(rows.limit(0), lt, ["a", "b"], "x").count() == 0


def test_a_thousand_deep_trees(spark):
    """Attribution adds up for 1,000 random trees of depth 8, whose leaves fill many blocks."""
    rng = np.random.default_rng(4)
    depth, trees, n = 8, 1000, 40
    out = []
    for t in range(trees):
        cover = {0: 4096.0}
        for node in range(2 ** (depth + 1) - 1):
            leaf = node >= 2 ** depth - 1
            if not leaf:
                left = max(1.0, float(int(cover[node] * rng.uniform(0.2, 0.8))))
                cover[2 * node + 1], cover[2 * node + 2] = left, max(1.0, cover[node] - left)
            out.append((t, node, float(rng.normal()) if leaf else 0.0, cover[node], 0.0, -1 if leaf else 2 * node + 1,
                        -1 if leaf else 2 * node + 2, -1 if leaf else int(rng.integers(0, 12)),
                        None if leaf else float(rng.normal()), 0.01))
    columns = ["treeID", "node", "prediction", "cover", "gain", "left", "right", "feature_index", "threshold", "tree_weight"]
    import pandas as pd
    nodes = spark.createDataFrame(pd.DataFrame(out, columns=columns))
    x = rng.normal(size=(n, 12))
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "SK_ID_CURR long, x array<double>")
    lt = explain.leaf_table(nodes)
    total = explain.shap_values(rows, lt, [str(i) for i in range(12)], "x").groupBy("SK_ID_CURR").agg(F.sum("shap").alias("s"))
    margin = stages.tree_stages(nodes)(x)[:, -1]
    got = {r["SK_ID_CURR"]: r["s"] + lt.base for r in total.collect()}
    # covers are cut to whole rows, so children need not sum to their parent: compare the change between rows
    shift = got[0] - margin[0]
    assert max(abs(got[i] - margin[i] - shift) for i in range(n)) < 1e-6


def test_best_round_patience():
    losses = [5, 4, 3, 3.5, 3.6, 3.7, 2.0]
    assert stages.best_round(losses, patience=3) == 3      # stops at round 6, best is round 3
    assert stages.best_round(losses, patience=10) == 7     # never stops: overall best
    assert stages.best_round([1.0], patience=50) == 1


def test_search_with_early_stopping(spark, small_model):
    df, _, _, _ = small_model
    folded = df.withColumn("fold", (F.col("SK_ID_CURR") % 3).cast("int"))
    res = train.search(folded, 1.0, n_trials=2, n_folds=3, space=small_space(8, 12), parallelism=2, patience=2)
    rows = res.trials.collect()
    assert len(rows) == 6 and all(r["auc_roc"] is not None for r in rows)
    assert all(1 <= r["best_iteration"] <= 12 for r in rows)
    drawn = {i: p["n_estimators"] for i, p in enumerate(train.sample_trials(2, space=small_space(8, 12)))}
    assert all(r["n_trees"] == drawn[r["trial"]] for r in rows)  # what is reported is what was grown
    assert res.summary.count() == 2 and 0.5 < res.best_value <= 1.0


def test_search_independent_of_thread_scheduling(spark, small_model):
    df, _, _, _ = small_model
    folded = df.withColumn("fold", (F.col("SK_ID_CURR") % 2).cast("int"))
    a = train.search(folded, 1.0, n_trials=2, n_folds=2, space=small_space(3, 6), parallelism=1)
    b = train.search(folded, 1.0, n_trials=2, n_folds=2, space=small_space(3, 6), parallelism=2)
    assert sorted(a.trials.collect()) == sorted(b.trials.collect())
    assert a.best_params == b.best_params and a.best_value == b.best_value


def test_search_resumes_from_its_trial_table(spark, small_model, monkeypatch):
    """A search that lost its driver fits only what is missing, with the same result; other data is fitted anew."""
    df, _, _, _ = small_model
    folded = df.withColumn("fold", (F.col("SK_ID_CURR") % 2).cast("int"))
    path = scratch_path(spark, f"tests/fits-{id(df)}")
    fits, keep = [], train._fold_score

    def counted(*args):
        if len(fits) == 3:
            raise KeyboardInterrupt  # the driver goes in the fourth fit
        fits.append(args)
        return keep(*args)
    run = dict(n_trials=2, n_folds=2, space=small_space(3, 6), parallelism=1, trial_path=path)
    monkeypatch.setattr(train, "_fold_score", counted)
    with pytest.raises(KeyboardInterrupt):
        train.search(folded, 1.0, **run)
    monkeypatch.setattr(train, "_fold_score", lambda *a: fits.append(a) or keep(*a))
    resumed = train.search(folded, 1.0, **run)
    assert len(fits) == 4
    again = train.search(folded, 1.0, **run)
    assert len(fits) == 4 and sorted(again.trials.collect()) == sorted(resumed.trials.collect())
    fresh = train.search(folded, 1.0, n_trials=2, n_folds=2, space=small_space(3, 6), parallelism=1)
    assert sorted(fresh.trials.collect()) == sorted(resumed.trials.collect())
    train.search(folded.where("SK_ID_CURR < 400"), 1.0, **run)
    assert len(fits) == 4 + 4 + 4


def test_stopping_watches_auc(spark, small_model):
    """The fold's score is the best AUC over the rounds that patience allows, not the round of least loss."""
    df, _, _, _ = small_model
    folded = df.withColumn("fold", (F.col("SK_ID_CURR") % 2).cast("int"))
    params = {"n_estimators": 12, "max_depth": 3, "learning_rate": 0.3}
    auc, kept, grown = train._fold_score(folded, params, 1.0, 0, "features", "TARGET", "fold", 42, "rounds", 2)
    model = train.train_gbt(folded.where("fold <> 0"), params, 1.0)
    held = folded.where("fold = 0").toPandas()
    margins = stages.tree_stages(train.tree_nodes(spark, train.save_model(spark, model, "tests/stop")))(
        np.vstack(held["features"].map(lambda v: v.toArray())))
    pos, neg = margins[held["TARGET"] == 1], margins[held["TARGET"] == 0]
    every = [float(((pos[:, None, i] > neg[None, :, i]) + 0.5 * (pos[:, None, i] == neg[None, :, i])).mean()) for i in range(12)]
    assert kept == stages.best_round([-a for a in every], 2) and grown == 12
    assert auc == pytest.approx(every[kept - 1], abs=1e-9)
