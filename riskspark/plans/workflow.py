"""End-to-end run over one folder of source tables, writing every artifact.

    python -m riskspark.plans.workflow --sf-dir /root/testdata/sf0.01 --out <shared folder>

Stages, each a Spark job reading the previous stage's written tables:

1. load      catalog summary of the sources (A1-A5)
2. features  marts + assembly + sentinel handling (D1-D5, C1, B4), quality
             reports (B5, D6, D7, F1), written as Parquet (A8)
3. prepare   leakage audit (I1), column routing (D8), stratified split and
             folds (E9, E10), encoders fit on train (I2-I7), encoded frames
             written partitioned by ``split``
4. train     baseline and boosted trees with the search (I8-I12), metrics
             document (A9), models (A10)
5. score     score tables partitioned by ``split`` (I13, H1, H2), deciles,
             summary, bands, histograms, PSI (D11-D17, E7, E8)
6. explain   sampled Tree SHAP (I16-I18), global and per-row attribution
             (D20, D21, F4-F6), split-count importance (I15, F2)

``out`` defaults to a folder under the session's checkpoint directory, which
a cluster points at shared storage.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as K
from ..operators import audit, explain, metrics, monitor, quality, train
from ..operators.encode import assemble, fit_preprocessor, identify_column_types
from ..operators.marts import build_features
from ..session import TABLES, drop_temporary, local_session, scratch_path
from ..sources import io
from ..sources.fixtures import LEAK_COLUMNS, Tables
from ..operators.split import stratified_split
from .modeling import Budget


def _write(df: DataFrame, out: str, name: str, partition_by=()) -> DataFrame:
    path = io.write_table(df, f"{out}/{name}", partition_by=partition_by)
    return df.sparkSession.read.parquet(path)


def run(spark: SparkSession, sf_dir: str, out: str | None = None, budget: Budget = Budget()) -> dict:
    out = (out or scratch_path(spark, "workflow")).rstrip("/")
    t = Tables(spark, sf_dir)
    summary: dict = {"out": out}

    # 1. load
    present = {n: getattr(t, n) for n in TABLES if io.path_exists(spark, f"{sf_dir}/{n}.parquet")}
    _write(io.catalog_summary(present), out, "reports/catalog_summary")

    # 2. features (the sentinel count needs the pre-replacement table)
    raw = build_features(t, replace_sentinel=False)
    _write(quality.sentinel_counts(raw), out, "reports/sentinel_counts")
    feat_path, n_features_rows = io.write_counted(quality.replace_sentinels(raw), f"{out}/features")
    feats = quality.prepared(spark.read.parquet(feat_path))
    summary["feature_rows"] = n_features_rows
    _write(quality.top_missing(feats), out, "reports/missingness")
    _write(quality.target_distribution(feats), out, "reports/target_distribution")

    # 3. prepare
    _write(audit.leakage_audit(feats), out, "reports/leakage_audit")
    model_frame = stratified_split(feats.drop(*LEAK_COLUMNS))
    model_frame = _write(model_frame, out, "split_features", partition_by=["split"])
    _write(metrics.class_balance(model_frame), out, "reports/class_balance")
    groups = identify_column_types(model_frame, exclude=(K.KEY, K.LABEL, "split", "fold"))
    pre = fit_preprocessor(model_frame.where(F.col("split") == "train"), groups, checkpoint=False)
    names = pre.feature_names()
    _write(pre.params_frame(spark), out, "encoders/numeric")
    pre.save(f"{out}/preprocessor")
    encoded = _write(assemble(pre.transform(model_frame), names)
                     .select(K.KEY, K.LABEL, "split", "fold", "features"),
                     out, "encoded", partition_by=["split"])
    tr = encoded.where(F.col("split") == "train")
    te_ = encoded.where(F.col("split") == "test")

    # 4. train
    ratio = train.ratio_of(tr)
    lr = train.train_baseline(tr)
    res = train.search(tr, ratio, budget.n_trials, budget.n_folds, parallelism=budget.parallelism,
                       space=budget.space, trial_path=f"{out}/search_fits")
    gbt = train.train_gbt(tr, res.best_params, ratio)
    paths = io.save_artifacts(spark, out, models={"baseline": lr, "gbt": gbt},
                              docs={"feature_names": names, "best_params": res.best_params,
                                    "scorecard": dict(monitor.DEFAULT_SCORECARD.as_rows())})
    _write(res.summary, out, "reports/search_trials")

    # 5. score
    scores = {}
    for name, model in (("logistic_regression", lr), ("gbt", gbt)):
        p = train.predict_proba(model, encoded)
        path = io.write_by_key(monitor.score_table(p, keep=[K.LABEL, "split"]), f"{out}/scores/{name}",
                               K.KEY, spark.sparkContext.defaultParallelism, partition_by=["split"])
        scores[name] = spark.read.parquet(path)
    test_scores = {m: s.where(F.col("split") == "test") for m, s in scores.items()}
    m_long = train.model_metrics(test_scores).unionByName(
        spark.createDataFrame([("gbt", "best_cv_auc", float(res.best_value))], io.METRICS_SCHEMA))
    io.write_metrics(m_long, f"{out}/model_metrics")
    s = scores["gbt"]
    test = s.where(F.col("split") == "test")
    _write(monitor.decile_table(test), out, "reports/deciles")
    _write(monitor.score_summary(s), out, "reports/score_summary")
    _write(monitor.band_distribution(test), out, "reports/bands")
    _write(monitor.histogram(s, "score", "split", K.HIST_BINS), out, "reports/histogram")
    psi = monitor.psi_by_split(s)
    _write(psi, out, "reports/psi_bins")
    psi_total = monitor.psi_summary(psi).first()

    # 6. explain
    lt = explain.leaf_table(train.tree_nodes(spark, paths["gbt"]))
    sample = explain.explanation_sample(te_)
    shap = _write(explain.shap_values(sample, lt, names), out, "shap/values")
    _write(explain.top_attribution(shap), out, "shap/global")
    _write(explain.attribution_spread(shap), out, "shap/spread")
    firsts = explain.first_per_class(sample).select(K.KEY)
    _write(explain.waterfall(shap.join(F.broadcast(firsts), K.KEY, "left_semi"), lt.base),
           out, "shap/waterfalls")
    _write(train.top_features(train.split_importance(spark, paths["gbt"], names)), out,
           "reports/feature_importance")

    summary.update({
        "metrics": {(r["model"], r["metric"]): r["value"] for r in m_long.collect()},
        "psi": psi_total["psi_total"], "psi_verdict": psi_total["verdict"],
        "shap_base": lt.base, "n_features": len(names),
    })
    drop_temporary(spark)
    return summary


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("--sf-dir", required=True)
    ap.add_argument("--out", default=None)
    ap.add_argument("--trials", type=int, default=K.N_TRIALS)
    ap.add_argument("--folds", type=int, default=K.N_FOLDS)
    a = ap.parse_args(argv)
    spark = SparkSession.getActiveSession() or local_session()
    res = run(spark, a.sf_dir, a.out, Budget(a.trials, a.folds))
    res["metrics"] = {f"{m}.{k}": v for (m, k), v in res["metrics"].items()}
    print(json.dumps(res, default=str, indent=2))


if __name__ == "__main__":
    main()
