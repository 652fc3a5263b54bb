"""End-to-end workflow at sf0.001 and stateless scoring of a file stream."""

import os
import tempfile

from pyspark.sql import functions as F

from conftest import SF001
from riskspark import constants as K
from riskspark.operators import train
from riskspark.operators.encode import assemble, fit_preprocessor, identify_column_types
from riskspark.plans import dashboard, workflow
from riskspark.plans.modeling import Budget
from riskspark.plans.scoring import split_features
from riskspark.sources import io
from riskspark.sources.fixtures import LEAK_COLUMNS, Tables
from riskspark.streaming.scoring import score_stream


def small_space(lo: int, hi: int) -> tuple:
    """The library's ranges with few trees per model."""
    return tuple(("n_estimators", lo, hi, False, True) if s[0] == "n_estimators" else s for s in train.SEARCH_SPACE)


def test_workflow_writes_every_stage(spark):
    out = tempfile.mkdtemp(prefix="riskspark-wf-")
    res = workflow.run(spark, SF001, out, Budget(n_trials=2, n_folds=3, space=small_space(5, 10)))
    for sub in ("features", "split_features", "encoded", "scores/gbt", "shap/values", "reports/psi_bins",
                "reports/deciles", "reports/leakage_audit", "models/gbt", "model_metrics"):
        assert os.path.exists(os.path.join(out, sub)), sub
    assert ("gbt", "auc_roc") in res["metrics"] and ("logistic_regression", "gini") in res["metrics"]
    assert res["psi_verdict"] in K.PSI_VERDICTS
    feats = spark.read.parquet(os.path.join(out, "features"))
    assert feats.count() == Tables(spark, SF001).customer.count()
    m = io.read_metrics(spark, os.path.join(out, "model_metrics"))
    assert m.where("metric = 'best_cv_auc'").count() == 1
    flagged = [r["column_name"] for r in
               spark.read.parquet(os.path.join(out, "reports/leakage_audit")).where("suspicious").collect()]
    assert flagged == ["c_acctbal"]
    shap = spark.read.parquet(os.path.join(out, "shap/values"))
    scores = spark.read.parquet(os.path.join(out, "scores/gbt"))
    cards_in = scores.where("split = 'test'").select(K.KEY, "score", "risk_band", "probability")
    card_frame = cards_in.withColumn("outcome", F.lit("x"))
    some = shap.select(K.KEY).first()[0]
    view = dashboard.applicant_view(card_frame, shap, res["shap_base"], some)
    assert view["card"].count() == 1 and view["waterfall"].count() == K.WATERFALL_DASHBOARD
    assert view["status"].first()["status"] == "ok"
    unknown = dashboard.applicant_view(card_frame, shap, res["shap_base"], -5)
    assert unknown["card"].count() == 0 and unknown["waterfall"].count() == 0
    assert unknown["status"].first()["status"] == "not_found"
    # a lookup on the key-sorted score table reads only files whose range holds the key
    plan = scores.where(F.col(K.KEY) == some)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(SK_ID_CURR), EqualTo(SK_ID_CURR," in plan


def test_stream_scoring_equals_batch(spark):
    t = Tables(spark, SF001)
    f = split_features(t).drop(*LEAK_COLUMNS)
    groups = identify_column_types(f, exclude=(K.KEY, K.LABEL, "split", "fold"))
    pre = fit_preprocessor(f.where(F.col("split") == "train"), groups)
    enc = assemble(pre.transform(f), pre.feature_names())
    model = train.train_baseline(enc.where(F.col("split") == "train"), max_iter=50)

    src = tempfile.mkdtemp(prefix="riskspark-stream-")
    new = f.where(F.col("split") == "test").drop("split", "fold", K.LABEL)
    new.write.mode("overwrite").parquet(os.path.join(src, "in"))
    stream = spark.readStream.schema(new.schema).parquet(os.path.join(src, "in"))
    q = (score_stream(stream, pre, model).writeStream.format("memory").queryName("scored_stream")
         .option("checkpointLocation", os.path.join(src, "ckpt")).outputMode("append").start())
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    got = {r[K.KEY]: (r["score"], r["risk_band"]) for r in spark.table("scored_stream").collect()}
    batch = score_stream(new, pre, model)
    ref = {r[K.KEY]: (r["score"], r["risk_band"]) for r in batch.collect()}
    assert got == ref and len(got) == new.count()


def test_portfolio_report(spark):
    from riskspark.plans.scoring import formula_scores
    s = formula_scores(Tables(spark, SF001))
    m = spark.createDataFrame([("gbt", "auc_roc", 0.7), ("lr", "auc_roc", 0.6)], io.METRICS_SCHEMA)
    imp = spark.createDataFrame([(f"f{i}", i, float(i)) for i in range(20)],
                                "feature string, split_count long, total_gain double")
    rep = dashboard.portfolio_report(s, m, imp)
    assert rep["histogram"].count() == 2 * K.HIST_BINS
    assert rep["importance"].count() == K.TOP_FEATURES_DASHBOARD
    assert rep["psi"].first()["verdict"] in K.PSI_VERDICTS
    assert set(rep["comparison"].columns) == {"metric", "gbt", "lr"}
