"""Plan-shape checks for the scale properties, and remaining edge cases."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF01
from riskspark.functions.formatting import report_round
from riskspark.operators import metrics, monitor, quality
from riskspark.operators.marts import build_features
from riskspark.operators.split import stratified_split
from riskspark.sources.fixtures import Tables


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def static_plans(spark):
    """Plans as the optimizer writes them, before run-time (AQE) changes."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def test_features_scan_lineitem_once(spark, static_plans):
    plan = _plan(build_features(Tables(spark, SF01)))
    assert plan.count("lineitem.parquet") == 1
    assert plan.count("orders.parquet") == 1
    # orders, lineitem, the orders' roll-up, customer and the events' roll-up
    assert plan.count("Exchange hashpartitioning") <= 5
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_features_prune_columns(spark, static_plans):
    plan = _plan(build_features(Tables(spark, SF01)))
    assert "l_comment" not in plan and "l_partkey" not in plan and "props" not in plan


def test_split_has_no_single_task_exchange(spark, static_plans):
    s = stratified_split(build_features(Tables(spark, SF01)))
    assert "SinglePartition" not in _plan(s)


def test_quality_reports_one_pass_codegen(spark, static_plans):
    f = build_features(Tables(spark, SF01))
    plan = _plan(quality.missingness(f))
    assert "WholeStageCodegen" in plan or "*(" in plan
    assert "PythonUDF" not in plan and "ArrowEvalPython" not in plan


def test_psi_lo_equals_hi_last_bin(spark):
    e = spark.createDataFrame([(500.0,)] * 10, "score double")
    a = spark.createDataFrame([(500.0,)] * 4, "score double")
    t = monitor.psi_table(e, a).orderBy("bin").toPandas()
    bins = np.linspace(500.0, 500.0, 11)
    ref, _ = np.histogram(np.full(10, 500.0), bins=bins)
    assert list((t.expected_pct > 1).astype(int)) == list((ref > 0).astype(int))
    assert monitor.psi_summary(monitor.psi_table(e, a)).first()["psi_total"] == pytest.approx(0.0)


def test_report_rounding_is_numpys(spark):
    xs = [0.5, 1.5, 2.5, -2.5, 2.675, 0.125, 1.005, -0.0000001]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    got0 = [r[0] for r in df.select(report_round("x", 0)).collect()]
    got2 = [r[0] for r in df.select(report_round("x", 2)).collect()]
    assert got0 == [float(np.round(x, 0)) + 0.0 for x in xs]
    assert got2 == [float(np.round(x, 2)) + 0.0 for x in xs]
    assert all(str(v) != "-0.0" for v in got0 + got2)


def test_empty_frames(spark):
    empty = spark.createDataFrame([], "SK_ID_CURR long, TARGET int, p double, score int")
    r = metrics.ranking_metrics(empty, "p").first()
    assert r["auc_roc"] is None
    assert monitor.decile_table(empty).count() == 0
    bands = monitor.band_distribution(empty.withColumn("risk_band", F.lit("x"))).collect()
    assert len(bands) == 6 and all(b["count"] == 0 for b in bands)
    m = {row["column_name"]: row["n_missing"] for row in quality.missingness(empty).collect()}
    assert m == {"SK_ID_CURR": 0, "TARGET": 0, "p": 0, "score": 0}
    assert monitor.psi_table(empty, empty, "score").count() == 0


def test_missingness_from_file_statistics(spark):
    """Null counts come from the footers; NaN, which footers do not tell, is counted exactly."""
    import tempfile
    path = f"{tempfile.mkdtemp(prefix='riskspark-test-')}/t"
    df = spark.createDataFrame([(i, None if i % 4 == 0 else float("nan") if i % 5 == 0 else 1.0, "x" if i % 2 else None, None)
                                for i in range(100)], "k long, `a.b` double, s string, e int").repartition(3)
    df.write.parquet(path)
    got = {r["column_name"]: (r["n_missing"], r["pct_missing"]) for r in quality.missingness_of_table(spark, path).collect()}
    assert got == {"k": (0, 0.0), "a.b": (40, 40.0), "s": (50, 50.0), "e": (100, 100.0)}
    old = {k: spark.conf.get(k) for k in quality._STATISTICS}
    try:
        for k, v in quality._STATISTICS.items():
            spark.conf.set(k, v)
        plan = _plan(quality.footer_counts(spark, path))
        assert "PushedAggregation: [COUNT(*), COUNT(k)" in plan and "ReadSchema: struct<count(*)" in plan
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
