"""Cases that once crashed or gave wrong results."""

import pytest
from conftest import SF001
from pyspark.sql import functions as F

from riskspark import constants as K
from riskspark import session
from riskspark.operators import explain, monitor
from riskspark.operators.encode import ColumnGroups, fit_preprocessor
from riskspark.plans import queries
from riskspark.plans.scoring import formula_scores, split_assignment
from riskspark.sources.fixtures import Tables


def test_nan_is_a_missing_number(spark):
    rows = [(i, i % 2, "train", i % 5, float("nan") if i == 3 else float(i)) for i in range(40)]
    df = spark.createDataFrame(rows, f"{K.KEY} long, {K.LABEL} int, split string, fold int, x double")
    pre = fit_preprocessor(df, ColumnGroups(["x"], [], []))
    out = [r["x"] for r in pre.transform(df).collect()]
    values = sorted(float(i) for i in range(40) if i != 3)
    assert pre.medians["x"] == values[19]
    assert all(v is not None and v == v for v in out)
    assert abs(pre.scales["x"] - 1.0) > 1


def test_histogram_with_a_null_group(spark):
    df = spark.createDataFrame([(float(i), ["train", "test", None][i % 3]) for i in range(90)], "score double, split string")
    for joint in (False, True):
        got = monitor.histogram(df, "score", "split", 10, joint=joint).collect()
        assert {r["split"] for r in got} == {"train", "test", None}
        for group in ("train", "test", None):
            assert sum(r["count"] for r in got if r["split"] == group) == 30


@pytest.mark.parametrize("n, rows", [(2, 2), (3, 3), (4, 3), (7, 3)])
def test_waterfall_folds_only_beyond_k(spark, n, rows):
    df = spark.createDataFrame([(1, f"f{i}", float(i), float(i + 1)) for i in range(n)],
                               f"{K.KEY} long, feature string, value double, shap double")
    got = explain.waterfall(df, 0.5, k=3).orderBy("rank").collect()
    assert len(got) == rows
    assert (got[-1]["feature"] == f"{n - 2} other features") == (n > 3)
    assert all(abs(r["output_margin"] - 0.5 - n * (n + 1) / 2) < 1e-9 for r in got)


def _files(df):
    plan = df._jdf.queryExecution().optimizedPlan().toString() + str(df.inputFiles())
    return {t for t in session.TABLES if f"/{t}.parquet" in plan}


def test_split_reports_read_the_label_alone(spark):
    assert _files(split_assignment(Tables(spark, SF001))) == {"customer"}
    assert _files(queries.q_class_balance(spark, SF001)) == {"customer"}


def test_scores_do_not_read_lines(spark, monkeypatch):
    seen = []
    monkeypatch.setattr("riskspark.plans.scoring.materialize", lambda df: seen.append(_files(df)) or df)
    formula_scores(Tables(spark, SF001))
    assert seen == [{"customer", "orders"}]
    assert _files(queries.q_mart_previous_app(spark, SF001)) == {"orders"}


def test_temporary_tables_are_dropped(spark):
    df = session.materialize(spark.range(5).withColumn("v", F.lit(1)))
    assert df.count() == 5 and session.drop_temporary(spark) >= 1
    assert session.drop_temporary(spark) == 0


def test_unset_checkpoint_folder_is_an_error_on_a_cluster():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default=None):
                return default
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())
