"""Exact quantiles by radix selection against numpy."""

import numpy as np
import pandas as pd
import pytest

from riskspark.operators import selection


def test_bits_order_like_the_values():
    v = np.array([-np.inf, -1e300, -2.5, -1.0, -5e-324, -0.0, 0.0, 5e-324, 1, 2.5, 1e300, np.inf])
    bits = selection.ordered_bits(v)
    assert (np.diff(bits)[[0, 1, 2, 3, 4, 6, 7, 8, 9, 10]] > 0).all() and bits[5] == bits[6]
    assert [selection.value_of(b) for b in bits] == [x + 0.0 for x in v.tolist()]


@pytest.mark.parametrize("parts", [1, 7])
def test_quantiles_are_numpys(spark, parts):
    rng = np.random.default_rng(9)
    n = 4_001
    pdf = pd.DataFrame({
        "normal": rng.normal(size=n), "tiny": rng.normal(size=n) * 1e-300, "close": 1.0 + np.arange(n) * 2.0 ** -52,
        "few": rng.integers(0, 3, n).astype(float), "one": np.full(n, -3.5), "heavy": np.exp(rng.normal(size=n) * 50),
        "signs": np.where(rng.random(n) < 0.5, -0.0, 0.0), "nan": np.where(rng.random(n) < 0.4, np.nan, rng.normal(size=n)),
        "empty": np.full(n, np.nan), "with.dot": rng.integers(-9, 9, n).astype(float), "two": np.where(np.arange(n) < 2, np.arange(n), np.nan)})
    df = spark.createDataFrame(pdf).repartition(parts)
    probs = [0.0, 0.1, 0.5, 0.75, 1.0]
    got = selection.column_quantiles(df, list(pdf.columns), probs)
    for c in pdf.columns:
        v = pdf[c].dropna().to_numpy()
        for q in probs:
            assert ((c, q) not in got) if not len(v) else (got[c, q] == pytest.approx(np.quantile(v, q), rel=1e-15, abs=0)), (c, q)


def test_many_columns_and_empty_frames(spark):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame(rng.normal(size=(300, 70)), columns=[f"c{i}" for i in range(70)])
    df = spark.createDataFrame(pdf)
    got = selection.column_quantiles(df, list(pdf.columns), [0.5])
    assert all(got[c, 0.5] == pytest.approx(pdf[c].median(), rel=1e-15) for c in pdf)
    assert selection.column_quantiles(df.limit(0), ["c0", "c1"], [0.5]) == {}
    assert selection.column_quantiles(df, [], [0.5]) == {}


def test_only_counts_are_shuffled(spark):
    """One exchange a round, above the counting; no row of the table is in it."""
    df = spark.range(1_000).selectExpr("CAST(id AS DOUBLE) AS a", "CAST(id % 3 AS DOUBLE) AS b")
    table = selection.digit_counts(df, [(0, 0), (1, 0)], 0)
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.index("Exchange") < plan.index("MapInArrow")
    assert "unpivot" not in plan.lower() and "Expand" not in plan
