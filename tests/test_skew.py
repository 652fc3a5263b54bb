"""A hot order key (a third of all lines) is joined by broadcast under default
settings, and the features are those of a plain join, adaptive or not."""

import datetime as dt
import os
import tempfile

import pandas as pd
import pytest

from riskspark.operators.marts import build_features
from riskspark.sources.fixtures import Tables


@pytest.fixture(scope="module")
def skewed_dir(spark):
    d = tempfile.mkdtemp(prefix="riskspark-skew-")
    n_orders, n_cust = 400, 40
    base = dt.datetime(2000, 1, 1)
    orders = pd.DataFrame({
        "o_orderkey": range(n_orders), "o_custkey": [i % n_cust for i in range(n_orders)],
        "o_orderstatus": ["F", "O", "P", "F"] * (n_orders // 4),
        "o_totalprice": [100.0 + i for i in range(n_orders)],
        "o_orderdate": [base + dt.timedelta(days=i % 90) for i in range(n_orders)],
        "o_orderpriority": ["1-URGENT", "2-HIGH"] * (n_orders // 2)})
    rows = []
    for i in range(6000):
        key = 7 if i % 3 == 0 else (i % n_orders)      # order 7 holds a third of all lines
        rows.append((key, "R" if i % 5 == 0 else "N", base + dt.timedelta(days=i % 120),
                     (i % 11) / 100, (i % 9) / 100, 10.0 + i % 50))
    lineitem = pd.DataFrame(rows, columns=["l_orderkey", "l_returnflag", "l_shipdate", "l_discount",
                                           "l_tax", "l_extendedprice"])
    customer = pd.DataFrame({"c_custkey": range(n_cust), "c_nationkey": [i % 5 for i in range(n_cust)],
                             "c_acctbal": [float(i - 10) for i in range(n_cust)],
                             "c_mktsegment": ["A", "B"] * (n_cust // 2)})
    nation = pd.DataFrame({"n_nationkey": range(5), "n_name": [f"N{i}" for i in range(5)]})
    events = pd.DataFrame({"user_id": [1, 2, 2], "event_type": ["error", "view", "error"],
                           "value": [1.5, 2.25, 3.0], "ts": [dt.datetime(2024, 1, d) for d in (3, 4, 5)]})
    for name, pdf in (("orders", orders), ("lineitem", lineitem), ("customer", customer),
                      ("nation", nation), ("events", events)):
        spark.createDataFrame(pdf).write.mode("overwrite").parquet(os.path.join(d, f"{name}.parquet"))
    return d


def test_hot_order_under_default_settings(spark, skewed_dir):
    """No flag is set: the hot order is found, its lines are joined by broadcast, the
    shuffled lines hold no hot key, and the features are those of a plain join."""
    from riskspark.operators import joins, marts
    t = Tables(spark, skewed_dir)
    assert joins.hot_keys(t.lineitem, "l_orderkey") == [7]
    f = build_features(t)
    plan = f._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" in plan and "NOT (l_orderkey" in plan
    got = sorted(f.collect())
    hot = [r for r in got if r["SK_ID_CURR"] == 7][0]
    assert hot["BURO_N_LINES"] >= 2000
    old, adaptive = marts.hot_keys, spark.conf.get("spark.sql.adaptive.enabled")
    marts.hot_keys = lambda df, key: []
    try:
        for on in ("true", "false"):
            spark.conf.set("spark.sql.adaptive.enabled", on)
            assert sorted(build_features(t).collect()) == got
    finally:
        marts.hot_keys = old
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)


def test_no_hot_key_in_an_even_table(spark):
    from riskspark.operators import joins
    even = spark.range(20_000).selectExpr("id % 5000 AS k")
    assert joins.hot_keys(even, "k") == []
    assert joins.hot_keys(even.limit(0), "k") == []
    two = even.unionByName(spark.range(9_000).selectExpr("CAST(-1 - id % 2 AS BIGINT) AS k")).unionByName(
        spark.range(9_000).selectExpr("CAST(NULL AS BIGINT) AS k"))
    assert joins.hot_keys(two, "k") == [-2, -1]
