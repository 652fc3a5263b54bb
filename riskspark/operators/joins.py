"""Join helpers: broadcast only a side whose row count is proven small, and find
the keys that hold too much of a table to be joined in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows a broadcast side may hold.  Parameter tables (encoder maps, bin grids,
# bucket offsets) are far below this; anything larger takes a shuffle join.
BROADCAST_MAX_ROWS = 2_000_000
#: Keys the sketch of ``hot_keys`` follows; a hot key is far above its error.
HOT_SKETCH = 10_000
#: Rows below which no key is worth a plan of its own.
HOT_ROWS = 1_000


def broadcast_checked(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Hint a broadcast only when the side is proven small.

    The proof is a ``count``, which every task takes over its own rows (a
    ``limit`` would gather them in one).  Above the bound the frame is returned unhinted and the
    planner shuffles (AQE may still switch at run time from real sizes).
    """
    n = df.count()
    return F.broadcast(df) if n <= max_rows else df


def hot_keys(df: DataFrame, key: str) -> list:
    """Keys that hold more than half of a shuffle partition's even share of ``df``:
    at most twice as many keys as there are partitions.  One pass over the key
    column; tasks send sketches of a fixed size, so the result decides how a join
    is planned, never what it returns."""
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    top = F.expr(f"approx_top_k(`{key}`, {min(2 * parts, HOT_SKETCH // 10)}, {HOT_SKETCH})")
    r = df.where(F.col(key).isNotNull()).agg(F.count(F.lit(1)).alias("n"), top.alias("top")).first()
    least = max(HOT_ROWS, r["n"] / (2 * parts))
    return sorted(t["item"] for t in (r["top"] or []) if t["count"] >= least)
