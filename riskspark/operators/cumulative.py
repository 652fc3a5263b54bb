"""Ordered running totals without a one-task window.

``Window.orderBy(v)`` with no partition pulls every row into one task.  Here
the distinct values of each group are cut into value buckets at approximate
quantiles; bucket totals (a tiny frame) give each bucket its offset, and the
running sum inside a bucket is a window partitioned by (group, bucket).  The
result is exact whatever the edge quality: edges only decide the balance.

Edges are computed once and used as data from then on, so a recompute after
executor loss assigns every row the same bucket (trap T7).  Grouped edges are a
written table, broadcast up to ``MAX_GROUPS`` groups and shuffled beyond.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize

# Upper bound on buckets per group: keeps the edge table (broadcast) small.
MAX_BUCKETS = 4096
# Groups whose edges and offsets are broadcast, at most.
MAX_GROUPS = 100_000


def default_buckets(spark) -> int:
    """About two buckets per shuffle partition, at least 16."""
    n = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    return max(16, min(MAX_BUCKETS, 2 * n))


def _bucket_index(edges: F.Column, value: F.Column, n_edges_max: int) -> F.Column:
    """Number of edges strictly below ``value`` by binary search (edges sorted).

    A fold over log2(k) steps keeps it O(log k) per row and a small
    expression; the predicate ``edge < value`` is monotone over sorted edges.
    """
    steps = []
    s = 1
    while s <= n_edges_max:
        s *= 2
    s //= 2
    while s >= 1:
        steps.append(s)
        s //= 2
    if not steps:
        return F.lit(0)
    step_arr = F.array(*[F.lit(x) for x in steps])
    return F.aggregate(
        step_arr, F.lit(0),
        lambda acc, st: F.when(
            ((acc + st) <= F.size(edges)) & (F.element_at(edges, acc + st) < value), acc + st
        ).otherwise(acc),
    )


def running_totals(df: DataFrame, value: str, measures: Sequence[str],
                   by: Sequence[str] = (), buckets: int | None = None,
                   pregrouped: bool = False) -> DataFrame:
    """Per (by, distinct value): the measures, their ascending inclusive
    running sums ``cum_<m>`` and the group totals ``total_<m>``.

    Rows with a null ``value`` are left out.
    """
    spark = df.sparkSession
    by = list(by)
    measures = list(measures)
    k = buckets or default_buckets(spark)
    if pregrouped:
        g = df.where(F.col(value).isNotNull())
    else:
        g = (df.where(F.col(value).isNotNull())
             .groupBy(*by, value).agg(*[F.sum(m).alias(m) for m in measures]))
    # the grouped frame is read twice (edges, then sums): checkpoint it once so
    # the input plan runs a single time and a lost executor re-reads files
    g = materialize(g)

    # 1. bucket edges per group, computed once and held as data
    probs = [i / k for i in range(1, k)]
    cut = F.percentile_approx(F.col(value).cast("double"), probs, 10 * k) if probs else F.array().cast("array<double>")
    few = F.broadcast
    if by:
        edges = materialize(g.groupBy(*by).agg(cut.alias("__edges") if probs else F.first(cut).alias("__edges")))
        if edges.count() > MAX_GROUPS:
            few = lambda df: df
        gb = g.join(few(edges), by, "left")
        edges_col = F.coalesce(F.col("__edges"), F.array().cast("array<double>"))
    else:
        row = g.agg(cut.alias("__edges")).first() if probs else None
        lit_edges = list(row["__edges"]) if row and row["__edges"] else []
        gb = g
        edges_col = F.array(*[F.lit(float(e)) for e in lit_edges]) if lit_edges \
            else F.array().cast("array<double>")
    gb = gb.withColumn("__bucket", _bucket_index(edges_col, F.col(value).cast("double"), max(k - 1, 0)))
    if by:
        gb = gb.drop("__edges")

    # 2. bucket totals -> exclusive offsets and group totals (groups x k rows)
    bt = gb.groupBy(*by, "__bucket").agg(*[F.sum(m).alias(f"__b_{m}") for m in measures])
    wb = Window.partitionBy(*by).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    wt = Window.partitionBy(*by)
    offsets = bt.select(
        *by, "__bucket",
        *[F.coalesce(F.sum(f"__b_{m}").over(wb), F.lit(0)).alias(f"__off_{m}") for m in measures],
        *[F.sum(f"__b_{m}").over(wt).alias(f"total_{m}") for m in measures],
    )
    # at most groups x buckets rows
    gb = gb.join(few(offsets), [*by, "__bucket"], "left")

    # 3. running sum inside each bucket plus the bucket's offset
    w = (Window.partitionBy(*by, "__bucket").orderBy(value)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    out = gb.select(
        *by, value, *measures,
        *[(F.col(f"__off_{m}") + F.sum(m).over(w)).alias(f"cum_{m}") for m in measures],
        *[F.col(f"total_{m}") for m in measures],
    )
    return out


QUANTILE_ACCURACY = 10_000
_NEG_INF = float("-inf")


def _lerp(q, n, v_lo, v_hi) -> F.Column:
    """numpy's linear interpolation between the order statistics around q*(n-1)."""
    pos = q * (n - 1)
    t = pos - F.floor(pos)
    a = v_lo.cast("double")
    b = v_hi.cast("double")
    # numpy's lerp: a + t*(b-a), or b - (b-a)*(1-t) when t >= 0.5
    val = F.when(t >= 0.5, b - (b - a) * (F.lit(1.0) - t)).otherwise(a + (b - a) * t)
    return F.when(a == b, a).otherwise(val)


def exact_quantiles(df: DataFrame, value: str, probs: Sequence[float],
                    by: Sequence[str] = ()) -> DataFrame:
    """Exact quantiles with linear interpolation (numpy's default), distributed.

    Only a thin slice of each group is ranked exactly:

    1. one pass: row count and approximate quantiles just below and above each
       target (``percentile_approx``, rank error at most n / accuracy) - one
       row per group, to the driver;
    2. rows below the lower bracket collapse into one ``-inf`` value per
       (group, q) by map-side aggregation; rows above the upper bracket are
       dropped; running totals over what is left give exact global ranks;
    3. a bracket whose exact ranks do not cover the target falls back to the
       full distinct-value ranking, so the answer is always exact.

    Output: one row per (by, q) with column ``quantile``.
    """
    spark = df.sparkSession
    by = list(by)
    probs = [float(q) for q in probs]
    base = df.select(*by, F.col(value).cast("double").alias("__v")).where(F.col("__v").isNotNull())
    eps = 3.0 / QUANTILE_ACCURACY
    lo_p = [max(0.0, q - eps) for q in probs]
    hi_p = [min(1.0, q + eps) for q in probs]
    st = (base.groupBy(*by)
          .agg(F.count(F.lit(1)).alias("__n"),
               F.percentile_approx("__v", lo_p, QUANTILE_ACCURACY).alias("__lo"),
               F.percentile_approx("__v", hi_p, QUANTILE_ACCURACY).alias("__hi"))
          .limit(MAX_GROUPS + 1).collect())
    if len(st) > MAX_GROUPS:  # too many brackets for the driver
        return _exact_quantiles_full(df, value, probs, by)
    key_fields = [base.schema[b] for b in by]
    rows = [(*[r[b] for b in by], qi, q, int(r["__n"]), float(r["__lo"][qi]), float(r["__hi"][qi]))
            for r in st for qi, q in enumerate(probs)]
    schema = T.StructType(key_fields + [T.StructField("__qi", T.IntegerType()),
                                        T.StructField("__q", T.DoubleType()),
                                        T.StructField("__n", T.LongType()),
                                        T.StructField("__blo", T.DoubleType()),
                                        T.StructField("__bhi", T.DoubleType())])
    brackets = spark.createDataFrame(rows, schema)
    if not rows:
        return spark.createDataFrame([], T.StructType(key_fields + [
            T.StructField("q", T.DoubleType()), T.StructField("quantile", T.DoubleType())]))
    # groups x probs rows: bounded by the checks above (an ungrouped input
    # joins on a constant key, still an equi-join)
    if by:
        j = base.join(F.broadcast(brackets), by, "inner")
    else:
        j = base.withColumn("__k", F.lit(0)).join(
            F.broadcast(brackets.withColumn("__k", F.lit(0))), "__k").drop("__k")
    sliced = (j.where(F.col("__v") <= F.col("__bhi"))
              .select(*by, "__qi",
                      F.when(F.col("__v") < F.col("__blo"), F.lit(_NEG_INF)).otherwise(F.col("__v"))
                      .alias("__v"),
                      F.lit(1).cast("long").alias("__c")))
    rt = running_totals(sliced, "__v", ["__c"], [*by, "__qi"])
    rt = rt.join(F.broadcast(brackets.select(*by, "__qi", "__q", "__n")), [*by, "__qi"])
    pos = F.col("__q") * (F.col("__n") - 1)
    i_lo, i_hi = F.floor(pos), F.ceil(pos)
    lo_idx = F.col("cum___c") - F.col("__c")
    hi_idx = F.col("cum___c") - 1
    real = F.col("__v") != F.lit(_NEG_INF)
    agg = rt.groupBy(*by, "__qi", "__q", "__n").agg(
        F.max(F.when(real & (i_lo >= lo_idx) & (i_lo <= hi_idx), F.col("__v"))).alias("v_lo"),
        F.max(F.when(real & (i_hi >= lo_idx) & (i_hi <= hi_idx), F.col("__v"))).alias("v_hi"))
    agg = agg.select(*by, F.col("__q").alias("q"), F.col("__n").alias("n"), "v_lo", "v_hi")
    got = agg.collect()  # groups x probs rows
    if len(got) < len(rows) or any(r["v_lo"] is None or r["v_hi"] is None for r in got):
        return _exact_quantiles_full(df, value, probs, by)
    out = spark.createDataFrame([tuple(r) for r in got], agg.schema)
    return out.select(*by, "q", _lerp(F.col("q"), F.col("n"), F.col("v_lo"), F.col("v_hi")).alias("quantile"))


def _exact_quantiles_full(df: DataFrame, value: str, probs: Sequence[float],
                          by: Sequence[str] = ()) -> DataFrame:
    """Exact quantiles over all distinct values (the fallback of
    ``exact_quantiles``): value counts + running totals locate the order
    statistics around ``q * (n - 1)``; no group is collected into one task."""
    by = list(by)
    base = df.select(*by, F.col(value).alias("__v"), F.lit(1).cast("long").alias("__c"))
    rt = running_totals(base, "__v", ["__c"], by)
    probs_arr = F.array(*[F.lit(float(q)) for q in probs])
    n = F.col("total___c")
    hi_idx = F.col("cum___c") - 1
    lo_idx = F.col("cum___c") - F.col("__c")
    # each row covers order statistics [lo_idx, hi_idx]; emit the wanted ones
    wanted = F.filter(
        F.transform(probs_arr, lambda q, i: F.struct(
            i.alias("qi"), q.alias("q"),
            F.floor(q * (n - 1)).alias("i_lo"), F.ceil(q * (n - 1)).alias("i_hi"))),
        lambda s: ((s["i_lo"] >= lo_idx) & (s["i_lo"] <= hi_idx))
        | ((s["i_hi"] >= lo_idx) & (s["i_hi"] <= hi_idx)))
    ex = rt.select(*by, "__v", lo_idx.alias("lo_idx"), hi_idx.alias("hi_idx"), n.alias("n"),
                   F.explode(wanted).alias("w"))
    ex = ex.select(
        *by, "n", F.col("w.qi").alias("qi"), F.col("w.q").alias("q"),
        F.when((F.col("w.i_lo") >= F.col("lo_idx")) & (F.col("w.i_lo") <= F.col("hi_idx")),
               F.col("__v")).alias("v_lo"),
        F.when((F.col("w.i_hi") >= F.col("lo_idx")) & (F.col("w.i_hi") <= F.col("hi_idx")),
               F.col("__v")).alias("v_hi"),
    )
    agg = ex.groupBy(*by, "qi", "q", "n").agg(F.max("v_lo").alias("v_lo"), F.max("v_hi").alias("v_hi"))
    pos = F.col("q") * (F.col("n") - 1)
    t = pos - F.floor(pos)
    a = F.col("v_lo").cast("double")
    b = F.col("v_hi").cast("double")
    # numpy's lerp: a + t*(b-a), or b - (b-a)*(1-t) when t >= 0.5
    val = F.when(t >= 0.5, b - (b - a) * (F.lit(1.0) - t)).otherwise(a + (b - a) * t)
    return agg.select(*by, "q", F.when(a == b, a).otherwise(val).alias("quantile"))
