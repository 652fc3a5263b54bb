"""Tree attribution for the boosted model.

Path-dependent Tree SHAP (Lundberg et al., 2018/2020) in a per-leaf form.  For a
leaf with value ``v`` whose path splits on m distinct features, feature j has an
interval ``(lo, hi]`` and a zero fraction ``r_j`` (product of child cover / parent
cover over its splits).  For a row, ``z_j = 1`` when x_j lies in the interval.  Then

  phi_i += v * (z_i - r_i) * sum_S |S|! (m-|S|-1)! / m! * prod_{j in S} z_j prod_{j not in S} r_j
         = v * (z_i - r_i) * integral over t in [0, 1] of prod_{j != i} (z_j t + r_j (1 - t)),

S over the subsets of the other features.  The integrand is a polynomial of
degree m - 1, which a Gauss rule of (m + 1) // 2 points integrates exactly, so a
row and leaf cost m * (m + 1) / 2 products.  The base value is the sum over
leaves of v * prod_j r_j.

Leaf paths come from a recursive query over the node table, as rows.  They are
dealt into blocks of one path length, the rows to explain into blocks of rows; a
task takes one of each and the blocks' contributions are added, so neither the
model nor the sample has to fit a task or the driver.
The explained margin is the log-odds ``2 * F`` of Spark's GBT (trap T6).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import constants as K
from ..session import materialize, ship_package
from .split import id_hash

#: Leaves and rows of one task.
LEAF_BLOCK = 4_096
ROW_BLOCK = 1_024
#: Numbers per array within a task: rows x leaves x path length at once.
CELLS = 1 << 20

_EDGES = """
SELECT p.treeID, p.node AS parent, c.node AS child, p.feature_index AS f,
       IF(c.node = p.left, CAST('-Infinity' AS DOUBLE), p.threshold) AS lo,
       IF(c.node = p.left, p.threshold, CAST('Infinity' AS DOUBLE)) AS hi,
       IF(p.cover > 0, c.cover / p.cover, 0D) AS r
FROM {nodes} p JOIN {nodes} c ON c.treeID = p.treeID AND c.node IN (p.left, p.right)
WHERE p.left >= 0"""

_WALK = """
WITH RECURSIVE walk(treeID, node, path) AS (
  SELECT treeID, node, CAST(array() AS ARRAY<STRUCT<f: INT, lo: DOUBLE, hi: DOUBLE, r: DOUBLE>>)
  FROM {nodes} n LEFT ANTI JOIN {edges} e ON e.treeID = n.treeID AND e.child = n.node
  UNION ALL
  SELECT e.treeID, e.child, concat(w.path, array(named_struct('f', e.f, 'lo', e.lo, 'hi', e.hi, 'r', e.r)))
  FROM walk w JOIN {edges} e ON e.treeID = w.treeID AND e.parent = w.node
)
SELECT w.treeID, w.node, {scale}D * n.tree_weight * n.prediction AS value,
       transform(array_sort(array_distinct(transform(w.path, s -> s.f))), f -> named_struct(
         'f', f,
         'lo', array_max(transform(filter(w.path, s -> s.f = f), s -> s.lo)),
         'hi', array_min(transform(filter(w.path, s -> s.f = f), s -> s.hi)),
         'r', aggregate(filter(w.path, s -> s.f = f), 1D, (a, s) -> a * s.r))) AS path
FROM walk w JOIN {nodes} n ON n.treeID = w.treeID AND n.node = w.node
WHERE n.left < 0"""


@dataclass
class LeafTable:
    """Leaves as rows (treeID, node, value, path of distinct features), and the base value."""
    leaves: DataFrame
    base: float


def leaf_paths(nodes: DataFrame, margin_scale: float = 2.0) -> DataFrame:
    """(treeID, node, value, path): every leaf of a node table (``train.tree_nodes``)
    with the interval and the zero fraction of each feature on its path."""
    spark = nodes.sparkSession
    cols = [F.col(c).cast(t).alias(c) for c, t in (
        ("treeID", "int"), ("node", "int"), ("left", "int"), ("right", "int"), ("feature_index", "int"),
        ("threshold", "double"), ("cover", "double"), ("prediction", "double"), ("tree_weight", "double"))]
    limit = "spark.sql.cteRecursionRowLimit"
    before = spark.conf.get(limit)
    names = {}
    try:
        spark.conf.set(limit, "-1")  # every node is one row of the recursion, however large the model
        for name, frame in (("nodes", lambda: materialize(nodes.select(*cols))),
                            ("edges", lambda: materialize(spark.sql(_EDGES.format(**names))))):
            view = f"riskspark_{name}_{id(nodes):x}"
            frame().createOrReplaceTempView(view)
            names[name] = view
        return materialize(spark.sql(_WALK.format(scale=float(margin_scale), **names)))
    finally:
        spark.conf.set(limit, before)
        for view in names.values():
            spark.catalog.dropTempView(view)


def leaf_table(nodes: DataFrame, margin_scale: float = 2.0) -> LeafTable:
    """``leaf_paths`` and the base value (I18): the margin's mean over the covers."""
    leaves = leaf_paths(nodes, margin_scale)
    zero = F.aggregate("path", F.lit(1.0), lambda a, s: a * s["r"])
    base = leaves.agg(F.sum(F.col("value") * zero).alias("base")).first()["base"]
    return LeafTable(leaves, float(base or 0.0))


def contributions(x: np.ndarray, feats: np.ndarray, lo: np.ndarray, hi: np.ndarray, r: np.ndarray,
                  value: np.ndarray, n_features: int) -> np.ndarray:
    """phi (rows x features) of leaves of one path length m; ``feats``, ``lo``,
    ``hi`` and ``r`` are (leaves, m)."""
    n, m = len(x), feats.shape[1]
    phi = np.zeros((n, n_features))
    points, weights = np.polynomial.legendre.leggauss((m + 1) // 2)
    points, weights = (points + 1) / 2, weights / 2
    step = max(1, CELLS // max(1, n * m))
    for at in range(0, len(value), step):
        f, rr = feats[at:at + step], r[at:at + step][None]
        z = (x[:, f] > lo[at:at + step]) & (x[:, f] <= hi[at:at + step])  # (rows, leaves, m)
        total = np.zeros(z.shape)
        for t, w in zip(points, weights):
            factor = z * t + rr * (1 - t)
            others, run = np.full(z.shape, w), np.ones(z.shape[:2])
            for j in range(m):  # product of the factors before j
                others[:, :, j] *= run
                run = run * factor[:, :, j]
            run = np.ones(z.shape[:2])
            for j in range(m - 1, -1, -1):  # and after it
                others[:, :, j] *= run
                run = run * factor[:, :, j]
            total += others
        total *= (z - rr) * value[at:at + step][None, :, None]
        order = np.argsort(f.reshape(-1), kind="stable")
        own, first = np.unique(f.reshape(-1)[order], return_index=True)
        phi[:, own] += np.add.reduceat(total.reshape(n, -1)[:, order], first, axis=1)
    return phi


def _block(key: str, n_features: int):
    """Contributions of one block of leaves to one block of rows, per feature met."""
    def run(rows: pa.Table, leaves: pa.Table) -> pa.Table:
        ids, phi, own = rows.column(key), np.zeros((rows.num_rows, 0)), np.empty(0, np.int64)
        if rows.num_rows and leaves.num_rows:
            x = rows.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(rows.num_rows, -1)
            path = leaves.column("path").combine_chunks().flatten()
            feats, lo, hi, r = (path.field(c).to_numpy(zero_copy_only=False).reshape(leaves.num_rows, -1)
                                for c in ("f", "lo", "hi", "r"))
            phi = contributions(x, feats, lo, hi, r, leaves.column("value").to_numpy(), n_features)
            own = np.unique(feats)
            phi = phi[:, own]
        return pa.table([ids.take(pa.array(np.repeat(np.arange(rows.num_rows), len(own)))),
                         pa.array(np.tile(own, rows.num_rows), pa.int32()), pa.array(phi.reshape(-1), pa.float64())],
                        names=[key, "feature_index", "shap"])
    return run


SAMPLE_OVERSAMPLE = 3.0


def explanation_sample(df: DataFrame, size: int = K.SHAP_SAMPLE_SIZE, key: str = K.KEY,
                       seed: int = K.RANDOM_STATE) -> DataFrame:
    """I16: the ``size`` rows first in hash order, without replacement (all if fewer).

    A top-k over a large frame would pull ``size`` rows from every partition
    into one task.  Instead rows are pre-filtered on the hash prefix to about
    ``3 * size`` candidates; the prefix order agrees with the full hash order,
    so the first ``size`` candidates are exactly the first ``size`` rows.  If
    fewer than ``size`` pass (very unlikely), the filter is dropped.
    """
    h = df.withColumn("__h", id_hash(key, seed + 1))
    n = df.count()
    if n <= size:
        return df
    frac = min(1.0, SAMPLE_OVERSAMPLE * size / n)
    threshold = int(frac * 16 ** 8)
    prefix = F.conv(F.substring("__h", 1, 8), 16, 10).cast("long")
    cand = h.where(prefix < F.lit(threshold))
    source = cand if cand.count() >= size else h
    return source.orderBy("__h", key).limit(size).drop("__h")


def shap_values(df: DataFrame, table: LeafTable, feature_names: Sequence[str],
                features: str = "features", key: str = K.KEY, leaf_block: int = LEAF_BLOCK,
                row_block: int = ROW_BLOCK) -> DataFrame:
    """Long (key, feature, value, shap) rows; ``features`` is a vector or an array column."""
    spark = df.sparkSession
    ship_package(spark)
    names = list(feature_names)
    array = F.col(features) if isinstance(df.schema[features].dataType, T.ArrayType) else vector_to_array(F.col(features))
    rows = df.select(F.col(key).cast("long").alias(key), array.alias("x"))
    leaves = table.leaves.where(F.size("path") > 0)  # a tree without splits moves the base only
    lengths = {r["m"]: r["n"] for r in  # a row per path length
               leaves.groupBy(F.size("path").alias("m")).agg(F.count(F.lit(1)).alias("n")).collect()}
    row_blocks = max(1, -(-df.count() // row_block))
    deal = F.create_map(*[F.lit(v) for m, n in sorted(lengths.items()) for v in (m, -(-n // leaf_block))]) if lengths else None
    named = F.array(*[F.lit(n) for n in names])
    out = rows.select(key, F.posexplode("x").alias("feature_index", "value"), F.lit(0.0).alias("shap"))
    if lengths:
        every = F.array(*[F.struct(F.lit(m).alias("m"), F.lit(b).alias("block"))
                          for m, n in sorted(lengths.items()) for b in range(-(-n // leaf_block))])
        asked = (rows.withColumn("rows", F.pmod(F.xxhash64(key), F.lit(row_blocks)).cast("int"))
                 .select(key, "x", "rows", F.explode(every).alias("b")).select(key, "x", "rows", "b.m", "b.block"))
        own = F.pmod(F.xxhash64("treeID", "node"), deal[F.size("path")]).cast("int")
        dealt = leaves.select("value", "path", F.size("path").alias("m"), own.alias("block"),
                              F.explode(F.sequence(F.lit(0), F.lit(row_blocks - 1))).alias("rows"))
        by = ["m", "block", "rows"]
        parts = asked.groupBy(*by).cogroup(dealt.groupBy(*by)).applyInArrow(
            _block(key, len(names)), f"{key} long, feature_index int, shap double")
        out = out.unionByName(parts.withColumn("value", F.lit(None).cast("double")))
    return (out.groupBy(key, "feature_index").agg(F.max("value").alias("value"), F.sum("shap").alias("shap"))
            .select(key, F.get(named, F.col("feature_index")).alias("feature"), "value", "shap"))


def global_attribution(shap: DataFrame) -> DataFrame:
    """Mean absolute SHAP per feature."""
    return shap.groupBy("feature").agg(F.avg(F.abs("shap")).alias("mean_abs_shap"))


def top_attribution(shap: DataFrame, k: int = K.TOP_FEATURES_PLOT) -> DataFrame:
    """top k features by mean absolute SHAP."""
    return global_attribution(shap).orderBy(F.desc("mean_abs_shap"), "feature").limit(k)


def attribution_spread(shap: DataFrame, k: int = K.TOP_FEATURES_PLOT) -> DataFrame:
    """All (value, shap) pairs of the top-k features (beeswarm data)."""
    top = top_attribution(shap, k).select("feature")
    return shap.join(F.broadcast(top), "feature", "left_semi")


def first_per_class(sample: DataFrame, label: str = K.LABEL, key: str = K.KEY,
                    seed: int = K.RANDOM_STATE) -> DataFrame:
    """the first sampled defaulter and non-defaulter (sample order)."""
    h = id_hash(key, seed + 1)
    return (sample.where(F.col(label).isNotNull())
            .groupBy(label).agg(F.min_by(F.col(key), F.struct(h, F.col(key))).alias(key)))


def waterfall(shap: DataFrame, base: float, k: int = K.WATERFALL_REPORT,
              key: str = K.KEY) -> DataFrame:
    """all rows of an applicant with at most k features; of more, the k-1
    largest |SHAP| rows and the rest summed into one "other features" row; plus
    base and output margin columns."""
    w = Window.partitionBy(key).orderBy(F.desc(F.abs(F.col("shap"))), F.asc("feature"))
    ranked = (shap.withColumn("rank", F.row_number().over(w))
              .withColumn("__n", F.count(F.lit(1)).over(Window.partitionBy(key))))
    own = (F.col("rank") < k) | (F.col("__n") <= k)
    head = ranked.where(own).select(key, "rank", "feature", "value", "shap")
    tail = (ranked.where(~own).groupBy(key)
            .agg(F.count(F.lit(1)).alias("n"), F.sum("shap").alias("shap"))
            .select(key, F.lit(k).alias("rank"),
                    F.concat(F.col("n").cast("string"), F.lit(" other features")).alias("feature"),
                    F.lit(None).cast("double").alias("value"), "shap"))
    total = shap.groupBy(key).agg(F.sum("shap").alias("__sum"))
    out = head.unionByName(tail).join(total, key)
    return out.select(key, "rank", "feature", "value", "shap",
                      F.lit(base).alias("base_value"), (F.lit(base) + F.col("__sum")).alias("output_margin"))
