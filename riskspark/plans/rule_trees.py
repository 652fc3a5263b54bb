"""A stored tree ensemble that both engines derive from the tables by rule.

Training is iterative and differs between engines; reports over a given ensemble
do not.  ``RULE_TREES`` trees of two levels over seven integer columns of the
applicants: which columns a tree splits on, and at which fraction of their
range, follows from its number; covers and leaf values (default rate of the
leaf over the base rate, in whole per mille) come from the train rows.  Tree
weights are powers of two that fall by half every eight trees, so every margin
is a sum of dyadic fractions, exact in any order.

Queries over it: early stopping on AUC by round, attribution, importance, and a
search over drawn coefficients of the same columns.  ``RULE_ORACLES`` has their
DuckDB SQL, written from the definitions: AUC as a rank sum, patience as the
first record round that 50 rounds do not beat, Shapley values by enumeration of
all subsets of the columns.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..operators import explain, report, stages, train
from ..operators.explain import explanation_sample
from ..operators.marts import previous_app_features
from ..operators.metrics import mean_over_folds
from ..session import materialize
from ..sources.fixtures import Tables
from .oracle import SPLIT, _ranking, numpy_rounding
from .queries import rounded
from .scoring import split_assignment

RULE_TREES = 160
#: Levels of fractions at which a column's range is cut.
FRACTIONS = 16
#: Columns of the ensemble: integers, 0 where an applicant has none.
COLUMNS = ("n_orders", "n_open", "days_first", "days_last", "min_cents", "max_cents", "nation")
#: Drawn settings of the coefficient search, coefficients -10 to 10.
SETTINGS = 50
#: Columns of the logistic baseline over the same rows.
BASELINE_COLUMNS = ("n_open", "days_last")
#: A report sample smaller than the data.
SMALL_SAMPLE = 100


def rule_rows(t: Tables) -> DataFrame:
    """Key, label, split, fold and ``x``, the columns as array<double>; written."""
    cents = [F.rint(F.col(c) * 100) for c in ("PREV_MIN_PRICE", "PREV_MAX_PRICE")]
    nation = t.customer.select(F.col("c_custkey").alias(K.KEY), "c_nationkey")
    cols = [F.col("PREV_N_ORDERS"), F.col("PREV_N_OPEN"), F.col("PREV_DAYS_FIRST_ORDER"), F.col("PREV_DAYS_LAST_ORDER"),
            *cents, F.col("c_nationkey")]
    x = F.array(*[F.coalesce(c.cast("double"), F.lit(0.0)) for c in cols])
    return materialize(split_assignment(t).join(previous_app_features(t), K.KEY, "left").join(nation, K.KEY)
                       .select(K.KEY, K.LABEL, "split", "fold", x.alias("x")))


def rule_splits(lo: list[int], hi: list[int]) -> list[tuple[int, int, int, int]]:
    """(tree, node, column, threshold) of the inner nodes 0, 1 and 2 of every tree."""
    out = []
    for t in range(RULE_TREES):
        for node in range(3):
            f = (3 * t * (node + 2) + 5 * node + t // 7) % len(COLUMNS)
            out.append((t, node, f, lo[f] + (hi[f] - lo[f]) * (1 + (5 * t + 3 * node) % (FRACTIONS - 1)) // FRACTIONS))
    return out


def rule_nodes(rows: DataFrame) -> DataFrame:
    """The node table, in the columns of ``train.tree_nodes``; written."""
    spark = rows.sparkSession
    fit = rows.where(F.col("split") == "train")
    at = range(len(COLUMNS))
    r = fit.agg(*[F.min(F.col("x")[i]).alias(f"lo{i}") for i in at], *[F.max(F.col("x")[i]).alias(f"hi{i}") for i in at]).first()
    splits = rule_splits(*[[int(r[f"{side}{i}"] or 0) for i in at] for side in ("lo", "hi")])
    trees = spark.createDataFrame([(t, *[v for _, _, f, thr in splits[3 * t:3 * t + 3] for v in (f, float(thr))])
                                   for t in range(RULE_TREES)], "treeID int, f0 int, t0 double, f1 int, t1 double, f2 int, t2 double")

    def side(n):  # the child of inner node n that a row goes to
        return F.when(F.get("x", F.col(f"f{n}")) <= F.col(f"t{n}"), 2 * n + 1).otherwise(2 * n + 2)

    # a row of every tree for each row, summed within the task: RULE_TREES x 4 rows leave it
    leaf = (fit.select(K.LABEL, "x", F.explode(F.sequence(F.lit(0), F.lit(RULE_TREES - 1))).alias("treeID"))
            .join(F.broadcast(trees), "treeID")
            .select("treeID", F.col(K.LABEL).cast("long").alias("y"), F.when(side(0) == 1, side(1)).otherwise(side(2)).alias("node"))
            .groupBy("treeID", "node").agg(F.count(F.lit(1)).alias("cover"), F.sum("y").alias("pos")))
    leaf = {(x["treeID"], x["node"]): (x["cover"], x["pos"]) for x in leaf.collect()}
    out = []
    for t in range(RULE_TREES):
        count = {n: leaf.get((t, n), (0, 0)) for n in range(3, 7)}
        for n in (2, 1):
            count[n] = tuple(a + b for a, b in zip(count[2 * n + 1], count[2 * n + 2]))
        count[0] = tuple(a + b for a, b in zip(count[1], count[2]))
        for n in range(7):
            cover, pos = count[n]
            inner = n < 3
            f, thr = splits[3 * t + n][2:] if inner else (-1, None)
            rate = 1000 * pos // cover - 1000 * count[0][1] // count[0][0] if cover and not inner else 0
            out.append((t, n, float(rate), float(cover), 0.0, 2 * n + 1 if inner else -1, 2 * n + 2 if inner else -1, f,
                        None if thr is None else float(thr), 2.0 ** -(10 + t // 8)))
    return materialize(spark.createDataFrame(
        out, "treeID int, node int, prediction double, cover double, gain double, left int, right int, "
             "feature_index int, threshold double, tree_weight double"))


# --- early stopping on AUC ------------------------------------------------------

def _ranked_rounds(spark, sf_dir):
    rows = rule_rows(Tables(spark, sf_dir))
    scorer = stages.tree_stages(rule_nodes(rows), scale=1.0)
    return stages.ranked_scores(rows.where(F.col("split") == "test"), "x", scorer)


def q_round_auc(spark, sf_dir) -> DataFrame:
    """AUC of the test rows after every round."""
    auc = _ranked_rounds(spark, sf_dir).exact()
    return rounded(auc.select((F.col("score") + 1).alias("n_trees"), "n_pos", "n_neg", F.col("auc").alias("auc_roc")))


def q_early_stopping(spark, sf_dir) -> DataFrame:
    """The round kept with a patience of 50 rounds, and whether patience ran out."""
    stop = stages.stopping_rounds(_ranked_rounds(spark, sf_dir))
    return rounded(stop.select("best_round", F.col("best_auc").alias("best_auc"), "last_round", "fired"))


# --- coefficient search ------------------------------------------------------------

def rule_settings() -> np.ndarray:
    """(settings, columns): the drawn coefficients."""
    k, j = np.arange(SETTINGS)[:, None], np.arange(len(COLUMNS))[None]
    return ((7 * k * (j + 3) + 11 * j + k // 3) % 21 - 10).astype(float)


def q_coefficient_search(spark, sf_dir) -> DataFrame:
    """50 settings x 5 folds ranked in one job, settings as columns;
    mean fold AUC of each and the best one (ties: the lowest number)."""
    rows = rule_rows(Tables(spark, sf_dir)).where(F.col("split") == "train")
    at = range(len(COLUMNS))
    r = rows.agg(*[F.min(F.col("x")[i]).alias(f"lo{i}") for i in at], *[F.max(F.col("x")[i]).alias(f"hi{i}") for i in at]).first()
    level = F.array(*[F.floor(F.lit(1000.0) * (F.col("x")[i] - F.lit(r[f"lo{i}"])) / F.lit(max(r[f"hi{i}"] - r[f"lo{i}"], 1.0)))
                      .cast("double") for i in at])
    folded = materialize(rows.select(K.LABEL, "fold", level.alias("z")))
    auc = stages.ranked_scores(folded, "z", stages.LinearScores(rule_settings()), part="fold").exact()
    means = mean_over_folds(auc.select(F.col("score").alias("setting"), F.col("auc").alias("auc_roc")), by=["setting"])
    means = rounded(means)
    best = means.agg(F.max_by("setting", F.struct("mean_auc_roc", -F.col("setting"))).alias("setting"))
    return (means.join(best.withColumn("best", F.lit(True)), "setting", "left")
            .select("setting", "mean_auc_roc", "n_folds", F.coalesce("best", F.lit(False)).alias("best")))


# --- attribution ---------------------------------------------------------------------

def _attributed(spark, sf_dir):
    """Node table, leaf table and explanation sample."""
    rows = rule_rows(Tables(spark, sf_dir))
    nodes = rule_nodes(rows)
    sample = explain.explanation_sample(rows.where(F.col("split") == "test"))
    return nodes, explain.leaf_table(nodes, margin_scale=1.0), sample


def q_shap_values(spark, sf_dir) -> DataFrame:
    """I16 + I17: long attribution rows of the explanation sample."""
    _, table, sample = _attributed(spark, sf_dir)
    return rounded(explain.shap_values(sample, table, COLUMNS, "x"))


def q_shap_global(spark, sf_dir) -> DataFrame:
    """D20 + F6."""
    _, table, sample = _attributed(spark, sf_dir)
    return rounded(explain.top_attribution(explain.shap_values(sample, table, COLUMNS, "x")))


def q_shap_spread(spark, sf_dir) -> DataFrame:
    """(value, shap) pairs of the five features of largest mean attribution."""
    _, table, sample = _attributed(spark, sf_dir)
    shap = materialize(explain.shap_values(sample, table, COLUMNS, "x"))
    return rounded(explain.attribution_spread(shap, 5))


def q_shap_waterfall(spark, sf_dir) -> DataFrame:
    """F4 + F5 + I18: waterfalls of the first sampled defaulter and non-defaulter;
    only these two are attributed."""
    _, table, sample = _attributed(spark, sf_dir)
    firsts = explain.first_per_class(sample).select(K.KEY)
    two = sample.join(F.broadcast(firsts), K.KEY, "left_semi")  # a row per class
    return rounded(explain.waterfall(explain.shap_values(two, table, COLUMNS, "x"), table.base, 5))


def q_shap_additivity(spark, sf_dir) -> DataFrame:
    """Base value plus attributions against the margin, per sampled row."""
    nodes, table, sample = _attributed(spark, sf_dir)
    total = explain.shap_values(sample, table, COLUMNS, "x").groupBy(K.KEY).agg((F.sum("shap") + table.base).alias("explained"))
    margin = stages.last_scores(sample, K.KEY, "x", stages.tree_stages(nodes, scale=1.0))
    return rounded(total.join(margin, K.KEY).select(K.KEY, F.col("score").alias("margin"), "explained"))


def q_feature_importance(spark, sf_dir) -> DataFrame:
    """I15 + F2: splits per feature over the node table, largest first."""
    nodes = rule_nodes(rule_rows(Tables(spark, sf_dir)))
    return train.top_features(train.importance_of(nodes, COLUMNS)).select("feature", "split_count")


def q_explain_sample_small(spark, sf_dir) -> DataFrame:
    """I16: a sample smaller than the data."""
    rows = split_assignment(Tables(spark, sf_dir))
    return explain.explanation_sample(rows, SMALL_SAMPLE).select(K.KEY, K.LABEL)


def q_sample_membership_small(spark, sf_dir) -> DataFrame:
    """Scored applicants inside and outside a sample smaller than the data."""
    rows = split_assignment(Tables(spark, sf_dir)).select(K.KEY, K.LABEL)
    return report.sample_membership(rows, explanation_sample(rows, SMALL_SAMPLE))


# --- fitted baseline against the stored ensemble -----------------------------------------

def _baseline(spark, sf_dir):
    """The logistic baseline on two standardised columns, fitted on the train rows,
    and the rows with their features."""
    rows = rule_rows(Tables(spark, sf_dir)).where(F.col("split").isNotNull())
    x = [F.col("x")[COLUMNS.index(c)] for c in BASELINE_COLUMNS]
    r = rows.where(F.col("split") == "train").agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(x)],
                                                  *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(x)]).first()
    scaled = [(c - F.lit(r[f"m{i}"])) / F.lit(r[f"s{i}"] or 1.0) for i, c in enumerate(x)]
    rows = materialize(rows.withColumn("z", F.array(*scaled)))
    vectors = rows.withColumn("features", array_to_vector("z"))
    return train.train_baseline(vectors.where(F.col("split") == "train"), tol=1e-12), vectors


def q_baseline_coefficients(spark, sf_dir) -> DataFrame:
    """I8: intercept and weights of the balanced, L2-penalised logistic baseline."""
    model, _ = _baseline(spark, sf_dir)
    named = zip(("intercept", *BASELINE_COLUMNS), (model.intercept, *model.coefficients.toArray().tolist()))
    return rounded(spark.createDataFrame([(n, float(v)) for n, v in named], "term string, weight double"), 5)


def q_baseline_scores(spark, sf_dir) -> DataFrame:
    """The baseline's probabilities of both splits."""
    model, rows = _baseline(spark, sf_dir)
    return rounded(train.predict_proba(model, rows), 5)


def _both_models(spark, sf_dir) -> dict[str, DataFrame]:
    """Test scores of the baseline and of the stored ensemble."""
    model, rows = _baseline(spark, sf_dir)
    test = rows.where(F.col("split") == "test")
    nodes = rule_nodes(rows.select(K.KEY, K.LABEL, "split", "fold", "x"))
    margin = stages.last_scores(test, K.KEY, "x", stages.tree_stages(nodes, scale=1.0))
    ensemble = test.select(K.KEY, K.LABEL).join(margin, K.KEY).withColumnRenamed("score", "probability")
    return {"logistic_regression": train.predict_proba(model, test), "stored_trees": ensemble}


def q_stored_model_comparison(spark, sf_dir) -> DataFrame:
    """I14 + G2: AUC, AP, KS and Gini of both models on the test split, long."""
    return rounded(train.model_metrics(_both_models(spark, sf_dir)), 4)


def q_stored_model_comparison_wide(spark, sf_dir) -> DataFrame:
    """Metric rows, one column per model."""
    return rounded(train.comparison_table(train.model_metrics(_both_models(spark, sf_dir))), 4)


RULE_QUERIES = {
    "round_auc": q_round_auc,
    "early_stopping": q_early_stopping,
    "coefficient_search": q_coefficient_search,
    "shap_values": q_shap_values,
    "shap_global": q_shap_global,
    "shap_spread": q_shap_spread,
    "shap_waterfall": q_shap_waterfall,
    "shap_additivity": q_shap_additivity,
    "feature_importance": q_feature_importance,
    "explain_sample_small": q_explain_sample_small,
    "sample_membership_small": q_sample_membership_small,
    "baseline_coefficients": q_baseline_coefficients,
    "baseline_scores": q_baseline_scores,
    "stored_model_comparison": q_stored_model_comparison,
    "stored_model_comparison_wide": q_stored_model_comparison_wide,
}

# --- DuckDB SQL ------------------------------------------------------------------------

_N = len(COLUMNS)
_RX = SPLIT + f""",
rx AS (SELECT SK_ID_CURR, TARGET, split, fold, [coalesce(PREV_N_ORDERS, 0), coalesce(PREV_N_OPEN, 0),
    coalesce(PREV_DAYS_FIRST_ORDER, 0), coalesce(PREV_DAYS_LAST_ORDER, 0),
    coalesce(CAST(round(PREV_MIN_PRICE * 100) AS BIGINT), 0), coalesce(CAST(round(PREV_MAX_PRICE * 100) AS BIGINT), 0),
    c_nationkey]::BIGINT[] AS x FROM split),
long_x AS (SELECT SK_ID_CURR, TARGET, split, fold, unnest(x) AS v, generate_subscripts(x, 1) - 1 AS f FROM rx),
span AS (SELECT f, min(v) AS lo, max(v) AS hi FROM long_x WHERE split = 'train' GROUP BY f)"""

_NODES = _RX + f""",
inner_nodes AS (
  SELECT t, node, s.f, lo + (hi - lo) * (1 + (5 * t + 3 * node) % {FRACTIONS - 1}) // {FRACTIONS} AS thr
  FROM range({RULE_TREES}) a(t), range(3) b(node), span s
  WHERE s.f = (3 * t * (node + 2) + 5 * node + t // 7) % {_N}
),
-- the way of every row through every tree: the child taken at each inner node
steps AS (SELECT r.SK_ID_CURR, r.TARGET, r.split, i.t, i.node, r.x[i.f + 1] <= i.thr AS below FROM rx r, inner_nodes i
          WHERE r.split IS NOT NULL),
ways AS (SELECT SK_ID_CURR, TARGET, split, t,
           bool_or(below) FILTER (WHERE node = 0) AS b0, bool_or(below) FILTER (WHERE node = 1) AS b1,
           bool_or(below) FILTER (WHERE node = 2) AS b2 FROM steps GROUP BY ALL),
leaf_of AS (SELECT *, CASE WHEN b0 THEN CASE WHEN b1 THEN 3 ELSE 4 END ELSE CASE WHEN b2 THEN 5 ELSE 6 END END AS leaf FROM ways),
leaves AS (
  SELECT t, n.leaf, CASE WHEN n.leaf < 5 THEN 1 ELSE 2 END AS parent,
         count(SK_ID_CURR) AS cover, coalesce(sum(TARGET), 0)::BIGINT AS pos
  FROM range({RULE_TREES}) a(t) CROSS JOIN (VALUES (3), (4), (5), (6)) n(leaf)
  LEFT JOIN (SELECT * FROM leaf_of WHERE split = 'train') l USING (t, leaf) GROUP BY ALL
),
tree AS (SELECT *, sum(cover) OVER (PARTITION BY t, parent) AS parent_cover, sum(cover) OVER (PARTITION BY t) AS root_cover,
         CASE WHEN cover > 0 THEN (1000 * pos) // cover
              - (1000 * (sum(pos) OVER (PARTITION BY t))::BIGINT) // (sum(cover) OVER (PARTITION BY t))::BIGINT ELSE 0 END
         * pow(2e0, -(10 + t // 8)) AS value FROM leaves)"""

_ROUNDS = _NODES + f""",
margins AS (SELECT l.SK_ID_CURR, l.TARGET, l.t, sum(tree.value) OVER (PARTITION BY l.SK_ID_CURR ORDER BY l.t) AS m
            FROM leaf_of l JOIN tree USING (t, leaf) WHERE l.split = 'test'),
ranks AS (SELECT t, TARGET, 2 * rank() OVER (PARTITION BY t ORDER BY m) + count(*) OVER (PARTITION BY t, m) - 1 AS twice FROM margins),
auc AS (SELECT t, sum(TARGET)::BIGINT AS n_pos, (count(*) - sum(TARGET))::BIGINT AS n_neg,
          (sum(twice) FILTER (WHERE TARGET = 1) - sum(TARGET) * (sum(TARGET) + 1))::BIGINT AS u2 FROM ranks GROUP BY t)"""

_AUC = "u2 / (2e0 * n_pos * n_neg)"

_SHAP = _NODES + f""",
sample AS (SELECT * FROM rx WHERE split = 'test' ORDER BY md5('43|' || CAST(SK_ID_CURR AS VARCHAR)), SK_ID_CURR LIMIT 5000),
-- each leaf with its two splits: column, the row's side, the share of the cover that takes the same side
sides AS (
  SELECT s.SK_ID_CURR, tr.t, tr.value, r0.f AS f0, (s.x[r0.f + 1] <= r0.thr) = (tr.parent = 1) AS z0,
         tr.parent_cover / tr.root_cover AS q0, r1.f AS f1, (s.x[r1.f + 1] <= r1.thr) = (tr.leaf % 2 = 1) AS z1,
         CASE WHEN tr.parent_cover > 0 THEN tr.cover / tr.parent_cover ELSE 0 END AS q1
  FROM sample s, tree tr JOIN inner_nodes r0 ON r0.t = tr.t AND r0.node = 0
  JOIN inner_nodes r1 ON r1.t = tr.t AND r1.node = tr.parent WHERE tr.value <> 0
),
-- expected margin when the columns of a subset are known
game AS (
  SELECT SK_ID_CURR, mask, sum(value * CASE WHEN (mask >> f0) & 1 = 1 THEN CAST(z0 AS INT) ELSE q0 END
                                     * CASE WHEN (mask >> f1) & 1 = 1 THEN CAST(z1 AS INT) ELSE q1 END) AS v
  FROM sides, range({1 << _N}) m(mask) GROUP BY ALL
),
phi AS (
  SELECT a.SK_ID_CURR, f, sum((b.v - a.v) * factorial(bit_count(a.mask)) * factorial({_N} - 1 - bit_count(a.mask))
                              / factorial({_N})) AS shap
  FROM range({_N}) p(f), game a JOIN game b ON b.SK_ID_CURR = a.SK_ID_CURR AND b.mask = a.mask | (1 << f)
  WHERE (a.mask >> f) & 1 = 0 GROUP BY ALL
),
base AS (SELECT coalesce(sum(value * CASE WHEN parent_cover > 0 THEN cover / root_cover ELSE 0 END), 0) AS base FROM tree),
named AS (SELECT p.SK_ID_CURR, {list(COLUMNS)!r}[p.f + 1] AS feature, CAST(s.x[p.f + 1] AS DOUBLE) AS value, p.shap
          FROM phi p JOIN sample s USING (SK_ID_CURR)),
means AS (SELECT feature, avg(abs(shap)) AS mean_abs_shap FROM named GROUP BY feature)"""

# Newton steps on the penalised, class-balanced likelihood: the sums of one step give the next weights
_NEWTON = _RX + f""",
two AS (SELECT SK_ID_CURR, TARGET, split, fold, x[{COLUMNS.index(BASELINE_COLUMNS[0]) + 1}]::DOUBLE AS x1,
          x[{COLUMNS.index(BASELINE_COLUMNS[1]) + 1}]::DOUBLE AS x2 FROM rx WHERE split IS NOT NULL),
shape AS (SELECT avg(x1) AS m1, stddev_pop(x1) AS s1, avg(x2) AS m2, stddev_pop(x2) AS s2, count(*) AS n, sum(TARGET) AS p
          FROM two WHERE split = 'train'),
z AS (SELECT SK_ID_CURR, TARGET, split, fold, (x1 - m1) / s1 AS z1, (x2 - m2) / s2 AS z2,
        CASE WHEN TARGET = 1 THEN n / (2e0 * p) ELSE n / (2e0 * (n - p)) END / n AS w, 1e0 / n AS l2 FROM two, shape),
fit AS MATERIALIZED (SELECT * FROM z WHERE split = 'train'),
newton(step, b0, b1, b2) AS (
  SELECT 0, 0e0, 0e0, 0e0
  UNION ALL
  SELECT step + 1, b0 - (g0 * c00 + g1 * c01 + g2 * c02) / det, b1 - (g0 * c01 + g1 * c11 + g2 * c12) / det,
         b2 - (g0 * c02 + g1 * c12 + g2 * c22) / det
  FROM (
    SELECT *, h11 * h22 - h12 * h12 AS c00, h02 * h12 - h01 * h22 AS c01, h01 * h12 - h02 * h11 AS c02,
           h00 * h22 - h02 * h02 AS c11, h01 * h02 - h00 * h12 AS c12, h00 * h11 - h01 * h01 AS c22,
           h00 * (h11 * h22 - h12 * h12) - h01 * (h01 * h22 - h12 * h02) + h02 * (h01 * h12 - h11 * h02) AS det
    FROM (
      SELECT step, b0, b1, b2, sum(w * (q - TARGET)) AS g0, sum(w * (q - TARGET) * z1) + any_value(l2) * b1 AS g1,
             sum(w * (q - TARGET) * z2) + any_value(l2) * b2 AS g2,
             sum(w * v) AS h00, sum(w * v * z1) AS h01, sum(w * v * z2) AS h02, sum(w * v * z1 * z1) + any_value(l2) AS h11,
             sum(w * v * z1 * z2) AS h12, sum(w * v * z2 * z2) + any_value(l2) AS h22
      FROM (SELECT *, q * (1 - q) AS v FROM (SELECT newton.*, fit.*, 1 / (1 + exp(-(b0 + b1 * z1 + b2 * z2))) AS q FROM newton, fit
                                             WHERE step < 12))
      GROUP BY step, b0, b1, b2)
  )
),
beta AS (SELECT * FROM newton WHERE step = 12),
proba AS (SELECT SK_ID_CURR, TARGET, split, 1 / (1 + exp(-(b0 + b1 * z1 + b2 * z2))) AS probability FROM z, beta)"""
_NEWTON = _NEWTON.replace("WITH ", "WITH RECURSIVE ", 1)

_BOTH = _NEWTON + _NODES[len(_RX):] + """,
margins AS (SELECT l.SK_ID_CURR, l.TARGET, sum(tree.value) AS m FROM leaf_of l JOIN tree USING (t, leaf)
            WHERE l.split = 'test' GROUP BY ALL),
both_models AS (SELECT 'logistic_regression' AS model, TARGET, probability AS v FROM proba WHERE split = 'test'
                UNION ALL SELECT 'stored_trees', TARGET, m FROM margins)""" + _ranking("both_models", "v", "model").replace(
    "SELECT auc.grp AS model, round(auc.auc, 6) AS auc_roc", "SELECT auc.grp AS model, auc.auc AS auc_roc").replace(
    "round(CASE WHEN apks.P > 0 AND apks.N > 0 THEN apks.ap END, 6)", "apks.ap").replace(
    "round(CASE WHEN apks.P > 0 AND apks.N > 0 THEN apks.ks END, 6)", "apks.ks").replace(
    "round(2 * auc.auc - 1, 6)", "2 * auc.auc - 1")


def _long_metrics(select: str) -> str:
    """The metrics of ``_BOTH`` as rows (model, metric, value), then ``select``."""
    head, tail = _BOTH.rsplit("\nSELECT auc.grp AS model", 1)
    rows = " UNION ALL ".join(f"SELECT model, '{m}' AS metric, {m} AS value FROM wide"
                              for m in ("auc_roc", "pr_auc", "ks_statistic", "gini"))
    return f"{head},\nwide AS (SELECT auc.grp AS model{tail}),\nlong AS ({rows})\n{select}"


_ORACLES = {
    "round_auc": _ROUNDS + f"\nSELECT CAST(t + 1 AS INTEGER) AS n_trees, n_pos, n_neg, round({_AUC}, 6) AS auc_roc FROM auc",
    "early_stopping": _ROUNDS + f""",
records AS (SELECT t, u2, n_pos, n_neg FROM (SELECT *, max(u2) OVER (ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS best
            FROM auc) WHERE best IS NULL OR u2 > best),
kept AS (SELECT * FROM (SELECT *, lead(t) OVER (ORDER BY t) AS next FROM records)
         WHERE next IS NULL OR next > t + {K.EARLY_STOPPING_ROUNDS} ORDER BY t LIMIT 1)
SELECT CAST(t + 1 AS INTEGER) AS best_round, round({_AUC}, 6) AS best_auc,
       CAST(least(t + 1 + {K.EARLY_STOPPING_ROUNDS}, {RULE_TREES}) AS INTEGER) AS last_round,
       t + 1 + {K.EARLY_STOPPING_ROUNDS} <= {RULE_TREES} AS fired FROM kept""",
    "coefficient_search": _RX + f""",
z AS (SELECT SK_ID_CURR, TARGET, fold, f, floor(1000e0 * (v - lo) / greatest(hi - lo, 1)) AS z
      FROM long_x JOIN span USING (f) WHERE split = 'train'),
drawn AS (SELECT k, SK_ID_CURR, TARGET, fold, sum(((7 * k * (f + 3) + 11 * f + k // 3) % 21 - 10) * z) AS m
          FROM z, range({SETTINGS}) s(k) GROUP BY ALL),
ranks AS (SELECT k, fold, TARGET, rank() OVER (PARTITION BY k, fold ORDER BY m) + (count(*) OVER (PARTITION BY k, fold, m) - 1) / 2e0 AS r FROM drawn),
auc AS (SELECT k, fold, (sum(r) FILTER (WHERE TARGET = 1) - sum(TARGET) * (sum(TARGET) + 1) / 2e0)
                        / (sum(TARGET) * (count(*) - sum(TARGET))) AS a FROM ranks GROUP BY k, fold),
mean AS (SELECT CAST(k AS INTEGER) AS setting, round(avg(a), 6) AS mean_auc_roc, count(*) AS n_folds FROM auc GROUP BY k)
SELECT *, row_number() OVER (ORDER BY mean_auc_roc DESC, setting) = 1 AS best FROM mean""",
    "shap_values": _SHAP + "\nSELECT SK_ID_CURR, feature, round(value, 6) AS value, round(shap, 6) AS shap FROM named",
    "shap_global": _SHAP + "\nSELECT feature, round(mean_abs_shap, 6) AS mean_abs_shap FROM means",
    "shap_spread": _SHAP + "\nSELECT SK_ID_CURR, feature, round(value, 6) AS value, round(shap, 6) AS shap FROM named "
                           "WHERE feature IN (SELECT feature FROM means ORDER BY mean_abs_shap DESC, feature LIMIT 5)",
    "shap_waterfall": _SHAP + """,
firsts AS (SELECT SK_ID_CURR FROM (SELECT SK_ID_CURR, row_number() OVER (PARTITION BY TARGET
             ORDER BY md5('43|' || CAST(SK_ID_CURR AS VARCHAR)), SK_ID_CURR) AS n FROM sample) WHERE n = 1),
placed AS (SELECT *, row_number() OVER (PARTITION BY SK_ID_CURR ORDER BY abs(shap) DESC, feature) AS place,
           sum(shap) OVER (PARTITION BY SK_ID_CURR) AS total FROM named SEMI JOIN firsts USING (SK_ID_CURR))
SELECT SK_ID_CURR, CAST(place AS INTEGER) AS rank, feature, round(value, 6) AS value, round(shap, 6) AS shap,
       round(base, 6) AS base_value, round(base + total, 6) AS output_margin FROM placed, base WHERE place < 5
UNION ALL
SELECT SK_ID_CURR, 5, count(*) || ' other features', NULL, round(sum(shap), 6), round(any_value(base), 6),
       round(any_value(base + total), 6) FROM placed, base WHERE place >= 5 GROUP BY SK_ID_CURR""",
    "shap_additivity": _SHAP + """,
walked AS (SELECT l.SK_ID_CURR, sum(tree.value) AS margin FROM leaf_of l JOIN tree USING (t, leaf) SEMI JOIN sample s
           ON s.SK_ID_CURR = l.SK_ID_CURR GROUP BY ALL)
SELECT w.SK_ID_CURR, round(margin, 6) AS margin, round(base + (SELECT sum(shap) FROM named n WHERE n.SK_ID_CURR = w.SK_ID_CURR), 6)
       AS explained FROM walked w, base""",
    "feature_importance": _NODES + f"\nSELECT {list(COLUMNS)!r}[f + 1] AS feature, count(*) AS split_count FROM inner_nodes GROUP BY f",
    "sample_membership_small": SPLIT + f""", s AS (SELECT SK_ID_CURR FROM split
  ORDER BY md5('43|' || CAST(SK_ID_CURR AS VARCHAR)), SK_ID_CURR LIMIT {SMALL_SAMPLE})
SELECT SK_ID_CURR, SK_ID_CURR IN (SELECT SK_ID_CURR FROM s) AS explained FROM split""",
    "baseline_coefficients": _NEWTON + "\nSELECT term, round(weight, 5) AS weight FROM (SELECT unnest(['intercept', "
        f"{', '.join(map(repr, BASELINE_COLUMNS))}]) AS term, unnest([b0, b1, b2]) AS weight FROM beta)",
    "baseline_scores": _NEWTON + "\nSELECT SK_ID_CURR, TARGET, split, round(probability, 5) AS probability FROM proba",
    "stored_model_comparison": _long_metrics("SELECT model, metric, round(value, 4) AS value FROM long"),
    "stored_model_comparison_wide": _long_metrics(
        "SELECT metric, round(max(value) FILTER (WHERE model = 'logistic_regression'), 4) AS logistic_regression, "
        "round(max(value) FILTER (WHERE model = 'stored_trees'), 4) AS stored_trees FROM long GROUP BY metric"),
    "explain_sample_small": SPLIT + "\nSELECT SK_ID_CURR, TARGET FROM split "
                            f"ORDER BY md5('43|' || CAST(SK_ID_CURR AS VARCHAR)), SK_ID_CURR LIMIT {SMALL_SAMPLE}",
}

RULE_ORACLES = {name: numpy_rounding(sql) for name, sql in _ORACLES.items()}
