"""AUC of many scores of the same rows in one job.

A boosted model has one score a row and round, a coefficient search one a row and
setting.  Ranking each alone would be a job per score; ranking rows x scores
would shuffle all of them.  Here tasks compute all scores of their rows
(``scorer``) and count positives and negatives per (score, bucket):

* bucket edges are values of a bounded sample, each edge value its own bucket,
  so ties there are exact and only open stretches between edges are not;
* running sums over the bucket counts give each score's AUC up to the mixed
  stretches (both classes in one): a lower and an upper bound (``bounds``);
* where the exact value is wanted, only rows in mixed stretches of the wanted
  scores are counted by value, and ranked within their stretch (``exact``).

Early stopping reads the bounds first: a round that cannot reach the best lower
bound before it is no improvement, whatever its exact value.

Counts are integers, so the result does not depend on the sample, the order of
rows or the partitioning.  Rows without a label, and NaN scores, are left out; a
group that lacks a class has no AUC (null).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as K
from ..session import materialize, ship_package

#: Rows whose scores give the edges; they decide the balance of buckets, nothing else.
EDGE_ROWS = 2_048
#: Edges of one score.
EDGES = 255
#: Rows scored at once in a task.
STRIP = 2_048
#: Scores a task counts by value at once.
HELD = 1 << 18

COUNTS = "part int, score int, bucket int, pos long, neg long"
VALUES = "part int, score int, bucket int, value array<double>, pos array<long>, neg array<long>"


def own_scores(x: np.ndarray) -> np.ndarray:
    """The array column holds the scores themselves."""
    return x


@dataclass
class LinearScores:
    """One score per row of ``weights``: the weighted sum of the array column."""
    weights: np.ndarray

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return x @ self.weights.T


@dataclass
class TreeStages:
    """Margin after every round of a tree ensemble: trees as node arrays of one
    size, all walked in lockstep; a leaf leads to itself."""
    feature: np.ndarray    # (trees, nodes)
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    depth: int

    def __call__(self, x: np.ndarray) -> np.ndarray:
        trees, nodes = self.feature.shape
        base = np.arange(trees)[None] * nodes
        row = np.arange(len(x))[:, None]
        at = np.broadcast_to(base, (len(x), trees))
        for _ in range(self.depth):
            below = x[row, self.feature.reshape(-1)[at]] <= self.threshold.reshape(-1)[at]
            at = base + np.where(below, self.left.reshape(-1)[at], self.right.reshape(-1)[at])
        return np.cumsum(self.value.reshape(-1)[at], axis=1)


def tree_stages(nodes: DataFrame, scale: float = 2.0) -> TreeStages:
    """``TreeStages`` of a node table (``train.tree_nodes``): one model's nodes,
    which are on the driver while it is fitted, reach the driver."""
    pdf = nodes.orderBy("treeID", "node").toPandas()
    trees = [t for _, t in pdf.groupby("treeID", sort=True)]
    size = max((len(t) for t in trees), default=1)
    shape = (len(trees), size)
    feature, threshold = np.zeros(shape, np.int64), np.full(shape, np.inf)
    left, right = (np.tile(np.arange(size), (len(trees), 1)) for _ in range(2))
    value, depth = np.zeros(shape), 0
    for i, t in enumerate(trees):
        node, inner = t["node"].to_numpy(), (t["left"] >= 0).to_numpy()
        value[i, :len(t)] = scale * t["tree_weight"].to_numpy(float) * t["prediction"].to_numpy(float)
        at = np.flatnonzero(inner)
        feature[i, at] = t["feature_index"].to_numpy()[at]
        threshold[i, at] = t["threshold"].to_numpy(float)[at]
        left[i, at] = np.searchsorted(node, t["left"].to_numpy()[at])
        right[i, at] = np.searchsorted(node, t["right"].to_numpy()[at])
        level, steps = np.zeros(1, np.int64), 0
        while len(level := level[inner[level]]):
            level, steps = np.concatenate([left[i, level], right[i, level]]), steps + 1
        depth = max(depth, steps)
    return TreeStages(feature, threshold, left, right, value, depth)


def _strips(batches, scorer):
    """(part, label, scores) of up to ``STRIP`` rows each."""
    for batch in batches:
        for lo in range(0, batch.num_rows, STRIP):
            part, label, x = batch.slice(lo, STRIP).columns
            yield (part.to_numpy(zero_copy_only=False), label.to_numpy(zero_copy_only=False).astype(np.int64),
                   scorer(x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), -1)))


def _buckets(edges: np.ndarray, values: np.ndarray) -> np.ndarray:
    """2 i: between edges i - 1 and i; 2 i + 1: the value of edge i."""
    at = np.searchsorted(edges, values)
    met = at < len(edges)
    met[met] = edges[at[met]] == values[met]
    return 2 * at + met


def _count(shared):
    def run(batches):
        scorer, edges = shared.value
        size, total = 2 * max(map(len, edges)) + 1, {}
        for part, label, scores in _strips(batches, scorer):
            for p in np.unique(part).tolist():
                own = part == p
                counts = total.setdefault(p, np.zeros((len(edges), size * 2), np.int64))
                for i, e in enumerate(edges):
                    s = scores[own, i]
                    real = ~np.isnan(s)
                    counts[i] += np.bincount(_buckets(e, s[real]) * 2 + label[own][real], minlength=size * 2)
        for p, counts in total.items():
            counts = counts.reshape(len(edges), size, 2)
            i, b = np.nonzero(counts.sum(axis=2))
            yield pa.record_batch([pa.array(np.full(len(i), p), pa.int32()), pa.array(i, pa.int32()), pa.array(b, pa.int32()),
                                   pa.array(counts[i, b, 1]), pa.array(counts[i, b, 0])],
                                  names=["part", "score", "bucket", "pos", "neg"])
    return run


def _together(strips):
    """Strips put together, up to about ``HELD`` scores."""
    held, cells = [], 0
    for strip in strips:
        held.append(strip)
        cells += strip[2].size
        if cells >= HELD:
            yield tuple(map(np.concatenate, zip(*held)))
            held, cells = [], 0
    if held:
        yield tuple(map(np.concatenate, zip(*held)))


def _stretches(edges: np.ndarray, wanted: np.ndarray, s: np.ndarray, y: np.ndarray) -> tuple:
    """(bucket, size, value, pos, neg): distinct values in the stretches between
    edges that are ``wanted`` (buckets 2 i), in order, counted by class."""
    order = np.argsort(s)
    s, y = s[order], y[order]
    first = np.flatnonzero(np.r_[True, s[1:] != s[:-1]][:len(s)])
    value, n = s[first], np.diff(np.r_[first, len(s)])
    pos = np.add.reduceat(y, first) if len(first) else n
    i = np.sort(wanted) // 2
    lo = np.r_[0, np.searchsorted(value, edges, "right")][i]
    size = np.r_[np.searchsorted(value, edges, "left"), len(value)][i] - lo
    i, lo, size = i[size > 0], lo[size > 0], size[size > 0]
    at = np.arange(size.sum()) + np.repeat(lo - np.cumsum(size) + size, size)
    return 2 * i, size, value[at], pos[at], (n - pos)[at]


def _values(shared):
    """Rows in mixed stretches counted by value: a row per stretch holds its values."""
    def run(batches):
        scorer, edges, mixed = shared.value  # mixed: part -> score -> buckets
        for part, label, scores in _together(_strips(batches, scorer)):
            out = []
            for p in np.unique(part).tolist():
                own = part == p
                for i, wanted in mixed.get(p, {}).items():
                    s, y = scores[own, i], label[own]
                    real = ~np.isnan(s)
                    bucket, *rest = _stretches(edges[i], wanted, s[real], y[real])
                    out.append((np.full(len(bucket), p), np.full(len(bucket), i), bucket, *rest))
            if out:
                p, i, bucket, size, *lists = (np.concatenate(c) for c in zip(*out))
                ends = pa.array(np.r_[0, np.cumsum(size)], pa.int32())
                yield pa.record_batch([*(pa.array(c, pa.int32()) for c in (p, i, bucket)),
                                       *(pa.ListArray.from_arrays(ends, pa.array(c)) for c in lists)],
                                      names=[f.split()[0] for f in VALUES.split(", ")])
    return run


def _ordered_pairs(dealt: pa.Table) -> pa.RecordBatch:
    """Per (part, score) twice the pairs in order, ties counted once, within the
    stretches of ``dealt``: whole stretches, the rows of one side by side."""
    keys = np.stack([dealt.column(c).to_numpy() for c in ("part", "score", "bucket")])
    own = np.cumsum(np.r_[False, (keys[:, 1:] != keys[:, :-1]).any(axis=0)])
    lists = [dealt.column(c).combine_chunks() for c in ("value", "pos", "neg")]
    own = np.repeat(own, np.diff(lists[0].offsets.to_numpy()))
    value, pos, neg = (c.flatten().to_numpy() for c in lists)
    order = np.lexsort((value, own))
    own, value, pos, neg = own[order], value[order], pos[order], neg[order]
    first = np.flatnonzero(np.r_[True, (own[1:] != own[:-1]) | (value[1:] != value[:-1])])
    own, pos, neg = own[first], np.add.reduceat(pos, first), np.add.reduceat(neg, first)
    if 2 * int(pos.sum()) * int(neg.sum()) >= 2 ** 63:  # beyond 64 bits: Python's integers
        pos, neg = pos.astype(object), neg.astype(object)
    below = np.cumsum(neg) - neg
    start = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
    below = below - np.repeat(below[start], np.diff(np.r_[start, len(own)]))
    total: dict[tuple[int, int], int] = {}
    stretch = np.flatnonzero(np.r_[True, (keys[:, 1:] != keys[:, :-1]).any(axis=0)])
    for p, i, pairs in zip(*keys[:2, stretch].tolist(), np.add.reduceat(pos * (2 * below + neg), start).tolist()):
        total[p, i] = total.get((p, i), 0) + pairs
    return pa.record_batch([*(pa.array([k[c] for k in total], pa.int32()) for c in (0, 1)),
                            pa.array(list(total.values()), pa.decimal128(38, 0))], names=["part", "score", "_in"])


def _inside(batches):
    """``_ordered_pairs`` of rows in order of their stretch; the last stretch waits for the next batch."""
    held = None
    for batch in batches:
        for lo in range(0, batch.num_rows, STRIP):
            rows = pa.Table.from_batches([batch.slice(lo, STRIP)])
            held = rows if held is None else pa.concat_tables([held, rows])
            keys = np.stack([held.column(c).to_numpy() for c in ("part", "score", "bucket")])
            whole = int(np.r_[-1, np.flatnonzero((keys != keys[:, -1:]).any(axis=0))][-1]) + 1
            if whole:
                yield _ordered_pairs(held.slice(0, whole))
                held = held.slice(whole)
    if held is not None:
        yield _ordered_pairs(held)


@dataclass
class RankedScores:
    """Bucket counts of many scores; ``rows`` (part, label, x) is a written table."""
    rows: DataFrame
    scorer: Callable[[np.ndarray], np.ndarray]
    edges: list[np.ndarray]
    table: DataFrame = field(init=False)

    def __post_init__(self):
        spark = self.rows.sparkSession
        ship_package(spark)
        shared = spark.sparkContext.broadcast((self.scorer, self.edges))
        counts = (self.rows.mapInArrow(_count(shared), COUNTS).groupBy("part", "score", "bucket")
                  .agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")))
        before = Window.partitionBy("part", "score").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        pos, neg = (F.col(c).cast("decimal(19,0)") for c in ("pos", "neg"))
        below = F.coalesce(F.sum("neg").over(before), F.lit(0)).cast("decimal(18,0)")
        mixed = (F.col("bucket") % 2 == 0) & (F.col("pos") > 0) & (F.col("neg") > 0)
        # at most 2 x EDGES + 1 rows a score; counted in halves, as ties count half
        self.table = materialize(
            counts.withColumn("twice", pos * (below + below))
            .withColumn("tied", F.when(F.col("bucket") % 2 == 1, pos * neg).otherwise(F.lit(0)))
            .withColumn("open", F.when(mixed, pos * neg).otherwise(F.lit(0)))
            .groupBy("part", "score").agg(
                F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg"),
                (F.sum("twice") + F.sum("tied")).cast("decimal(38,0)").alias("twice"),
                F.sum("open").cast("decimal(37,0)").alias("open"),
                F.collect_list(F.when(mixed, F.col("bucket"))).alias("mixed")))

    @staticmethod
    def _auc(twice):
        pairs = F.lit(2.0) * F.col("n_pos").cast("double") * F.col("n_neg")
        return F.when((F.col("n_pos") > 0) & (F.col("n_neg") > 0), F.try_divide(twice.cast("double"), pairs))

    def bounds(self) -> DataFrame:
        """(part, score, n_pos, n_neg, low, high): the AUC lies between; equal where it is known."""
        return self.table.select("part", "score", "n_pos", "n_neg", self._auc(F.col("twice")).alias("low"),
                                 self._auc(F.col("twice") + 2 * F.col("open")).alias("high"))

    def exact(self, wanted: Sequence[tuple[int, int]] | None = None) -> DataFrame:
        """(part, score, n_pos, n_neg, auc) of the (part, score) pairs ``wanted``, or of all."""
        spark = self.rows.sparkSession
        chosen = self.table
        if wanted is not None:
            pairs = spark.createDataFrame(list(wanted), "part int, score int")  # a row per score
            chosen = self.table.join(F.broadcast(pairs), ["part", "score"], "left_semi")
        mixed: dict[int, dict[int, np.ndarray]] = {}
        for r in chosen.where(F.size("mixed") > 0).select("part", "score", "mixed").collect():
            mixed.setdefault(r["part"], {})[r["score"]] = np.array(r["mixed"])  # EDGES + 1 numbers a score
        shared = spark.sparkContext.broadcast((self.scorer, self.edges, mixed))
        # dealt by stretch once, the values of a task's stretch in one row
        values = (self.rows.mapInArrow(_values(shared), VALUES).repartition("part", "score", "bucket")
                  .sortWithinPartitions("part", "score", "bucket"))
        inside = (values.mapInArrow(_inside, "part int, score int, _in decimal(38,0)")
                  .groupBy("part", "score").agg(F.sum("_in").cast("decimal(38,0)").alias("_in")))
        auc = self._auc(F.col("twice") + F.coalesce("_in", F.lit(0).cast("decimal(38,0)")))
        return chosen.join(inside, ["part", "score"], "left").select("part", "score", "n_pos", "n_neg", auc.alias("auc"))


def ranked_scores(df: DataFrame, x: str, scorer: Callable = own_scores, label: str = K.LABEL, part: str | None = None,
                  edge_rows: int = EDGE_ROWS, edges: int = EDGES) -> RankedScores:
    """Counts for all scores that ``scorer`` makes of the array column ``x``, per
    value of the integer column ``part`` (folds), if given.  ``df`` is read up to
    four times: pass a written table."""
    rows = (df.where(F.col(label).isNotNull())
            .select(F.col(part).cast("int").alias("part") if part else F.lit(0).alias("part"),
                    F.col(label).cast("int").alias("label"), F.col(x).cast("array<double>").alias("x")))
    every = max(1, rows.count() // (2 * edge_rows))
    sample = [r["x"] for r in rows.where(F.pmod(F.xxhash64("x"), F.lit(every)) == 0).select("x").limit(edge_rows).collect()]
    scores = scorer(np.array(sample, float).reshape(len(sample), -1)) if sample else np.empty((0, 0))
    places = np.linspace(0, max(len(sample) - 1, 0), edges).round().astype(int)
    cut = []
    for column in np.sort(scores, axis=0).T:  # NaN last
        e = np.unique(column[places])
        cut.append(e[~np.isnan(e)])
    return RankedScores(rows, scorer, cut or [np.empty(0)])


def last_scores(df: DataFrame, key: str, x: str, scorer: Callable) -> DataFrame:
    """(key, score): the last of the scores ``scorer`` makes of the array column
    ``x``: of ``TreeStages`` the margin of the whole ensemble."""
    spark = df.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(scorer)

    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, STRIP):
                ids, x = batch.slice(lo, STRIP).columns
                values = x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), -1)
                yield pa.record_batch([ids, pa.array(shared.value(values)[:, -1])], names=[key, "score"])

    return df.select(F.col(key).cast("long").alias(key), F.col(x).cast("array<double>")).mapInArrow(run, f"{key} long, score double")


def best_round(losses: Sequence[float], patience: int = K.EARLY_STOPPING_ROUNDS) -> int:
    """Rounds to keep: the lowest loss seen before ``patience`` rounds pass
    without improvement (1-based count of rounds)."""
    best_i, best = 0, float("inf")
    for i, v in enumerate(losses):
        if v < best:
            best_i, best = i, v
        elif i - best_i >= patience:
            break
    return best_i + 1


def open_rounds(low: Sequence[float], high: Sequence[float]) -> list[int]:
    """Rounds that may improve on all before them: those whose upper bound is not
    below the best lower bound so far."""
    best, out = float("-inf"), []
    for i, (lo, hi) in enumerate(zip(low, high)):
        if hi >= best:
            out.append(i)
        best = max(best, lo)
    return out


def stopping_rounds(ranked: RankedScores, patience: int = K.EARLY_STOPPING_ROUNDS) -> DataFrame:
    """Per part the round that early stopping on AUC keeps, as it would run
    round by round: (part, best_round, best_auc, last_round, fired).  Only rounds
    whose bounds leave it open are ranked exactly.  Without both classes no round
    improves on another: the first is kept, without an AUC."""
    spark = ranked.rows.sparkSession
    by_part: dict[int, list] = {}
    for r in ranked.bounds().orderBy("part", "score").collect():  # a row per part and round
        by_part.setdefault(r["part"], []).append(r)
    nothing = float("-inf")
    wanted = [(p, rows[i]["score"]) for p, rows in by_part.items()
              for i in open_rounds(*[[nothing if r[c] is None else r[c] for r in rows] for c in ("low", "high")])]
    exact = {(r["part"], r["score"]): r["auc"] for r in ranked.exact(wanted).where("auc IS NOT NULL").collect()} if wanted else {}
    out = []
    for p, rows in by_part.items():
        losses = [-exact.get((p, r["score"]), nothing) for r in rows]
        keep = best_round(losses, patience)
        fired = keep + patience <= len(rows)
        out.append((p, keep, exact.get((p, keep - 1)), keep + patience if fired else len(rows), fired))
    return spark.createDataFrame(out, "part int, best_round int, best_auc double, last_round int, fired boolean")
