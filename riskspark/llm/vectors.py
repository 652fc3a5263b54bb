"""Approximate nearest neighbours with learned partitions.

A bounded sample gives a neighbour graph, which is cut into balanced parts so
that few edges cross; a small network learns the part of a vector.  Every vector
is indexed under its most probable part; a query goes to its several most
probable parts and is reranked there by exact double-precision distance.  How
many parts a query needs is set on the sample: the fewest that hold ``RECALL`` of
its true neighbours.  Queries that find fewer than k rows that way search all.

Rows of a part are dealt into blocks of at most ``BLOCK`` rows by hash, and its
queries likewise, so a part holding a third of all vectors, or one vector
repeated that often, is many tasks.

Defined cases: null vectors, vectors with null, NaN or infinite components, zero
vectors and vectors of another length than the most frequent one take no part;
rows without an id are left out; rows sharing a query's id are not its
neighbours, and of several vectors of one id the smallest asks; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import ship_package
from .common import first_by_hash, map_arrow, read_table, written

#: Vectors the graph, the parts and the network are fitted on, at most.
SAMPLE = 6000
#: Sample vectors per part, and parts at most.
PART_SAMPLE = 250
MAX_PARTS = 32
GRAPH_NEIGHBOURS = 10
#: Share of true neighbours in the sample that the probed parts must hold.
RECALL = 0.985
HIDDEN = 96
EPOCHS = 40
BLOCK = 20_000
QUERY_BLOCK = 2_000
NEAREST = 10
QUERY_STEP = 100

FOUND = "query_id long, vec_id long, score double"


def usable(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """(vec_id, v array<double>) of vectors that take part."""
    v = F.col("v")
    good = (vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(column).cast("array<double>").alias("v"))
            .where(F.col("vec_id").isNotNull() & v.isNotNull() & (F.size(v) > 0)
                   & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
                   & F.exists(v, lambda x: x != 0)))
    common = (good.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n"))
              .orderBy(F.desc("n"), "d").limit(1).select("d"))
    return good.join(F.broadcast(common), F.size("v") == F.col("d"), "left_semi")  # one row


def distances(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Euclidean distance in double precision, by differences."""
    return np.sqrt(np.square(x - q).sum(axis=1))


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """Indices of the k nearest others of each row."""
    norm = np.square(x).sum(1)
    out = np.empty((len(x), k), np.int64)
    for lo in range(0, len(x), 1000):
        part = norm[lo:lo + 1000, None] + norm[None] - 2 * x[lo:lo + 1000] @ x.T
        part[np.arange(len(part)), lo + np.arange(len(part))] = np.inf
        out[lo:lo + 1000] = np.argpartition(part, k - 1, axis=1)[:, :k]
    return out


def balanced_parts(x: np.ndarray, graph: np.ndarray, parts: int, slack: float = 0.15, sweeps: int = 12) -> np.ndarray:
    """Part of each row: halves along main directions, then rows move to the part
    of most neighbours, both ways along the graph, while sizes stay balanced."""
    label = np.zeros(len(x), np.int64)
    groups = [np.arange(len(x))]
    while len(groups) < parts:
        groups.sort(key=len)
        own = groups.pop()
        centred = x[own] - x[own].mean(0)
        direction = np.ones(x.shape[1])
        for _ in range(20):
            direction = centred.T @ (centred @ direction)
            direction /= max(np.linalg.norm(direction), 1e-12)
        order = own[np.argsort(centred @ direction, kind="stable")]
        groups += [order[:len(order) // 2], order[len(order) // 2:]]
    for i, own in enumerate(groups):
        label[own] = i
    limit = int(np.ceil(len(x) / parts * (1 + slack)))
    least = int(len(x) / parts * (1 - slack))
    size = np.bincount(label, minlength=parts)
    source = np.repeat(np.arange(len(x)), graph.shape[1])
    for _ in range(sweeps):
        votes = np.zeros((len(x), parts), np.float32)
        np.add.at(votes, (source, label[graph.reshape(-1)]), 1)
        np.add.at(votes, (graph.reshape(-1), label[source]), 1)
        gain = votes.max(1) - votes[np.arange(len(x)), label]
        moved = 0
        for i in np.argsort(-gain, kind="stable").tolist():
            if gain[i] <= 0:
                break
            for to in np.argsort(-votes[i], kind="stable")[:3].tolist():
                if to == label[i] or votes[i, to] <= votes[i, label[i]]:
                    break
                if size[to] < limit and size[label[i]] > least:
                    size[label[i]] -= 1
                    size[to] += 1
                    label[i] = to
                    moved += 1
                    break
        if not moved:
            break
    return label


@dataclass
class Router:
    """Network from a vector to the probabilities of the parts."""
    mean: np.ndarray
    scale: float
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray
    probes: int = 1

    def logits(self, x: np.ndarray) -> np.ndarray:
        h = np.maximum(0, (x - self.mean) * self.scale @ self.w1 + self.b1)
        return h @ self.w2 + self.b2

    def ranked(self, x: np.ndarray) -> np.ndarray:
        """Parts of each row, most probable first."""
        return np.argsort(-self.logits(x), axis=1, kind="stable")


def fit_router(x: np.ndarray, seed: int = 7, recall: float = RECALL) -> Router:
    """Graph, balanced parts and network from sample rows."""
    parts = int(np.clip(len(x) // PART_SAMPLE, 1, MAX_PARTS))
    rng = np.random.default_rng(seed)
    mean, scale = x.mean(0), 1 / max(float(x.std()), 1e-12)
    net = Router(mean, scale, rng.normal(0, np.sqrt(2 / x.shape[1]), (x.shape[1], HIDDEN)), np.zeros(HIDDEN),
                 rng.normal(0, np.sqrt(1 / HIDDEN), (HIDDEN, parts)), np.zeros(parts), 1)
    if parts == 1:
        return net
    graph = neighbour_graph(x, GRAPH_NEIGHBOURS)
    label = balanced_parts(x, graph, parts)
    target = np.zeros((len(x), parts))  # a vector's part and its neighbours' parts
    np.add.at(target, (np.repeat(np.arange(len(x)), graph.shape[1]), label[graph.reshape(-1)]), 0.5 / graph.shape[1])
    target[np.arange(len(x)), label] += 0.5
    weights = [net.w1, net.b1, net.w2, net.b2]
    first, second, step = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights], 0
    for epoch in range(EPOCHS):
        for rows in np.array_split(rng.permutation(len(x)), max(1, len(x) // 256)):
            z = (x[rows] - mean) * scale
            h = np.maximum(0, z @ net.w1 + net.b1)
            p = h @ net.w2 + net.b2
            p = np.exp(p - p.max(1, keepdims=True))
            p = (p / p.sum(1, keepdims=True) - target[rows]) / len(rows)
            back = (p @ net.w2.T) * (h > 0)
            step += 1
            for w, g, m, v in zip(weights, (z.T @ back, back.sum(0), h.T @ p, p.sum(0)), first, second):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                w -= 0.004 * (1 - epoch / EPOCHS) * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    order = net.ranked(x)
    place = np.argsort(order, axis=1)  # rank of each part for each row
    needed = place[np.repeat(np.arange(len(x)), graph.shape[1]), order[graph.reshape(-1), 0]]
    covered = np.cumsum(np.bincount(needed, minlength=parts)) / len(needed)
    net.probes = int(min(parts, np.searchsorted(covered, recall) + 1))
    return net


def _matrix(column) -> np.ndarray:
    import pyarrow as pa
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.empty((0, 0))


def _route(shared, probes: int):
    import pyarrow as pa

    def run(batches):
        router = shared.value
        for batch in batches:
            if batch.num_rows:
                ranked = router.ranked(_matrix(batch.column("v")))[:, :probes or router.probes]
                parts = pa.array(ranked.astype(np.int32).tolist(), pa.list_(pa.int32()))
                yield pa.record_batch([batch.column("vec_id"), batch.column("v"), parts],
                                      names=["vec_id", "v", "parts"])
    return run


def _nearest(k: int):
    def run(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(rows):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        x, ids = np.stack(rows["v"].to_numpy()), rows["vec_id"].to_numpy(np.int64)
        out = []
        for q, v in zip(queries["vec_id"].tolist(), queries["v"]):
            d = distances(x, v)
            d[ids == q] = np.inf
            near = np.flatnonzero(d <= np.partition(d, min(k, len(d)) - 1)[min(k, len(d)) - 1])
            near = near[np.lexsort((ids[near], d[near]))][:k]
            near = near[np.isfinite(d[near])]
            out.append(pd.DataFrame({"query_id": np.full(len(near), q), "vec_id": ids[near], "score": d[near]}))
        return pd.concat(out)
    return run


def search(queries: DataFrame, index: DataFrame, k: int, block: int = BLOCK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """The k best of the probed parts: (query_id, rank, vec_id, score).
    ``queries`` (vec_id, v, part) and ``index`` (vec_id, v, part)."""
    ship_package(index.sparkSession)

    def blocks_of(df: DataFrame, size: int, name: str) -> DataFrame:
        return df.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / size).cast("int").alias(name))

    sizes = F.broadcast(blocks_of(index, block, "xs").join(blocks_of(queries, query_block, "qs"), "part"))  # a row per part

    def own(n: str):
        return F.pmod(F.xxhash64(F.lit(11), "vec_id"), F.col(n)).cast("int")

    def every(n: str):
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    def named(df: DataFrame) -> DataFrame:  # both may come from one frame
        return df.select(*[F.col(c).alias(c) for c in ("vec_id", "v", "part")]).join(sizes, "part")

    q = named(queries).select("vec_id", "v", "part", own("qs").alias("qb"), every("xs").alias("xb"))
    x = named(index).select("vec_id", "v", "part", own("xs").alias("xb"), every("qs").alias("qb"))
    key = ["part", "xb", "qb"]
    found = q.groupBy(*key).cogroup(x.groupBy(*key)).applyInPandas(_nearest(k), FOUND)
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (found.distinct().withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))


def nearest(vectors: DataFrame, step: int = QUERY_STEP, k: int = NEAREST, probes: int = 0) -> DataFrame:
    """k nearest of each query (vec_id divisible by ``step``) among all other rows."""
    spark = vectors.sparkSession
    good = usable(vectors)
    sample = first_by_hash(good, SAMPLE, "vec_id").toPandas()  # SAMPLE rows
    if not len(sample):
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    x = np.unique(np.stack(sample["v"].to_numpy()), axis=0)
    router = fit_router(x)
    shared = spark.sparkContext.broadcast(router)
    index = written(map_arrow(good, _route(shared, 1), "vec_id long, v array<double>, parts array<int>")
                    .select("vec_id", "v", F.col("parts")[0].alias("part")), "vector-index")
    asked = index.where(F.col("vec_id") % step == 0).groupBy("vec_id").agg(F.min("v").alias("v"))
    queries = written(map_arrow(asked, _route(shared, probes), "vec_id long, v array<double>, parts array<int>"),
                      "vector-queries")
    first = written(search(queries.select("vec_id", "v", F.explode("parts").alias("part")), index, k), "vectors-found")
    # fewer than k found: search every part
    got = first.groupBy(F.col("query_id").alias("vec_id")).agg(F.count(F.lit(1)).alias("got"))
    short = (queries.join(got, "vec_id", "left").where(F.coalesce("got", F.lit(0)) < k)
             .select("vec_id", "v", F.explode(F.sequence(F.lit(0), F.lit(router.w2.shape[1] - 1))).alias("part")))
    short = written(short, "vectors-short")
    if short.limit(1).count() == 0:
        return first
    again = search(short, index, k)
    return first.join(short.select(F.col("vec_id").alias("query_id")).distinct(), "query_id", "left_anti").unionByName(again)


def op10_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(read_table(spark, sf_dir, "embeddings"))
