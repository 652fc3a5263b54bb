"""Exact top-k by integer inner product: the three-phase uniform threshold.

A vector's components are cut into ``LISTS`` stretches.  Each stretch is a list
of local scores (the inner product of that stretch), a score is their sum:

1. Every list sends each query's ``DEPTH`` best local entries.  The totals of
   the rows seen are completed; the k-th best of them is a safe cutoff, as k
   rows reach it.
2. The cutoff goes with the query to all parts of all lists, and they send every
   entry of at least cutoff / ``LISTS``.  A row that sends none lies below the
   cutoff in total.  What a list did not send is less than that share, which
   bounds the total of rows some of whose entries are missing.
3. Rows whose bound still reaches the k-th best known total are resolved by
   their whole vectors.

Lists are dealt into blocks of ``BLOCK`` rows and ``QUERY_BLOCK`` queries, each
its own group, so no task grows with the table.  Rows with equal vectors are one
entry that carries its k + 1 smallest ids: no more of them can be in a result,
so a vector that fills a third of the table costs one entry a query.

Defined cases: null vectors and vectors with a null, NaN or infinite component
take no part, neither do rows without an id; rows that share an id count once,
with the smallest of their vectors (component by component); components that a
shorter vector lacks count as 0, so an empty vector scores 0 everywhere; ties go
to the smaller id; an empty table gives no rows; other columns are not read.
Quantised components are 64-bit integers, and a score beyond them is an error.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import ship_package
from .common import read_table, written

SCALE = 1024
NEAREST = 10
QUERY_STEP = 100
#: Stretches of components.  Two prune best: a cutoff is shared by as few lists as possible.
LISTS = 2
#: Entries that each list sends in the first phase, a query.
DEPTH = 50
BLOCK = 8_192
QUERY_BLOCK = 1_024
#: Queries multiplied at once in a task.
STRIP = 128

ENTRIES = "query_id long, list int, rep long, part long"
RESULT = "query_id long, rank int, vec_id long, score long"


def quantised(vectors: DataFrame, column: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(vec_id, v array<long>) of the vectors that take part, one row an id."""
    v = F.col("v")
    return (vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(column).cast("array<double>").alias("v"))
            .where(F.col("vec_id").isNotNull() & v.isNotNull()
                   & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
            .select("vec_id", F.transform(v, lambda x: F.floor(x * scale).cast("long")).alias("v"))
            .groupBy("vec_id").agg(F.min("v").alias("v")))


def distinct_vectors(rows: DataFrame, k: int) -> DataFrame:
    """(rep, ids, v): each vector once, with its k + 1 smallest ids, ``rep`` the first of them."""
    same = Window.partitionBy("v").orderBy("vec_id")
    few = rows.withColumn("_n", F.row_number().over(same)).where(F.col("_n") <= k + 1)
    return (few.groupBy("v").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))  # k + 1 at most
            .select(F.col("ids")[0].alias("rep"), "ids", "v"))


def _matrix(column, width: int) -> np.ndarray:
    """Rows of a list column, filled up with zeros to ``width``."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = pa.compute.list_value_length(column).to_numpy(zero_copy_only=False)
    out = np.zeros((len(column), width), np.int64)
    out[np.arange(width)[None] < sizes[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def products(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Inner products of all rows of both: in doubles where these are exact, else in integers."""
    if not x.size or not q.size:
        return np.zeros((len(x), len(q)), np.int64)
    most = x.shape[1] * max(abs(int(x.min())), abs(int(x.max()))) * max(abs(int(q.min())), abs(int(q.max())))
    if most < 1 << 53:
        return (x.astype(np.float64) @ q.astype(np.float64).T).astype(np.int64)
    if most < 1 << 63:
        return x @ q.T
    return (x.astype(object) @ q.astype(object).T).astype(np.int64)  # an error where one exceeds 64 bits


def _local(width: int, choose):
    """Local scores of one block of one list for one block of queries; ``choose``
    picks the entries sent from a query's scores."""
    def run(queries: pa.Table, rows: pa.Table) -> pa.Table:
        out = [(np.empty(0, np.int64),) * 3]
        which = 0
        if queries.num_rows and rows.num_rows:
            which = rows.column("list")[0].as_py()
            x, rep = _matrix(rows.column("part"), width), rows.column("rep").to_numpy()
            alone = rows.column("alone").to_numpy()
            asked, cut = queries.column("query_id").to_numpy(), queries.column("cutoff").to_pylist()
            q = _matrix(queries.column("part"), width)
            for lo in range(0, len(asked), STRIP):
                scores = products(x, q[lo:lo + STRIP])
                for i in range(scores.shape[1]):
                    query, s = asked[lo + i], scores[:, i]
                    near = choose(s, cut[lo + i])
                    near = near[(rep[near] != query) | ~alone[near]]  # a query is no candidate of its own
                    out.append((np.full(len(near), query), rep[near], s[near]))
        query, rep, s = (np.concatenate(c) for c in zip(*out))
        return pa.table([pa.array(query, pa.int64()), pa.array(np.full(len(query), which), pa.int32()),
                         pa.array(rep, pa.int64()), pa.array(s, pa.int64())], names=["query_id", "list", "rep", "part"])
    return run


def _deepest(depth: int):
    def choose(s: np.ndarray, cut) -> np.ndarray:
        n = min(depth + 1, len(s))  # one more, as the query itself may be among them
        return np.argpartition(-s, n - 1)[:n]
    return choose


def _above(lists: int):
    def choose(s: np.ndarray, cut) -> np.ndarray:
        return np.arange(len(s)) if cut is None else np.flatnonzero(s >= -(-cut // lists))
    return choose


class Lists:
    """The lists of one table in blocks, and the queries against them."""

    def __init__(self, reps: DataFrame, queries: DataFrame, lists: int, block: int, query_block: int):
        ship_package(reps.sparkSession)
        self.reps, self.queries, self.lists = reps, queries, lists
        size = reps.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("d")).first()
        self.width = max(1, -(-(size["d"] or 0) // lists))
        self.blocks = max(1, -(-size["n"] // block))
        self.query_blocks = max(1, -(-queries.count() // query_block))

    def _part(self, which):
        return F.slice("v", which * self.width + 1, F.lit(self.width)).alias("part")

    def gather(self, choose, cutoffs: DataFrame | None = None) -> DataFrame:
        """``ENTRIES`` that the lists send; ``cutoffs`` (query_id, cutoff) go along with the queries."""
        q = self.queries.withColumn("cutoff", F.lit(None).cast("long")) if cutoffs is None else \
            self.queries.join(cutoffs, "query_id", "left")
        every = [F.explode(F.sequence(F.lit(0), F.lit(n - 1))) for n in (self.lists, self.blocks, self.query_blocks)]
        own = F.pmod(F.xxhash64(F.lit(13), "query_id"), F.lit(self.query_blocks)).cast("int")
        asked = (q.select("query_id", "v", "cutoff", every[0].alias("list"), own.alias("qb"))
                 .select("query_id", "cutoff", "list", "qb", self._part(F.col("list")), every[1].alias("xb")))
        own = F.pmod(F.xxhash64(F.lit(17), "rep"), F.lit(self.blocks)).cast("int")
        rows = (self.reps.select("rep", "v", (F.size("ids") == 1).alias("alone"), every[0].alias("list"), own.alias("xb"))
                .select("rep", "alone", "list", "xb", self._part(F.col("list")), every[2].alias("qb")))
        key = ["list", "xb", "qb"]
        return asked.groupBy(*key).cogroup(rows.groupBy(*key)).applyInArrow(_local(self.width, choose), ENTRIES)

    def totals(self, pairs: DataFrame) -> DataFrame:
        """(query_id, rep, score) of pairs by their whole vectors."""
        q = self.queries.select("query_id", F.col("v").alias("_q"))
        x = self.reps.select("rep", F.col("v").alias("_x"))
        zero = F.lit(0).cast("long")
        dot = F.aggregate(F.zip_with("_q", "_x", lambda a, b: F.coalesce(a, zero) * F.coalesce(b, zero)),
                          zero, lambda total, p: total + p)
        return pairs.select("query_id", "rep").join(q, "query_id").join(x, "rep").select("query_id", "rep", dot.alias("score"))


def _kth(scores: DataFrame, k: int, name: str) -> DataFrame:
    """(query_id, name): each query's k-th best score, where it has that many."""
    best = Window.partitionBy("query_id").orderBy(F.desc("score"))
    return (scores.select("query_id", "score").withColumn("_n", F.row_number().over(best))
            .where(F.col("_n") <= k).where(F.col("_n") == k).select("query_id", F.col("score").alias(name)))


def top_k(vectors: DataFrame, step: int = QUERY_STEP, k: int = NEAREST, scale: int = SCALE, lists: int = LISTS,
          depth: int = DEPTH, block: int = BLOCK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """Each query's k highest scores among all other rows: (query_id, rank, vec_id, score).
    Queries are the rows whose vec_id is divisible by ``step``."""
    rows = written(quantised(vectors, scale=scale), "threshold-rows")
    reps = written(distinct_vectors(rows, k), "threshold-vectors")
    queries = rows.where(F.col("vec_id") % step == 0).select(F.col("vec_id").alias("query_id"), "v")
    table = Lists(reps, queries, lists, block, query_block)

    deep = Window.partitionBy("query_id", "list").orderBy(F.desc("part"), "rep")
    seen = (table.gather(_deepest(max(depth, k))).withColumn("_n", F.row_number().over(deep))
            .where(F.col("_n") <= max(depth, k)).select("query_id", "rep").distinct())
    cutoffs = written(_kth(table.totals(seen), k, "cutoff"), "threshold-cutoffs")

    sent = written(table.gather(_above(lists), cutoffs).groupBy("query_id", "rep")
                   .agg(F.sum("part").alias("score"), F.count(F.lit(1)).alias("got")), "threshold-entries")
    known = sent.where(F.col("got") == lists)
    unsent = F.expr(f"(cutoff - 1 - pmod(cutoff - 1, {lists})) div {lists}")  # the most that an entry not sent can be
    bound = F.col("score") + (lists - F.col("got")) * unsent
    open_ = (sent.where(F.col("got") < lists).join(cutoffs, "query_id", "left")
             .join(_kth(known, k, "reached"), "query_id", "left")
             .where(F.col("cutoff").isNull() | (bound >= F.greatest("cutoff", F.coalesce("reached", "cutoff")))))
    scores = known.select("query_id", "rep", "score").unionByName(table.totals(open_))

    # an entry's smallest id is its rep: k + 1 entries by (score, rep) hold the result, one may be led by the query itself
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "rep")
    few = scores.withColumn("_n", F.row_number().over(best)).where(F.col("_n") <= k + 1)
    last = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (few.join(reps.select("rep", "ids"), "rep")
            .select("query_id", F.explode("ids").alias("vec_id"), "score").where(F.col("vec_id") != F.col("query_id"))
            .withColumn("rank", F.row_number().over(last)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))


def op13_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(read_table(spark, sf_dir, "embeddings"))
