"""Quality selection by importance resampling.

Two generative models of hashed word n-grams, one of target documents and one of
all raw documents, give each document an importance: its probability under the one
over that under the other, as a logarithm the sum over its n-grams.  Adding Gumbel
noise and taking the top k is sampling without replacement in proportion to
importance; k is a share of the documents.  Noise depends on the id and a seed
alone.  ``scale`` controls length: with a number, every document counts as one of
so many n-grams (the mean times ``scale``), where lengths would decide otherwise.

The target is at most ``TARGET_DOCS`` documents labelled good, chosen by hash;
the raw model counts every n-gram of every document.  Count arrays have a fixed
size.  The k-th key is found by counting keys over ever finer edges, so nothing
is sorted as a whole.

Defined cases: null or empty text has no n-grams and the importance of the
worst document there could be; rows without a doc_id are left out; repeated rows
have equal keys, ties going to the smaller doc_id; without target documents all
ratios are 0 and the noise alone decides; an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import (COUNTS, SMALL_BLOCK, blocks, counts_batch, documents, first_by_hash, map_arrow, read_table, summed_counts,
                     texts, written)
from .wordhash import WORD_OR_SIGN, U, Words, runs

BUCKETS_BITS = 16
TARGET_DOCS = 20_000
KEEP_SHARE = 0.85
#: N-grams a document's mean log ratio counts for; None: as many as it has, the plain ratio.
SCALE = None
SEED = 7
#: Keys sorted in one task once the edges enclose no more.
LAST_KEYS = 50_000
EDGES = 200


def grams(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of each word or sign and of each two neighbours."""
    words = Words(column, classes=WORD_OR_SIGN)
    hashes = words.hashes()
    sizes = np.diff(words.bounds)
    row = np.repeat(np.arange(len(sizes)), sizes)
    pairs = runs(hashes, 2)
    inside = row[:-1] == row[1:] if len(row) > 1 else np.empty(0, bool)
    bucket = np.concatenate([hashes, pairs[inside]]) >> U(64 - BUCKETS_BITS)
    return np.concatenate([row, row[:-1][inside]]), bucket.astype(np.int64)


def _count(batches):
    total = np.zeros((2, 1 << BUCKETS_BITS), np.int64)
    for batch in blocks(batches, limit=SMALL_BLOCK):
        row, bucket = grams(batch.column("text"))
        target = batch.column("target").to_numpy(zero_copy_only=False).astype(bool)
        total[0] += np.bincount(bucket, minlength=total.shape[1])
        total[1] += np.bincount(bucket[target[row]], minlength=total.shape[1])
    if total.any():
        yield counts_batch(dict(enumerate(total)))


def log_ratios(docs: DataFrame, target_ids: DataFrame) -> np.ndarray:
    """Log ratio of the target's and the raw model's probability of each bucket."""
    marked = docs.join(F.broadcast(target_ids.withColumn("target", F.lit(True))), "doc_id", "left")  # TARGET_DOCS rows
    rows = map_arrow(marked.select("text", F.coalesce("target", F.lit(False)).alias("target")), _count, COUNTS)
    counts = summed_counts(rows, 2)
    zero = np.zeros(1 << BUCKETS_BITS, np.int64)
    raw, target = counts.get(0, zero), counts.get(1, zero)
    if not target.any():
        return zero.astype(float)
    # smoothed towards the raw model, in which a bucket has some share in any case
    raw_share = (raw + 1) / (raw + 1).sum()
    prior = 0.001 * target.sum()
    return np.log((target + prior * raw_share) / (target.sum() + prior)) - np.log(raw_share)


def _weigh(shared, scale: float | None):
    def run(batches):
        ratios = shared.value
        worst = float(ratios.min()) * (scale or 1.0)
        for batch in blocks(batches, limit=SMALL_BLOCK):
            row, bucket = grams(batch.column("text"))
            n = np.bincount(row, minlength=batch.num_rows)
            total = np.bincount(row, ratios[bucket], minlength=batch.num_rows)
            weight = np.where(n > 0, total if scale is None else scale * total / np.maximum(n, 1), worst)
            yield pa.record_batch([batch.column("doc_id"), pa.array(weight, pa.float64())],
                                  names=["doc_id", "log_weight"])
    return run


def kth_greatest(rows: DataFrame, column: str, k: int) -> tuple:
    """(value, rows above it): the k-th greatest ``column``, by counting over ever
    finer edges; rows with one value are one row of the last, sorted step."""
    span = rows.agg(F.min(column).alias("lo"), F.max(column).alias("hi"), F.count(F.lit(1)).alias("n")).collect()[0]
    lo, hi, above, inside = span["lo"], span["hi"], 0, span["n"]  # the k-th is in [lo, hi], with ``above`` rows over hi
    whole = isinstance(lo, int)
    while inside > LAST_KEYS and hi > lo:
        cuts = {lo + (hi - lo) * i // EDGES for i in range(EDGES)} if whole else set(np.linspace(lo, hi, EDGES).tolist())
        edges = sorted({lo, hi, *cuts})
        counts = rows.agg(*[F.count(F.when((F.col(column) >= e) & (F.col(column) <= hi), 1)).alias(f"c{i}")
                            for i, e in enumerate(edges)]).collect()[0]
        at = max(i for i in range(len(edges)) if counts[i] >= k - above)  # last edge with enough rows from it on
        over = counts[at + 1] if at + 1 < len(edges) else 0
        top = hi if at + 1 == len(edges) else edges[at + 1] - 1 if whole else float(np.nextafter(edges[at + 1], -np.inf))
        if (edges[at], top) == (lo, hi):
            break
        lo, hi, above, inside = edges[at], top, above + over, counts[at] - over
    if lo == hi:
        return lo, above
    found = (rows.where(F.col(column).between(lo, hi)).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
             .withColumn("upto", F.sum("n").over(Window.orderBy(F.desc(column))))  # LAST_KEYS rows at most
             .where(F.col("upto") >= k - above).orderBy("upto").limit(1).collect()[0])
    return found[column], above + found["upto"] - found["n"]


def top_k(keys: DataFrame, k: int) -> DataFrame:
    """``keys`` (doc_id, key, row, ...), a written table, with ``selected``: exactly
    the k greatest keys, ties by smaller doc_id, rows of one doc_id by ``row``."""
    n = keys.count()
    if not n or k <= 0 or k >= n:
        return keys.withColumn("selected", F.lit(k > 0))
    chosen, ties, rest = F.lit(False), F.lit(True), keys
    for column, order in (("key", F.col("key")), ("_doc", -F.col("doc_id")), ("_row", -F.col("row"))):
        rest = rest.withColumn(column, order) if column != "key" else rest
        value, above = kth_greatest(rest, column, k)
        chosen, k = chosen | (ties & (order > F.lit(value))), k - above
        ties, rest = ties & (order == F.lit(value)), rest.where(F.col(column) == F.lit(value))
        if rest.count() == k:  # the rows with the k-th value are all wanted
            break
    return keys.withColumn("selected", chosen | ties)


def resampled(docs: DataFrame, target_ids: DataFrame, share: float = KEEP_SHARE, scale: float | None = SCALE,
              seed: int = SEED) -> DataFrame:
    """(doc_id, log_weight, key, row, selected) of every document; rows that share a doc_id share its noise."""
    docs = texts(docs)
    shared = docs.sparkSession.sparkContext.broadcast(log_ratios(docs, target_ids))
    uniform = (F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    keys = written(map_arrow(docs, _weigh(shared, scale), "doc_id long, log_weight double")
                   .withColumn("key", F.col("log_weight") - F.log(-F.log(uniform)))
                   .withColumn("row", F.monotonically_increasing_id()), "resampling-keys")
    return top_k(keys, int(np.ceil(share * keys.count())))


def good_ids(labels: DataFrame, limit: int = TARGET_DOCS) -> DataFrame:
    """At most ``limit`` documents labelled good, chosen by hash of the id."""
    return (labels.where("quality = 1 and doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"))
            .distinct().transform(first_by_hash, limit, "doc_id"))


def op5_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = resampled(documents(spark, sf_dir), good_ids(read_table(spark, sf_dir, "labels")))
    return found.select("doc_id", F.round("log_weight", 6).alias("log_weight"), F.round("key", 6).alias("key"), "selected")
