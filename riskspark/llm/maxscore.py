"""Ranked lexical search with pair-bound MaxScore.

Only the items' terms are indexed.  One Arrow pass over the documents counts all
terms and writes, a document, the item terms it holds.  Spark sums the corpus
statistics and deals the documents into chunks; a chunk's index is written as
posting lists with their greatest impact and as intersection lists of term pairs
that stand in one item, with their greatest joint impact and their best rows.

A search takes three steps.  Each item starts from a threshold that k documents
reach: the k-th best joint impact over all chunks of any of its pairs.  In each
chunk its lists are opened by falling greatest impact, until the lists left
cannot lift a new document to the threshold; from there on only documents met
so far are looked up in the lists left, and those that cannot reach the
threshold any more are let go.  The bound of the lists left pairs them up: two
terms never add more than their joint maximum where both occur, which is less
than the sum of their maxima and nothing where they never meet.  Last, the best
of all chunks are ranked.  Skipping never changes a result: a document equal to
the threshold is kept.

Items are searched in blocks of about ``BLOCK_TERMS`` terms, so what is broadcast
for a block does not grow with the number of items.

Defined cases: null texts and texts without terms count nowhere; rows without an
id are left out; rows that share a doc_id are documents of their own, each may
be listed; texts that share an item_id are one item; items without terms and
items that no document meets have no rows; empty tables give no rows; other
columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import ship_package
from .common import blocks, documents, map_arrow, read_table, written

BEST = 10
#: Documents of a chunk of the index, on average.
CHUNK = 16_384
#: Item terms of one block; the item that reaches it is its last.
BLOCK_TERMS = 50_000
#: A term is paired with as many of the next rarer ones in its item.
PAIR_REACH = 3

RESULT = "item_id long, rank int, doc_id long, score long"
SIGNS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Signs between terms become spaces, A-Z lower case; bytes of other scripts stay.
_FOLD = bytes(b if b >= 0x80 or chr(b).isalnum() and not chr(b).isupper() else b + 32 if chr(b).isupper() else 0x20
              for b in range(256))

DOCS = "doc_id long, n long, terms array<int>, times array<int>"
INDEX = "chunk int, a int, b int, top long, rows array<int>, impacts array<long>"


def terms(text: str | bytes | None) -> list[bytes]:
    """Terms of a text, in order, as UTF-8."""
    raw = text.encode() if isinstance(text, str) else text or b""
    return raw.translate(_FOLD).split(b" ")


def _count(shared):
    def run(batches):
        known = {t: i for i, t in enumerate(shared.value)}
        for batch in blocks(batches):
            n, held, times, ends = [], [], [], [0]
            for raw in batch.column("text").cast(pa.binary()).to_pylist():
                found = terms(raw)
                n.append(len(found) - found.count(b""))
                ids = [i for i in map(known.get, found) if i is not None]
                ids, counts = np.unique(np.array(ids, np.int32), return_counts=True)
                held.append(ids)
                times.append(counts)
                ends.append(ends[-1] + len(ids))
            ends = pa.array(ends, pa.int32())
            yield pa.record_batch(
                [batch.column("doc_id"), pa.array(n, pa.int64()),
                 pa.ListArray.from_arrays(ends, pa.array(np.concatenate(held), pa.int32())),
                 pa.ListArray.from_arrays(ends, pa.array(np.concatenate(times).astype(np.int32)))],
                names=["doc_id", "n", "terms", "times"])
    return run


def counted(docs: DataFrame, vocabulary: list[bytes]) -> DataFrame:
    """(doc_id, n, terms, times): documents with terms, and those of ``vocabulary`` they hold, by index."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)  # of one block of items
    df = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_arrow(df.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull()), _count(shared), DOCS).where("n > 0")


def item_pairs(held: list[int], weights: np.ndarray, reach: int = PAIR_REACH) -> list[tuple[int, int]]:
    """Pairs of an item's terms that the index intersects: neighbours in the order of weight, smaller index first."""
    order = sorted(held, key=lambda t: (-weights[t], t))
    return [(min(a, b), max(a, b)) for i, a in enumerate(order) for b in order[i + 1:i + 1 + reach]]


def intersect(rows_a, impacts_a, rows_b, impacts_b) -> tuple[np.ndarray, np.ndarray]:
    """Rows of both lists and their joint impacts; the shorter list is looked up in the longer one."""
    if len(rows_a) > len(rows_b):
        rows_a, impacts_a, rows_b, impacts_b = rows_b, impacts_b, rows_a, impacts_a
    at = np.searchsorted(rows_b, rows_a)
    hit = at < len(rows_b)
    hit[hit] = rows_b[at[hit]] == rows_a[hit]
    return rows_a[hit], impacts_a[hit] + impacts_b[at[hit]]


def _index(shared, k: int):
    """Posting lists and pair lists of one chunk.  Rows are numbered within the chunk."""
    def run(key: tuple[pa.Scalar, ...], docs: pa.Table) -> pa.Table:
        weights, share, pairs = shared.value
        chunk = key[0].as_py()
        docs = docs.sort_by([("doc_id", "ascending"), ("n", "ascending")])
        held, n = docs.column("terms").combine_chunks(), docs.column("n").to_numpy()
        row = np.repeat(np.arange(docs.num_rows), pa.compute.list_value_length(held).to_numpy(zero_copy_only=False))
        term = held.flatten().to_numpy()
        tf = docs.column("times").combine_chunks().flatten().to_numpy().astype(np.int64)
        m = 10 + (90 * n * share[0]) // share[1]
        impact = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[row]))
        order = np.argsort(term, kind="stable")
        term, row, impact = term[order], row[order], impact[order]
        starts = np.flatnonzero(np.append(True, term[1:] != term[:-1])[:len(term)])
        lists = {int(term[lo]): (row[lo:hi], impact[lo:hi])
                 for lo, hi in zip(starts.tolist(), np.append(starts[1:], len(term)).tolist())}
        out = [(t, -1, int(x.max()), r, x) for t, (r, x) in lists.items()]
        for a, b in pairs:
            if a in lists and b in lists:
                r, x = intersect(*lists[a], *lists[b])
                best = np.argsort(-x, kind="stable")[:k]
                out.append((a, b, int(x.max(initial=0)), r[best], x[best]))
        # the rows' documents go along as a list without a term
        out.append((-1, -1, 0, np.arange(docs.num_rows), docs.column("doc_id").to_numpy()))
        a, b, top, rows, impacts = zip(*out)
        return pa.table([pa.array([chunk] * len(out), pa.int32()), pa.array(a, pa.int32()), pa.array(b, pa.int32()),
                         pa.array(top, pa.int64()), pa.array(rows, pa.list_(pa.int32())),
                         pa.array(impacts, pa.list_(pa.int64()))], names=["chunk", "a", "b", "top", "rows", "impacts"])
    return run


def pair_bounds(order: list[int], tops: dict[int, int], joint: dict[tuple[int, int], int]) -> list[int]:
    """``bounds[i]``: what the lists ``order[i:]`` add to one document at most.
    From the last list on, each is matched with the free later one that saves most:
    two matched lists add their joint maximum or the greater single one."""
    bounds, free = [0] * (len(order) + 1), set()
    for i in range(len(order) - 1, -1, -1):
        t, most, mate = order[i], 0, None
        for u in free:
            both = joint.get((min(t, u), max(t, u)))
            if both is not None:
                saved = tops[t] + tops[u] - max(tops[t], tops[u], both)
                if saved > most:
                    most, mate = saved, u
        bounds[i] = bounds[i + 1] + tops[t] - most
        free.add(t) if mate is None else free.discard(mate)
    return bounds


def search_chunk(lists: dict, joint: dict, item: list[int], n_rows: int, k: int, threshold: int = 0) -> tuple:
    """(rows, scores, postings looked at): the chunk's rows that may be among the
    item's k best, complete with every row of at least ``threshold`` and of the chunk's k-th score."""
    held = [t for t in item if t in lists]
    tops = {t: int(lists[t][1].max()) for t in held}
    order = sorted(held, key=lambda t: (-tops[t], t))
    bounds = pair_bounds(order, tops, joint)
    score = np.zeros(n_rows, np.int64)
    i = looked = 0
    while i < len(order) and bounds[i] >= max(threshold, 1):  # a row not met yet may still reach the threshold
        rows, impacts = lists[order[i]]
        score[rows] += impacts
        looked += len(rows)
        i += 1
        met = score[score > 0]
        if len(met) >= k:
            threshold = max(threshold, int(np.partition(met, len(met) - k)[len(met) - k]))
    rows = np.flatnonzero(score)
    for j in range(i, len(order)):
        rows = rows[score[rows] + bounds[j] >= threshold]
        other, impacts = lists[order[j]]
        few, many = (rows, other) if len(rows) <= len(other) else (other, rows)
        at = np.searchsorted(many, few)
        hit = at < len(many)
        hit[hit] = many[at[hit]] == few[hit]
        found, places = (rows[hit], at[hit]) if few is rows else (other[hit], np.flatnonzero(hit))
        score[found] += impacts[places]
        looked += len(few)
        if len(rows) >= k:
            s = score[rows]
            threshold = max(threshold, int(np.partition(s, len(s) - k)[len(s) - k]))
    return rows[score[rows] >= max(threshold, 1)], score, looked


def _search(shared, k: int):
    """Each item's best documents of one chunk."""
    def run(key: tuple[pa.Scalar, ...], index: pa.Table) -> pa.Table:
        items, thresholds = shared.value
        lists, joint, docs = {}, {}, np.empty(0, np.int64)
        for a, b, top, rows, impacts in zip(*(index.column(c) for c in ("a", "b", "top", "rows", "impacts"))):
            a, b = a.as_py(), b.as_py()
            if b >= 0:
                joint[a, b] = top.as_py()
            elif a >= 0:
                lists[a] = rows.values.to_numpy(), impacts.values.to_numpy()
            else:
                docs = impacts.values.to_numpy()
        out = [(np.empty(0, np.int64),) * 3]
        for item, held in items.items():
            rows, score, _ = search_chunk(lists, joint, held, len(docs), k, thresholds.get(item, 0))
            best = rows[np.lexsort((docs[rows], -score[rows]))][:k]
            out.append((np.full(len(best), item), docs[best], score[best]))
        return pa.table([pa.array(np.concatenate(c), pa.int64()) for c in zip(*out)], names=["item_id", "doc_id", "score"])
    return run


def item_terms(items: DataFrame) -> DataFrame:
    """(item_id, term): the distinct terms of each item."""
    lower = F.translate(F.col("text").cast("string"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return (items.where(F.col("item_id").isNotNull() & F.col("text").isNotNull())
            .select(F.col("item_id").cast("long").alias("item_id"), F.explode(F.split(lower, SIGNS)).alias("term"))
            .where(F.col("term") != "").distinct())


def item_blocks(items: DataFrame, block_terms: int = BLOCK_TERMS) -> list[dict[int, list[bytes]]]:
    """Items with their distinct terms, in blocks; few rows at a time reach the driver."""
    out, held, size = [], {}, 0
    for r in items.orderBy("item_id", "term").toLocalIterator():
        if size >= block_terms and r["item_id"] not in held:
            out, held, size = [*out, held], {}, 0
        held.setdefault(r["item_id"], []).append(r["term"].encode())
        size += 1
    return [*out, held] if held else out


def search_block(docs: DataFrame, items: dict[int, list[bytes]], k: int, chunk: int, reach: int) -> DataFrame:
    """(item_id, doc_id, score) of one block of items: the best of every chunk."""
    spark = docs.sparkSession
    ship_package(spark)
    vocabulary = sorted({t for held in items.values() for t in held})
    number = {t: i for i, t in enumerate(vocabulary)}
    items = {item: [number[t] for t in held] for item, held in items.items()}
    table = written(counted(docs, vocabulary).withColumn("row", F.monotonically_increasing_id()), "lexical-documents")
    total = table.agg(F.count(F.lit(1)).alias("N"), F.sum("n").alias("L")).first()
    if not total["N"]:
        return spark.createDataFrame([], "item_id long, doc_id long, score long")
    n = total["N"]
    w = F.floor(1000 * F.log(F.lit(float(2 * n + 2)) / (2 * F.col("df") + 1))).cast("long")
    weights = np.zeros(len(vocabulary), np.int64)
    for r in table.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("df")) \
            .select("t", w.alias("w")).collect():  # a row per term of the block
        weights[r["t"]] = r["w"]
    pairs = {item: item_pairs(held, weights, reach) for item, held in items.items()}
    chunks = max(1, -(-n // chunk))
    shared = spark.sparkContext.broadcast((weights, (n, total["L"]), sorted({p for ps in pairs.values() for p in ps})))
    dealt = table.select("doc_id", "n", "terms", "times", F.pmod(F.xxhash64("row"), F.lit(chunks)).cast("int").alias("chunk"))
    index = written(dealt.groupBy("chunk").applyInArrow(_index(shared, k), INDEX), "lexical-index")

    # the k-th best joint impact of a pair, or impact of a term, is reached by k documents
    best = Window.partitionBy("a", "b").orderBy(F.desc("x"))
    reached = (index.where("a >= 0").select("a", "b", F.explode(F.slice(F.reverse(F.array_sort("impacts")), 1, k)).alias("x"))
               .withColumn("_n", F.row_number().over(best)).where(F.col("_n") <= k).where(F.col("_n") == k).select("a", "b", "x"))
    floor = {(r["a"], r["b"]): r["x"] for r in reached.collect()}  # a row per term and pair of the block
    thresholds = {item: max([floor.get((t, -1), 0) for t in held] + [floor.get(p, 0) for p in pairs[item]])
                  for item, held in items.items()}
    asked = spark.sparkContext.broadcast((items, thresholds))
    return index.groupBy("chunk").applyInArrow(_search(asked, k), "item_id long, doc_id long, score long")


def search(docs: DataFrame, items: DataFrame, k: int = BEST, chunk: int = CHUNK, block_terms: int = BLOCK_TERMS,
           reach: int = PAIR_REACH) -> DataFrame:
    """The k best documents of each item: (item_id, rank, doc_id, score)."""
    spark = docs.sparkSession
    found = [search_block(docs, b, k, chunk, reach) for b in item_blocks(item_terms(items), block_terms)]
    if not found:
        return spark.createDataFrame([], RESULT)
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    best = Window.partitionBy("item_id").orderBy(F.desc("score"), "doc_id")
    return (every.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"))


def op11_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(documents(spark, sf_dir), read_table(spark, sf_dir, "benchmark"))
