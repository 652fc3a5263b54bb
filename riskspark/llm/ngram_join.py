"""N-gram Jaccard join by grouped prefixes: near-duplicate components.

A document is the set of its distinct 4-word shingles; two documents link when
100 * intersection >= 85 * union.  Sets that can link share a shingle among the
first ``n - ceil(0.85 n) + 1`` of each in one global order.  That order is rare
first, by a fixed-size count sketch over all documents, so that passages which
many documents share come last; any order is right, a good one is fast.

1. Equal sets become one class, kept by its smallest doc_id.
2. Classes with the same size and prefix become one group (the grouped prefix
   join); only one prefix per group is posted.
3. Round one verifies a linear number of pairs: in each posting list its first
   group with every other and neighbours with each other, and in each group its
   first member with the others.  Links join components.
4. Round two expands what is left: pairs of members of different components
   that share postings, filtered by size and by the number of shared prefix
   shingles, then verified.  Pairs inside a component need no verification, as
   they could not change it.  After it every link between different components
   has been verified, so the components are exact.

Verification reads the whole texts of candidate documents again and compares
full sets.  Hashes of shingles are 64 bits, signatures of sets 128.

Defined cases: null, empty or blank text has no shingles and links with nothing;
fewer than four words are one shingle; rows without a doc_id are left out;
repeated rows give a row each, and rows sharing a doc_id count as one node; an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import COUNTS, SMALL_BLOCK, blocks, counts_batch, documents, map_arrow, summed_counts, texts, without_ids, written
from .components import connected
from .wordhash import U, Words, mix, runs

WIDTH = 4
PERCENT = 85
#: The count sketch has 2 ** SKETCH_BITS counters whatever the corpus.
SKETCH_BITS = 22
SKETCH_ROWS = 16
#: Pairs of one document verified by one task at most, about.
PARTNERS = 512
#: Candidate ids (8 bytes each) sent to every task; with more, texts are joined to them.
LISTED = 4_000_000

SETS = "doc_id long, shingles binary"


def shingle_sets(column: pa.Array, width: int, lower: bool = True) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    words = Words(column, lower=lower)
    hashes = words.hashes()
    shingles = runs(hashes, width)
    out = []
    bounds = words.bounds.tolist()
    for lo, hi in zip(bounds, bounds[1:]):
        if hi - lo >= width:
            out.append(np.unique(shingles[lo:hi - width + 1]))
        elif hi > lo:
            out.append(runs(hashes[lo:hi], hi - lo, seed=width + 1))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def _bucket(shingles: np.ndarray, bits: int) -> np.ndarray:
    return (shingles >> U(64 - bits)).astype(np.int64)


def _count_rows(width: int, bits: int):
    def run(batches):
        counts = np.zeros(1 << bits, np.int64)
        for batch in blocks(batches, limit=SMALL_BLOCK):
            sets = shingle_sets(batch.column("text"), width)
            np.add.at(counts, _bucket(np.concatenate(sets), bits), 1)  # in place: no second array of counters
        if counts.any():
            yield counts_batch(dict(enumerate(counts.reshape(SKETCH_ROWS, -1))))
    return run


def frequency_levels(docs: DataFrame, width: int = WIDTH, bits: int = SKETCH_BITS) -> np.ndarray:
    """Level (0 to 63, steps of half a doubling) of each of 2**bits counters of
    documents per shingle.  Tasks send one compressed sketch each; sums are
    taken in two steps of streaming tasks, and only the fixed-size result
    reaches the driver."""
    rows = map_arrow(docs.select("text"), _count_rows(width, bits), COUNTS)
    counts = np.zeros((SKETCH_ROWS, (1 << bits) // SKETCH_ROWS), np.int64)
    for part, x in summed_counts(rows, SKETCH_ROWS).items():  # 2**bits counters
        counts[part] = x
    return np.minimum(63, np.floor(2 * np.log2(counts.reshape(-1) + 1))).astype(np.uint8)


def prefix_length(n, percent: int = PERCENT):
    return n - (percent * n + 99) // 100 + 1


def _signatures(width: int, percent: int, bits: int, shared):
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("sig1", pa.int64()), ("sig2", pa.int64()),
                        ("prefix", pa.list_(pa.int64()))])

    def run(batches):
        levels = shared.value
        for batch in blocks(batches, limit=SMALL_BLOCK):
            sets = shingle_sets(batch.column("text"), width)
            n = np.array([len(s) for s in sets])
            sig1, sig2, prefixes, sizes = [], [], [], []
            for s in sets:
                k = prefix_length(len(s), percent) if len(s) else 0
                sig1.append(mix(s ^ U(0x5851F42D4C957F2D)).sum(dtype=np.uint64))
                sig2.append(mix(s ^ U(0x14057B7EF767814F)).sum(dtype=np.uint64))
                order = (levels[_bucket(s, bits)].astype(np.uint64) << U(57)) | ((s << U(6)) >> U(7))
                prefixes.append(np.sort(np.partition(order, k - 1)[:k]) if 0 < k < len(s) else np.sort(order[:k]))
                sizes.append(k)
            bounds = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            flat = np.concatenate(prefixes).astype(np.int64)
            yield pa.record_batch([batch.column("doc_id"), pa.array(n, pa.int64()),
                                   pa.array(np.array(sig1, np.uint64).view(np.int64)),
                                   pa.array(np.array(sig2, np.uint64).view(np.int64)),
                                   pa.ListArray.from_arrays(pa.array(bounds), pa.array(flat))], schema=schema)
    return run


def _sets(width: int, shared=None):
    def run(batches):
        for batch in blocks(batches, limit=SMALL_BLOCK):
            if shared is not None:
                batch = batch.filter(pa.array(np.isin(batch.column("doc_id").to_numpy(), shared.value)))
                if not batch.num_rows:
                    continue
            sets = shingle_sets(batch.column("text"), width)
            yield pa.record_batch([batch.column("doc_id"), pa.array([s.tobytes() for s in sets], pa.binary())],
                                  names=["doc_id", "shingles"])
    return run


def _verify(percent: int):
    """Rows sorted by (a, b) where b = -1 carries a's own set and others b's set."""
    def run(batches):
        owner, own = None, None
        for batch in batches:
            a, b, sets = (c.to_pylist() for c in batch.columns)
            out = ([], [])
            for x, y, raw in zip(a, b, sets):
                s = np.frombuffer(raw, np.uint64)
                if y < 0:
                    owner, own = x, s
                elif x == owner:
                    common = len(np.intersect1d(own, s, assume_unique=True))
                    if common and 100 * common >= percent * (len(own) + len(s) - common):
                        out[0].append(x)
                        out[1].append(y)
            yield pa.record_batch([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64())], names=["a", "b"])
    return run


def verified(docs: DataFrame, pairs: DataFrame, width: int, percent: int) -> DataFrame:
    """The (a, b) of ``pairs`` whose full sets link.  Each pair moves one set."""
    ids = written(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "candidate-ids")
    if ids.count() <= LISTED:  # texts of other documents need not travel
        listed = np.sort(ids.toPandas()["doc_id"].to_numpy(np.int64))
        found = map_arrow(docs, _sets(width, docs.sparkSession.sparkContext.broadcast(listed)), SETS)
    else:
        found = map_arrow(docs.join(ids, "doc_id", "left_semi"), _sets(width), SETS)
    sets = written(found.dropDuplicates(["doc_id"]), "shingle-sets")
    # a set with many partners is dealt out over salts, its own set to each of them
    share = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / PARTNERS).alias("salts"))
    salted = pairs.join(share, "a").withColumn("salt", F.pmod("b", "salts")).drop("salts")
    others = salted.join(sets, F.col("b") == F.col("doc_id")).select("a", "salt", "b", "shingles")
    owners = (salted.select("a", "salt").distinct().join(sets, F.col("a") == F.col("doc_id"))
              .select("a", "salt", F.lit(-1).cast("long").alias("b"), "shingles"))
    rows = (owners.unionByName(others).repartition("a", "salt").sortWithinPartitions("a", "salt", "b")
            .select("a", "b", "shingles"))
    return map_arrow(rows, _verify(percent), "a long, b long")


def overlap(na, nb, percent: int):
    """Shingles that sets of these sizes must share to link."""
    return F.ceil(percent * (na + nb) / (100 + percent))


def may_link(na, nb, percent: int):
    """Sizes alone allow a link."""
    return (100 * na >= percent * nb) & (100 * nb >= percent * na)


def first_shared(na, posa, nb, posb, percent: int):
    """A shared shingle at these places of the order can be a linking pair's
    first: what follows suffices on both sides.  Linking pairs have such a one."""
    need = overlap(na, nb, percent)
    return (na - posa >= need) & (nb - posb >= need)


def enough_shared(pairs: DataFrame, prefixes: DataFrame, percent: int) -> DataFrame:
    """The (a, b) whose prefixes share enough: of the prefix that ends first, no
    shingle outside the shared ones is in the other set."""
    a, b = (prefixes.select(F.col("rep").alias(s), F.col("n").alias("n" + s), F.col("prefix").alias("p" + s))
            for s in ("a", "b"))

    def rest(n):
        return n - prefix_length_column(n, percent)

    shared = F.size(F.array_intersect("pa", "pb"))
    most = shared + F.when(F.element_at("pa", -1) <= F.element_at("pb", -1), rest(F.col("na"))).otherwise(
        rest(F.col("nb")))
    return (pairs.join(a, "a").join(b, "b").where(most >= overlap(F.col("na"), F.col("nb"), percent))
            .select("a", "b"))


def near_duplicates(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of documents (doc_id, text)."""
    spark = docs.sparkSession
    docs = texts(docs)
    levels = spark.sparkContext.broadcast(frequency_levels(docs, width))
    signed = written(map_arrow(docs, _signatures(width, percent, SKETCH_BITS, levels),
                               "doc_id long, n long, sig1 long, sig2 long, prefix array<long>"), "signatures")
    key = ["n", "sig1", "sig2"]
    classes = written(signed.where("n > 0").groupBy(*key).agg(F.min("doc_id").alias("rep")), "classes")
    # one prefix per class, then one per (size, prefix)
    prefixes = (signed.where("n > 0").join(classes.withColumnRenamed("rep", "doc_id"), ["doc_id", *key], "left_semi")
                .select(F.col("doc_id").alias("rep"), "n", "prefix").dropDuplicates(["rep"]))
    reps = prefixes.select("rep", "n", "prefix", F.xxhash64("prefix").alias("p1"),
                           F.xxhash64(F.lit(7), "prefix").alias("p2"))
    grouped = reps.groupBy("n", "p1", "p2").agg(
        F.min(F.struct("rep", "prefix")).alias("first"), F.count(F.lit(1)).alias("members"))
    groups = written(grouped.select(F.col("first.rep").alias("gid"), "n", "p1", "p2", "members",
                                    F.col("first.prefix").alias("prefix")), "groups")
    multiple = groups.where("members > 1").select("n", "p1", "p2", "gid")
    inside = written(reps.select("rep", "n", "p1", "p2").join(multiple, ["n", "p1", "p2"])
                     .select("gid", "rep", "n"), "members")
    # posting lists of at least two groups
    lists = Window.partitionBy("token").orderBy("gid")
    posted = (groups.select("gid", "n", F.posexplode("prefix").alias("pos", "token"))
              .select("*", F.lag(F.struct("gid", "n")).over(lists).alias("prev"),
                      F.lead("gid").over(lists).alias("next"),
                      F.first(F.struct("gid", "n")).over(lists).alias("head")))
    posted = written(posted.where("prev is not null or next is not null")
                     .select("token", "gid", "n", "pos", "prev", "head"), "postings")
    near = (posted.where("prev is not null")
            .select("gid", "n", F.explode(F.array("prev", "head")).alias("other"))
            .where(may_link(F.col("n"), F.col("other.n"), percent))
            .groupBy(F.col("other.gid").alias("a"), F.col("gid").alias("b"))
            .agg(F.count(F.lit(1)).alias("c"), F.first("n").alias("n"))
            .where(F.col("c") * 8 >= prefix_length_column(F.col("n"), percent)).select("a", "b"))
    own = inside.where("rep <> gid").select(F.col("gid").alias("a"), F.col("rep").alias("b"))
    first = written(near.unionByName(own).distinct(), "pairs-1")
    links = written(verified(docs, first, width, percent), "links-1")
    component = connected(links, "a", "b")
    # what is left: members of different components in one list
    member = (groups.select(F.col("gid").alias("rep"), "gid").unionByName(
        inside.where("rep <> gid").select("rep", "gid")))
    member = (member.join(component.select(F.col("node").alias("rep"), "component"), "rep", "left")
              .select("gid", "rep", F.coalesce("component", "rep").alias("component")))
    entries = written(
        posted.select("token", "gid", "n", "pos").join(member, "gid").select("token", "rep", "n", "pos", "component")
        .unionByName(inside.where("rep = gid").select(F.xxhash64(F.lit("group"), "gid").alias("token"), "gid", "n")
                     .join(member, "gid").select("token", "rep", "n", F.lit(0).alias("pos"), "component")), "entries")
    mixed = (entries.groupBy("token").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
             .where("lo <> hi").select("token"))
    entries = entries.join(mixed, "token", "left_semi")
    a, b = (entries.select("token", *[F.col(c).alias(c + s) for c in ("rep", "n", "pos", "component")])
            for s in ("a", "b"))
    pairs = (a.join(b, "token").where("repa < repb and componenta <> componentb")
             .where(first_shared(F.col("na"), F.col("posa"), F.col("nb"), F.col("posb"), percent))
             .groupBy(F.col("repa").alias("a"), F.col("repb").alias("b")).agg(F.count(F.lit(1)).alias("tokens")))
    second = written(enough_shared(pairs.select("a", "b").join(first, ["a", "b"], "left_anti"), prefixes, percent),
                     "pairs-2")
    more = written(verified(docs, second, width, percent).unionByName(links), "links-2")
    component = connected(more, "a", "b")
    found = (classes.join(component.select(F.col("node").alias("rep"), "component"), "rep", "left")
             .select(*key, F.coalesce("component", "rep").alias("component")))
    return (signed.drop("prefix").join(found, key, "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.coalesce("component", "doc_id").alias("component_id")))


def prefix_length_column(n, percent: int = PERCENT):
    return n - F.floor((percent * n + 99) / 100) + 1


def one_of_each(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one document of each component, its smallest doc_id; of rows
    sharing a doc_id the first by text stays; rows without a doc_id stay."""
    found = written(near_duplicates(docs, width, percent), "components")
    kept = without_ids(docs, found.where("doc_id <> component_id").select("doc_id").distinct())
    again = written(found.groupBy("doc_id").count().where("count > 1").select("doc_id"), "repeated-ids")
    if again.limit(1).count() == 0:
        return kept
    twice = kept.join(again.select(F.col("doc_id").alias("_again_id")),
                      kept["doc_id"].cast("long") == F.col("_again_id"))
    first = Window.partitionBy("_again_id").orderBy(F.xxhash64("text"), "text")
    twice = twice.withColumn("_nth", F.row_number().over(first)).where("_nth = 1").select(*docs.columns)
    return without_ids(kept, again).unionByName(twice)


def op9_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir))
