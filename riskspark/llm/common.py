"""Helpers shared by the operators: written intermediates, narrow reads."""

from __future__ import annotations

import ctypes
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import read_table, scratch_path, ship_package

#: Texts of one block handled at once in a task, in bytes; a single longer text is its own block.
BLOCK_BYTES = 4 << 20
#: The same where a block takes many times its size in memory.
SMALL_BLOCK = 1 << 20
#: Bytes of the Arrow batches that tasks and their Python workers exchange.
BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


#: Paths that ``written`` collects for the stage being built, if one is.
_COLLECTED: list[str] | None = None


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared checkpoint folder and read it
    back: later jobs, and tasks rerun after a lost executor, read the files
    instead of computing the plan again."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm/{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    if _COLLECTED is not None:
        _COLLECTED.append(path)
    return spark.read.schema(df.schema).parquet(path)


#: Tables of the last stage built in each application.
_STAGE: dict[str, list[str]] = {}


def stage_of(build):
    """A pipeline stage whose intermediate tables go when the next one is built: by
    then its result is written.  Two stages of one application are not built at once."""
    def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        global _COLLECTED
        conf, app = spark.sparkContext._jsc.hadoopConfiguration(), spark.sparkContext.applicationId
        for path in _STAGE.pop(app, []):
            old = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            old.getFileSystem(conf).delete(old, True)
        _COLLECTED = []
        try:
            return build(spark, docs, sf_dir)
        finally:
            _STAGE[app], _COLLECTED = _COLLECTED, None
    stage.__name__, stage.__doc__ = build.__name__, build.__doc__
    return stage


def texts(docs: DataFrame) -> DataFrame:
    """(doc_id long, text string) of documents, null text as empty.  Only these
    two columns are read, so other columns, whatever their names, are ignored;
    rows without a doc_id cannot be reported and are left out."""
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
            .where(F.col("doc_id").isNotNull()))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents")


def give_back() -> None:
    """Return memory that Arrow and the C library keep for later to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc
    if trim:
        trim(0)


def small_batches(spark: SparkSession) -> None:
    """Batches of a block's size, unless the session names another: by default one
    holds up to 64 MB, which the JVM (outside its heap) and the worker keep for as
    long as one of its blocks is in use.  Plans read the setting when they run."""
    if BATCH not in spark.conf.getAll:
        spark.conf.set(BATCH, str(BLOCK_BYTES))


def map_arrow(df: DataFrame, fn, schema: str | T.StructType) -> DataFrame:
    """``mapInArrow`` with the package shipped to the workers, in small batches.  A task
    gives its memory back when it ends: its worker waits beside those of later stages."""
    ship_package(df.sparkSession)
    small_batches(df.sparkSession)

    def run(batches):
        yield from fn(batches)
        give_back()
    return df.mapInArrow(run, schema)


def blocks(batches, column: str = "text", limit: int = BLOCK_BYTES):
    """Cut Arrow record batches into tables whose ``column`` holds about
    ``limit`` bytes at most (one longer value stands alone)."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        i = batch.schema.get_field_index(column)
        size = batch.column(i).nbytes
        if size <= limit:
            yield batch
            continue
        sizes = pa.compute.binary_length(batch.column(i)).to_pylist()
        start = total = 0
        for k in range(n):
            s = sizes[k] or 0
            if k > start and total + s > limit:
                yield batch.slice(start, k - start)
                start, total = k, 0
            total += s
        yield batch.slice(start, n - start)


COUNTS = "part int, counts binary"


def counts_batch(parts: dict[int, np.ndarray]) -> pa.RecordBatch:
    """Counter arrays of 64-bit integers as compressed rows (``COUNTS``)."""
    pack = zstandard.ZstdCompressor(level=1).compress
    return pa.record_batch([pa.array(list(parts), pa.int32()),
                            pa.array([pack(np.ascontiguousarray(x).tobytes()) for x in parts.values()], pa.binary())],
                           names=["part", "counts"])


def _add_counts(batches):
    total, unpack = {}, zstandard.ZstdDecompressor().decompress
    for batch in batches:
        for part, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            x = np.frombuffer(unpack(raw), np.int64)
            total[part] = total[part] + x if part in total else x
    if total:
        yield counts_batch(total)


def summed_counts(rows: DataFrame, parts: int) -> dict[int, np.ndarray]:
    """Sum rows of ``COUNTS`` (``parts`` arrays of fixed size, one set per task)
    in two steps of streaming tasks; only the fixed-size sums reach the driver."""
    for salts in (16, 1):
        rows = map_arrow(rows.repartition(parts, "part", F.pmod(F.spark_partition_id(), F.lit(salts))), _add_counts, COUNTS)
    unpack = zstandard.ZstdDecompressor().decompress
    return {r["part"]: np.frombuffer(unpack(bytes(r["counts"])), np.int64) for r in rows.collect()}


def first_by_hash(df: DataFrame, n: int, *columns: str) -> DataFrame:
    """The ``n`` rows first in the order of the hash of ``columns``, then ``columns``.

    A plain top n would send up to n rows of every partition to one task.  Rows
    are filtered on the hash first, to about 3 n; these are the first ones in the
    same order, so the result is the same."""
    rows = df.withColumn("_hash", F.xxhash64(*columns))
    share = 3 * n / max(df.count(), 1)
    if share < 1:
        few = rows.where(F.col("_hash") < F.lit(-(1 << 63) + int(share * (1 << 64))))
        rows = few if few.count() >= n else rows
    return rows.orderBy("_hash", *columns).limit(n).drop("_hash")


#: Rows of (id, few short values) that may be broadcast; larger frames are shuffled instead.
SMALL_ROWS = 500_000


def small(df: DataFrame, limit: int = SMALL_ROWS) -> DataFrame:
    """``df`` (written already) marked for broadcast if it has at most ``limit`` rows."""
    return F.broadcast(df) if df.count() <= limit else df


def without_ids(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose doc_id is not among ``ids`` (column doc_id, written already)."""
    gone = small(ids.select(F.col("doc_id").alias("_gone_id")))
    return docs.join(gone, docs["doc_id"].cast("long") == F.col("_gone_id"), "left_anti")


def with_text(docs: DataFrame, joined: DataFrame, text) -> DataFrame:
    """Columns of ``docs`` from ``joined`` with the new ``text``, n_chars following it."""
    out = joined.withColumn("_new_text", text)
    kinds = dict(docs.dtypes)
    return out.select(*[
        F.col("_new_text").alias(c) if c == "text"
        else F.when(F.col("_new_text").isNull() | (F.col("_new_text") == joined["text"]), joined[c])
        .otherwise(F.length("_new_text")).cast(kinds[c]).alias(c) if c == "n_chars" else joined[c]
        for c in docs.columns])
