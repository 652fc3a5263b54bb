"""Sources and sinks (A1-A10).

CSV and Parquet scans, create-or-replace writes, row counts, a catalog
summary, ordered named queries, a metrics document and a model store.  Paths
are any Hadoop URI (local, HDFS, object store); nothing here goes through the
driver's local disk.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .csv_records import read_records

METRICS_SCHEMA = "model string, metric string, value double"
PARAMS_SCHEMA = "model string, param string, value double"


# --- A1 / A2: CSV scan, absent sources skipped ----------------------------------

def path_exists(spark: SparkSession, path: str) -> bool:
    """Check through the Hadoop FileSystem of the path (works for any scheme)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(hpath))


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None,
             multi_line: bool = True) -> DataFrame:
    """Header row; an explicit schema when known, else types inferred from every
    row, so that no late value fails to fit.  A value that does not fit a given
    schema raises instead of turning into null.

    ``multi_line``: quoted values may hold line breaks; large files are still cut
    into many tasks (``csv_records``).  False takes every line for a record, which
    saves a pass over files known to have none.
    """
    if multi_line:
        return read_records(spark, path, schema)
    r = spark.read.option("header", "true").option("mode", "FAILFAST").option("escape", '"')
    return r.schema(schema).csv(path) if schema is not None else r.option("inferSchema", "true").csv(path)


def load_tables(spark: SparkSession, data_dir: str, tables: Sequence[tuple[str, str]],
                schemas: Mapping[str, StructType | str] | None = None,
                fmt: str = "csv", multi_line: bool = True) -> tuple[dict[str, DataFrame], list[str]]:
    """Read (name, file) pairs; absent files are skipped and
    reported, any other error is raised."""
    schemas = schemas or {}
    out: dict[str, DataFrame] = {}
    skipped: list[str] = []
    for name, file in tables:
        path = f"{data_dir.rstrip('/')}/{file}"
        if not path_exists(spark, path):
            skipped.append(name)
            continue
        out[name] = (read_csv(spark, path, schemas.get(name), multi_line) if fmt == "csv"
                     else spark.read.parquet(path))
    return out, skipped


# --- A3 / A4 / A8: create-or-replace, counts -------------------------------------

def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = (),
                fmt: str = "parquet") -> str:
    """Overwrite the target (drop then create), Parquet by default."""
    w = df.write.mode("overwrite").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
    return path


def save_as_table(df: DataFrame, name: str, bucket_by: str | None = None,
                  n_buckets: int | None = None, path: str | None = None) -> None:
    """Catalog table, at ``path`` if one is given; bucketing on the key lets later
    key joins skip a shuffle."""
    w = df.write.mode("overwrite").format("parquet")
    if path:
        w = w.option("path", path)
    if bucket_by and n_buckets:
        w = w.bucketBy(n_buckets, bucket_by).sortBy(bucket_by)
    w.saveAsTable(name)


def row_count(df: DataFrame) -> int:
    return int(df.count())


def write_counted(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> tuple[str, int]:
    """A3 + A4: write, then count the written Parquet with an empty projection
    (row-group metadata only, no column data), never re-running the plan.

    ``observe`` on the write would avoid even that, but on Spark 4.1 it fails
    to serialise for plans with broadcasts, so the written files are counted.
    """
    write_table(df, path, partition_by)
    return path, int(df.sparkSession.read.parquet(path).select().count())


# --- A5: catalog summary ----------------------------------------------------------

def catalog_summary(tables: Mapping[str, DataFrame]) -> DataFrame:
    """table_name, n_rows, n_columns for every table, as one frame."""
    parts = [df.agg(F.count(F.lit(1)).alias("n_rows"))
             .select(F.lit(name).alias("table_name"), "n_rows",
                     F.lit(len(df.columns)).alias("n_columns"))
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def catalog_tables_summary(spark: SparkSession, database: str | None = None) -> DataFrame:
    """A5 over the session catalog: every table of ``database`` with its row
    and column counts (one aggregate per table, unioned)."""
    names = [t.name for t in spark.catalog.listTables(database) if not t.isTemporary]
    if not names:
        return spark.createDataFrame([], "table_name string, n_rows long, n_columns int")
    prefix = f"{database}." if database else ""
    return catalog_summary({n: spark.table(prefix + n) for n in names})


def write_by_key(df: DataFrame, path: str, key: str, n_files: int,
                 partition_by: Sequence[str] = ()) -> str:
    """Range-partition on ``key`` and sort inside files, so each file covers a
    narrow key range and a single-key lookup (B7) skips the others through
    Parquet min/max statistics."""
    return write_table(df.repartitionByRange(n_files, key).sortWithinPartitions(key), path, partition_by)


def write_with_bloom(df: DataFrame, path: str, keys: Sequence[str], expected: int | None = None,
                     partition_by: Sequence[str] = ()) -> str:
    """Parquet with a Bloom filter on each of ``keys`` in every row group, so that an
    equality lookup (B7) skips row groups whose min/max range covers the key, too:
    tables not sorted on it, or looked up by several keys.  ``expected`` distinct
    values a row group decide a filter's size."""
    w = df.write.mode("overwrite").partitionBy(*partition_by)
    for key in keys:
        w = w.option(f"parquet.bloom.filter.enabled#{key}", "true")
        if expected:
            w = w.option(f"parquet.bloom.filter.expected.ndv#{key}", str(expected))
    w.parquet(path)
    return path


# --- A6: named queries to tables, in order ----------------------------------------

def run_named(queries: Mapping[str, Callable[[], DataFrame]], out_dir: str | None = None,
              views: bool = True) -> dict[str, DataFrame]:
    """Run (name, builder) pairs in order; each result becomes a temp view
    and, with ``out_dir``, a Parquet table read back for the next step."""
    done: dict[str, DataFrame] = {}
    for name, build in queries.items():
        df = build()
        if out_dir:
            path = write_table(df, f"{out_dir.rstrip('/')}/{name}")
            df = df.sparkSession.read.parquet(path)
        if views:
            df.createOrReplaceTempView(name)
        done[name] = df
    return done


# --- A9: metrics document -----------------------------------------------------------

def metrics_frame(spark: SparkSession, metrics: Mapping[str, Mapping[str, float]]) -> DataFrame:
    rows = [(m, k, float(v)) for m, d in metrics.items() for k, v in d.items()
            if isinstance(v, (int, float))]
    return spark.createDataFrame(rows, METRICS_SCHEMA)


def write_metrics(df: DataFrame, path: str) -> str:
    """Long (model, metric, value) rows as JSON lines, numbers as doubles."""
    df.select("model", "metric", F.col("value").cast("double")).coalesce(1) \
        .write.mode("overwrite").json(path)
    return path


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(METRICS_SCHEMA).json(path)


def params_frame(spark: SparkSession, model: str, params: Mapping[str, float]) -> DataFrame:
    """Best parameters kept apart from metrics."""
    return spark.createDataFrame([(model, k, float(v)) for k, v in params.items()], PARAMS_SCHEMA)


# --- A10: model and side-artifact store -------------------------------------------------

def save_artifacts(spark: SparkSession, base: str, models: Mapping[str, object] = (),
                   tables: Mapping[str, DataFrame] = (), docs: Mapping[str, object] = ()) -> dict:
    """Models through ML persistence, tables as Parquet, small documents as
    one-row JSON tables; returns the written paths."""
    paths = {}
    for name, m in dict(models).items():
        p = f"{base.rstrip('/')}/models/{name}"
        m.write().overwrite().save(p)
        paths[name] = p
    for name, df in dict(tables).items():
        paths[name] = write_table(df, f"{base.rstrip('/')}/tables/{name}")
    for name, doc in dict(docs).items():
        p = f"{base.rstrip('/')}/docs/{name}"
        spark.createDataFrame([(json.dumps(doc, sort_keys=True),)], "doc string") \
            .coalesce(1).write.mode("overwrite").text(p)
        paths[name] = p
    return paths


def read_doc(spark: SparkSession, path: str) -> object:
    row = spark.read.text(path).first()
    return json.loads(row[0]) if row else None
