"""Session construction and lineage helpers.

The library never creates its own session inside an operator: every function
takes a ``SparkSession`` or a ``DataFrame``.  ``local_session`` is only for
tests, benchmarks and the command line.
"""

from __future__ import annotations

import os
import tempfile
import threading
import uuid

from pyspark.sql import DataFrame, SparkSession

# Tables of the driver fixture set, one parquet file each.
TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "riskspark", extra: dict[str, str] | None = None) -> SparkSession:
    """Session for tests and local runs: AQE on, UI off, UTC clock."""
    builder = SparkSession.builder
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = (
        builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # split a hot join key even when an aggregate right after needs a shuffle
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("RISKSPARK_DRIVER_MEMORY", "16g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def cluster_settings(total_cores: int, shuffle_bytes: int) -> dict[str, str]:
    """Suggested settings for a large cluster (not applied automatically: a
    cluster's own configuration wins).  Partitions are sized to about 256 MB
    of shuffle data each, at least 3 per core; AQE coalesces small ones and
    splits skewed join partitions at run time."""
    target = 256 * 1024 * 1024
    parts = max(3 * total_cores, shuffle_bytes // target)
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.shuffle.partitions": str(int(parts)),
        "spark.sql.files.maxPartitionBytes": str(target),
        "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    }


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint directory, setting one only where none is named.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used
    as is.  Only when nothing is configured (a bare local test session) is a
    fresh scratch folder taken.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="riskspark-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


_SHIPPED: set[str] = set()
_SHIP_LOCK = threading.Lock()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers (once per context).

    Arrow UDFs (``mapInPandas``) run library code on executors; a cluster
    normally ships it with ``--py-files``.  When the workers cannot already
    import it, the package is zipped and added with ``addPyFile`` (Spark's
    file server distributes it).
    """
    sc = spark.sparkContext
    app = sc.applicationId
    with _SHIP_LOCK:  # search trials call this from several driver threads
        if app in _SHIPPED:
            return
        import shutil
        pkg = os.path.dirname(os.path.abspath(__file__))
        staging = tempfile.mkdtemp(prefix="riskspark-pyfiles-")
        archive = shutil.make_archive(os.path.join(staging, "riskspark"), "zip",
                                      root_dir=os.path.dirname(pkg), base_dir=os.path.basename(pkg))
        try:
            sc.addPyFile(archive)
        except Exception as e:  # already shipped to this context under another path
            if "already registered" not in str(e):
                raise
        _SHIPPED.add(app)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for written intermediates."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/riskspark/{name}"


_TEMPORARY: dict[str, list[str]] = {}


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage with a table in the shared folder, read back.

    Used where a frame feeds several jobs (fitted parameters, the training
    frame of a search) so executor loss re-reads files instead of
    recomputing the whole plan.  Readers prune its columns and push filters
    into it.  ``drop_temporary`` deletes the tables when a run is over.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"tables/{uuid.uuid4().hex}")
    df.write.parquet(path)
    _TEMPORARY.setdefault(spark.sparkContext.applicationId, []).append(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_temporary(spark: SparkSession) -> int:
    """Delete the tables ``materialize`` wrote in this application; frames that
    read them cannot be used afterwards.  Returns how many there were."""
    paths = _TEMPORARY.pop(spark.sparkContext.applicationId, [])
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        hpath = jvm.org.apache.hadoop.fs.Path(path)
        hpath.getFileSystem(conf).delete(hpath, True)
    return len(paths)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
