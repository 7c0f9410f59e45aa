"""Session construction and lineage helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on.  ANSI stays on (the Spark 4 default); all
# divisions go through try_divide so a zero denominator yields NULL.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def cluster_conf(input_bytes: int, cores: int, partition_bytes: int = 256 << 20) -> dict:
    """Settings sized for a large cluster: about ``partition_bytes`` per scan
    split and per shuffle partition at the start, AQE coalescing what turns
    out smaller and splitting skewed join partitions.  For 100 TB of input
    and 256 MB partitions that is ~400k shuffle partitions before
    coalescing, never fewer than 3 waves of the available cores."""
    shuffle = max(3 * cores, -(-input_bytes // partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * partition_bytes),
    }


def apply_unset(spark: SparkSession, conf: dict) -> None:
    """Set only what the cluster's launch configuration leaves unset, e.g.
    ``apply_unset(spark, cluster_conf(input_bytes, cores))`` in a job."""
    launched = dict(spark.sparkContext.getConf().getAll())
    for k, v in conf.items():
        if k not in launched:
            spark.conf.set(k, v)


def build_session(master: str = "local[*]", app: str = "marketlens",
                  shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    """Local session for tests and the bench; clusters pass their own conf."""
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder, setting one only when unset.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used
    as is.  Only a bare local session (tests) gets a fresh scratch folder.
    Works without a SparkContext handle (Spark Connect) too: the folder is
    then only used for the files this package writes and reads back."""
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect sessions have no SparkContext handle
        sc = None
    if sc is not None and sc.getCheckpointDir():
        return sc.getCheckpointDir()
    if not conf_dir:
        master = sc.master if sc is not None else spark.conf.get("spark.master", "")
        if not master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        conf_dir = tempfile.mkdtemp(prefix="marketlens-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    if sc is None:
        return conf_dir
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the session's (shared) checkpoint folder for
    intermediate files a job writes and reads back."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/scratch/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as parquet under the shared checkpoint folder and
    read it back: later plans start from the files (lineage cut, computed
    once, survives executor loss) instead of recomputing ``df``."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def materialize_bucketed(df: DataFrame, name: str, buckets: int, *columns: str) -> DataFrame:
    """``materialize`` with the files dealt into ``buckets`` by a hash of
    ``columns``: windows, aggregations and joins on them read the files as
    they are, without an exchange.  The files lie under the shared checkpoint
    folder; the table that records the layout has a name of its own."""
    spark = df.sparkSession
    table = f"marketlens_{name.replace('-', '_')}_{uuid.uuid4().hex[:12]}"
    # a task with few buckets keeps their files open instead of sorting its rows
    open_files = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(open_files)
    spark.conf.set(open_files, "4")
    try:
        (df.write.bucketBy(buckets, *columns).option("compression", "zstd")
         .option("path", scratch_path(spark, name)).saveAsTable(table))
    finally:
        spark.conf.set(open_files, before)
    return spark.table(table)
