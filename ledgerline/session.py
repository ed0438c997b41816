"""Session construction and shared-storage scratch locations.

On a cluster the shared folder comes from ``spark.checkpoint.dir`` (set by the
operator of the cluster).  Only when it is unset -- local tests -- do we make a
folder of our own.  Nothing here ever writes to a machine-local path when the
cluster names a shared one.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter at scale.  AQE re-plans joins from measured sizes,
# coalesces tiny shuffle partitions and splits skewed ones; the rebalance hint
# used by the writers relies on it too.  Timestamps are UTC wall-clock values
# (extractors write naive UTC), and Parquet timestamps are written as
# microseconds so other engines read them.  Dynamic partition overwrite is set
# per write by the upsert, never session-wide.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
}


def build_session(
    master: str = "local[*]",
    shuffle_partitions: int = 8,
    app_name: str = "ledgerline",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Local session for tests and the bench; clusters bring their own."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("LEDGERLINE_DRIVER_MEMORY", "8g"))
    )
    for k, v in {**SCALE_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_scale_conf(spark)
    return spark


def apply_scale_conf(spark: SparkSession) -> None:
    """Apply the runtime SQL settings the library relies on (idempotent)."""
    for k, v in SCALE_CONF.items():
        spark.conf.set(k, v)
    ensure_checkpoint_dir(spark)


def _context(spark: SparkSession):
    """The SparkContext of a classic session; None for a Spark Connect client."""
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - Connect sessions have no SparkContext
        return None


def _local_folder(master: str) -> str:
    """A folder of our own, for local tests only; a cluster must name a shared one."""
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix="ledgerline-ckpt-")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting one only if none is named."""
    sc = _context(spark)
    if sc is None:
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if not configured:
        configured = _local_folder(sc.master)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def shared_root(spark: SparkSession) -> str:
    """Root folder for tables and staging that every executor can reach."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/ledgerline"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared root (never reused)."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def changed_at(spark: SparkSession, path: str) -> tuple[int, int] | None:
    """(modification time, length) of a file or folder; None where it is missing or not reachable (Connect)."""
    sc = _context(spark)
    if sc is None:
        return None
    jpath = sc._jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(sc._jsc.hadoopConfiguration())
    if not fs.exists(jpath):
        return None
    status = fs.getFileStatus(jpath)
    return status.getModificationTime(), status.getLen()


def path_exists(spark: SparkSession, path: str) -> bool:
    """True when ``path`` exists and is not an empty folder (any Hadoop file system)."""
    sc = _context(spark)
    if sc is None:  # Connect: ask a file listing instead of the JVM
        try:
            files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
            return not files.select("path").isEmpty()
        except Exception:  # noqa: BLE001 - missing path
            return False
    jpath = sc._jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(sc._jsc.hadoopConfiguration())
    return bool(fs.exists(jpath)) and len(fs.listStatus(jpath)) > 0
