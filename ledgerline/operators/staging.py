"""Lineage cuts and size-checked broadcasts.

``stage`` writes a DataFrame to a fresh folder under the shared checkpoint
directory and reads it back: the plan after it starts from files (it survives
lost executors and the optimizer sees the real size), and a result used more
than once is computed once.

``broadcast_if_small`` broadcasts only a side whose row count and stored size
were measured and found under both bounds; above them the join stays a
shuffle join (AQE can still split skewed partitions).  Both measurements read
a staged table (Parquet footers and the file listing), so they are cheap.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.session import scratch_path

# What we are willing to ship to every executor: at most this many rows and
# this many bytes of stored (compressed Parquet) data.
BROADCAST_MAX_ROWS = 1_000_000
BROADCAST_MAX_BYTES = 32 * 1024 * 1024


def stage_at(df: DataFrame, name: str = "stage") -> tuple[DataFrame, str]:
    """Write ``df`` as Parquet under the shared folder; return the read-back and its folder."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path), path


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` as Parquet under the shared folder and return the read-back."""
    return stage_at(df, name)[0]


def release(spark: SparkSession, path: str) -> None:
    """Delete a staged folder once every job that reads it has finished.

    Only for staging whose readers are done (nothing lazy still points at it).
    A no-op without a SparkContext (Connect clients); the folder is then left
    to the checkpoint folder's retention.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001
        return
    jpath = sc._jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(sc._jsc.hadoopConfiguration())
    if fs.exists(jpath):
        fs.delete(jpath, True)


def stored_bytes(df: DataFrame) -> int | None:
    """Spark's size estimate of ``df`` (for a staged table, its file sizes).

    None when the plan statistics are not reachable (Spark Connect client).
    """
    try:
        return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except Exception:  # noqa: BLE001
        return None


def broadcast_if_small(
    df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS, max_bytes: int = BROADCAST_MAX_BYTES
) -> tuple[DataFrame, int]:
    """Return (possibly broadcast-hinted df, measured row count).

    ``df`` should be staged (or otherwise cheap to count).
    """
    n = df.count()
    size = stored_bytes(df) if n <= max_rows else None
    # Without a size measurement, only a tenth of the row bound is trusted.
    small = n <= max_rows and (size <= max_bytes if size is not None else n <= max_rows // 10)
    return (F.broadcast(df) if small else df), n
