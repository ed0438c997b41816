"""Incremental Bronze ingest: a file stream over the landing tree.

The file source remembers which files it has processed in the checkpoint, so a
re-run only picks up new files, and the file sink commits each micro-batch
exactly once.  ``availableNow`` processes everything present and stops, in
bounded micro-batches (``max_files_per_trigger``), which is how a scheduled
daily catch-up runs without holding a cluster.
"""

from __future__ import annotations

import time
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ledgerline.operators.bronze import unify
from ledgerline.schemas import BRONZE_PARTITIONS, BRONZE_SCHEMA, LANDING_SCHEMA
from ledgerline.session import path_exists
from ledgerline.sources import landing
from ledgerline.sources.growth import grown_columns, known_columns
from ledgerline.sources.landing import product_path, with_landing_columns
from ledgerline.sources.tables import add_columns

# The file source skips files older than this against the newest one it has
# seen; the default of a week loses late or time-preserving copies silently.
# It remembers the names of all younger files, so without an archive it has to
# remember every file for ever.
MAX_FILE_AGE = "36500d"

# With an archive, files that were read leave the landing tree, so that a listing
# and the names remembered are those of this many days.  A file that is still
# there and older is one that was not read: it gets the present time first.
ARCHIVED_FILE_DAYS = 7

# The sink sorts the rows of a task by partition in memory.  By default Spark deals a
# batch's files over as many tasks as there are cores, so a task grows with the input;
# with these a task reads two small files or this much of larger ones, at least a row
# group (landed files have at most ``landing.ROWS_A_FILE`` rows).
TASK_FILES = {"spark.sql.files.maxPartitionBytes": "8m", "spark.sql.files.openCostInBytes": "4m"}


@contextmanager
def small_tasks(spark: SparkSession) -> Iterator[None]:
    """File scans planned inside read ``TASK_FILES`` a task (a stream's scans follow the session that made its reader)."""
    before = {k: spark.conf.get(k) for k in TASK_FILES}
    try:
        for k, v in TASK_FILES.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def finish(query: StreamingQuery, timeout_s: float | None) -> None:
    """Wait for the end of an availableNow query; a timeout is an error, not an end."""
    ended = query.awaitTermination(timeout_s) if timeout_s is not None else query.awaitTermination()
    if timeout_s is not None and not ended:
        query.stop()
        raise TimeoutError(f"stream did not finish within {timeout_s} s; part of the input is not processed")
    if query.exception() is not None:
        raise query.exception()


def landing_stream(
    spark: SparkSession,
    landing_root: str,
    product: str | None = None,
    max_files_per_trigger: int | None = None,
    extra: Sequence[T.StructField] = (),
    archive: str | None = None,
) -> DataFrame:
    """Streaming read of new landed Parquet files (both record kinds).

    With ``archive`` files are moved below that folder once the batch that read
    them is committed (at the latest by the next batch).
    """
    reader = (
        spark.readStream.schema(T.StructType([*LANDING_SCHEMA.fields, *extra]))
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .option("maxFileAge", f"{ARCHIVED_FILE_DAYS}d" if archive else MAX_FILE_AGE)
    )
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return with_landing_columns(reader.parquet(product_path(landing_root, product)))


def bronze_stream(
    spark: SparkSession,
    landing_root: str,
    product: str | None = None,
    max_files_per_trigger: int | None = None,
    extra: Sequence[T.StructField] = (),
    archive: str | None = None,
) -> DataFrame:
    """The Bronze rows of newly landed files (same transform as batch)."""
    landed = landing_stream(spark, landing_root, product, max_files_per_trigger, extra, archive)
    return unify(landed, extra=[f.name for f in extra])


def ingest(
    spark: SparkSession,
    landing_root: str,
    bronze_path: str,
    checkpoint_path: str,
    product: str | None = None,
    max_files_per_trigger: int | None = 1000,
    timeout_s: float | None = None,
    table: str | None = None,
    column_log: str | None = None,
    batches: int | None = None,
    archive: str | None = None,
) -> dict:
    """Append new landed files to the Bronze table at ``bronze_path`` and stop.

    With ``table`` the sink is that catalog table (created by
    :func:`ledgerline.sources.tables.create_bronze_table` or on first run)
    instead of the bare path.  With ``column_log`` columns that landed files have
    gained are appended too (see :mod:`ledgerline.sources.growth`); read the table
    with ``read_bronze(..., column_log=...)``.  ``batches`` ends the run after at
    least so many micro-batches although files may be left; the next run goes on
    from the checkpoint.  With ``archive`` (a folder outside the landing tree, on
    the same file system) files that were read are moved there, so the landing
    tree holds what is not read yet; unread files of any age are still read.
    Returns the last progress report (metadata); an empty dict when nothing has
    been landed for the selection yet.
    """
    source = product_path(landing_root, product)
    if not path_exists(spark, source):
        return {}
    extra = grown_columns(spark, source, column_log) if column_log else []
    if table and extra:
        add_columns(spark, table, extra)
    if archive:
        landing.renew_times(spark, source, days=ARCHIVED_FILE_DAYS / 2)
    writer = (
        bronze_stream(spark, landing_root, product, max_files_per_trigger, extra, archive)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint_path)
        .partitionBy(*BRONZE_PARTITIONS)
    )
    writer = writer.trigger(availableNow=True) if batches is None else writer.trigger(processingTime="0 seconds")
    with small_tasks(spark):
        query = writer.toTable(table) if table else writer.start(bronze_path)
        if batches is None:
            finish(query, timeout_s)
        else:
            _stop_after(query, batches, timeout_s)
    return query.lastProgress or {}


def _stop_after(query: StreamingQuery, batches: int, timeout_s: float | None) -> None:
    """Stop once ``batches`` micro-batches are committed or no files are left."""
    deadline = None if timeout_s is None else time.monotonic() + timeout_s
    while query.isActive:
        done = [p for p in query.recentProgress if p["numInputRows"] > 0]
        idle = query.lastProgress is not None and not query.status["isDataAvailable"]
        if len(done) >= batches or (done and idle and not query.status["isTriggerActive"]):
            break
        if deadline is not None and time.monotonic() > deadline:
            query.stop()
            raise TimeoutError(f"stream did not commit {batches} micro-batches within {timeout_s} s")
        query.awaitTermination(0.2)
    query.stop()
    if query.exception() is not None:
        raise query.exception()


def read_bronze(spark: SparkSession, bronze_path: str, column_log: str | None = None) -> DataFrame:
    """Batch read of the Bronze table (explicit schema: ``date=`` mixes days and months).

    With ``column_log`` the columns gained over time are read as well; files that
    were written before a column was known have NULL there.
    """
    extra = known_columns(spark, column_log) if column_log else []
    return spark.read.schema(T.StructType([*BRONZE_SCHEMA.fields, *extra])).parquet(bronze_path)


def bronze_row_count(spark: SparkSession, bronze_path: str) -> DataFrame:
    return read_bronze(spark, bronze_path).agg(F.count(F.lit(1)).alias("n"))
