"""Landing zone: partitioned Parquet writers, the ragged-tree reader, audits.

Layout (hive-style directories)::

    <root>/product=<p>/year=<Y>/month=<MM>/day=<DD>/part-*.parquet      usage
    <root>/product=estimated_cost/year=<Y>/month=<MM>/part-*.parquet    cost

The cost tree has no day level and a cost record carries a text month that
would collide with the ``month=`` directory, so the writer stores it as
``cost_month`` and the reader reads the whole tree with
``recursiveFileLookup`` (no partition discovery) and takes ``product`` from
the file path.

Writers use the ``rebalance`` hint on the partition columns: normally one file
per partition directory, but AQE splits a hot partition (say one day holding a
third of the rows) over several tasks instead of funnelling it through one.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.schemas import COST_PRODUCT, LANDING_SCHEMA
from ledgerline.session import path_exists

USAGE_PARTITIONS = ["product", "year", "month", "day"]
COST_PARTITIONS = ["product", "year", "month"]
PRODUCT_PATTERN = r"product=([^/]+)"
ROWS_A_FILE = 1_000_000  # at most; a reader's task gets a whole row group, however well it is compressed


def _write(df: DataFrame, root: str, partitions: list[str], mode: str, skip_empty: bool) -> int:
    """Write and return the number of rows written (observed by the write job)."""
    if skip_empty and df.isEmpty():
        return 0
    obs = Observation(f"landed-{uuid.uuid4().hex[:8]}")
    (
        df.observe(obs, F.count(F.lit(1)).alias("rows"))
        .hint("rebalance", *partitions)
        .write.mode(mode)
        .option("compression", "snappy")
        .option("maxRecordsPerFile", str(ROWS_A_FILE))
        .partitionBy(*partitions)
        .parquet(root)
    )
    return int(obs.get["rows"])


def _timestamped(df: DataFrame) -> DataFrame:
    """``extracted_at`` as a timestamp (ISO text is parsed; bad text -> NULL)."""
    if dict(df.dtypes).get("extracted_at") == "string":
        return df.withColumn("extracted_at", F.try_to_timestamp(F.col("extracted_at")))
    return df


def write_usage(usage: DataFrame, root: str, mode: str = "append", skip_empty: bool = True) -> int:
    """Land usage records partitioned by product and day; returns the rows written
    (0, and nothing written, for empty input)."""
    parts = F.split(F.col("date"), "-")
    df = _timestamped(usage).withColumns({"year": parts[0], "month": parts[1], "day": parts[2]})
    return _write(df, root, USAGE_PARTITIONS, mode, skip_empty)


def write_cost(cost: DataFrame, root: str, mode: str = "append", skip_empty: bool = True) -> int:
    """Land cost records partitioned by month (text month kept as ``cost_month``)."""
    parts = F.split(F.col("cost_month"), "-")
    df = _timestamped(cost).withColumnRenamed("month", "cost_month").withColumns(
        {"product": F.lit(COST_PRODUCT), "year": parts[0], "month": parts[1]}
    )
    return _write(df, root, COST_PARTITIONS, mode, skip_empty)


def product_path(root: str, product: str | None) -> str:
    """Directory of one product, or the whole tree for None / ``all``."""
    root = root.rstrip("/")
    return root if product in (None, "all") else f"{root}/product={product}"


NANOS_CONF = "spark.sql.legacy.parquet.nanosAsLong"


def _nanos_schema() -> T.StructType:
    return T.StructType(
        [T.StructField(f.name, T.LongType()) if f.name == "extracted_at" else f for f in LANDING_SCHEMA.fields]
    )


def read_landing(
    spark: SparkSession, root: str, product: str | None = None, nanos: bool = False
) -> DataFrame:
    """Read the landing tree (both record kinds) with the superset schema.

    Adds ``_source_file``; fills ``product`` from the path and ``month`` from
    ``cost_month``.  ``product`` scopes the scan to one product directory.

    ``nanos=True`` reads files whose ``extracted_at`` is a nanosecond Parquet
    timestamp (what pandas writes by default), which Spark cannot read as a
    timestamp: the column is read as a long and converted to microseconds.
    This sets ``spark.sql.legacy.parquet.nanosAsLong`` on the session (the
    reader consults it when the job runs, so it is left on; other nanosecond
    Parquet columns read in this session then also come back as longs).
    """
    if not path_exists(spark, product_path(root, product)):  # nothing landed yet
        empty = spark.createDataFrame([], LANDING_SCHEMA).drop("cost_month")
        return empty.withColumn("_source_file", F.lit(None).cast("string"))
    schema = _nanos_schema() if nanos else LANDING_SCHEMA
    if nanos:
        spark.conf.set(NANOS_CONF, "true")
    raw = (
        spark.read.schema(schema)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .parquet(product_path(root, product))
    )
    if nanos:
        raw = raw.withColumn("extracted_at", F.timestamp_micros(F.floor(F.col("extracted_at") / 1000)))
    return with_landing_columns(raw)


def migrate_landing(spark: SparkSession, src_root: str, dst_root: str, nanos: bool = True) -> None:
    """Rewrite a landing tree written elsewhere into this library's layout.

    Usage files keep their day partitions; cost files get ``cost_month``.
    Timestamps become microseconds.  One distributed job per record kind.
    """
    previous = spark.conf.get(NANOS_CONF, "false")
    try:
        landed = read_landing(spark, src_root, nanos=nanos)
        is_cost = F.col("cost_usd").isNotNull() & F.col("date").isNull()
        usage = landed.filter(~is_cost).select(
            "product", "date", "org_name", "metric_name", "value", "unit", "extracted_at"
        )
        cost = landed.filter(is_cost).select(
            "product_name", "charge_type", "cost_usd", "month", "org_name", "extracted_at"
        )
        write_usage(usage, dst_root)
        write_cost(cost, dst_root)
    finally:
        spark.conf.set(NANOS_CONF, previous)  # the jobs above have run


def with_landing_columns(raw: DataFrame) -> DataFrame:
    path = F.col("_metadata.file_path")
    return raw.withColumns(
        {
            "product": F.coalesce(
                F.col("product"), F.nullif(F.regexp_extract(path, PRODUCT_PATTERN, 1), F.lit(""))
            ),
            "month": F.coalesce(F.col("month"), F.col("cost_month")),
            "_source_file": path,
        }
    ).drop("cost_month")


def read_usage_landing(spark: SparkSession, root: str) -> DataFrame:
    """Read a usage-only tree with partition discovery (year/month/day as ints)."""
    return spark.read.option("basePath", root).parquet(root)


def file_audit(spark: SparkSession, root: str, product: str | None = None) -> DataFrame:
    """Landed files: path, size_bytes, last_modified (contents are not read).

    The product match is exact on the ``product=`` directory, so ``apm`` does
    not also list ``apm2``.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .load(root)
        .select(
            F.col("path"),
            F.col("length").alias("size_bytes"),
            F.col("modificationTime").alias("last_modified"),
        )
    )
    if product not in (None, "all"):
        files = files.filter(F.regexp_extract("path", PRODUCT_PATTERN, 1) == product)
    return files


def renew_times(spark: SparkSession, root: str, days: float) -> int:
    """Give landed files older than ``days`` the present modification time; returns their number.

    For a landing tree whose read files are archived: what is left there and old was
    brought late or by a time-preserving copy, and a file stream would pass it over.
    Only such files reach the driver.  (Object stores date a file by its upload, so
    there are none there; a file system that cannot set times raises.)
    """
    now = dt.datetime.now(dt.timezone.utc)
    old = file_audit(spark, root).where(F.col("last_modified") < F.lit(now - dt.timedelta(days=days)))
    paths = [r["path"] for r in old.select("path").collect()]
    sc = spark.sparkContext
    for path in paths:
        jpath = sc._jvm.org.apache.hadoop.fs.Path(path)
        fs = jpath.getFileSystem(sc._jsc.hadoopConfiguration())
        fs.setTimes(jpath, int(now.timestamp() * 1000), -1)
    return len(paths)


PERIOD_PATTERN = r"/year=(\d+)/month=(\d+)(?:/day=(\d+))?/"


def _same_form(path):
    """A file's path however many slashes follow its scheme."""
    return F.regexp_replace(path, "^([A-Za-z][A-Za-z0-9+.-]*):/+", "$1:/")


def file_period(path):
    """The day (usage) or month (cost) that a landed file's directory names."""
    part = [F.nullif(F.regexp_extract(path, PERIOD_PATTERN, i), F.lit("")) for i in (1, 2, 3)]
    return F.concat_ws("-", *part)


def file_row_counts(landed: DataFrame) -> DataFrame:
    """Rows per landed file (what the source system kept as object metadata)."""
    return landed.groupBy("product", "_source_file").agg(F.count(F.lit(1)).alias("rows"))


def described_files(spark: SparkSession, root: str) -> DataFrame:
    """path, product, period, rows, size_bytes, created_at of every landed file.

    The listing names the files; their rows are counted without reading a column
    (row counts of the Parquet row groups).  A file without rows is listed with 0.
    """
    listed = file_audit(spark, root).withColumn("path", _same_form(F.col("path")))
    read = spark.read.schema(LANDING_SCHEMA).option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
    rows = read.parquet(root).groupBy(_same_form(F.col("_metadata.file_path")).alias("path")).count()
    return listed.join(rows, "path", "left").select(
        "path",
        F.regexp_extract("path", PRODUCT_PATTERN, 1).alias("product"),
        file_period(F.col("path")).alias("period"),
        F.coalesce("count", F.lit(0)).alias("rows"),
        "size_bytes",
        F.col("last_modified").alias("created_at"),
    )


# The manifest of a landing tree: one row per file with the tag of the run that
# landed it.  Its folder starts with an underscore, so readers of the tree skip it.
MANIFEST = "_manifest"
MANIFEST_SCHEMA = (
    "path string, product string, period string, rows long, size_bytes long, created_at timestamp, "
    "pipeline string, run_tag string"
)
PIPELINE = "ledgerline"


def read_manifest(spark: SparkSession, root: str) -> DataFrame:
    path = f"{root.rstrip('/')}/{MANIFEST}"
    if not path_exists(spark, path):
        return spark.createDataFrame([], MANIFEST_SCHEMA)
    return spark.read.schema(MANIFEST_SCHEMA).parquet(path)


def record_run(spark: SparkSession, root: str, run_tag: str, pipeline: str = PIPELINE) -> int:
    """Enter the files that the manifest does not know yet, tagged with ``run_tag``; returns their number.

    Run after a landing write.  Repeating it changes nothing.
    """
    root = root.rstrip("/")
    if not path_exists(spark, root):
        return 0
    known = read_manifest(spark, root).select("path")
    new = described_files(spark, root).join(known, "path", "left_anti")
    new = new.withColumns({"pipeline": F.lit(pipeline), "run_tag": F.lit(run_tag)})
    obs = Observation(f"manifest-{uuid.uuid4().hex[:8]}")
    new.observe(obs, F.count(F.lit(1)).alias("files")).write.mode("append").parquet(f"{root}/{MANIFEST}")
    return int(obs.get["files"])


def load_summary(landed: DataFrame) -> DataFrame:
    """Per product: number of landed files and rows (from ``_source_file``)."""
    return landed.groupBy("product").agg(
        F.countDistinct("_source_file").alias("files"), F.count(F.lit(1)).alias("rows")
    )


def dry_run_counts(records: DataFrame) -> DataFrame:
    """What a run would land, per product, without writing anything."""
    return records.groupBy("product").agg(F.count(F.lit(1)).alias("n"))


def batch_periods(bronze: DataFrame) -> DataFrame:
    """Distinct (product, period) a batch covers, sorted: days for usage, months for cost."""
    return bronze.select("product", F.col("date").alias("period")).distinct().orderBy("product", "period")
