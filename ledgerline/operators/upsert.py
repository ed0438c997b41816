"""Keyed upsert (MERGE: update matched, insert unmatched) on a partitioned
Parquet table, path based.

Plan
----
1. Deduplicate the source on the key (a MERGE with several source rows for
   one target row is ill-defined) and stage it (lineage cut; it is used three
   times below).
2. Touched partitions = distinct partition values of the source (table
   metadata of the same order as the directories this merge is about to write).
   They become one set membership test on the partition columns, which the file
   index evaluates per directory before any file is opened.  The cost follows
   the number of touched partitions, few or many: there is no size above which
   the whole target is read.
3. Target rows of touched partitions without a matching source key
   (left-anti join on the key, ``=`` or null-safe ``<=>``) plus all source
   rows = the new content of the touched partitions.  The source side of the
   anti-join is broadcast only when its measured size allows; otherwise it is
   a shuffle join and AQE splits skewed keys.
4. The new content is written with dynamic partition overwrite, which may read
   the table that it writes (the job's files replace the old ones when it
   commits): untouched partitions are never rewritten and touched ones are
   written once.  The staged source is then deleted (``release_staging``), so a
   merge leaves no copy behind.

Not atomic for concurrent readers of the touched partitions; replaying the
same source is idempotent for non-NULL keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.operators.dedupe import DEFAULT_ORDER, dedupe_latest
from ledgerline.operators.staging import broadcast_if_small, release, stage_at
from ledgerline.schemas import SILVER_KEY, SILVER_PARTITIONS
from ledgerline.session import path_exists

_SEPARATOR = "\u0001"
_NULL = "\u0002"


def table_exists(spark: SparkSession, path: str) -> bool:
    """True when ``path`` holds a table (a non-empty folder)."""
    return path_exists(spark, path)


def write_partitioned(
    df: DataFrame, path: str, partitions: Sequence[str], mode: str, dynamic: bool = True
) -> None:
    """Partitioned Parquet write; ``dynamic`` overwrite replaces only the
    partitions present in ``df``, static overwrite replaces the whole table."""
    (
        df.hint("rebalance", *partitions)
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic" if dynamic else "static")
        .partitionBy(*partitions)
        .parquet(path)
    )


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(path)


def upsert(
    source: DataFrame,
    target_path: str,
    keys: Sequence[str] = SILVER_KEY,
    partitions: Sequence[str] = SILVER_PARTITIONS,
    null_safe: bool = False,
    on_duplicate: str = "latest",
    order: Sequence[str] = DEFAULT_ORDER,
    release_staging: bool = True,
    matched: str = "source",
) -> dict:
    """Merge ``source`` into the partitioned Parquet table at ``target_path``.

    A matched row takes the source (``matched="source"``, the literal merge) or
    the greater of both rows by ``order`` (``matched="newest"``: the result then
    does not depend on how the input was cut into merges).

    An absent or empty target is a first load (plain partitioned write).
    Returns small bookkeeping counts (touched partitions, source rows) and,
    under ``"touched"``, a DataFrame of the partition values written.  With
    ``release_staging`` the staged copy of the source is deleted once the final
    write has succeeded.
    """
    spark = source.sparkSession
    keys, partitions = list(keys), list(partitions)
    columns = source.columns
    null_keys = "group" if null_safe else "keep"
    src, src_path = stage_at(dedupe_latest(source, keys, order, on_duplicate, null_keys), "upsert-source")
    staged = [src_path]

    keys_seen = src.select(*partitions).distinct().collect()  # one row for each directory to write
    touched = spark.createDataFrame(keys_seen, src.select(*partitions).schema)

    def done(info: dict) -> dict:
        if release_staging:
            for path in staged:
                release(spark, path)
        return {**info, "touched": touched}

    if not table_exists(spark, target_path):
        write_partitioned(src, target_path, partitions, "overwrite")
        return done({"touched_partitions": -1, "source_rows": src.count(), "first_load": 1})
    if not keys_seen:
        return done({"touched_partitions": 0, "source_rows": 0, "first_load": 0})

    schema = src.schema  # target has the same layout; avoids partition-type inference
    target = read_table(spark, target_path, schema).select(*columns)
    n_touched = len(keys_seen)
    in_touched = target.filter(partition_predicate(keys_seen, partitions))

    if matched == "newest":
        merged = dedupe_latest(in_touched.unionByName(src.select(*columns)), keys, order, "latest", null_keys)
        n_src = src.count()
    else:
        src_keys, n_src = broadcast_if_small(src.select(*keys))
        src_keys = src_keys.alias("_s")
        match = [
            (in_touched[k].eqNullSafe(F.col(f"_s.{k}")) if null_safe else in_touched[k] == F.col(f"_s.{k}"))
            for k in keys
        ]
        merged = in_touched.join(src_keys, match, "left_anti").unionByName(src.select(*columns))
    # A dynamic overwrite may read the table that it writes: new files go to a
    # staging folder of the job and replace the old ones when it commits.
    write_partitioned(merged, target_path, partitions, "overwrite")
    return done({"touched_partitions": n_touched, "source_rows": n_src, "first_load": 0})


def drop_partition(spark: SparkSession, table_path: str, values: dict) -> None:
    """Delete one partition directory (values in partition-column order).

    Dynamic overwrite cannot empty a partition; this is how a partition whose
    recomputed content is empty is cleared.
    """
    sc = spark.sparkContext
    escape = sc._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    rel = "/".join(f"{escape(k)}={escape(str(v))}" for k, v in values.items())
    jpath = sc._jvm.org.apache.hadoop.fs.Path(f"{table_path.rstrip('/')}/{rel}")
    fs = jpath.getFileSystem(sc._jsc.hadoopConfiguration())
    if fs.exists(jpath):
        fs.delete(jpath, True)


def partition_name(partitions: Sequence[str]):
    """The partition values of a row as one text (NULL is a value of its own)."""
    parts = [F.coalesce(F.col(p).cast("string"), F.lit(_NULL)) for p in partitions]
    return F.concat_ws(_SEPARATOR, *parts)


def _written(value) -> str:
    if value is None:
        return _NULL
    return str(value).lower() if isinstance(value, bool) else str(value)


def partition_predicate(keys, partitions: Sequence[str]):
    """Whether a row lies in one of the partitions ``keys``: a hashed set test on partition columns only."""
    names = {_SEPARATOR.join(_written(row[p]) for p in partitions) for row in keys}
    return partition_name(partitions).isin(sorted(names))
