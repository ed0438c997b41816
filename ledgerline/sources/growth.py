"""Columns that landed files gain over time (additive schema change).

A landed file may hold columns that the record schemas do not know yet.  Before
a stream run, the footers of the files landed since the last run are merged
(``mergeSchema``, a distributed job over footers, no rows are read) and fields
that are new are written to a small table of columns, the column log.  The run
then reads and writes them, and readers of the table fill them with NULL for
files written before.

Only additions are accepted: a column whose type differs between files, or from
the logged type, is an error.  Known columns keep their declared types, and the
names that the library itself writes are never taken from a file.
"""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.schemas import BRONZE_COLUMNS, LANDING_SCHEMA
from ledgerline.session import path_exists

LOG_SCHEMA = "position int, name string, type string, merged_until timestamp"
# Footers are merged again for this long before the last run: files may be seen
# later than their modification time says.
OVERLAP = dt.timedelta(days=1)
_RESERVED = {name.lower() for name in [*BRONZE_COLUMNS, *LANDING_SCHEMA.fieldNames()]}


def _log(spark: SparkSession, log_path: str) -> DataFrame:
    return spark.read.schema(LOG_SCHEMA).parquet(log_path)


def known_columns(spark: SparkSession, log_path: str) -> list[T.StructField]:
    """The logged columns, in the order in which they were first found."""
    if not path_exists(spark, log_path):
        return []
    rows = _log(spark, log_path).where("name is not null").orderBy("position").collect()  # one row a column
    return [T.StructField(r["name"], T.DataType.fromDDL(r["type"])) for r in rows]


def _merged_until(spark: SparkSession, log_path: str) -> dt.datetime | None:
    if not path_exists(spark, log_path):
        return None
    return _log(spark, log_path).agg(F.max("merged_until").alias("t")).first()["t"]


def landed_fields(spark: SparkSession, path: str, since: dt.datetime | None = None) -> list[T.StructField]:
    """Fields of the Parquet files below ``path`` that were modified after ``since``, from their footers."""
    reader = (
        spark.read.option("mergeSchema", "true")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
    )
    if since is not None:
        reader = reader.option("modifiedAfter", since.strftime("%Y-%m-%dT%H:%M:%S"))
    try:
        return list(reader.parquet(path).schema.fields)
    except AnalysisException as e:
        if "UNABLE_TO_INFER_SCHEMA" in str(e):  # no file in that time
            return []
        raise


def grown_columns(spark: SparkSession, landing_path: str, log_path: str) -> list[T.StructField]:
    """Logged columns plus those of newly landed files, which are logged now."""
    started = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None, microsecond=0)
    known = known_columns(spark, log_path)
    until = _merged_until(spark, log_path)
    types = {f.name.lower(): f.dataType for f in known}
    new = []
    for field in landed_fields(spark, landing_path, None if until is None else until - OVERLAP):
        name = field.name.lower()
        if name in _RESERVED:
            continue
        if name not in types:
            new.append(T.StructField(field.name, field.dataType))
            types[name] = field.dataType
        elif types[name] != field.dataType:
            raise ValueError(f"column {field.name} changed from {types[name].simpleString()} to {field.dataType.simpleString()}")
    rows = [(len(known) + i, f.name, f.dataType.simpleString(), started) for i, f in enumerate(new)]
    rows.append((None, None, None, started))  # how far footers were merged
    spark.createDataFrame(rows, LOG_SCHEMA).coalesce(1).write.mode("append").parquet(log_path)
    return [*known, *new]
