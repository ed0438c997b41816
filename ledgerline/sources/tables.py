"""Catalog DDL for the layered tables (plain Parquet tables, no extra jars)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

BRONZE_DDL = """
CREATE TABLE IF NOT EXISTS {name} (
    product       STRING    COMMENT 'product feed (infrastructure, apm, logs, estimated_cost)',
    date          STRING    COMMENT 'reference day yyyy-MM-dd, or month yyyy-MM for cost',
    org_name      STRING    COMMENT 'organisation',
    metric_name   STRING    COMMENT 'metric, or charged product for cost rows',
    value         DOUBLE    COMMENT 'metric value or cost in USD',
    unit          STRING    COMMENT 'unit of the metric',
    extracted_at  TIMESTAMP COMMENT 'extraction time, UTC',
    _source_file  STRING    COMMENT 'landed file the row came from',
    _ingested_at  TIMESTAMP COMMENT 'ingestion time'
)
USING parquet
PARTITIONED BY (product, date)
COMMENT 'Bronze: raw usage and cost facts'
{location}
"""

SILVER_DDL = """
CREATE TABLE IF NOT EXISTS {name} (
    date                DATE      COMMENT 'reference day',
    week_of_year        INT       COMMENT 'ISO week',
    day_of_week         STRING    COMMENT 'weekday name',
    org_name            STRING    COMMENT 'organisation, trimmed and lower-cased',
    metric_name         STRING    COMMENT 'metric, trimmed and lower-cased',
    metric_category     STRING    COMMENT 'usage or cost',
    value               DOUBLE    COMMENT 'metric value',
    value_normalized    DOUBLE    COMMENT 'value in GB / thousands of hosts',
    unit                STRING    COMMENT 'original unit',
    unit_normalized     STRING    COMMENT 'unit after normalisation',
    is_cost_metric      BOOLEAN   COMMENT 'row is a USD cost',
    extracted_at        TIMESTAMP COMMENT 'extraction time',
    _silver_updated_at  TIMESTAMP COMMENT 'last Silver update',
    product             STRING    COMMENT 'product feed',
    year                INT       COMMENT 'year of date',
    month               INT       COMMENT 'month of date'
)
USING parquet
PARTITIONED BY (product, year, month)
COMMENT 'Silver: cleaned, typed and enriched facts'
{location}
"""


def create_database(spark: SparkSession, database: str, path: str | None = None) -> None:
    """Create ``database`` unless it exists; ``path`` is where tables without a location of their own go."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} {_location(path)}")


def _location(path: str | None) -> str:
    return f"LOCATION '{path}'" if path else ""


def create_bronze_table(spark: SparkSession, name: str, path: str | None = None) -> None:
    spark.sql(BRONZE_DDL.format(name=name, location=_location(path)))


def create_silver_table(spark: SparkSession, name: str, path: str | None = None) -> None:
    spark.sql(SILVER_DDL.format(name=name, location=_location(path)))


def add_columns(spark: SparkSession, name: str, fields: Sequence[T.StructField]) -> None:
    """Add the columns that table ``name`` does not have yet (old files read as NULL there)."""
    have = {c.lower() for c in spark.table(name).columns}
    new = [f"`{f.name}` {f.dataType.simpleString()}" for f in fields if f.name.lower() not in have]
    if new:
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({', '.join(new)})")


def table_columns(spark: SparkSession, name: str) -> DataFrame:
    """position, column_name, data_type of the columns of table ``name``, partition columns included."""
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(spark.table(name).schema.fields, 1)]
    return spark.createDataFrame(rows, "position int, column_name string, data_type string")


def overwrite_table(df: DataFrame, name: str, path: str | None = None) -> None:
    """Replace a Gold table, schema included (Gold tables are small and unpartitioned)."""
    writer = df.write.mode("overwrite").format("parquet")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
