"""Adapters that shape the supplied test tables as billing records.

The test tables hold no billing data, so ``events`` plays the role of usage
records and ``orders`` that of estimated-cost records.  Both are narrow
projections of a full scan (column-pruned at the parquet reader) and keep every
row, so their work grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.calendar import text_day, text_month
from ledgerline.schemas import COST_PRODUCT

# Fixed values of the adapters.
EVENT_PRODUCT = {
    "click": "infrastructure",
    "view": "infrastructure",
    "signup": "infrastructure",
    "purchase": "apm",
    "error": "logs",
}
EVENT_UNIT = {"error": "bytes", "purchase": "spans"}  # everything else: hosts
PRIORITY_PRODUCT = {
    "1-URGENT": "infrastructure",
    "2-HIGH": "apm",
    "3-MEDIUM": "logs",
    "4-NOT SPECIFIED": "synthetics",
    "5-LOW": "custom_metrics",
}
STATUS_CHARGE = {"F": "committed", "O": "on_demand", "P": "pending"}


def _lookup(col: Column, table: dict[str, str], default: Column | None = None) -> Column:
    expr = None
    for k, v in table.items():
        expr = F.when(col == k, F.lit(v)) if expr is None else expr.when(col == k, F.lit(v))
    return expr.otherwise(default) if default is not None else expr


def _org(key: Column) -> Column:
    # Padded and capitalised on purpose: Silver has to trim and lower it.
    return F.concat(F.lit(" Org_"), (key % 3).cast("string"), F.lit(" "))


def usage_records(events: DataFrame, *extra: Column) -> DataFrame:
    """Usage records (product, date, org_name, metric_name, value, unit, extracted_at), then ``extra``."""
    et = F.col("event_type")
    even = (F.col("user_id") % 2) == 0
    metric = (
        F.when(et == "click", F.when(even, F.lit("aws_hosts")).otherwise(F.lit("azure_hosts")))
        .when(et == "view", F.when(even, F.lit("gcp_hosts")).otherwise(F.lit("agent_hosts")))
        .when(et == "signup", F.lit("total_hosts"))
        .when(et == "purchase", F.lit("indexed_spans"))
        .when(et == "error", F.lit("logs_ingested_bytes"))
    )
    # Integral host counts avoid rounding ties in the /1000 normalisation.
    value = F.when(et == "error", F.col("value") * F.lit(1e9)).otherwise(F.round(F.col("value") * 100, 0))
    return events.select(
        _lookup(et, EVENT_PRODUCT).alias("product"),
        text_day(F.col("ts")).alias("date"),
        _org(F.col("user_id")).alias("org_name"),
        metric.alias("metric_name"),
        value.alias("value"),
        _lookup(et, EVENT_UNIT, F.lit("hosts")).alias("unit"),
        F.col("ts").cast("timestamp").alias("extracted_at"),
        *extra,
    )


def cost_records(orders: DataFrame, *extra: Column) -> DataFrame:
    """Cost records (product_name, charge_type, cost_usd, month, org_name, extracted_at), then ``extra``.

    ``product`` is added as the landing path would supply it.
    """
    return orders.select(
        F.lit(COST_PRODUCT).alias("product"),
        _lookup(F.col("o_orderpriority"), PRIORITY_PRODUCT).alias("product_name"),
        _lookup(F.col("o_orderstatus"), STATUS_CHARGE).alias("charge_type"),
        F.col("o_totalprice").alias("cost_usd"),
        text_month(F.col("o_orderdate")).alias("month"),
        _org(F.col("o_custkey")).alias("org_name"),
        F.col("o_orderdate").cast("timestamp").alias("extracted_at"),
        *extra,
    )


# Read schemas of the input tables (schema-on-read: no footer inference).
TABLE_SCHEMAS = {
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
    "orders": (
        "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
        "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING"
    ),
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    if name in TABLE_SCHEMAS:
        reader = reader.schema(TABLE_SCHEMAS[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def usage_from(spark: SparkSession, sf_dir: str, *extra: Column) -> DataFrame:
    return usage_records(read_table(spark, sf_dir, "events"), *extra)


def cost_from(spark: SparkSession, sf_dir: str, *extra: Column) -> DataFrame:
    return cost_records(read_table(spark, sf_dir, "orders"), *extra)
