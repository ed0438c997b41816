from __future__ import annotations

import datetime as dt
import os

from pyspark.sql import types as T

from ledgerline.schemas import COST_SCHEMA, USAGE_SCHEMA

TS = dt.datetime(2024, 1, 15, 6, 0, 0)


def usage_df(spark, rows):
    """rows: (product, date, org, metric, value, unit[, extracted_at])"""
    full = [tuple(r) + ((TS,) if len(r) == 6 else ()) for r in rows]
    return spark.createDataFrame(full, USAGE_SCHEMA)


def cost_df(spark, rows):
    """rows: (product_name, charge_type, cost_usd, month, org[, extracted_at])"""
    full = [tuple(r) + ((TS,) if len(r) == 5 else ()) for r in rows]
    return spark.createDataFrame(full, COST_SCHEMA)


SILVER_IN = T.StructType(
    [
        T.StructField("product", T.StringType()),
        T.StructField("date", T.StringType()),
        T.StructField("org_name", T.StringType()),
        T.StructField("metric_name", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("unit", T.StringType()),
        T.StructField("extracted_at", T.TimestampType()),
    ]
)


def bronze_df(spark, rows):
    full = [tuple(r) + ((TS,) if len(r) == 6 else ()) for r in rows]
    return spark.createDataFrame(full, SILVER_IN)


def partition_dirs(path: str) -> list[str]:
    """Leaf partition directories of a local table."""
    out = []
    for root, _dirs, files in os.walk(path):
        if any(f.endswith(".parquet") for f in files):
            out.append(os.path.relpath(root, path))
    return sorted(out)
