"""Bronze: one tall fact shape over usage and cost records.

The same function serves the batch path and the streaming path (it is a
stateless projection + filter), so a stream and a batch over the same files
give the same rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.schemas import LANDING_SCHEMA

OUTPUT = ["product", "date", "org_name", "metric_name", "value", "unit", "extracted_at", "_source_file", "_ingested_at"]


def superset(*frames: DataFrame) -> DataFrame:
    """Union record frames of either kind by name; absent fields become NULL."""
    out = None
    for df in frames:
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return with_missing_columns(out)


def with_missing_columns(df: DataFrame) -> DataFrame:
    missing = {
        f.name: F.lit(None).cast(f.dataType) for f in LANDING_SCHEMA.fields if f.name not in df.columns
    }
    return df.withColumns(missing) if missing else df


def unify(raw: DataFrame, source_file: Column | None = None, extra: Sequence[str] = ()) -> DataFrame:
    """Superset records -> Bronze rows.

    value = value, else cost; metric = metric, else charged product; date =
    day, else month.  Rows without a positive value are dropped.  ``extra`` names
    columns of the records that are carried along behind the Bronze ones.
    """
    raw = with_missing_columns(raw)
    if source_file is None:
        source_file = F.col("_source_file") if "_source_file" in raw.columns else F.lit(None).cast("string")
    value = F.coalesce(F.col("value"), F.col("cost_usd"))
    # Text timestamps (ISO, as extractors write them) parse leniently: bad text
    # becomes NULL instead of failing the job.
    ts_type = dict(raw.dtypes).get("extracted_at")
    extracted = F.try_to_timestamp(F.col("extracted_at")) if ts_type == "string" else F.col("extracted_at").cast("timestamp")
    return raw.select(
        F.col("product"),
        F.coalesce(F.col("date"), F.col("month")).alias("date"),
        F.col("org_name"),
        F.coalesce(F.col("metric_name"), F.col("product_name")).alias("metric_name"),
        value.alias("value"),
        F.col("unit"),
        extracted.alias("extracted_at"),
        source_file.alias("_source_file"),
        F.current_timestamp().alias("_ingested_at"),
        *[F.col(c) for c in extra],
    ).filter(F.col("value").isNotNull() & (F.col("value") > 0))


def product_scope(df: DataFrame, product: str | None) -> DataFrame:
    """Keep one product (``None`` / ``all`` keep everything)."""
    return df if product in (None, "all") else df.filter(F.col("product") == product)
