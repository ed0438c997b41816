"""Layer profiles and row counts (the check tables after each layer)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def profile(
    layer: DataFrame,
    keys: Sequence[str],
    measures: dict[str, Column],
    order: Sequence[str],
    top: int | None = None,
) -> DataFrame:
    """Row count and ``measures`` of each group of ``keys``, in ``order`` ("-" marks descending).

    With ``top`` only that many groups are reported (planned as
    TakeOrderedAndProject: each task keeps its own top rows only).
    """
    counted = layer.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows"), *[measure.alias(name) for name, measure in measures.items()]
    )
    counted = counted.orderBy(*[F.desc(k[1:]) if k.startswith("-") else F.asc(k) for k in order])
    return counted if top is None else counted.limit(top)


def bronze_profile(bronze: DataFrame, top: int = 30) -> DataFrame:
    """Rows, value total and last ingestion per (product, date); latest dates first."""
    seen = {"value_total": F.sum("value"), "last_ingested_at": F.max("_ingested_at")}
    return profile(bronze, ["product", "date"], seen, ["product", "-date"], top)


def silver_profile(silver: DataFrame) -> DataFrame:
    """Rows, cost (NULL when the group has no cost rows) and distinct metrics per month."""
    cost = F.sum(F.when(F.col("is_cost_metric"), F.col("value")))
    seen = {"cost_usd": F.round(cost, 2), "distinct_metrics": F.countDistinct("metric_name")}
    return profile(silver, ["product", "year", "month"], seen, ["-year", "-month", "product"])


def layer_counts(layers: dict[str, DataFrame]) -> DataFrame:
    """One (layer, n) row per named DataFrame, as a single distributed job."""
    out = None
    for name, df in layers.items():
        row = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("layer"), "n")
        out = row if out is None else out.unionByName(row)
    return out
