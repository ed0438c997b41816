"""Usage anomalies by z-score within (product, metric, month) groups.

The obvious plan -- ``avg``/``stddev`` over a window partitioned by the group
-- shuffles and sorts every usage row and puts a whole group into one task;
with a handful of products and metrics a single group can hold a third of the
data.  Here the group statistics are an aggregate instead (mean and sample
standard deviation merge map-side, so a hot group costs nothing extra), they
are staged, their row count is measured, and they are joined back to the rows:
broadcast when the measured count is under the bound (no shuffle of the usage
rows at all), a shuffle join otherwise.  Same numbers as the window form.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.labels import severity_label, z_score
from ledgerline.operators.staging import BROADCAST_MAX_ROWS, broadcast_if_small, stage
from ledgerline.schemas import Z_ANOMALY

GROUP = ("product", "metric_name", "month")
OUTPUT = [
    "product", "date", "metric_name", "org_name", "value",
    "avg_value", "stddev_value", "z_score", "anomaly_severity", "unit",
]


def group_stats(silver: DataFrame, group: Sequence[str] = GROUP) -> DataFrame:
    """Mean, sample stddev and row count of usage values per group."""
    return (
        silver.filter(~F.col("is_cost_metric"))
        .groupBy(*group)
        .agg(
            F.avg("value").alias("avg_value"),
            F.stddev_samp("value").alias("stddev_value"),
            F.count(F.lit(1)).alias("n"),
        )
    )


def score(silver: DataFrame, stats: DataFrame, group: Sequence[str] = GROUP) -> DataFrame:
    """All usage rows with their group's mean, stddev, z-score and severity."""
    usage = silver.filter(~F.col("is_cost_metric"))
    s = stats.alias("_g")
    # Null-safe: grouping puts NULLs in one group, so must the join.
    cond = [usage[c].eqNullSafe(F.col(f"_g.{c}")) for c in group]
    joined = usage.join(s, cond, "inner").select(
        usage["*"], F.col("_g.avg_value").alias("avg_value"), F.col("_g.stddev_value").alias("stddev_value")
    )
    z = z_score(F.col("value"), F.col("avg_value"), F.col("stddev_value"))
    return joined.withColumn("z_score", z).withColumn("anomaly_severity", severity_label(F.col("z_score")))


def anomalies(
    silver: DataFrame,
    group: Sequence[str] = GROUP,
    stat_places: int | None = None,
    broadcast_max_rows: int = BROADCAST_MAX_ROWS,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Usage rows whose |z| > 2 within their group.

    ``group`` defaults to (product, metric_name, month): months of different
    years share a group, as in the source system.  ``stat_places`` rounds the
    reported mean and stddev (the z-score uses the unrounded values).
    ``carry`` names extra Silver columns to keep (e.g. ``_silver_updated_at``).
    """
    group = list(group)
    stats, _ = broadcast_if_small(stage(group_stats(silver, group), "anomaly-stats"), broadcast_max_rows)
    scored = score(silver, stats, group).filter(F.abs(F.col("z_score")) > Z_ANOMALY)
    if stat_places is not None:
        scored = scored.withColumns(
            {
                "avg_value": F.round("avg_value", stat_places),
                "stddev_value": F.round("stddev_value", stat_places),
            }
        )
    return scored.select(*OUTPUT, *[c for c in carry if c in scored.columns])
