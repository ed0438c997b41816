"""Label rules for trends, anomalies and cloud providers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerline.schemas import (
    PROVIDER_OTHER,
    PROVIDER_RULES,
    SEVERITY_HIGH,
    SEVERITY_MEDIUM,
    SEVERITY_NORMAL,
    TREND_DOWN,
    TREND_STABLE,
    TREND_THRESHOLD_PCT,
    TREND_UP,
    Z_ANOMALY,
    Z_HIGH,
)


def mom_change_pct(current: Column, previous: Column) -> Column:
    """Percent change against the previous value; NULL unless previous > 0."""
    return F.when(previous > 0, F.round((current - previous) / previous * 100, 2))


def trend_label(pct: Column) -> Column:
    """Up above +10 %, down below -10 %, stable otherwise (NULL included)."""
    return (
        F.when(pct > TREND_THRESHOLD_PCT, F.lit(TREND_UP))
        .when(pct < -TREND_THRESHOLD_PCT, F.lit(TREND_DOWN))
        .otherwise(F.lit(TREND_STABLE))
    )


def z_score(value: Column, mean: Column, stddev: Column) -> Column:
    """(value - mean) / stddev rounded to 2 places; 0.0 for flat or single-row groups."""
    return F.when(stddev > 0, F.round((value - mean) / stddev, 2)).otherwise(F.lit(0.0))


def severity_label(z: Column) -> Column:
    return (
        F.when(F.abs(z) > Z_HIGH, F.lit(SEVERITY_HIGH))
        .when(F.abs(z) > Z_ANOMALY, F.lit(SEVERITY_MEDIUM))
        .otherwise(F.lit(SEVERITY_NORMAL))
    )


def cloud_provider(metric_name: Column) -> Column:
    """First provider whose token appears in the metric name, else Total."""
    expr = None
    for token, label in PROVIDER_RULES:
        cond = metric_name.contains(token)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(PROVIDER_OTHER))
