"""Unit normalisation and cost classification rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerline.schemas import BYTES_PER_GB, COST_PRODUCT, HOSTS_PER_K


def normalized_value(value: Column, unit: Column) -> Column:
    """bytes -> GB, hosts -> thousands of hosts, anything else as is; 4 places."""
    return (
        F.when(unit == "bytes", F.round(value / F.lit(BYTES_PER_GB), 4))
        .when(unit == "hosts", F.round(value / F.lit(HOSTS_PER_K), 4))
        .otherwise(F.round(value, 4))
    )


def normalized_unit(unit: Column) -> Column:
    """Unit label after :func:`normalized_value` (NULL unit stays NULL)."""
    return F.when(unit == "bytes", F.lit("GB")).when(unit == "hosts", F.lit("K hosts")).otherwise(unit)


def is_cost(product: Column) -> Column:
    return product == F.lit(COST_PRODUCT)


def metric_category(product: Column) -> Column:
    return F.when(is_cost(product), F.lit("cost")).otherwise(F.lit("usage"))


def clean_text(c: Column) -> Column:
    """Lower-case and strip surrounding spaces."""
    return F.trim(F.lower(c))
