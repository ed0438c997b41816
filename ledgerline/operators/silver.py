"""Silver: typed, cleaned and enriched facts.

One projection over Bronze (Catalyst collapses it into a single Project inside
whole-stage codegen) followed by the quality filters, which Catalyst pushes to
the scan where they only touch input columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.calendar import calendar_columns, parse_day
from ledgerline.functions.units import (
    clean_text,
    is_cost,
    metric_category,
    normalized_unit,
    normalized_value,
)
from ledgerline.schemas import SILVER_COLUMNS

OUTPUT = SILVER_COLUMNS


def transform(bronze: DataFrame, month_grain: str = "first_day") -> DataFrame:
    """Bronze -> Silver rows (see ``SILVER_COLUMNS``).

    * ``date`` parsed as ``yyyy-MM-dd``; a cost month is anchored to its first
      day unless ``month_grain="drop"``; unparsable dates are dropped.
    * value normalised by unit (bytes -> GB, hosts -> K hosts), 4 places.
    * product/org/metric trimmed and lower-cased *before* the cost flag is
      derived, so a padded or capitalised product is still recognised.
    * rows with NULL or negative value are dropped.
    """
    day = parse_day(F.col("date"), month_grain)
    product = clean_text(F.col("product"))
    typed = bronze.select(
        product.alias("product"),
        day.alias("date"),
        clean_text(F.col("org_name")).alias("org_name"),
        clean_text(F.col("metric_name")).alias("metric_name"),
        F.col("value"),
        F.col("unit"),
        F.col("extracted_at"),
    ).filter(F.col("date").isNotNull() & F.col("value").isNotNull() & (F.col("value") >= 0))
    cal = calendar_columns(F.col("date"))
    return typed.select(
        "product",
        "date",
        cal["year"].alias("year"),
        cal["month"].alias("month"),
        cal["week_of_year"].alias("week_of_year"),
        cal["day_of_week"].alias("day_of_week"),
        "org_name",
        "metric_name",
        metric_category(F.col("product")).alias("metric_category"),
        "value",
        normalized_value(F.col("value"), F.col("unit")).alias("value_normalized"),
        "unit",
        normalized_unit(F.col("unit")).alias("unit_normalized"),
        is_cost(F.col("product")).alias("is_cost_metric"),
        "extracted_at",
        F.current_timestamp().alias("_silver_updated_at"),
    )
