"""Extraction-window selectors.  "Today" is always a parameter."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def date_window(records: DataFrame, end: str | dt.date, days: int = 30, column: str = "date") -> DataFrame:
    """Rows whose day lies in [end - days, end] inclusive (days + 1 dates).

    Compared as ``yyyy-MM-dd`` text, so the predicate is a plain range that
    reaches the Parquet reader (and prunes a ``date=`` partition column).
    """
    end_d = dt.date.fromisoformat(str(end))
    start_d = end_d - dt.timedelta(days=days)
    return records.filter(F.col(column).between(start_d.isoformat(), end_d.isoformat()))


def month_window(records: DataFrame, start_month: str, end_month: str, column: str = "month") -> DataFrame:
    """Rows whose ``yyyy-MM`` month lies in [start_month, end_month] inclusive."""
    return records.filter(F.col(column).between(start_month, end_month))


def months_of_window(end: str | dt.date, days: int = 30) -> tuple[str, str]:
    """The month range a day window spans (what a cost extraction asks for)."""
    end_d = dt.date.fromisoformat(str(end))
    start_d = end_d - dt.timedelta(days=days)
    return start_d.strftime("%Y-%m"), end_d.strftime("%Y-%m")
