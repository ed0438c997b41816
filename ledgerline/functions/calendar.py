"""Calendar columns derived from a date, all JVM-side built-ins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_FORMAT = "yyyy-MM-dd"
MONTH_FORMAT = "yyyy-MM"
DAY_PATTERN = r"^\d{4}-\d{2}-\d{2}$"
MONTH_PATTERN = r"^\d{4}-\d{2}$"

# Weekday names, English, indexed by dayofweek() (1 = Sunday).
WEEKDAYS = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]


def parse_day(text: Column, month_grain: str = "first_day") -> Column:
    """Parse ``yyyy-MM-dd`` text to a date; NULL when it does not parse.

    Cost rows carry a month (``yyyy-MM``) where usage rows carry a day.
    ``month_grain="first_day"`` anchors such a month to its first day so cost
    reaches Silver and Gold; ``"drop"`` leaves it NULL (and the Silver filter
    then drops it), which is what a strict day parse does.
    """
    # Same accepted set as a strict ``yyyy-MM-dd`` / ``yyyy-MM`` formatter
    # parse, but the shape is checked first and the text then goes through
    # the built-in string->date cast (no formatter, no exception per failing
    # row); an impossible day such as 2024-02-30 still yields NULL.
    day = F.when(text.rlike(DAY_PATTERN), text.try_cast("date"))
    if month_grain == "drop":
        return day
    if month_grain != "first_day":
        raise ValueError(f"month_grain must be 'first_day' or 'drop', got {month_grain!r}")
    return F.coalesce(day, F.when(text.rlike(MONTH_PATTERN), text.try_cast("date")))


def calendar_columns(day: Column) -> dict[str, Column]:
    """year, month, ISO week and English weekday name of ``day``."""
    return {
        "year": F.year(day),
        "month": F.month(day),
        "week_of_year": F.weekofyear(day),
        # same names as date_format(day, 'EEEE'), without a formatter per row
        "day_of_week": F.element_at(F.array(*[F.lit(d) for d in WEEKDAYS]), F.dayofweek(day)),
    }


def period_label(year: Column, month: Column) -> Column:
    """``YYYY-MM`` label from integer year and month."""
    return F.concat(year.cast("string"), F.lit("-"), F.lpad(month.cast("string"), 2, "0"))


def text_day(ts: Column) -> Column:
    """``yyyy-MM-dd`` text of a timestamp's calendar day."""
    return F.date_format(ts, DAY_FORMAT)


def text_month(ts: Column) -> Column:
    """``yyyy-MM`` text of a timestamp's calendar month."""
    return F.date_format(ts, MONTH_FORMAT)
