"""Calendar attributes of a date column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def calendar_columns(day: str = "date_day") -> list[Column]:
    """The nine attributes of the date dimension (week is ISO, Sunday is 0)."""
    weekday = F.dayofweek(day) - 1
    return [
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.monthname(day).alias("month_name"),
        F.weekofyear(day).alias("week_of_year"),
        F.dayofmonth(day).alias("day_of_month"),
        weekday.alias("day_of_week"),
        F.dayname(day).alias("day_name"),
        weekday.isin(0, 6).alias("is_weekend"),
    ]
