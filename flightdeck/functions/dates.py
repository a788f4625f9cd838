"""Date parsing, calendar attributes and date keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from flightdeck.functions._util import as_col
from flightdeck.schemas import RAW_DATE_FORMAT


def parse_flight_date(c: Column | str, fmt: str = RAW_DATE_FORMAT) -> Column:
    """Strict parse of ``1/1/2025 12:00:00 AM`` style text to a DATE.

    Text that does not match the pattern becomes NULL (the caller counts those
    as conversion failures); single-letter month/day/hour fields accept one or
    two digits.
    """
    return F.to_date(F.try_to_timestamp(as_col(c), F.lit(fmt)))


def date_key(d: Column | str) -> Column:
    """Smart key ``YYYYMMDD`` as INT."""
    d = as_col(d)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def year_month_key(d: Column | str) -> Column:
    """``YYYYMM`` as INT."""
    d = as_col(d)
    return (F.year(d) * 100 + F.month(d)).cast("int")


def iso_weekday(d: Column | str) -> Column:
    """1 = Monday ... 7 = Sunday, independent of any locale setting."""
    return (F.weekday(as_col(d)) + 1).cast("short")


def is_weekend(d: Column | str) -> Column:
    return iso_weekday(d).isin(6, 7)


def date_parts(d: Column | str) -> dict[str, Column]:
    """Year, quarter, month and day of month as SMALLINT columns."""
    d = as_col(d)
    return {
        "Year": F.year(d).cast("short"),
        "Quarter": F.quarter(d).cast("short"),
        "Month": F.month(d).cast("short"),
        "DayOfMonth": F.dayofmonth(d).cast("short"),
    }


def date_names(d: Column | str) -> dict[str, Column]:
    """English quarter / month / weekday names (full names, not abbreviations)."""
    d = as_col(d)
    return {
        "QuarterName": F.concat(F.lit("Q"), F.quarter(d).cast("string")),
        "MonthName": F.date_format(d, "MMMM"),
        "DayName": F.date_format(d, "EEEE"),
    }


def iso_date_text(d: Column | str) -> Column:
    return F.date_format(as_col(d), "yyyy-MM-dd")
