"""Calendar buckets and labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def month_start(col: Column | str) -> Column:
    return F.trunc(_c(col), "month")


def quarter_start(col: Column | str) -> Column:
    return F.trunc(_c(col), "quarter")


def week_friday(col: Column | str) -> Column:
    """The Friday of the (Monday-based) week of a date."""
    return F.date_add(F.trunc(_c(col), "week"), 4)


def year_month(col: Column | str) -> Column:
    return F.date_format(_c(col), "yyyy-MM")


def quarter_label(col: Column | str) -> Column:
    return F.concat(F.lit("Q"), F.quarter(_c(col)))


def year_quarter(col: Column | str) -> Column:
    return F.concat_ws("-", F.year(_c(col)), quarter_label(col))


def year_end(year: Column | str) -> Column:
    return F.make_date(_c(year), F.lit(12), F.lit(31))


def in_years(col: Column | str, first: int, last: int) -> Column:
    """Date range test: unlike ``year(col) between``, it reaches the Parquet statistics."""
    value = _c(col)
    return (value >= F.lit(f"{first:04d}-01-01").cast("date")) & (value < F.lit(f"{last + 1:04d}-01-01").cast("date"))
