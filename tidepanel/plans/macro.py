"""Macro series brought to a common period: always aggregated, one row per (country, period)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepanel.operators.panel import with_difference
from tidepanel.functions import periods

REAL_GDP_YOY = "%Real GDP%yoy%"
NOMINAL_GDP = "%Nominal GDP%bn%"
CPI_YOY = "%CPI%yoy%"
HOUSING_STARTS = "%Housing Start%"


def series(macro: DataFrame, pattern: str, country: str | None = None) -> DataFrame:
    """Rows of the indicators whose name matches the pattern, ignoring case."""
    rows = macro.where(F.col("indicator_name").ilike(pattern))
    return rows.where(F.col("country_id") == country) if country else rows


def mean_by(macro: DataFrame, pattern: str, bucket: Column, name: str, value: str, country: str | None = None) -> DataFrame:
    return series(macro, pattern, country).groupBy("country_id", bucket.alias(name)).agg(F.avg("indicator_value").alias(value))


def yearly(macro: DataFrame, pattern: str, value: str, country: str | None = None) -> DataFrame:
    return mean_by(macro, pattern, F.year("indicator_date"), "year", value, country)


def quarterly(macro: DataFrame, pattern: str, value: str) -> DataFrame:
    return mean_by(macro, pattern, periods.quarter_start("indicator_date"), "quarter_start", value)


def monthly(macro: DataFrame, pattern: str, value: str, country: str | None = None) -> DataFrame:
    return mean_by(macro, pattern, periods.month_start("indicator_date"), "month", value, country)


def gdp_phase(macro: DataFrame) -> DataFrame:
    phase = F.when(F.col("gdp_growth") < 0, "Contraction").otherwise("Expansion")
    return yearly(macro, REAL_GDP_YOY, "gdp_growth").withColumn("gdp_phase", phase)


def gdp_trend(macro: DataFrame) -> DataFrame:
    """Mean growth per country and year, and its change to the country's previous year."""
    return with_difference(yearly(macro, REAL_GDP_YOY, "gdp_growth"), "country_id", "year", "gdp_growth", "gdp_change")


def yearly_rate(rates: DataFrame, rate_type: str, value: str, country: str | None = None) -> DataFrame:
    rows = rates.where(F.col("rate_type") == rate_type)
    if country:
        rows = rows.where(F.col("country_id") == country)
    return rows.groupBy("country_id", F.year("rate_date").alias("year")).agg(F.avg("rate_value").alias(value))
