"""Named views over the domain tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepanel.functions.scalars import positive_ratio


def company_details(companies: DataFrame, countries: DataFrame) -> DataFrame:
    """Companies with their country name (kept without one). ``countries`` is the constant table."""
    names = countries.select("country_id", "country_name")
    return companies.join(names, "country_id", "left").select(
        "company_id", "ticker", "company_name", "country_id", "country_name", "currency",
        "gics_sector_name", "gics_industry_group_name", "is_active",
    )


def financials_annual(financials: DataFrame, companies: DataFrame) -> DataFrame:
    """Annual statements with company attributes, interest coverage and gross margin."""
    attributes = companies.select("company_id", "ticker", "company_name", "country_id", "gics_sector_name")
    return (
        financials.where(F.col("period_type") == "ANNUAL")
        .join(attributes, "company_id")
        .withColumn("interest_coverage_ratio", positive_ratio("ebitda", "interest_expense"))
        .withColumn("gross_margin", positive_ratio("gross_profit", "revenue"))
    )


def index_members(membership: DataFrame, companies: DataFrame, indices: DataFrame) -> DataFrame:
    """Members with company attributes and index name. ``indices`` is the constant table."""
    attributes = companies.select("company_id", "ticker", "company_name", "country_id", "gics_sector_name")
    names = indices.select("index_id", "index_name")
    return membership.join(names, "index_id").join(attributes, "company_id")


def macro_with_country(macro: DataFrame, countries: DataFrame) -> DataFrame:
    return macro.join(countries, "country_id")


def register(tables: dict[str, DataFrame]) -> None:
    """Publish the four views (and the tables) under their SQL names."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    company_details(tables["companies"], tables["countries"]).createOrReplaceTempView("v_company_details")
    financials_annual(tables["financials"], tables["companies"]).createOrReplaceTempView("v_financials_annual")
    index_members(tables["index_membership"], tables["companies"], tables["indices"]).createOrReplaceTempView("v_index_members")
    macro_with_country(tables["macro_indicators"], tables["countries"]).createOrReplaceTempView("v_macro_with_country")
