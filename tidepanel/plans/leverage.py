"""Leverage cycles and sensitivity of interest coverage to policy rates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepanel.functions.scalars import band, excludes, label_in, positive_ratio, share_pct
from tidepanel.operators.joins import broadcast_bounded, country_periods
from tidepanel.operators.panel import (
    latest_per_entity, with_monotone_decline, with_period_count, with_rolling, with_rolling_correlation,
)
from tidepanel.plans import macro as macro_plans

# Labelled years and the bands of the rate sensitivity.
ECONOMIC_PERIODS = {"Crisis Year": [2008, 2009, 2020], "Boom Year": [2006, 2007, 2021]}
SENSITIVITY_BANDS = [(-0.3, "Highly Rate-Sensitive"), (0.0, "Moderately Rate-Sensitive"), (0.3, "Rate-Insulated")]


def statements(
    financials: DataFrame, companies: DataFrame, period_type: str | None = "ANNUAL",
    exclude_sector: str | None = "Financials",
) -> DataFrame:
    """Statements of one period type with company attributes, without one sector."""
    rows = financials.where(F.col("period_type") == period_type) if period_type else financials
    firms = companies.select("company_id", "company_name", "country_id", "gics_sector_name")
    if exclude_sector:
        firms = firms.where(excludes("gics_sector_name", exclude_sector))
    return rows.join(firms, "company_id").withColumn("year", F.year("period_end_date"))


def debt_to_revenue(financials: DataFrame, companies: DataFrame) -> DataFrame:
    rows = statements(financials, companies).where(F.col("total_debt").isNotNull() & (F.col("revenue") > 0))
    return rows.withColumn("debt_to_revenue", positive_ratio("total_debt", "revenue"))


def leverage_distribution(
    financials: DataFrame, companies: DataFrame, labels: dict | None = ECONOMIC_PERIODS,
) -> DataFrame:
    """Per year: firms, mean, least and greatest debt/revenue, and the label of the year."""
    out = (
        debt_to_revenue(financials, companies)
        .groupBy("year")
        .agg(
            F.count("*").alias("company_count"),
            F.round(F.avg("debt_to_revenue"), 3).alias("mean_debt_to_revenue"),
            F.round(F.min("debt_to_revenue"), 3).alias("min_ratio"),
            F.round(F.max("debt_to_revenue"), 3).alias("max_ratio"),
        )
    )
    if labels is not None:
        out = out.withColumn("economic_period", label_in("year", labels, "Normal"))
    return out.orderBy("year")


def debt_declines(financials: DataFrame, companies: DataFrame) -> DataFrame:
    """Firm-years with three debt values; ``declining`` is 1 where debt fell twice running."""
    rows = statements(financials, companies).where(F.col("total_debt").isNotNull())
    flagged = with_monotone_decline(rows, "company_id", "period_end_date", "total_debt")
    return flagged.where(F.col("declining").isNotNull())


def deleveraging_by_phase(financials: DataFrame, companies: DataFrame, macro: DataFrame) -> DataFrame:
    """Per year and GDP phase: firms and share of firms whose debt fell twice running.

    Counted per (year, country) before the phase is joined, so only a few rows meet."""
    counts = debt_declines(financials, companies).groupBy("year", "country_id").agg(
        F.count("*").alias("n"), F.sum("declining").alias("k")
    )
    phases = macro_plans.gdp_phase(macro).select("year", "country_id", "gdp_phase")
    return (
        counts.join(phases, ["year", "country_id"], "left")
        .groupBy("year", "gdp_phase")
        .agg(F.sum("n").alias("total_companies"), F.sum("k").alias("deleveraging_companies"))
        .withColumn("deleveraging_pct", F.round(share_pct(F.col("deleveraging_companies"), F.col("total_companies")), 1))
        .orderBy("year", "gdp_phase")
    )


def deleveraging_by_year(financials: DataFrame, companies: DataFrame) -> DataFrame:
    return (
        debt_declines(financials, companies)
        .groupBy("year")
        .agg(F.count("*").alias("companies"), F.sum("declining").alias("deleveraging"))
        .withColumn("pct", F.round(share_pct(F.col("deleveraging"), F.col("companies")), 1))
        .orderBy("year")
    )


def deleveraging_by_sector(financials: DataFrame, companies: DataFrame) -> DataFrame:
    """Per year and sector: firms whose debt/revenue fell twice running."""
    flagged = with_monotone_decline(debt_to_revenue(financials, companies), "company_id", "year", "debt_to_revenue")
    return (
        flagged.where(F.col("declining") == 1)
        .groupBy("year", "gics_sector_name")
        .agg(F.count("*").alias("deleveraging_companies"), F.count("*").alias("count_by_sector"))
        .orderBy("year", F.desc("count_by_sector"), "gics_sector_name")
    )


def coverage_with_rates(financials: DataFrame, companies: DataFrame, rates: DataFrame) -> DataFrame:
    """Firm-years with interest coverage and the mean policy rate of the firm's country.

    Joining on (country, year) would put most firms on a handful of keys, so the
    rate table, one row per country and year, is the broadcast side.
    """
    policy = macro_plans.yearly_rate(rates, "POLICY_RATE", "policy_rate")
    rows = statements(financials, companies).where(F.col("ebitda").isNotNull() & (F.col("interest_expense") > 0))
    rows = rows.withColumn("icr", positive_ratio("ebitda", "interest_expense"))
    return rows.join(broadcast_bounded(policy, country_periods(1)), ["country_id", "year"])


def latest_correlation(
    financials: DataFrame, companies: DataFrame, rates: DataFrame, window: int = 5, min_years: int = 10,
) -> DataFrame:
    """Per firm with enough history: its latest complete rolling correlation of coverage with rates."""
    firm = ["company_id", "company_name", "gics_sector_name", "country_id"]
    panel = coverage_with_rates(financials, companies, rates).select(*firm, "year", "icr", "policy_rate")
    panel = with_rolling(panel, "company_id", "year", "icr", window, "icr")
    panel = with_rolling_correlation(panel, "company_id", "year", "icr", "policy_rate", window)
    panel = with_period_count(panel, "company_id", "year", "total_years_data")
    full = panel.where((F.col("icr_count") == window) & (F.col("total_years_data") >= min_years))
    return latest_per_entity(full, firm, "year", ["total_years_data", "icr_mean", "roll_corr"])


def rate_sensitivity(
    financials: DataFrame, companies: DataFrame, rates: DataFrame,
    window: int = 5, min_years: int = 10, limit: int = 50,
) -> DataFrame:
    """The firms with the lowest correlation of interest coverage with the policy rate."""
    return (
        latest_correlation(financials, companies, rates, window, min_years)
        .where(F.col("roll_corr").isNotNull())
        .orderBy("roll_corr", "company_id")
        .limit(limit)
        .select(
            "company_name", "gics_sector_name", "country_id", "total_years_data",
            F.round("icr_mean", 2).alias("avg_icr_recent_5y"),
            F.round("roll_corr", 4).alias("correlation_with_policy_rate"),
            band("roll_corr", SENSITIVITY_BANDS, "Positively Correlated").alias("rate_sensitivity_classification"),
        )
    )


def rate_correlation_all(
    financials: DataFrame, companies: DataFrame, rates: DataFrame, window: int = 5, min_rows: int = 10,
) -> DataFrame:
    """Every firm with at least ``min_rows`` rows of history, with the year of its latest window."""
    panel = coverage_with_rates(financials, companies, rates)
    enough = panel.groupBy("company_id").agg(F.count("*").alias("rows")).where(F.col("rows") >= min_rows)
    kept = panel.join(enough, "company_id", "left_semi").select("company_id", "company_name", "year", "icr", "policy_rate")
    rolled = with_rolling_correlation(kept, "company_id", "year", "icr", "policy_rate", window)
    full = rolled.where(F.col("roll_count") == window)
    latest = latest_per_entity(full, ["company_id", "company_name"], "year", ["roll_corr"])
    return latest.select(
        "company_name", F.col("year").alias("latest_year"), F.round("roll_corr", 4).alias("rolling_correlation")
    ).orderBy("rolling_correlation", "company_name")
