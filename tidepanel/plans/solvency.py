"""Persistent low coverage, rate shocks and geographic concentration of risk."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepanel.functions.scalars import positive_ratio, ratio, share_pct
from tidepanel.functions.periods import in_years
from tidepanel.operators.panel import with_streak
from tidepanel.plans import macro as macro_plans
from tidepanel.plans.leverage import statements

THRESHOLD = 1.5


def coverage(financials: DataFrame, companies: DataFrame, period_type: str | None = "ANNUAL") -> DataFrame:
    """Statements with a positive interest expense and their interest coverage."""
    rows = statements(financials, companies, period_type)
    rows = rows.where(F.col("ebitda").isNotNull() & (F.col("interest_expense") > 0))
    return rows.withColumn("icr", positive_ratio("ebitda", "interest_expense"))


def persistent_zombies(
    financials: DataFrame, companies: DataFrame, macro: DataFrame, threshold: float = THRESHOLD, years: int = 3,
) -> DataFrame:
    """Per year and country with falling GDP growth: firms below the threshold ``years`` rows running.

    Firms are counted per (year, country) first; the macro rows join the counts."""
    rows = with_streak(coverage(financials, companies), "company_id", "year", F.col("icr") < threshold, years)
    counts = rows.where(F.col("streak") >= years).groupBy("year", "country_id").agg(F.count("*").alias("n"))
    trend = macro_plans.gdp_trend(macro).where(F.col("gdp_change") < 0)
    return (
        counts.join(trend, ["country_id", "year"])
        .select(
            "year", "country_id", F.col("n").alias("total_companies_analyzed"), F.col("n").alias("persistent_zombies"),
            F.round("gdp_growth", 2).alias("avg_gdp_growth"), F.round("gdp_change", 2).alias("gdp_trend"),
        )
        .orderBy("year", F.desc("persistent_zombies"), "country_id")
    )


def zombies_by_sector(financials: DataFrame, companies: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Per year and sector: firms below the threshold in that year."""
    return (
        coverage(financials, companies)
        .where(F.col("icr") < threshold)
        .groupBy("year", "gics_sector_name")
        .agg(F.count("*").alias("zombie_count"))
        .orderBy("year", F.desc("zombie_count"), "gics_sector_name")
    )


def zombies_all(
    financials: DataFrame, companies: DataFrame, threshold: float = THRESHOLD, rows_running: int = 3,
) -> DataFrame:
    """Per year and country over all period types, without a macro condition, with denominators."""
    rows = statements(financials, companies, period_type=None)
    low = F.coalesce((F.col("interest_expense") > 0) & (ratio("ebitda", "interest_expense") < threshold), F.lit(False))
    streaks = with_streak(rows, "company_id", ["period_end_date", "period_type"], low, rows_running)
    return (
        streaks.groupBy("year", "country_id")
        .agg(F.count("*").alias("total"), F.count_if(F.col("streak") >= rows_running).alias("zombies"))
        .orderBy("year", F.desc("zombies"), "country_id")
    )


def shocked(rows: DataFrame, shock_bp: Column | float = 200, floating_share: Column | float = 0.5) -> DataFrame:
    """Interest and coverage after the floating part of the debt reprices at once."""
    bp = F.lit(shock_bp) if not isinstance(shock_bp, Column) else shock_bp
    floating = F.lit(floating_share) if not isinstance(floating_share, Column) else floating_share
    rise = F.col("total_debt") * floating * (bp / F.lit(10000.0))
    return rows.withColumn("shocked_interest", F.col("interest_expense") + rise).withColumn(
        "shocked_icr", ratio("ebitda", "shocked_interest")
    )


def latest_coverage(
    financials: DataFrame, companies: DataFrame, year: int, require_debt: str | None = "known",
) -> DataFrame:
    """Coverage in one year; debt must be known, positive, or is not looked at (None)."""
    rows = coverage(financials.where(in_years("period_end_date", year, year)), companies)
    if require_debt == "known":
        rows = rows.where(F.col("total_debt").isNotNull())
    elif require_debt == "positive":
        rows = rows.where(F.col("total_debt") > 0)
    return rows


def rate_shock(
    financials: DataFrame, companies: DataFrame, year: int = 2024, shock_bp: float = 200, floating_share: float = 0.5,
    healthy: float = 2.0, threshold: float = THRESHOLD, require_debt: str = "known", min_firms: int = 0,
) -> DataFrame:
    """Per country: firms crossing the threshold under the shock, mean coverage before and after."""
    rows = shocked(latest_coverage(financials, companies, year, require_debt), shock_bp, floating_share)
    falls = F.col("shocked_icr") < threshold
    return (
        rows.groupBy("country_id")
        .agg(
            F.count("*").alias("total_companies"),
            F.count_if((F.col("icr") >= healthy) & falls).alias("healthy_to_atrisk"),
            F.count_if((F.col("icr") >= threshold) & falls).alias("newly_distressed"),
            F.round(F.avg("icr"), 2).alias("avg_current_icr"),
            F.round(F.avg("shocked_icr"), 2).alias("avg_shocked_icr"),
            F.round(F.avg(F.col("icr") - F.col("shocked_icr")), 2).alias("avg_icr_decline"),
        )
        .where(F.col("total_companies") >= min_firms)
        .orderBy(F.desc("newly_distressed"), "country_id")
    )


def scenario_grid(
    financials: DataFrame, companies: DataFrame, year: int,
    shocks_bp: list[float], floating_shares: list[float], threshold: float = THRESHOLD,
) -> DataFrame:
    """The shock for several scenarios at once: each firm row carries its scenarios in
    a constant array, so no join is needed and the table is read once."""
    scenarios = F.array(*[
        F.struct(F.lit(float(bp)).alias("shock_bp"), F.lit(float(share)).alias("floating_share"))
        for bp in shocks_bp for share in floating_shares
    ])
    rows = latest_coverage(financials, companies, year).withColumn("s", F.explode(scenarios)).select("*", "s.*")
    rows = shocked(rows, F.col("shock_bp"), F.col("floating_share"))
    return (
        rows.groupBy("shock_bp", "floating_share")
        .agg(
            F.count("*").alias("total_companies"),
            F.count_if((F.col("icr") >= threshold) & (F.col("shocked_icr") < threshold)).alias("newly_distressed"),
            F.round(F.avg("shocked_icr"), 4).alias("avg_shocked_icr"),
        )
        .orderBy("shock_bp", "floating_share")
    )


def geographic_risk(
    financials: DataFrame, companies: DataFrame, macro: DataFrame, year: int = 2024,
    threshold: float = THRESHOLD, unit_scale: float = 1000000.0,
) -> DataFrame:
    """Per country: share of firms below the threshold, and their debt against nominal GDP."""
    low = F.col("icr") < threshold
    firms = latest_coverage(financials, companies, year, require_debt=None).groupBy("country_id").agg(
        F.count("*").alias("total_companies"), F.count_if(low).alias("zombie_count"),
        F.sum(F.when(low, F.col("total_debt")).otherwise(0.0)).alias("debt"),
    )
    gdp = (
        macro_plans.series(macro, macro_plans.NOMINAL_GDP)
        .where(in_years("indicator_date", year, year))
        .groupBy("country_id")
        .agg(F.avg("indicator_value").alias("gdp"))
    )
    debt_bn = F.col("debt") / F.lit(unit_scale)
    return (
        firms.join(gdp, "country_id", "left")
        .select(
            "country_id", "total_companies", "zombie_count",
            F.round(share_pct(F.col("zombie_count"), F.col("total_companies")), 1).alias("zombie_pct"),
            F.round(debt_bn, 2).alias("zombie_debt_bn"),
            F.round("gdp", 0).alias("country_gdp_bn"),
            F.round(ratio(debt_bn, F.col("gdp")) * 100, 2).alias("zombie_debt_pct_gdp"),
        )
        .orderBy(F.desc("zombie_pct"), "country_id")
    )
