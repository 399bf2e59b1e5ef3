"""Macro lead-lag, revenue cyclicality and downturn resilience."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepanel.functions import periods
from tidepanel.functions.aggregates import correlation, string_list
from tidepanel.functions.scalars import ratio, share_pct
from tidepanel.operators.panel import latest_per_entity, with_growth, with_lags, with_period_count, with_rolling
from tidepanel.operators.ranking import with_ntile
from tidepanel.plans import macro as macro_plans
from tidepanel.plans.leverage import statements

# Sectors with housing exposure and the labels of the quartiles.
HOUSING_SECTORS = ["Consumer Discretionary", "Materials", "Industrials"]
QUARTILE_LABELS = {
    1: "Low Volatility (Defensive)",
    2: "Below Average",
    3: "Above Average",
    4: "High Volatility (Cyclical)",
}


def revenue_growth(
    financials: DataFrame, companies: DataFrame, period_type: str, exclude_sector: str | None = None,
    sectors: list[str] | None = None, required: tuple[str, ...] = ("revenue",),
) -> DataFrame:
    """Statements with revenue growth to the firm's previous row that has the required measures."""
    rows = statements(financials, companies, period_type, exclude_sector)
    if sectors:
        rows = rows.where(F.col("gics_sector_name").isin(sectors))
    for measure in required:
        rows = rows.where(F.col(measure).isNotNull())
    return with_growth(rows, "company_id", "period_end_date", "revenue", "rev_growth")


def _bucketed(rows: DataFrame, frequency: str) -> tuple[DataFrame, str]:
    if frequency == "QUARTERLY":
        return rows.withColumn("quarter_start", periods.quarter_start("period_end_date")), "quarter_start"
    return rows, "year"


def _mean_series(macro: DataFrame, pattern: str, frequency: str, value: str) -> DataFrame:
    if frequency == "QUARTERLY":
        return macro_plans.quarterly(macro, pattern, value)
    return macro_plans.yearly(macro, pattern, value)


def housing_lead(
    financials: DataFrame, companies: DataFrame, macro: DataFrame, frequency: str = "QUARTERLY",
    lag: int = 2, sectors: list[str] = HOUSING_SECTORS,
) -> DataFrame:
    """Per sector and country: mean revenue growth beside mean lagged housing starts.

    Growth is summed per (sector, country, period) before the macro rows join."""
    required = ("revenue",) if frequency == "QUARTERLY" else ()
    growth, bucket = _bucketed(revenue_growth(financials, companies, frequency, sectors=sectors, required=required), frequency)
    cells = growth.where(F.col("rev_growth").isNotNull()).groupBy("gics_sector_name", "country_id", bucket).agg(
        F.count("*").alias("n"), F.sum("rev_growth").alias("total")
    )
    housing = _mean_series(macro, macro_plans.HOUSING_STARTS, frequency, "starts")
    housing = with_lags(housing, "country_id", bucket, "starts", [lag]).where(F.col(f"starts_lag{lag}").isNotNull())
    return (
        cells.join(housing, ["country_id", bucket])
        .groupBy("gics_sector_name", "country_id")
        .agg(
            F.sum("n").alias("observations"),
            F.round(F.sum("total") / F.sum("n"), 2).alias("avg_revenue_growth_pct"),
            F.round(F.sum(F.col("n") * F.col(f"starts_lag{lag}")) / F.sum("n"), 2).alias("avg_housing_lag_2q"),
        )
        .orderBy("gics_sector_name", "country_id")
    )


def firm_volatility(financials: DataFrame, companies: DataFrame, window: int = 10, min_years: int = 10) -> DataFrame:
    """Per firm: deviation and mean of revenue growth over its latest complete window."""
    rows = revenue_growth(financials, companies, "ANNUAL")
    rows = with_rolling(rows, "company_id", "year", "rev_growth", window)
    rows = with_period_count(rows, "company_id", "year", "total_years_data")
    full = rows.where(
        F.col("rev_growth").isNotNull() & (F.col("roll_count") == window) & (F.col("total_years_data") >= min_years)
    )
    firm = ["company_id", "company_name", "gics_sector_name", "country_id"]
    latest = latest_per_entity(full, firm, "year", ["total_years_data", "roll_std", "roll_mean"])
    return latest.where(F.col("roll_std").isNotNull()).select(
        *firm, "total_years_data", F.col("roll_std").alias("volatility"), F.col("roll_mean").alias("avg_growth")
    )


def firm_quartiles(financials: DataFrame, companies: DataFrame, window: int = 10, min_years: int = 10) -> DataFrame:
    firms = firm_volatility(financials, companies, window, min_years)
    return with_ntile(firms, 4, "volatility", "company_id", "volatility_quartile")


def volatility_quartiles(
    financials: DataFrame, companies: DataFrame, window: int = 10, min_years: int = 10, with_sectors: bool = True,
) -> DataFrame:
    """Quartiles of firms by volatility of revenue growth, with labels and means."""
    labels = F.create_map(*[F.lit(x) for pair in QUARTILE_LABELS.items() for x in pair])
    sectors = [string_list("gics_sector_name", distinct=True, sep=",").alias("sectors_represented")] if with_sectors else []
    out = firm_quartiles(financials, companies, window, min_years).groupBy("volatility_quartile").agg(
        F.count("*").alias("company_count"), *sectors,
        F.round(F.avg("volatility"), 2).alias("avg_volatility"),
        F.round(F.avg("avg_growth"), 2).alias("avg_growth_rate"),
    )
    return out.select(
        "volatility_quartile",
        F.element_at(labels, F.col("volatility_quartile").cast("int")).alias("classification"),
        *[c for c in out.columns if c != "volatility_quartile"],
    ).orderBy("volatility_quartile")


def volatility_by_sector(financials: DataFrame, companies: DataFrame, min_rows: int = 10) -> DataFrame:
    """Per sector: mean, least and greatest full-history deviation of firms' revenue growth."""
    known = companies.where(F.col("gics_sector_name").isNotNull())
    firms = (
        revenue_growth(financials, known, "ANNUAL")
        .where(F.col("rev_growth").isNotNull())
        .groupBy("company_id", "gics_sector_name")
        .agg(F.count("*").alias("rows"), F.abs(F.stddev_pop("rev_growth")).alias("vol"))
        .where(F.col("rows") >= min_rows)
    )
    return (
        firms.groupBy("gics_sector_name")
        .agg(
            F.count("*").alias("companies"), F.avg("vol").alias("avg_vol"),
            F.min("vol").alias("min_vol"), F.max("vol").alias("max_vol"),
        )
        .orderBy("avg_vol", "gics_sector_name")
    )


def downturn_resilience(
    financials: DataFrame, companies: DataFrame, macro: DataFrame, frequency: str = "QUARTERLY",
) -> DataFrame:
    """Per country and contraction period: firms with falling revenue but positive free cash flow.

    Firms are counted per (country, period) before the contraction periods join."""
    growth, bucket = _bucketed(
        revenue_growth(financials, companies, frequency, "Financials", required=("revenue", "free_cash_flow")), frequency
    )
    resilient = (F.col("rev_growth") < 0) & (F.col("free_cash_flow") > 0)
    counts = growth.where(F.col("rev_growth").isNotNull()).groupBy("country_id", bucket).agg(
        F.count("*").alias("total_companies"), F.count_if(resilient).alias("resilient_companies")
    )
    contraction = _mean_series(macro, macro_plans.REAL_GDP_YOY, frequency, "gdp_growth").where(F.col("gdp_growth") < 0)
    label = periods.year_quarter(bucket).alias("year_quarter") if frequency == "QUARTERLY" else F.col("year")
    return (
        counts.join(contraction, ["country_id", bucket])
        .orderBy(bucket, "country_id")
        .select(
            "country_id", label, F.round("gdp_growth", 2).alias("gdp_growth_pct"), "total_companies", "resilient_companies",
            F.round(share_pct(F.col("resilient_companies"), F.col("total_companies")), 1).alias("resilience_rate_pct"),
        )
    )


def housing_correlation(
    financials: DataFrame, companies: DataFrame, macro: DataFrame, lags: list[int] = [0, 1, 2, 3, 4],
    sectors: list[str] = HOUSING_SECTORS,
) -> DataFrame:
    """Extension. Per sector and lag: correlation of lagged housing starts with mean revenue
    growth, over (country, quarter) cells."""
    growth, bucket = _bucketed(revenue_growth(financials, companies, "QUARTERLY", sectors=sectors), "QUARTERLY")
    cells = growth.where(F.col("rev_growth").isNotNull()).groupBy("gics_sector_name", "country_id", bucket).agg(
        F.avg("rev_growth").alias("growth")
    )
    starts = macro_plans.quarterly(macro, macro_plans.HOUSING_STARTS, "starts")
    lagged = with_lags(starts, "country_id", bucket, "starts", lags)
    long = lagged.unpivot(["country_id", bucket], [f"starts_lag{k}" for k in lags], "series", "lagged_starts")
    long = long.withColumn("lag", F.regexp_extract("series", r"(\d+)$", 1).cast("int")).where(F.col("lagged_starts").isNotNull())
    return (
        cells.join(long, ["country_id", bucket])
        .groupBy("gics_sector_name", "lag")
        .agg(F.count("*").alias("cells"), F.round(correlation("lagged_starts", "growth"), 6).alias("correlation"))
        .orderBy("gics_sector_name", "lag")
    )


def quartile_by_phase(
    financials: DataFrame, companies: DataFrame, macro: DataFrame, window: int = 10, min_years: int = 10,
) -> DataFrame:
    """Extension. Mean revenue growth of each volatility quartile by GDP phase."""
    quartiles = firm_quartiles(financials, companies, window, min_years).select("company_id", "volatility_quartile")
    growth = revenue_growth(financials, companies, "ANNUAL").where(F.col("rev_growth").isNotNull())
    cells = growth.join(quartiles, "company_id").groupBy("volatility_quartile", "country_id", "year").agg(
        F.count("*").alias("n"), F.sum("rev_growth").alias("total")
    )
    phases = macro_plans.gdp_phase(macro).select("country_id", "year", "gdp_phase")
    return (
        cells.join(phases, ["country_id", "year"])
        .groupBy("volatility_quartile", "gdp_phase")
        .agg(F.sum("n").alias("observations"), F.round(ratio(F.sum("total"), F.sum("n")), 4).alias("avg_growth"))
        .orderBy("volatility_quartile", "gdp_phase")
    )
